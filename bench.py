"""Headline timings as one JSON line.

The four stages run over raw sales files derived from the test tables (written before the
clock starts), then the main queries over the test tables. ``BENCH_SF_DIR`` and
``BENCH_CPUS`` select the data and the number of threads.
"""

from __future__ import annotations

import datetime as dt
import json
import os
import time

from tallyline.plans import jobs
from tallyline.registry import QUERIES
from tallyline.registry.base import Inputs
from tallyline.session import local_session
from tallyline.settings import Settings
from tallyline.sources.tables import new_path, write_csv
from tallyline.sources.warehouse import LOAD_ORDER, LOAD_TYPES, TEST_DOMAINS

HEADLINE = (
    "core_sales", "rpt_monthly_revenue", "vw_revenue_trends", "vw_regional_performance",
    "vw_product_analysis", "core_summary", "dq_check_report", "dq_null_counts",
    "dedup_keep_first", "rpt_anomalies", "exec_summary", "metric_rollup_all_days",
    "log_stage_stats",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, "bench")
    spark.sparkContext.setLogLevel("ERROR")
    src = Inputs(spark, folder)
    raw = new_path(spark, "bench-csv")
    write_csv(src.sales_raw(), raw)
    rows = spark.read.option("header", True).csv(raw).count()

    timings: dict[str, float] = {}
    results = jobs.run_all(
        spark, raw, new_path(spark, "bench-run"), dt.date(2024, 1, 31),
        settings=Settings(domains=TEST_DOMAINS), order=LOAD_ORDER, order_types=LOAD_TYPES,
    ).collect()
    for row in results:
        if not row.success:
            raise RuntimeError(f"stage {row.stage} failed: {row.error}")
        timings[f"stage_{row.stage}"] = round(row.seconds, 3)
    for name in HEADLINE:
        began = time.monotonic()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.monotonic() - began, 3)
    print(json.dumps({
        "metric": "stages and headline queries, total",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
        "fact_rows": rows,
        "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
