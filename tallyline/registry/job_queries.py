"""The batch jobs, run over the test tables in a new folder each time."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.plans import jobs
from tallyline.registry.base import Inputs, query
from tallyline.registry.core_queries import _SUMMARY_SQL
from tallyline.registry.source_queries import DAY, written_csv
from tallyline.registry.sql import sql
from tallyline.schemas import OPERATIONAL, REPORTING_SUMMARY, STAGED_SALES
from tallyline.settings import Settings
from tallyline.sources.tables import new_path
from tallyline.sources.warehouse import LOAD_ORDER, LOAD_TYPES, TEST_DOMAINS

SETTINGS = Settings(domains=TEST_DOMAINS)


@query(
    "daily_extract",
    sql(f"""SELECT record_date, entity_id, metric_name, metric_value, source_system
        FROM op_metrics WHERE record_date = DATE '{DAY}'""", "op_metrics"),
)
def daily_extract(src: Inputs) -> DataFrame:
    """The day is extracted twice; its rows are there once."""
    table = new_path(src.spark, "operational")
    log = jobs.AuditLog(src.spark, new_path(src.spark, "log"), DAY)
    for _ in range(2):
        jobs.daily_extract(src.op_metrics(), DAY, table, log)
    return src.spark.read.schema(OPERATIONAL).parquet(table).select(
        "record_date", "entity_id", "metric_name", "metric_value", "source_system"
    )


@query(
    "metric_rollup",
    sql(f"""SELECT * FROM ({_SUMMARY_SQL.format('''(SELECT * REPLACE (last_value(metric_value
            IGNORE NULLS) OVER (PARTITION BY entity_id, metric_name, record_date
            ORDER BY staging_id) AS metric_value) FROM gap_metrics)''')})
        WHERE report_date = DATE '{DAY}'""", "gap_metrics"),
)
def metric_rollup(src: Inputs) -> DataFrame:
    """The rows of the day have gaps and one load time, so their order is that of their ids."""
    staged, summary = new_path(src.spark, "operational"), new_path(src.spark, "summary")
    log = jobs.AuditLog(src.spark, new_path(src.spark, "log"), DAY)
    source = src.op_metrics(with_gaps=True).withColumn(
        "loaded_at", F.col("record_date").cast("timestamp"))
    jobs.daily_extract(source, DAY, staged, log)
    jobs.metric_rollup(src.spark, staged, summary, DAY)
    return src.spark.read.schema(REPORTING_SUMMARY).parquet(summary)


_CLEAN_COUNTS = """SELECT table_name, row_count,
    (SELECT cast(sum(revenue) AS decimal(38,2)) FROM clean_core) AS total_revenue FROM (
    SELECT 'stg_sales_clean' AS table_name, count(*) AS row_count FROM clean
    UNION ALL SELECT 'core_sales', count(*) FROM clean_core
    UNION ALL SELECT 'rpt_monthly_revenue', count(DISTINCT txn_month_label) FROM clean_core
    UNION ALL SELECT 'rpt_regional_summary', count(*)
        FROM (SELECT DISTINCT region, txn_year FROM clean_core)
    UNION ALL SELECT 'rpt_product_summary', count(*)
        FROM (SELECT DISTINCT product_category, product_name, txn_year FROM clean_core))"""


@query("transform_layers", sql(_CLEAN_COUNTS, "clean_core"))
def transform_layers(src: Inputs) -> DataFrame:
    staged = src.staged().select(*STAGED_SALES.fieldNames(), "l_partkey", "l_suppkey")
    folder = jobs.RunFolder(new_path(src.spark, "layers"))
    tables = jobs.transform_layers(staged, folder, SETTINGS, LOAD_ORDER)
    out = None
    for name, df in tables.items():
        money = "revenue" if "revenue" in df.columns else "total_revenue"
        one = df.agg(
            F.count("*").alias("row_count"),
            F.sum(money).cast("decimal(38,2)").alias("total_revenue"),
        ).select(F.lit(name).alias("table_name"), "row_count", "total_revenue")
        out = one if out is None else out.unionByName(one)
    return out


@query(
    "run_pipeline",
    sql("""SELECT 'ingest' AS stage, true AS success, count(*) AS records FROM staged
        UNION ALL SELECT 'transform', true, count(*) FROM clean_core
        UNION ALL SELECT 'anomaly', true, count(*) FROM anomalies
        UNION ALL SELECT 'report', true,
            (SELECT count(DISTINCT txn_year) FROM clean_core)
            + (SELECT count(DISTINCT txn_month_label) FROM clean_core)
            + (SELECT count(*) FROM (SELECT DISTINCT region, txn_year FROM clean_core))
            + (SELECT count(*) FROM (SELECT DISTINCT product_category, product_name, txn_year
                                     FROM clean_core))
            + (SELECT count(*) FROM anomalies)""", "staged", "clean_core", "anomalies"),
)
def run_pipeline(src: Inputs) -> DataFrame:
    """Raw files to reports. (No region has tied best reps here, so its tab has one row per
    region and year.)"""
    results = jobs.run_all(
        src.spark, written_csv(src), new_path(src.spark, "run"), dt.date(2024, 1, 31),
        settings=SETTINGS, order=LOAD_ORDER, order_types=LOAD_TYPES,
    )
    return results.select("stage", "success", "records")


@query(
    "ingest_rejects_table",
    sql("SELECT count_if(is_bad) AS rejected, count_if(NOT is_bad) AS loaded FROM tagged",
        "tagged"),
)
def ingest_rejects_table(src: Inputs) -> DataFrame:
    """What a run's ingest stage has loaded and written to its table of rejects."""
    folder = jobs.RunFolder(new_path(src.spark, "run"))
    jobs.run_all(
        src.spark, written_csv(src), folder.root, dt.date(2024, 1, 31), stage="ingest",
        settings=SETTINGS, order=LOAD_ORDER, order_types=LOAD_TYPES)
    bad, good = (folder.read(src.spark, n) for n in ("stg_sales_rejects", "stg_sales_raw"))
    tags = bad.select(F.size("reject_reasons").alias("n")).union(good.select(F.lit(0)))
    return tags.agg(
        F.count_if(F.col("n") > 0).alias("rejected"), F.count_if(F.col("n") == 0).alias("loaded"))
