"""The batch jobs: daily extract, layer transformation, metric roll-up, full run.

A stage writes its layers aside, reads the next layer from there, so the fact is computed once
and marts, views and detection share the written copy, and publishes them together at its end.
Readers of the run folder see the tables of before or all of the new ones. Rows are counted by
the jobs that write them.
"""

from __future__ import annotations

import datetime as dt
import secrets
import time
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline.operators import anomalies, core, ingest, kpis, marts, metrics, runlog, staging
from tallyline.operators import views
from tallyline.schemas import OPERATIONAL, STAGED_SALES
from tallyline.session import compile_wide_projections
from tallyline.settings import Settings
from tallyline.sources.operational import extract_day
from tallyline.sources.sales_csv import read_sales_csv, require_columns
from tallyline.sources.snapshots import NoSuchTable, TableStore, Transaction
from tallyline.sources.tables import (
    conform,
    forget_shuffles,
    replace_day,
    row_counts,
    staging_scope,
    write_csv,
)

FEW_TASKS = 32
STAGES = ("ingest", "transform", "anomaly", "report")
# A load has one load time, so the other columns decide which copy of an id is the first.
FIRST_LOADED = ("loaded_at", *(
    c for c in STAGED_SALES.fieldNames()
    if c not in ("transaction_id", "source_system", "loaded_at")
))


def _now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


@dataclass(frozen=True)
class RunFolder:
    """One run's published tables, and paths of its other files."""

    root: str

    def table(self, name: str) -> str:
        return f"{self.root}/{name}"

    def store(self, spark: SparkSession) -> TableStore:
        return TableStore(spark, self.root)

    def read(self, spark: SparkSession, name: str) -> DataFrame:
        return self.store(spark).read(name)


def stamped(df: DataFrame, name: str, at: dt.datetime) -> DataFrame:
    """The time of the batch on each of its rows."""
    return df.withColumn(name, F.lit(at).cast("timestamp"))


def write_each(frames: dict[str, DataFrame], transaction: Transaction) -> int:
    """Write independent small tables as concurrent Spark jobs; returns their total rows."""
    if not frames:
        return 0
    with ThreadPoolExecutor(len(frames)) as pool:
        return sum(pool.map(lambda name: transaction.write(name, frames[name]), frames))


class AuditLog:
    """Writes a Started event and then Completed or Failed around a piece of work."""

    def __init__(self, spark: SparkSession, path: str, run_date: dt.date):
        self.spark, self.path, self.run_date = spark, path, run_date

    def run(self, stage: str, work: Callable[[], int]) -> int:
        # Ordered by time; the last bits tell runs apart that begin at the same moment.
        start, log_id = _now(), time.time_ns() // 1000 << 10 | secrets.randbits(10)

        def write(status: str, **fields) -> None:
            line = runlog.event(
                self.spark, log_id, self.run_date, stage, status, start, **fields
            )
            runlog.append(line, self.path)

        write("Started", message=f"{stage} initiated")
        try:
            records = work()
        except Exception as error:
            write("Failed", end_time=_now(), error=str(error))
            raise
        write("Completed", end_time=_now(), records=records, message=f"{stage} complete")
        runlog.compact(self.spark, self.path)
        return records


def daily_extract(
    source: DataFrame, day: dt.date, table: str, log: AuditLog
) -> int:
    """Stage one day of the operational source, replacing that day only.

    A day that the source no longer has becomes empty.
    """

    def work() -> int:
        return replace_day(extract_day(source, day), table, "record_date", day)

    return log.run("Extraction", work)


def metric_rollup(
    spark: SparkSession, staged_table: str, summary_table: str, day: dt.date,
    created_at: dt.datetime | None = None,
) -> int:
    """Summarise one staged day into the summary table, replacing that day only; returns the
    rows written."""
    staged = spark.read.schema(OPERATIONAL).parquet(staged_table)
    with staging_scope(spark):
        summary = metrics.daily_rollup(staged, day, tie_break=("staging_id",))
        summary = stamped(summary, "created_at", created_at or _now())
        return replace_day(summary, summary_table, "report_date", day)


def clean_staging(
    staged: DataFrame, settings: Settings = Settings(), order: Sequence[str] = FIRST_LOADED
) -> DataFrame:
    """Invalid rows out, then duplicates out, then repairs and canonical text.

    The invalid rows leave first: rows without an id would otherwise be one huge key, and an
    invalid copy would displace a valid one. (Staging filled by ``ingest`` has none.)
    """
    valid = staging.remove_invalid(staged)
    single = staging.deduplicate(valid, settings.dedup, "transaction_id", order)
    return ingest.standardise(ingest.repair(single), settings.domains)


def transform_layers(
    staged: DataFrame,
    folder: RunFolder,
    settings: Settings = Settings(),
    order: Sequence[str] = FIRST_LOADED,
    log: AuditLog | None = None,
    at: dt.datetime | None = None,
) -> dict[str, DataFrame]:
    """Staging to core to marts, each written once, all published at the end.

    The fact is partitioned by year, so slices by year read their years only.
    """
    at = at or _now()
    store = folder.store(staged.sparkSession)

    def run(stage: str, work: Callable[[], int]) -> int:
        return log.run(stage, work) if log else work()

    with store.begin() as txn:

        def to_core() -> int:
            fact = stamped(core.enrich(txn.read("stg_sales_clean")), "transformed_at", at)
            # Many tasks would each leave a file per year. Their rows are dealt by year then, and
            # large years split.
            if fact.rdd.getNumPartitions() > FEW_TASKS:
                fact = fact.hint("rebalance", F.col("txn_year"))
            return txn.write("core_sales", fact, partition_by="txn_year")

        def to_marts() -> int:
            txn.write("revenue_cube", marts.revenue_cube(txn.read("core_sales")))
            made = marts.all_marts(txn.read("revenue_cube"))
            return write_each({n: stamped(df, "refreshed_at", at) for n, df in made.items()}, txn)

        run("Staging", lambda: txn.write("stg_sales_clean", clean_staging(staged, settings, order)))
        # The copies that deduplication has shuffled are the largest files of the run.
        forget_shuffles(staged.sparkSession)
        run("Transformation", to_core)
        run("Reporting", to_marts)
    return {name: txn.read(name) for name in ("stg_sales_clean", "core_sales", *made_marts())}


def made_marts() -> tuple[str, ...]:
    return ("rpt_monthly_revenue", "rpt_regional_summary", "rpt_product_summary")


def reports(spark: SparkSession, folder: RunFolder) -> dict[str, DataFrame]:
    """The five report tabs from the tables of one snapshot, without their stamps."""
    published = folder.store(spark).snapshot()

    def table(name: str) -> DataFrame:
        return published.read(name).drop("transformed_at", "refreshed_at", "detected_at")

    fact = table("core_sales")
    trends = views.revenue_trends(table("rpt_monthly_revenue"))
    regional = views.regional_performance(table("rpt_regional_summary"), fact)
    return {
        "executive_summary": kpis.executive_summary(core.annual_core(fact)),
        "monthly_trends": kpis.report_monthly(trends),
        "regional_performance": kpis.report_regional(regional),
        "product_analysis": kpis.report_products(table("rpt_product_summary")),
        "anomaly_report": kpis.report_anomalies(table("rpt_anomalies")),
    }


def run_all(
    spark: SparkSession,
    raw_path: str,
    root: str,
    run_date: dt.date,
    stage: str = "all",
    settings: Settings = Settings(),
    order: Sequence[str] = FIRST_LOADED,
    loaded_at: dt.datetime | None = None,
    order_types: Mapping[str, str] | None = None,
) -> DataFrame:
    """Run the stages in order; returns ``(stage, success, records, rejected, seconds, error)``.

    Ingest writes what it cannot load, with the reasons, to ``stg_sales_rejects``, in the same
    pass. With ``stage="all"`` the run stops at the first stage that fails, by an error or by
    loading nothing. Running again over the same folder replaces the same tables; a stage that
    fails leaves them as they were. Every batch has one time in its stamp columns.

    ``order`` may name columns of the file that a staging row does not have. They are text, and
    compared as such, unless ``order_types`` gives their type.
    """
    compile_wide_projections(spark)
    folder = RunFolder(root)
    store = folder.store(spark)
    log = AuditLog(spark, folder.table("pipeline_log"), run_date)
    at = loaded_at or _now()

    def do_ingest() -> int:
        raw = require_columns(read_sales_csv(spark, raw_path))
        parsed = ingest.parse(raw, settings.date_formats)
        told = ingest.both_kinds(parsed, settings.domains, settings.source_system, at)
        beyond = [c for c in order if c not in STAGED_SALES.fieldNames()]
        form = T.StructType(list(STAGED_SALES.fields))
        for c in beyond:
            form.add(c, (order_types or {}).get(c, "string"))
        typed = conform(told, form, keep=["rejected", "is_rejected"])
        staged = typed.select(*STAGED_SALES.fieldNames(), *beyond).schema
        with store.begin() as txn:
            rows = txn.write_split(typed, "is_rejected", {
                False: ("stg_sales_raw", staged, None),
                True: ("stg_sales_rejects", typed.select("rejected").schema, "rejected"),
            })
        rejected["ingest"] = rows["stg_sales_rejects"]
        return rows["stg_sales_raw"]

    def do_transform() -> int:
        staged = folder.read(spark, "stg_sales_raw")
        with staging_scope(spark):
            transform_layers(staged, folder, settings, order, log, at)
        return store.snapshot().tables["core_sales"].extra["rows"]

    def do_anomaly() -> int:
        fact = folder.read(spark, "core_sales").select(
            "transaction_id", "txn_date", "product_name", "product_category", "region",
            "revenue", "cost", "discount_pct",
        )
        with staging_scope(spark), store.begin() as txn:
            found = anomalies.detect_all(fact, settings.anomaly)
            rows = txn.write("rpt_anomalies", stamped(found, "detected_at", at))
            write_csv(txn.read("rpt_anomalies").drop("detected_at"), folder.table("anomalies_csv"))
        return rows

    def do_report() -> int:
        with staging_scope(spark), store.begin() as txn:
            tabs = {f"report_{name}": df for name, df in reports(spark, folder).items()}
            return write_each(tabs, txn)

    rejected: dict[str, int] = {}
    steps = {
        "ingest": (do_ingest, True), "transform": (do_transform, False),
        "anomaly": (do_anomaly, False), "report": (do_report, False),
    }
    results = []
    for name in STAGES:
        if stage not in ("all", name):
            continue
        work, needs_rows = steps[name]
        began, error = time.monotonic(), None
        try:
            records = work()
            success = records > 0 or not needs_rows
        except Exception as problem:
            records, success, error = None, False, str(problem)
        seconds = time.monotonic() - began
        results.append((name, success, records, rejected.get(name), seconds, error))
        if not success and stage == "all":
            break
    store.expire(keep=len(STAGES) + 1)
    return spark.createDataFrame(
        results,
        "stage string, success boolean, records long, rejected long, seconds double, error string",
    )


def table_counts(spark: SparkSession, folder: RunFolder) -> DataFrame:
    """Row counts of the run's six tables, -1 for one that is not there."""
    published = folder.store(spark).snapshot()

    def find(name: str) -> DataFrame | None:
        try:
            return published.read(name)
        except NoSuchTable:
            return None

    names = (
        "stg_sales_raw", "core_sales", "rpt_monthly_revenue", "rpt_regional_summary",
        "rpt_product_summary", "rpt_anomalies",
    )
    return row_counts({name: find(name) for name in names})
