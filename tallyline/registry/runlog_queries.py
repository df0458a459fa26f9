"""Audit-log statistics."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.operators import runlog
from tallyline.registry.base import Inputs, query
from tallyline.registry.sql import mean, pct, sql
from tallyline.sources.tables import new_path

# The events span 30 days, so an as-of date past their end leaves some days out.
AS_OF = dt.date(2024, 2, 10)
RECENT = f"run_date >= DATE '{AS_OF - dt.timedelta(days=30)}'"
DONE, BAD = "status = 'Completed'", "status = 'Failed'"
SINCE, UNTIL = dt.date(2024, 1, 5), dt.date(2024, 1, 20)


def _share(part: str, whole: str) -> str:
    return f"coalesce({pct(part, whole, 4)}, 0)"


def events(src: Inputs) -> DataFrame:
    """Opening and closing events of every run, appended to one table."""
    path = new_path(src.spark, "run-log")
    log = src.run_log()
    runlog.append(runlog.started_events(log), path)
    runlog.append(log, path)
    return src.spark.read.schema(log.schema).parquet(path)


@query(
    "log_append",
    sql("""SELECT stage, 'Started' AS status, count(*) AS event_count, cast(0 AS bigint)
            AS records_processed FROM run_log GROUP BY stage
        UNION ALL SELECT stage, status, count(*), cast(sum(records_processed) AS bigint)
        FROM run_log GROUP BY stage, status""", "run_log"),
)
def log_append(src: Inputs) -> DataFrame:
    return events(src).groupBy("stage", "status").agg(
        F.count("*").alias("event_count"),
        F.coalesce(F.sum("records_processed"), F.lit(0)).alias("records_processed"),
    )


@query(
    "log_current",
    sql("SELECT log_id, run_date, stage, status, records_processed FROM run_log", "run_log"),
)
def log_current(src: Inputs) -> DataFrame:
    return runlog.current_state(events(src)).select(
        "log_id", "run_date", "stage", "status", "records_processed"
    )


@query(
    "log_success_rate",
    sql(f"""SELECT count(*) AS total_runs, count_if({DONE}) AS successful_runs,
        {_share(f'count_if({DONE})', 'count(*)')} AS success_rate_pct,
        count_if({RECENT}) AS total_runs_30d, count_if({RECENT} AND {DONE}) AS successful_runs_30d,
        {_share(f'count_if({RECENT} AND {DONE})', f'count_if({RECENT})')} AS success_rate_30d_pct
        FROM run_log""", "run_log"),
)
def log_success_rate(src: Inputs) -> DataFrame:
    return runlog.success_rate(src.run_log(), AS_OF)


@query(
    "log_failed_runs",
    sql(f"""SELECT count_if({BAD}) AS failed_runs,
        count_if({BAD} AND {RECENT}) AS failed_runs_30d FROM run_log""", "run_log"),
)
def log_failed_runs(src: Inputs) -> DataFrame:
    return runlog.failed_runs(src.run_log(), AS_OF)


@query(
    "log_duration",
    sql("""SELECT log_id, CASE WHEN log_id % 50 = 7
            THEN datediff('second', start_time, (SELECT max(start_time) FROM run_log))
            ELSE duration_seconds END AS duration_seconds FROM run_log""", "run_log"),
)
def log_duration(src: Inputs) -> DataFrame:
    """Some runs are still open here; they last until the latest start in the log."""
    log = src.run_log()
    still_open = F.when(F.col("log_id") % 50 != 7, F.col("end_time"))
    latest = log.agg(F.max("start_time").alias("t")).scalar()
    return runlog.with_duration(log.withColumn("end_time", still_open), latest).select(
        "log_id", "duration_seconds"
    )


@query(
    "log_averages",
    sql(f"""SELECT {mean('duration_seconds', 4)} AS avg_duration_seconds,
        {mean('records_processed', 4)} AS avg_records FROM run_log""", "run_log"),
)
def log_averages(src: Inputs) -> DataFrame:
    return runlog.averages(src.timed_log())


_STAGE_STATS = f"""SELECT stage, count(*) AS runs, count_if({DONE}) AS successful_runs,
    count_if({BAD}) AS failed_runs, {mean('duration_seconds', 4)} AS avg_duration_seconds,
    {mean('records_processed', 4)} AS avg_records FROM run_log"""


@query("log_stage_stats", sql(f"{_STAGE_STATS} GROUP BY stage", "run_log"))
def log_stage_stats(src: Inputs) -> DataFrame:
    return runlog.stage_stats(src.timed_log())


@query(
    "log_daily_trend",
    sql(f"""SELECT run_date, count(*) AS runs,
        cast(sum(duration_seconds) AS bigint) AS duration_seconds,
        cast(sum(records_processed) AS bigint) AS records_processed,
        count_if({BAD}) AS failed_runs, count_if(duration_seconds < 2) AS early_failures
        FROM run_log GROUP BY run_date""", "run_log"),
)
def log_daily_trend(src: Inputs) -> DataFrame:
    return runlog.daily_trend(src.timed_log())


@query(
    "log_staging_extract",
    sql(f"""SELECT log_id, run_date, status, records_processed,
        CASE WHEN {DONE} THEN 'Staging complete' END AS message
        FROM run_log WHERE stage = 'Staging'""", "run_log"),
)
def log_staging_extract(src: Inputs) -> DataFrame:
    return runlog.staging_extract(src.run_log())


def _quality_sql(rejected: str) -> str:
    loaded = (
        f"coalesce(sum(records_processed) FILTER (stage = 'Staging' AND {DONE}), 0)"
    )
    seen = f"coalesce(sum(records_processed) FILTER (stage = 'Staging'), 0) + {rejected}"
    return (
        f"cast({loaded} AS bigint) AS completed_records, cast({seen} AS bigint) AS all_records, "
        f"{_share(loaded, f'({seen})')} AS quality_score_pct"
    )


@query(
    "log_quality_score",
    sql(f"SELECT {_quality_sql('(SELECT count_if(is_bad) FROM tagged)')} FROM run_log",
        "run_log", "tagged"),
)
def log_quality_score(src: Inputs) -> DataFrame:
    from tallyline.operators.ingest import rejected

    bad = rejected(src.parsed("part")).agg(F.count("*").alias("n")).scalar()
    return runlog.quality_score(src.run_log(), bad)


@query(
    "log_quality_trend",
    sql(f"""SELECT run_date, {_quality_sql('0')} FROM run_log WHERE {RECENT}
        GROUP BY run_date""", "run_log"),
)
def log_quality_trend(src: Inputs) -> DataFrame:
    return runlog.quality_trend(src.run_log(), AS_OF)


@query(
    "log_staging_success",
    sql(f"SELECT count(*) AS staging_success FROM run_log WHERE stage = 'Staging' AND {DONE}",
        "run_log"),
)
def log_staging_success(src: Inputs) -> DataFrame:
    return runlog.staging_success(src.run_log())


@query(
    "log_run_table",
    sql("""SELECT log_id, run_date, stage, status, records_processed, duration_seconds
        FROM run_log ORDER BY log_id DESC""", "run_log"),
)
def log_run_table(src: Inputs) -> DataFrame:
    return runlog.run_table(src.timed_log()).select(
        "log_id", "run_date", "stage", "status", "records_processed", "duration_seconds"
    )


@query(
    "log_status_flag",
    sql(f"""SELECT log_id, status, CASE WHEN {DONE} THEN 'ok' ELSE 'alert' END AS status_flag,
        duration_seconds < 2 AS ended_early FROM run_log""", "run_log"),
)
def log_status_flag(src: Inputs) -> DataFrame:
    return runlog.status_flags(src.timed_log())


@query(
    "log_rows_loaded",
    sql("""SELECT cast(coalesce(sum(records_processed) FILTER (stage = 'Staging'), 0) AS bigint)
        AS rows_loaded FROM run_log""", "run_log"),
)
def log_rows_loaded(src: Inputs) -> DataFrame:
    return runlog.rows_loaded(src.run_log())


@query(
    "log_sliced",
    sql(f"""{_STAGE_STATS} WHERE run_date BETWEEN DATE '{SINCE}' AND DATE '{UNTIL}'
        AND stage = 'Reporting' AND {DONE} GROUP BY stage""", "run_log"),
)
def log_sliced(src: Inputs) -> DataFrame:
    log = runlog.sliced(src.timed_log(), SINCE, UNTIL, "Reporting", "Completed")
    return runlog.stage_stats(log)
