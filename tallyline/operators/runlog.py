"""The audit log: append-only events, the current state of each run, and its statistics."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.functions.calendar import seconds_between
from tallyline.functions.numbers import mean, percent, zero_if_null
from tallyline.schemas import RUN_LOG
from tallyline.sources import files
from tallyline.sources.snapshots import Snapshot, StaleSnapshot, TableStore


def _completed() -> Column:
    return F.col("status") == "Completed"


def _failed() -> Column:
    return F.col("status") == "Failed"


def _last_30_days(as_of: dt.date | Column) -> Column:
    latest = as_of if isinstance(as_of, Column) else F.lit(as_of)
    return F.col("run_date") >= F.date_sub(latest, 30)


def event(
    spark: SparkSession,
    log_id: int,
    run_date: dt.date,
    stage: str,
    status: str,
    start_time: dt.datetime,
    end_time: dt.datetime | None = None,
    records: int | None = None,
    message: str | None = None,
    error: str | None = None,
) -> DataFrame:
    """One log event. A run writes Started, then Completed or Failed under the same id."""
    row = (log_id, run_date, stage, status, message, records, start_time, end_time, error)
    # Literals: rows from Python would need a Python worker for each event.
    return spark.range(1, numPartitions=1).select(*(
        F.lit(value).cast(field.dataType).alias(field.name)
        for value, field in zip(row, RUN_LOG.fields)
    ))


def append(events: DataFrame, path: str) -> None:
    """Add events; nothing is updated in place."""
    events.write.mode("append").parquet(path)


# Event files that may lie about before a run merges them.
LOOSE_FILES = 64


def _store(spark: SparkSession, path: str) -> TableStore:
    return TableStore(spark, f"{path}/_merged")


def _loose(spark: SparkSession, path: str, published: Snapshot) -> list[str]:
    """Event files that the merged table does not have."""
    merged = published.tables.get("events")
    done = set(merged.extra["files"]) if merged else set()
    return [f for f in files.data_files(spark, path) if f.rsplit("/", 1)[1] not in done]


def read(spark: SparkSession, path: str) -> DataFrame:
    """All events: the merged ones and those written since, each once."""
    published = _store(spark, path).snapshot()
    loose = _loose(spark, path, published)
    parts = [spark.read.schema(RUN_LOG).parquet(*loose)] if loose else []
    if "events" in published.tables:
        parts.append(published.read("events").select(*RUN_LOG.fieldNames()))
    if not parts:
        return spark.createDataFrame([], RUN_LOG)
    return reduce(DataFrame.unionByName, parts)


def compact(spark: SparkSession, path: str, most: int = LOOSE_FILES) -> int:
    """Merge event files once there are more than ``most``; returns how many were merged.

    The merged table and the list of the files in it are published in one snapshot. The files
    themselves go with the next merge, so that a reader who began before it still finds them. If
    two writers merge at once, one publishes and the other leaves no trace.
    """
    store = _store(spark, path)
    published = store.snapshot()
    loose = _loose(spark, path, published)
    if len(loose) <= most:
        return 0
    txn = store.begin()
    if txn.base.version != published.version:
        return 0
    # The table grows by one file per merge; now and then it is made one again.
    before = published.tables.get("events")
    grown = before is not None and sum(map(len, before.folders.values())) >= most
    # Files of the last merge are still there until this one is published.
    there = {f.rsplit("/", 1)[1] for f in files.data_files(spark, path)}
    last = [n for n in before.extra["files"] if n in there] if before else []
    events = spark.read.schema(RUN_LOG).parquet(*loose)
    if grown:
        events = events.unionByName(published.read("events"))
    try:
        txn.write("events", events.coalesce(1 if not grown else 8), append=not grown,
                  extra={"files": [f.rsplit("/", 1)[1] for f in loose] + last})
        txn.commit()
    except StaleSnapshot:
        txn.abort()
        return 0
    for name in last:
        files.remove(spark, f"{path}/{name}")
    store.expire()
    return len(loose)


def started_events(log: DataFrame) -> DataFrame:
    """The opening event of each finished run."""
    none = F.lit(None)
    return log.withColumns({
        "status": F.lit("Started"),
        "message": F.concat(F.col("stage"), F.lit(" initiated")),
        "records_processed": none.cast("long"),
        "end_time": none.cast("timestamp"),
        "error_message": none.cast("string"),
    })


def current_state(events: DataFrame) -> DataFrame:
    """The last event of each run; an end time is later than its start."""
    last = F.struct(F.coalesce("end_time", "start_time"), F.col("end_time").isNotNull())
    row = F.struct(*events.columns)
    return events.groupBy(F.col("log_id").alias("_id")).agg(
        F.max_by(row, last).alias("_row")
    ).select("_row.*")


def with_duration(log: DataFrame, as_of: dt.datetime | Column | None = None) -> DataFrame:
    """Add ``duration_seconds``; a run that has not ended lasts until ``as_of``."""
    if as_of is None:
        end = F.col("end_time")
    else:
        now = as_of if isinstance(as_of, Column) else F.lit(as_of)
        end = F.coalesce(F.col("end_time"), now)
    return log.withColumn("duration_seconds", seconds_between(F.col("start_time"), end))


def success_rate(log: DataFrame, as_of: dt.date | Column) -> DataFrame:
    """Runs, completed runs and their share, over all time and the last 30 days."""
    recent = _last_30_days(as_of)
    return log.agg(
        F.count("*").alias("total_runs"),
        F.count_if(_completed()).alias("successful_runs"),
        zero_if_null(percent(F.count_if(_completed()), F.count("*"), 4)).alias(
            "success_rate_pct"
        ),
        F.count_if(recent).alias("total_runs_30d"),
        F.count_if(recent & _completed()).alias("successful_runs_30d"),
        zero_if_null(
            percent(F.count_if(recent & _completed()), F.count_if(recent), 4)
        ).alias("success_rate_30d_pct"),
    )


def failed_runs(log: DataFrame, as_of: dt.date | Column) -> DataFrame:
    return log.agg(
        F.count_if(_failed()).alias("failed_runs"),
        F.count_if(_failed() & _last_30_days(as_of)).alias("failed_runs_30d"),
    )


def averages(log: DataFrame) -> DataFrame:
    return log.agg(
        mean(F.col("duration_seconds"), 4).alias("avg_duration_seconds"),
        mean(F.col("records_processed"), 4).alias("avg_records"),
    )


def stage_stats(log: DataFrame) -> DataFrame:
    return log.groupBy("stage").agg(
        F.count("*").alias("runs"),
        F.count_if(_completed()).alias("successful_runs"),
        F.count_if(_failed()).alias("failed_runs"),
        mean(F.col("duration_seconds"), 4).alias("avg_duration_seconds"),
        mean(F.col("records_processed"), 4).alias("avg_records"),
    )


def daily_trend(log: DataFrame, early_seconds: int = 2) -> DataFrame:
    """Duration and records per day; a run shorter than ``early_seconds`` ended early."""
    return log.groupBy("run_date").agg(
        F.count("*").alias("runs"),
        F.sum("duration_seconds").alias("duration_seconds"),
        F.sum("records_processed").alias("records_processed"),
        F.count_if(_failed()).alias("failed_runs"),
        F.count_if(F.col("duration_seconds") < early_seconds).alias("early_failures"),
    )


def staging_extract(log: DataFrame) -> DataFrame:
    return log.filter(F.col("stage") == "Staging").select(
        "log_id", "run_date", "status", "records_processed", "message"
    )


def _quality(rejected: Column) -> list[Column]:
    staging = F.col("stage") == "Staging"
    records = F.col("records_processed")
    loaded = F.coalesce(F.sum(F.when(staging & _completed(), records)), F.lit(0))
    seen = F.coalesce(F.sum(F.when(staging, records)), F.lit(0)) + rejected
    return [
        loaded.alias("completed_records"),
        seen.alias("all_records"),
        zero_if_null(percent(loaded, seen, 4)).alias("quality_score_pct"),
    ]


def quality_score(log: DataFrame, rows_rejected: int | Column = 0) -> DataFrame:
    """Completed staging records over all staging records and the rejected rows."""
    rejected = rows_rejected if isinstance(rows_rejected, Column) else F.lit(rows_rejected)
    return log.agg(*_quality(rejected))


def quality_trend(log: DataFrame, as_of: dt.date | Column) -> DataFrame:
    """The score per day of the last 30 days; days without staging records score 0."""
    return log.filter(_last_30_days(as_of)).groupBy("run_date").agg(*_quality(F.lit(0)))


def staging_success(log: DataFrame) -> DataFrame:
    return log.filter((F.col("stage") == "Staging") & _completed()).agg(
        F.count("*").alias("staging_success")
    )


def run_table(log: DataFrame) -> DataFrame:
    return log.orderBy(F.desc("log_id"))


def status_flags(log: DataFrame) -> DataFrame:
    """Class of each run for display."""
    return log.select(
        "log_id",
        "status",
        F.when(_completed(), "ok").otherwise("alert").alias("status_flag"),
        (F.col("duration_seconds") < 2).alias("ended_early"),
    )


def rows_loaded(log: DataFrame) -> DataFrame:
    return log.agg(
        F.coalesce(
            F.sum(F.when(F.col("stage") == "Staging", F.col("records_processed"))), F.lit(0)
        ).alias("rows_loaded")
    )


def sliced(
    log: DataFrame,
    since: dt.date | None = None,
    until: dt.date | None = None,
    stage: str | None = None,
    status: str | None = None,
) -> DataFrame:
    """Filter by date range, stage and status, ahead of any of the measures above."""
    if since is not None:
        log = log.filter(F.col("run_date") >= F.lit(since))
    if until is not None:
        log = log.filter(F.col("run_date") <= F.lit(until))
    if stage is not None:
        log = log.filter(F.col("stage") == stage)
    if status is not None:
        log = log.filter(F.col("status") == status)
    return log
