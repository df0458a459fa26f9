"""Table writers, staged intermediates, conformance to a schema, and row counts."""

from __future__ import annotations

import datetime as dt
import gc
import tempfile
import uuid
import weakref
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline.sources import files
from tallyline.sources.snapshots import TableStore, counted

_staged_paths: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()
_scope: ContextVar[list[str] | None] = ContextVar("staging_scope", default=None)


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach: ``spark.checkpoint.dir`` of the session.

    A temporary folder is used only where the setting is missing and Spark runs locally.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    local = context.master.split("[")[0] == "local"
    if folder:
        return folder.rstrip("/")
    if local:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(tempfile.mkdtemp(prefix="tallyline-"))
        return context.getCheckpointDir()
    raise RuntimeError("spark.checkpoint.dir must name a shared folder")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stage_table(df: DataFrame, name: str) -> DataFrame:
    """Write a frame once and read it back, for plans that use it more than once.

    The written copy cuts the lineage, survives lost executors and is columnar, so each
    consumer prunes it. Spark also knows its true size, so joins against small staged
    aggregates become broadcast joins through ``autoBroadcastJoinThreshold`` alone, and
    stay shuffled joins (with adaptive skew handling) when the aggregate is large.
    """
    path = new_path(df.sparkSession, name)
    if (owned := _scope.get()) is not None:
        owned.append(path)
    df.write.parquet(path)
    staged = df.sparkSession.read.schema(df.schema).parquet(path)
    _staged_paths[staged] = path
    return staged


def drop_staged(df: DataFrame) -> None:
    """Remove the files behind a frame of ``stage_table`` that nothing reads any more."""
    path = _staged_paths.pop(df, None)
    if path is not None:
        files.remove(df.sparkSession, path)


def forget_shuffles(spark: SparkSession) -> None:
    """Have the shuffle files of finished jobs removed, in loops that make many of them.

    Spark removes them once the driver's garbage collection finds that no plan uses them, which a
    driver with much memory may not come to for long.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


@contextmanager
def staging_scope(spark: SparkSession) -> Iterator[None]:
    """Owns the tables staged inside and removes them at the end, also after a failure.

    What the block returns must have been written by then: a lazy frame over a staged table is
    of no use outside.
    """
    owned: list[str] = []
    token = _scope.set(owned)
    try:
        yield
    finally:
        _scope.reset(token)
        for path in owned:
            files.remove(spark, path)


def full_refresh(df: DataFrame, path: str) -> DataFrame:
    """Replace the table published at ``path``, also one that ``df`` reads from.

    The new rows are written aside and then published; readers see the old table until that,
    and one generation longer if they began with it.
    """
    store = TableStore(df.sparkSession, path)
    with store.begin() as transaction:
        transaction.write("table", df)
    store.expire()
    return store.read("table")


def read_refreshed(spark: SparkSession, path: str) -> DataFrame:
    """The table that ``full_refresh`` last published at ``path``."""
    return TableStore(spark, path).read("table")


def replace_dates(df: DataFrame, path: str, date_column: str) -> None:
    """Write the days in ``df``, replacing only those days: running a day twice is safe."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(date_column)
        .parquet(path)
    )


def replace_day(df: DataFrame, path: str, date_column: str, day: dt.date) -> int:
    """Replace one day by what ``df`` has of it, which may be nothing; returns its rows, counted
    by the job that writes them."""
    own = df.where(F.col(date_column) == F.lit(day)).drop(date_column)
    own, seen = counted(own, rows=F.count(F.lit(1)))
    own.write.mode("overwrite").parquet(f"{path}/{date_column}={day.isoformat()}")
    return seen.get["rows"]


def write_csv(
    df: DataFrame, path: str, compression: str = "none", most_rows: int | None = None,
) -> None:
    """``most_rows`` bounds a file: a compressed one is read by one task."""
    (
        df.write.mode("overwrite")
        .option("compression", compression)
        # Of gzip; its usual level takes a third more CPU seconds for a hundredth less.
        .option("zlib.compress.level", "FIVE")
        .option("maxRecordsPerFile", most_rows or 0)
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def conform(df: DataFrame, schema: T.StructType, keep: Sequence[str] = ()) -> DataFrame:
    """One typed projection onto ``schema``: unparseable text and NaN become NULL. Columns
    in ``keep`` go along as they are."""

    def cast(field: T.StructField):
        c = F.col(field.name)
        source = df.schema[field.name].dataType
        if isinstance(source, (T.DoubleType, T.FloatType)):
            c = F.when(~F.isnan(c), c)
        return c.try_cast(field.dataType).alias(field.name)

    return df.select(*(cast(f) for f in schema.fields), *keep)


def row_counts(tables: Mapping[str, DataFrame | None]) -> DataFrame:
    """``(table_name, row_count, status)`` per table; a missing table counts as -1."""
    frames = [df for df in tables.values() if df is not None]
    spark = frames[0].sparkSession if frames else SparkSession.active()
    out = None
    for name, df in tables.items():
        if df is None:
            one = spark.range(1).select(F.lit(-1).cast("long").alias("row_count"))
        else:
            one = df.agg(F.count("*").alias("row_count"))
        one = one.select(F.lit(name).alias("table_name"), "row_count")
        out = one if out is None else out.unionByName(one)
    status = F.when(F.col("row_count") > 0, "OK").otherwise("EMPTY")
    return out.withColumn("status", status)
