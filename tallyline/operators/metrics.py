"""Daily roll-up of long-format operational metrics."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyline.functions.numbers import mean
from tallyline.sources.tables import stage_table

SERIES = ("entity_id", "metric_name")


def forward_fill(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    keys: Sequence[str] = SERIES,
    time: str = "loaded_at",
    tie_break: Sequence[str] = (),
    chunk_seconds: int = 900,
) -> DataFrame:
    """Fill NULLs with the last value of the same series, in time order, column by column.

    ``columns`` are by default all but the keys, the time and the tie-breakers. A series is cut
    into time chunks, so that one series holding most of the rows is spread over many tasks.
    Each chunk fills itself; its last row then holds the last value of every column. What is still
    open at a chunk's start takes the last values of the chunks before, carried over those last
    rows only. The input is read and shuffled once; the filled chunks are staged.
    """
    order = [time, *tie_break]
    if columns is None:
        columns = [c for c in df.columns if c not in (*keys, *order)]
    chunk = F.floor(F.unix_timestamp(time) / chunk_seconds)
    inside = Window.partitionBy(*keys, "_chunk").orderBy(*order)
    so_far = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    filled = df.withColumn("_chunk", chunk).withColumns({
        **{c: F.last(c, ignorenulls=True).over(so_far) for c in columns},
        "_ends": F.lead(F.lit(True), 1, False).over(inside) == F.lit(False),
    })
    filled = stage_table(filled, "filled")
    earlier = (
        Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    )
    carry = filled.filter("_ends").select(
        *(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)),
        F.col("_chunk").alias("_of_chunk"),
        F.struct(*(F.last(c, ignorenulls=True).over(earlier).alias(c) for c in columns)).alias(
            "_carry"),
    )
    on = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
    on.append(F.col("_chunk").eqNullSafe(F.col("_of_chunk")))
    joined = filled.join(carry, on, "left")
    return joined.select(*(
        F.coalesce(F.col(c), F.col("_carry").getField(c)).alias(c) if c in columns else F.col(c)
        for c in df.columns))


def summarise(df: DataFrame, *more_keys: str) -> DataFrame:
    """Sum, mean and count of values per series; rows without a series are left out."""
    keys = [*more_keys, *SERIES]
    present = df.dropna(subset=list(SERIES))
    return present.groupBy(*keys).agg(
        F.sum("metric_value").alias("total_value"),
        mean(F.col("metric_value"), 4).alias("avg_value"),
        F.count("metric_value").alias("record_count"),
    )


def daily_rollup(
    staged: DataFrame, day: dt.date, tie_break: Sequence[str] = (), chunk_seconds: int = 900
) -> DataFrame:
    """One day's summary: load, forward-fill, aggregate. No rows in, no rows out."""
    rows = staged.filter(F.col("record_date") == F.lit(day))
    filled = forward_fill(rows, tie_break=tie_break, chunk_seconds=chunk_seconds)
    return summarise(filled, "record_date").withColumnRenamed("record_date", "report_date")
