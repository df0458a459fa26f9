"""Ranks and shares whose groups may be too large for one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyline.sources.tables import stage_table

def _same(left: Sequence[str], right: Sequence[str]) -> list[Column]:
    return [F.col(a).eqNullSafe(F.col(b)) for a, b in zip(left, right)]


def rank_descending(
    df: DataFrame, keys: Sequence[str], value: str, name: str, base: DataFrame | None = None
) -> DataFrame:
    """Add ``RANK() OVER (PARTITION BY keys ORDER BY value DESC)``.

    Rows are counted per value first, so that equal values, however many, are one row. The
    distinct values are dealt to tasks in ranges, which holds for any distribution; a value's rank
    is one more than the rows above it in its range, and in the ranges before (one count each). The
    ranks are then joined back. ``base`` is a frame with the same keys and values that is cheaper
    to read than ``df`` (a staged table, of which ``df`` has further columns).
    """
    counted = (df if base is None else base).groupBy(*keys, value).agg(F.count("*").alias("_n"))
    order = [*(F.col(k) for k in keys), F.desc(value)]
    dealt = counted.repartitionByRange(*order).sortWithinPartitions(*order)
    dealt = stage_table(dealt.withColumn("_at", F.monotonically_increasing_id()), "values")
    dealt = dealt.withColumn("_range", F.shiftright("_at", 33))
    before = (Window.unboundedPreceding, -1)
    right = [f"_of_{k}" for k in keys]
    above = dealt.groupBy(*keys, "_range").agg(F.sum("_n").alias("_n")).select(
        *(F.col(k).alias(r) for k, r in zip(keys, right)), F.col("_range").alias("_of_range"),
        F.coalesce(F.sum("_n").over(
            Window.partitionBy(*keys).orderBy("_range").rowsBetween(*before)), F.lit(0)).alias("_above"))
    inside = Window.partitionBy(*keys, "_range").orderBy("_at").rowsBetween(*before)
    ranks = (
        dealt.withColumn("_within", F.coalesce(F.sum("_n").over(inside), F.lit(0)))
        .join(above, _same([*keys, "_range"], [*right, "_of_range"]))
        .select(
            *(F.col(k).alias(f"_with_{k}") for k in keys), F.col(value).alias("_with_value"),
            (F.col("_above") + F.col("_within") + 1).cast("int").alias(name))
    )
    on = _same([*keys, value], [*(f"_with_{k}" for k in keys), "_with_value"])
    return df.join(ranks, on).select(*df.columns, name)


def with_group_total(
    df: DataFrame, keys: Sequence[str], value: str, name: str, base: DataFrame | None = None
) -> DataFrame:
    """Add the total of ``value`` over ``keys``, summed on the map side (of ``base``, as above) and
    joined back."""
    total = (df if base is None else base).groupBy(*keys).agg(F.sum(value).alias(name))
    right = [f"_of_{k}" for k in keys]
    total = total.select(*(F.col(k).alias(r) for k, r in zip(keys, right)), name)
    return df.join(total, _same(keys, right)).select(*df.columns, name)
