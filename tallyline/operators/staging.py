"""Staging clean-up: duplicates, invalid rows, canonical text, summary."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyline.functions.numbers import quotient
from tallyline.functions.text import strip
from tallyline.schemas import TOTAL
from tallyline.sources.tables import stage_table


def keep_first(
    df: DataFrame, key: str = "transaction_id", order: Sequence[str] = ("loaded_at",)
) -> DataFrame:
    """The earliest row per key.

    ``order`` should name tie-breakers too. Spark plans the ``= 1`` filter as a group limit
    on both sides of the shuffle, so each task sends at most one row per key and a key that
    holds most of the rows costs no more than any other.
    """
    w = Window.partitionBy(key).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


# Slots that keys are hashed to: a bit each, so 16 MB at most are broadcast.
SLOTS = 1 << 27


def _single_rows(df: DataFrame, key: str) -> DataFrame:
    """Rows whose key occurs once. A key that survives has exactly one row, so the row itself can
    be an aggregate: one shuffle with map-side combining, where an anti-join would send every
    copy of a hot key to one task."""
    return (
        df.groupBy(key)
        .agg(F.count("*").alias("_n"), F.any_value(F.struct(*df.columns)).alias("_row"))
        .filter("_n = 1")
        .select("_row.*")
    )


def drop_all_copies(df: DataFrame, key: str = "transaction_id", slots: int = SLOTS) -> DataFrame:
    """Only rows whose key occurs once; rows without a key all stay.

    The input is staged, and keys are hashed to ``slots``. Counting a slot takes two states
    beyond empty, one and more, so the slots with more make a bitmap, which is broadcast. A row
    whose slot has no other is single and never shuffled; only suspects (copies, and keys that
    share a slot by chance) meet their key's other rows. Beyond a row per two slots most rows would
    be suspects by chance, and all meet at once.
    """
    names = df.columns
    slot = F.pmod(F.xxhash64(key), F.lit(slots))
    cut = df.withColumn("_slot", F.when(F.col(key).isNotNull(), slot))
    staged = stage_table(cut, "slots")
    keyed = staged.filter("_slot is not null")
    crowded = keyed.groupBy("_slot").agg(F.least(F.count("*"), F.lit(2)).alias("_n")).filter("_n > 1")
    if staged.count() * 2 > slots:
        single = _single_rows(keyed.select(*names), key)
        return single.unionByName(staged.filter("_slot is null").select(*names))
    bitmap = crowded.groupBy(F.bitmap_bucket_number("_slot").alias("_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("_slot")).alias("_bits"))
    # Its size is bounded by the parameter: a bit per slot.
    told = staged.withColumn("_bucket", F.bitmap_bucket_number("_slot")).join(
        F.broadcast(bitmap), "_bucket", "left")
    at = F.bitmap_bit_position("_slot")
    byte = F.conv(F.hex(F.substring("_bits", (at / 8).cast("int") + 1, 1)), 16, 10).cast("int")
    suspect = F.coalesce(F.getbit(byte, (at % 8).cast("int")) == 1, F.lit(False))
    told = told.withColumn("_suspect", suspect)
    rest = _single_rows(told.filter("_suspect").select(*names), key)
    return told.filter("not _suspect").select(*names).unionByName(rest)


def deduplicate(
    df: DataFrame,
    policy: str = "keep_first",
    key: str = "transaction_id",
    order: Sequence[str] = ("loaded_at",),
) -> DataFrame:
    if policy == "keep_first":
        return keep_first(df, key, order)
    if policy == "drop_all":
        return drop_all_copies(df, key)
    raise ValueError(f"unknown dedup policy: {policy}")


def remove_invalid(df: DataFrame) -> DataFrame:
    """Drop rows without id, date or revenue, and rows with negative revenue."""
    return df.filter(
        F.col("transaction_id").isNotNull()
        & (strip(F.col("transaction_id")) != "")
        & F.col("record_date").isNotNull()
        & F.col("revenue").isNotNull()
        & (F.col("revenue") >= 0)
    )


def staging_summary(df: DataFrame) -> DataFrame:
    """One row about the staged table.

    Summing per (region, product) first leaves the exact distinct counts a small input; on
    the table itself they would multiply every row by the number of counted columns.
    """
    parts = df.groupBy("region", "product_name").agg(
        F.count("*").alias("n"),
        F.count("revenue").alias("n_revenue"),
        F.min("record_date").alias("lo"),
        F.max("record_date").alias("hi"),
        F.sum("revenue").alias("revenue"),
    )
    total = F.sum("revenue").cast(TOTAL)
    return parts.agg(
        F.lit("STAGING_SUMMARY").alias("layer"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
        F.min("lo").alias("earliest_date"),
        F.max("hi").alias("latest_date"),
        total.alias("total_revenue"),
        quotient(total, F.sum("n_revenue"), 2).alias("avg_revenue"),
        F.countDistinct("region").alias("region_count"),
        F.countDistinct("product_name").alias("product_count"),
    )
