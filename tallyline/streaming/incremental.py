"""Incremental load by high-water mark, and marts kept up to date by what a batch changes."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyline.operators import core, kpis, marts
from tallyline.operators.staging import keep_first
from tallyline.sources.snapshots import TableStore
from tallyline.sources.tables import stage_table, staging_scope


def changes_since(source: DataFrame, mark: dt.datetime | Column) -> DataFrame:
    """Rows loaded at the mark or later; a plain comparison, so it is pushed to the scan.

    The mark itself is included, as more rows may arrive with the load time of the last ones
    seen. Merging a row again changes nothing.
    """
    limit = mark if isinstance(mark, Column) else F.lit(mark)
    return source.filter(F.col("loaded_at") >= limit)


def high_water_mark(source: DataFrame) -> DataFrame:
    return source.agg(F.max("loaded_at").alias("high_water_mark"))


def merge_by_key(
    current: DataFrame,
    changes: DataFrame,
    key: str = "transaction_id",
    order: Sequence[str] = ("loaded_at",),
    policy: str = "keep_first",
) -> DataFrame:
    """``current`` brought up to date, as a full refresh over all rows would give it.

    With ``keep_first`` the earliest row of a key stays: only keys that are not there yet are
    added. With ``keep_latest`` the latest row of a changed key, in ``order``, takes the place of
    its current one (and of the batches before it). Batches have to come in order of loading.

    ``current`` is unique by key and the changes are made so first, so no key is hot in the
    anti-join. The changes are staged: a small batch is broadcast by its size, and the
    current table is then not shuffled at all. The staged copy is in the shared folder.
    """
    if policy == "keep_first":
        fresh = stage_table(keep_first(changes, key, order), "changes")
        new = fresh.join(current.select(key), key, "left_anti")
        return current.unionByName(new.select(*current.columns))
    if policy != "keep_latest":
        raise ValueError(f"unknown policy: {policy}")
    latest = Window.partitionBy(key).orderBy(*(F.desc(c) for c in order))
    fresh = changes.withColumn("_n", F.row_number().over(latest)).where("_n = 1").drop("_n")
    fresh = stage_table(fresh, "changes")
    untouched = current.join(fresh.select(key), key, "left_anti")
    return untouched.select(*current.columns).unionByName(fresh.select(*current.columns))


FACT, CUBE = "core_sales", "revenue_cube"


def _added(cube: DataFrame) -> DataFrame:
    """Equal keys added up; a key without transactions left is gone."""
    total = cube.groupBy(*marts.CUBE_KEYS).agg(
        *(F.sum(c).cast(t).alias(c) for c, t in marts.CUBE_SUMS.items()))
    return total.filter("transactions <> 0")


def apply_batch(
    store: TableStore,
    batch: DataFrame,
    key: str = "transaction_id",
    order: Sequence[str] = ("loaded_at",),
    policy: str = "keep_first",
    at: dt.datetime | None = None,
) -> dict[str, int]:
    """Merge a batch of staged rows into the fact and bring the marts up to date.

    With ``keep_first`` the new rows are added to the revenue cube, in exact decimals. With
    ``keep_latest`` the years that the batch touches, also those of rows that it replaces, are
    written anew, and their cube is made from them. The marts are then rolled up from the cube, for
    these years; what lies in other years is neither read (but for its keys) nor written. Fact, cube
    and marts are partitioned by year and published in one snapshot. Batches have to come in order
    of loading; a batch that is applied again changes nothing.

    A row of the fact is shuffled once, to meet the other rows of its key, and written as it lies
    then: each task leaves a file per year.

    Returns the rows added, the rows replaced and the years touched. The result equals the marts
    of a full refresh over all rows, under the same ``policy`` as ``merge_by_key``.
    """
    if policy not in ("keep_first", "keep_latest"):
        raise ValueError(f"unknown policy: {policy}")
    spark = store.spark
    with staging_scope(spark), store.begin() as txn:
        if policy == "keep_first":
            single = keep_first(batch, key, order)
        else:
            latest = Window.partitionBy(key).orderBy(*(F.desc(c) for c in order))
            single = batch.withColumn("_n", F.row_number().over(latest)).where("_n = 1").drop("_n")
        stamp = F.lit(at or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)).cast("timestamp")
        new = core.enrich(single).withColumn("transformed_at", stamp)
        replaced = 0
        if FACT in txn.tables and policy == "keep_latest":
            # Read for its keys and its years, before it is written.
            new = stage_table(new, "fresh")
            keys = new.select(key)
            taken = stage_table(
                txn.read(FACT).select(key, "txn_year").join(keys, key, "left_semi")
                .groupBy("txn_year").agg(F.count("*").alias("n")), "taken").collect()
            replaced = sum(r.n for r in taken)
            years = {r.txn_year for r in new.select("txn_year").distinct().collect()}
            years = sorted(years | {r.txn_year for r in taken}, key=str)
            kept = txn.read(FACT).filter(kpis.years_of(years)).join(keys, key, "left_anti")
            added = new.count()
            txn.write(FACT, kept.unionByName(new), "txn_year", replace=years)
            # The years are new as a whole, so their cube is made from what was written.
            cube = marts.revenue_cube(txn.read(FACT).filter(kpis.years_of(years)))
        else:
            if FACT in txn.tables:
                # The batch lies by key already, from its own copies: only keys of the fact move.
                new = new.join(txn.read(FACT).select(key), key, "left_anti")
            added = txn.write(FACT, new, "txn_year", append=True)
            delta = stage_table(marts.revenue_cube(txn.written(FACT)), "delta")
            years = [r.txn_year for r in delta.select("txn_year").distinct().collect()]
            cube = delta if CUBE not in txn.tables else _added(
                txn.read(CUBE).filter(kpis.years_of(years)).unionByName(delta))
        txn.write(CUBE, cube.repartition("txn_year"), "txn_year", replace=years)
        cube = txn.read(CUBE).filter(kpis.years_of(years))
        for name, mart in marts.all_marts(cube).items():
            mart = mart.withColumn("refreshed_at", stamp)
            txn.write(name, mart.repartition("txn_year"), "txn_year", replace=years)
        counts = {"added": added, "replaced": replaced, "years": len(years)}
    store.expire(keep=3)
    return counts
