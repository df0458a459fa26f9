"""Connected components by alternating large-star and small-star steps on staged edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.sources.tables import drop_staged, stage_table


def _lowest(edges: DataFrame) -> DataFrame:
    """Each edge ``(u, v)`` with the lowest neighbour of ``u``.

    An aggregation joined back instead of a window: the hub of a large component is then
    aggregated map-side, and the join can be split by adaptive skew handling.
    """
    low = edges.groupBy("u").agg(F.min("v").alias("low"))
    low = low.select("u", F.least("u", "low").alias("m"))
    return edges.join(low, "u")


def _mark(edges: DataFrame) -> tuple[int, object]:
    mark = F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))
    row = edges.agg(F.count("*").alias("n"), mark.alias("s")).first()
    return row.n, row.s


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """``(node, component)`` of the linked nodes; the component is its smallest node.

    ``links`` needs two columns of long ids. Every round contracts the graph (the number of
    rounds grows with the logarithm of its size) and is written to the shared folder, so a
    lost executor repeats one round at most. Only a count and a checksum reach the driver.
    """
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    edges = stage_table(edges.where("u <> v").distinct(), "edges")
    mark = _mark(edges)
    while mark[0]:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _lowest(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        near = _lowest(large)
        small = near.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.union(near.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        before, edges = edges, stage_table(small, "edges")
        drop_staged(before)
        last, mark = mark, _mark(edges)
        if mark == last:
            break
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return nodes.union(roots)


def extended(comps: DataFrame, links: DataFrame, a: str, b: str) -> DataFrame:
    """``(node, component)`` of ``comps``, which came from earlier links, and of further ``links``.

    Further links are taken between the components of their ends, so only what they connect is
    contracted, and not all earlier links again. Components keep their smallest node as name.
    """
    ends = links.select(F.col(a).alias("a"), F.col(b).alias("b"))
    for side in "ab":
        own = comps.select(F.col("node").alias(side), F.col("component").alias(f"c_{side}"))
        ends = ends.join(own, side, "left")
    ends = ends.select(F.coalesce("c_a", "a").alias("a"), F.coalesce("c_b", "b").alias("b"))
    merged = stage_table(components(ends, "a", "b"), "merged")
    moved = merged.select(F.col("node").alias("component"), F.col("component").alias("moved"))
    known = comps.join(moved, "component", "left").select(
        "node", F.coalesce("moved", "component").alias("component"))
    return known.union(merged.join(comps, "node", "left_anti").select("node", "component"))
