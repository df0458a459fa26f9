"""Byte-balanced shards by Karmarkar-Karp differencing.

Differencing keeps partial partitions (one byte sum per shard) and again and again combines the
two with the largest spread, oppositely ordered, so their differences cancel. It composes: the
result for one bucket of groups is itself a partial partition. So buckets of bounded size are
differenced in parallel, then the buckets' results, until one is left.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyline.sources.tables import stage_table

GROUPS_PER_TASK = 20_000
FAN_IN = 512
ROWS_PER_SLOT_BUCKET = 20_000


def difference(vectors: list[list[int]]) -> tuple[list[list[int]], list[int]]:
    """Combine partial partitions of equal width.

    Returns for each input the final shard of each of its subsets, and the final sums.
    """
    width = len(vectors[0])
    nodes, heap = [], []

    def add(sums, left, right):
        order = sorted(range(width), key=lambda i: -sums[i])
        sums = [sums[i] for i in order]
        nodes.append((left, right, order))
        heapq.heappush(heap, (sums[-1] - sums[0], len(nodes) - 1, sums))

    for v in vectors:
        add(v, -1, -1)
    while len(heap) > 1:
        _, a, x = heapq.heappop(heap)
        _, b, y = heapq.heappop(heap)
        add([p + q for p, q in zip(x, reversed(y))], a, b)
    total = heap[0][2]
    shard_of = [None] * len(nodes)
    shard_of[-1] = list(range(width))
    for at in range(len(nodes) - 1, -1, -1):
        left, right, order = nodes[at]
        before = [0] * width
        for place, i in enumerate(order):
            before[i] = shard_of[at][place]
        if left >= 0:
            shard_of[left], shard_of[right] = before, before[::-1]
            shard_of[at] = None
        else:
            shard_of[at] = before
    return shard_of[: len(vectors)], total


def _difference_items(shards: int):
    def run(items: pd.DataFrame) -> pd.DataFrame:
        items = items.sort_values(["bytes", "g", "part"], ascending=[False, True, True])
        width = [0] * (shards - 1)
        where, _ = difference([[int(b), *width] for b in items["bytes"]])
        return items.assign(label=np.array([w[0] for w in where], np.int32))

    return run


def _difference_nodes(nodes: pd.DataFrame) -> pd.DataFrame:
    nodes = nodes.sort_values("node")
    where, total = difference([[int(x) for x in v] for v in nodes["sums"]])
    return pd.DataFrame({
        "node": nodes["node"], "parent": nodes["parent"], "labels": where,
        "total": [total] * len(nodes)})


def shard_documents(
    docs: DataFrame, shards: int = 8, *, doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """All rows with ``doc_id, size, text_crc32, shard, slot``, shards equal in bytes.

    ``size`` is the UTF-8 length of the text plus 1; documents of equal text form a group that
    stays in one shard. Only a group of more bytes than an even share of all, which no balanced
    sharding can hold whole, is cut into parts of about half a share by a hash of ``doc_id``.
    ``slot`` counts 0, 1, .. within each shard.

    A NULL text has size 1, a NULL checksum and a group apart from the empty text. Repeated
    rows each come back with a slot of their own; NULL ids are allowed (a cut group of them
    stays together). An empty table gives no rows; other columns are ignored.
    """
    base = docs.select(
        F.col(doc_id).alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1).alias("size"),
        F.crc32(F.col(text).cast("binary")).alias("text_crc32"),
        F.coalesce(F.unhex(F.md5(F.col(text).cast("binary"))), F.lit(b"")).alias("g"),
    )
    base = stage_table(base, "sizes")
    groups = stage_table(base.groupBy("g").agg(F.sum("size").alias("bytes")), "groups")
    whole = groups.agg(F.sum("bytes").alias("bytes"), F.count("*").alias("n")).first()
    if not whole.n:
        return base.select(
            "doc_id", "size", "text_crc32", F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))

    # Fewer groups than shards exceed an even share, so this frame has a fixed size bound.
    share = max(whole.bytes // shards, 1)
    wide = groups.where(F.col("bytes") > share).select(
        "g", F.ceil(F.col("bytes") * 2 / share).cast("int").alias("parts"))
    part = F.coalesce(F.pmod(F.xxhash64("doc_id"), F.col("parts")), F.lit(0)).cast("int")
    base = base.join(F.broadcast(wide), "g", "left").withColumn("part", part).drop("parts")
    items = base.groupBy("g", "part").agg(F.sum("size").alias("bytes"))
    buckets = max(1, -(-whole.n // GROUPS_PER_TASK))
    bucket = F.pmod(F.xxhash64("g", "part"), F.lit(buckets)).alias("bucket")
    items = stage_table(
        items.select("g", "part", "bytes", bucket).groupBy("bucket").applyInPandas(
            _difference_items(shards), "g binary, part int, bytes long, bucket long, label int"),
        "items")

    sums = [F.sum(F.when(F.col("label") == i, F.col("bytes")).otherwise(0)) for i in range(shards)]
    nodes = items.groupBy(F.col("bucket").alias("node")).agg(F.array(*sums).alias("sums"))
    placed = items.withColumn("node", F.col("bucket"))
    while buckets > 1:
        parent = F.floor(F.col("node") / FAN_IN).alias("parent")
        step = nodes.select("node", "sums", parent).groupBy("parent").applyInPandas(
            _difference_nodes, "node long, parent long, labels array<int>, total array<long>")
        step = stage_table(step, "nodes")
        placed = placed.join(step.select("node", "parent", "labels"), "node").select(
            "g", "part", F.col("parent").alias("node"),
            F.get("labels", F.col("label")).alias("label"))
        nodes = step.groupBy(F.col("parent").alias("node")).agg(F.first("total").alias("sums"))
        buckets = -(-buckets // FAN_IN)

    rows = F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(max(1, -(-whole.n // ROWS_PER_SLOT_BUCKET))))
    out = base.join(placed.select("g", "part", F.col("label").alias("shard")), ["g", "part"])
    out = stage_table(out.select("doc_id", "size", "text_crc32", "shard", rows.alias("run")), "placed")
    counts = out.groupBy("shard", "run").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("shard").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(
        "shard", "run", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    order = Window.partitionBy("shard", "run").orderBy("doc_id", "text_crc32", "size")
    out = out.withColumn("at", F.row_number().over(order) - 1).join(counts, ["shard", "run"])
    return out.select(
        "doc_id", "size", "text_crc32", "shard", (F.col("at") + F.col("before")).alias("slot"))
