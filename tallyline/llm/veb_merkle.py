"""Merkle manifest of a dataset, its trees stored in van Emde Boas order.

Every row is a leaf, every key (the source) has a tree of fan-out 16 over its leaves, and one more
tree stands over the keys' roots. A tree is cut into aligned blocks of ``BLOCK_LEVELS`` levels of
runs, one row each: bounded in size, built and read independently. Block roots are the leaves of
the next layer of blocks, and so on, so a key with a third of all rows is many blocks.

In a block the nodes lie in van Emde Boas order: the levels are split at half height, the top
comes first, then the bottom subtrees one after the other, each laid out in the same way. Where a
node lies is arithmetic on level, index and leaf count (``address``); building and sibling
retrieval both use it, and a block holds no pointers and no empty places.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyline.sources.tables import stage_table

BITS = 4  # of the fan-out: runs of 16
FANOUT = 1 << BITS
BLOCK_LEVELS = 3
BLOCK = FANOUT ** BLOCK_LEVELS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_ONE_TREE = "="


# ---- layout -------------------------------------------------------------------------------

def _above(n, levels: int):
    """Nodes ``levels`` higher than ``n`` neighbouring nodes."""
    return -(-n // (1 << BITS * levels))


def tree_size(leaves, levels: int):
    """Nodes of a tree of ``levels`` levels over ``leaves`` leaves."""
    return sum(_above(leaves, level) for level in range(levels))


def levels_for(leaves: int) -> int:
    """Levels until one node remains."""
    levels = 1
    while leaves > 1:
        leaves, levels = _above(leaves, 1), levels + 1
    return levels


def address(level, index, leaves, levels: int):
    """Places of nodes (``level`` 0 is the leaves) in a tree's van Emde Boas order; all but
    ``levels`` may be arrays."""
    level, index, leaves = np.broadcast_arrays(*(np.asarray(x, np.int64) for x in (level, index, leaves)))
    if levels == 1:
        return np.zeros(level.shape, np.int64)
    low = (levels + 1) // 2
    width = 1 << BITS * (low - 1)  # leaves of a full bottom subtree
    top_leaves = _above(-(-leaves // width), 1)
    out = np.empty(level.shape, np.int64)
    top = level >= low
    if top.any():
        out[top] = address(level[top] - low, index[top], top_leaves[top], levels - low)
    down = ~top
    if down.any():
        shift = BITS * (low - 1 - level[down])
        subtree = index[down] >> shift
        own_leaves = np.minimum(width, leaves[down] - subtree * width)
        start = tree_size(top_leaves[down], levels - low) + subtree * tree_size(width, low)
        out[down] = start + address(level[down], index[down] - (subtree << shift), own_leaves, low)
    return out


def build_block(leaves: np.ndarray, levels: int) -> np.ndarray:
    """All nodes, in van Emde Boas order, over leaf digests of shape (n, 32)."""
    n = len(leaves)
    nodes = np.empty((tree_size(n, levels), 32), np.uint8)
    nodes[address(0, np.arange(n), n, levels)] = leaves
    for level in range(1, levels):
        below = level_text(nodes, n, levels, level - 1)
        run = FANOUT * 64
        made = b"".join(
            hashlib.sha256(below[at: at + run].encode()).digest() for at in range(0, len(below), run))
        own = np.frombuffer(made, np.uint8).reshape(-1, 32)
        nodes[address(level, np.arange(len(own)), n, levels)] = own
    return nodes


def level_text(nodes: np.ndarray, leaves: int, levels: int, level: int) -> str:
    """The digests of one level, left to right, as hex text."""
    return nodes[address(level, np.arange(_above(leaves, level)), leaves, levels)].tobytes().hex()


def siblings(texts: list[str], leaf: int) -> tuple[list[str], list[str]]:
    """Digests left and right of the leaf's ancestor in its run, level by level below the root."""
    before, after = [], []
    for text in texts:
        run = (leaf >> BITS) * FANOUT * 64
        before.append(text[run: leaf * 64])
        after.append(text[(leaf + 1) * 64: run + FANOUT * 64])
        leaf >>= BITS
    return before, after


def fold(digest: str, before: list[str], after: list[str]) -> str:
    """The root that a leaf and its siblings give."""
    for left, right in zip(before, after):
        digest = hashlib.sha256(f"{left}{digest}{right}".encode()).hexdigest()
    return digest


# ---- tasks --------------------------------------------------------------------------------

_BLOCK = "key string, block long, total long, n long, levels int, root binary, nodes binary"


def _digests(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, 32)


def _block_task(carry: bool):
    """One block from its leaves; with ``carry`` the ids and claimed digests go along."""

    def run(table: pa.Table) -> pa.Table:
        at = np.argsort(table["pos"].to_numpy())
        total = table["total"][0].as_py()
        levels = BLOCK_LEVELS + 1 if total > BLOCK else levels_for(total)
        nodes = build_block(_digests(table["digest"])[at], levels)
        out = {
            "key": table["key"][:1], "block": table["block"][:1], "total": table["total"][:1],
            "n": pa.array([len(at)], pa.int64()), "levels": pa.array([levels], pa.int32()),
            "root": pa.array([nodes[address(levels - 1, 0, len(at), levels)].tobytes()]),
            "nodes": pa.array([nodes.tobytes()], pa.binary()),
        }
        if carry:
            ids = table["id"].combine_chunks().take(pa.array(at))
            out["ids"] = pa.array([ids.to_pylist()], pa.list_(pa.int64()))
            out["claims"] = pa.array([_digests(table["claim"])[at].tobytes()], pa.binary())
        return pa.table(out)

    return run


def _blocks_of(batch):
    """Each block of a batch: its row, the texts of the levels below its root, and the path above."""
    for row in batch.to_pylist():
        nodes = np.frombuffer(row["nodes"], np.uint8).reshape(-1, 32)
        texts = [level_text(nodes, row["n"], row["levels"], level) for level in range(row["levels"] - 1)]
        yield row, texts


def _path_task(batches):
    """The path of each leaf of the blocks, for the blocks of the layer below."""
    for batch in batches:
        for row, texts in _blocks_of(batch):
            out = {"key": [], "block": [], "before": [], "after": [], "subroot": [], "top": []}
            first = row["block"] * BLOCK
            for leaf in range(row["n"]):
                before, after = siblings(texts, leaf)
                values = (row["key"], first + leaf, before + row["before"], after + row["after"],
                          row["subroot"], row["top"])
                for name, value in zip(out, values):
                    out[name].append(value)
            yield pa.RecordBatch.from_pydict(out, _PATH)


_PATH = pa.schema([
    ("key", pa.string()), ("block", pa.int64()), ("before", pa.list_(pa.string())),
    ("after", pa.list_(pa.string())), ("subroot", pa.string()), ("top", pa.string()),
])
_PATH_SQL = (
    "key string, block long, before array<string>, after array<string>, subroot string, top string")


def _proof_task(batches):
    """Proof, folded root and verdict of each row of the blocks."""
    for batch in batches:
        for row, texts in _blocks_of(batch):
            nodes = np.frombuffer(row["nodes"], np.uint8).reshape(-1, 32)
            leaves = level_text(nodes, row["n"], row["levels"], 0)
            claims = row["claims"].hex()
            leaf, proof, folded = [], [], []
            for i in range(row["n"]):
                before, after = siblings(texts, i)
                before += row["before"]
                after += row["after"]
                said = "".join(x for pair in zip(before, after) for x in pair)
                leaf.append(leaves[i * 64: i * 64 + 64])
                proof.append(hashlib.sha256(said.encode()).hexdigest())
                folded.append(fold(claims[i * 64: i * 64 + 64], before, after))
            n = row["n"]
            yield pa.RecordBatch.from_pydict({
                "doc_id": pa.array(row["ids"], pa.int64()), "leaf": leaf,
                "subroot": [row["subroot"]] * n, "root": [row["top"]] * n, "proof_sha256": proof,
                "folded_root": folded, "verified": [x == row["top"] for x in folded],
            })


# ---- Spark --------------------------------------------------------------------------------

def ranked(df: DataFrame, key: str, *order: str) -> DataFrame:
    """``df`` with ``pos``, the place of a row among those of its key, and ``total``, their number.

    Rows are dealt by ranges of key and order, so a key's rows spread over as many tasks as they
    need, and numbered as they lie. What is added up over a key is one count per task. The last
    of ``order`` should be unique. The numbered rows are written once, which fixes the numbers.
    """
    here = df.repartitionByRange(key, *order).sortWithinPartitions(key, *order)
    here = stage_table(here.withColumn("_at", F.monotonically_increasing_id()), "ranked")
    part = F.shiftright("_at", 33)
    runs = here.groupBy(part.alias("_part"), key).agg(
        F.min("_at").alias("_first"), F.count("*").alias("_n"))
    before = Window.partitionBy(key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumns({
        "_before": F.coalesce(F.sum("_n").over(before), F.lit(0)),
        "total": F.sum("_n").over(Window.partitionBy(key)),
    }).drop("_n")
    placed = here.withColumn("_part", part).join(stage_table(runs, "runs"), ["_part", key])
    pos = F.col("_before") + F.col("_at") - F.col("_first")
    return placed.withColumn("pos", pos).drop("_part", "_at", "_first", "_before")


def _forest(leaves: DataFrame, carry: bool = False) -> list[DataFrame]:
    """Layers of blocks over ``key, pos, total, digest`` (and ``id, claim``), bottom first."""
    layers = []
    while True:
        block = F.shiftright("pos", BITS * BLOCK_LEVELS).alias("block")
        extra = ("id", "claim") if carry else ()
        schema = _BLOCK + (", ids array<long>, claims binary" if carry else "")
        made = leaves.select("key", block, "pos", "total", "digest", *extra)
        made = made.groupBy("key", "block").applyInArrow(_block_task(carry), schema)
        layers.append(stage_table(made, "blocks"))
        most = layers[-1].agg(F.max("total").alias("m")).first().m
        if most is None or most <= BLOCK:
            return layers
        up = F.ceil(F.col("total") / BLOCK).cast("long")
        leaves = layers[-1].where(F.col("total") > BLOCK).select(
            "key", F.col("block").alias("pos"), up.alias("total"), F.col("root").alias("digest"))
        carry = False


def _tops(layers: list[DataFrame]) -> DataFrame:
    """``key, digest``: the root of each tree, from the layer that has all of it in one block."""
    out = None
    for layer in layers:
        own = layer.where(F.col("total") <= BLOCK).select("key", F.col("root").alias("digest"))
        out = own if out is None else out.unionByName(own)
    return out


@dataclass(frozen=True)
class Manifest:
    """Block tables of the keys' trees and of the tree over their roots, bottom layer first."""

    layers: list[DataFrame]
    key_layers: list[DataFrame]
    subroots: DataFrame  # key, place among the keys, digest

    def root(self) -> str | None:
        """Hex digest of the dataset; None if it is empty."""
        row = _tops(self.key_layers).first()
        return row.digest.hex() if row else None


def field_text(column: str | Column) -> Column:
    """``-`` for NULL, else the byte length, a colon and the value."""
    value = (F.col(column) if isinstance(column, str) else column).cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf_digest(*columns: str | Column) -> Column:
    return F.unhex(F.sha2(F.concat(*(field_text(c) for c in columns)).cast("binary"), 256))


def build(
    docs: DataFrame, *, claimed_text: Column | None = None, fields: tuple[str, ...] = FIELDS,
    key: str = "source", doc_id: str = "doc_id", text: str = "text",
) -> Manifest:
    """Build the manifest of a table.

    ``claimed_text`` is the text as it is found later, for ``verify`` (by default the text
    itself). Leaves ascend by ``doc_id``, NULL first; rows of one id by digest; equal rows are
    leaves each. A NULL key is a tree of its own, before all others. Keys are ordered bytewise.
    Empty texts are fields of length 0, unlike NULL. Other columns are ignored. An empty table
    has no blocks and no root.

    Texts are read once, and only digests are shuffled; tasks hold one block of at most
    ``BLOCK`` leaves. All layers are written in the shared folder.
    """
    own = [F.col(c) for c in fields]
    leaf = leaf_digest(*own)
    claim = leaf
    if claimed_text is not None:
        said = leaf_digest(*(claimed_text if c == text else F.col(c) for c in fields))
        claim = F.when(claimed_text.eqNullSafe(F.col(text)), leaf).otherwise(said)
    leaves = stage_table(docs.select(
        F.coalesce(F.concat(F.lit("="), F.col(key).cast("string")), F.lit("")).alias("key"),
        F.col(doc_id).cast("long").alias("id"), leaf.alias("digest"), claim.alias("claim"),
        F.monotonically_increasing_id().alias("row"),
    ), "leaves")
    layers = _forest(ranked(leaves, "key", "id", "digest", "row"), carry=True)
    tops = stage_table(_tops(layers), "tops")
    named = tops.select(F.lit(_ONE_TREE).alias("key"), F.col("key").alias("name"), "digest")
    subroots = stage_table(ranked(named, "key", "name"), "subroots")
    return Manifest(layers, _forest(subroots), subroots)


def _with_paths(layer: DataFrame, paths: DataFrame) -> DataFrame:
    return layer.join(paths, ["key", "block"])


def verify(manifest: Manifest) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified`` per row.

    Paths go down: each block gets the siblings above its root (a few hundred digests at most)
    and hands them, with those inside, to the blocks that stand on its leaves. A row's claimed
    digest is folded with its siblings, and verified if that gives the root.
    """
    top = manifest.root()
    spark = manifest.subroots.sparkSession
    none = F.array().cast("array<string>")
    down = spark.range(1).select(
        F.lit(_ONE_TREE).alias("key"), F.lit(0).cast("long").alias("block"), none.alias("before"),
        none.alias("after"), F.lit(None).cast("string").alias("subroot"),
        F.lit(top).cast("string").alias("top"))
    for layer in reversed(manifest.key_layers):
        down = _with_paths(layer, down).mapInArrow(_path_task, _PATH_SQL)
    # The n-th leaf of the tree over the keys is the root of the n-th key.
    names = manifest.subroots.select(
        F.col("name").alias("key"), F.col("pos").alias("block"),
        F.lower(F.hex("digest")).alias("own"))
    down = down.drop("key", "subroot").join(names, "block").select(
        "key", F.lit(0).cast("long").alias("block"), "before", "after",
        F.col("own").alias("subroot"), "top")
    tops = stage_table(down, "paths")
    above = None
    for layer in reversed(manifest.layers[1:]):
        alone = _with_paths(layer.where(F.col("total") <= BLOCK), tops)
        both = alone if above is None else alone.unionByName(_with_paths(layer, above))
        above = stage_table(both.mapInArrow(_path_task, _PATH_SQL), "paths")
    layer = manifest.layers[0]
    rows = _with_paths(layer.where(F.col("total") <= BLOCK), tops)
    if above is not None:
        rows = rows.unionByName(_with_paths(layer.where(F.col("total") > BLOCK), above))
    return rows.mapInArrow(
        _proof_task,
        "doc_id long, leaf string, subroot string, root string, proof_sha256 string, "
        "folded_root string, verified boolean")
