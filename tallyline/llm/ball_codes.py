"""Product-quantisation codes of vectors by Ball k-means, in whole numbers.

Vectors are cut into parts, each coded by the nearest entry of its position's codebook. Every
part remembers its entry from the round before. The parts of one entry in a block are a ball: its
centre is the entry (as moved since), its radius the largest distance of a part to it. Exactly:

- only entries j with d(i, j) <= 2 * radius can take a part from entry i: the neighbours;
- a part nearer to its entry than half the way to the closest other entry stays: the stable core;
- any other part needs only neighbours with d(i, j) <= 2 * its own distance: its annular ring.

All distances are squared and whole, so nothing is rounded and ties go to the lower index.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.llm import words as wd
from tallyline.sources.tables import drop_staged, stage_table

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
BLOCK_ROWS = 1 << 15
BLOCK_BYTES = 16 << 20
# Whole numbers below this are exact as doubles.
EXACT = 1 << 53


def part_bounds(width: int, parts: int = PARTS) -> list[int]:
    """Where the parts begin and end; the first ones are longer where the width has a rest."""
    size, rest = divmod(width, parts)
    out = [0]
    for p in range(parts):
        out.append(out[-1] + size + (p < rest))
    return out


def _workable(x: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both as doubles where four times any squared distance is exact, else as Python numbers."""
    most = max([1, *(abs(int(f())) for a in (x, c) if a.size for f in (a.max, a.min))])
    kind = np.float64 if 16 * most * most * max(1, x.shape[1]) < EXACT else object
    return x.astype(kind), c.astype(kind)


def _squares(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of ``x`` to all of ``c``."""
    if x.dtype == object:
        return np.array([[sum((a - b) ** 2) for b in c] for a in x], object).reshape(len(x), len(c))
    return (x * x).sum(1)[:, None] - 2 * (x @ c.T) + (c * c).sum(1)[None]


def ball_assign(x: np.ndarray, home: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry of each part (ties: lower index) and its squared distance.

    ``home`` is any entry of each part; the nearer, the less there is to compare.
    """
    if x.shape[1] == 0:
        return np.zeros(len(x), np.int64), np.zeros(len(x), np.int64)
    x, c = _workable(x, entries)
    between = _squares(c, c)
    away = ((x - c[home]) ** 2).sum(1)
    best, found = home.astype(np.int64), away.copy()
    order = np.argsort(home, kind="stable")
    cuts = np.flatnonzero(np.diff(home[order], prepend=-1))
    for members in np.split(order, cuts[1:]) if len(order) else []:
        i = int(home[members[0]])
        others = np.delete(np.arange(len(c)), i)
        radius = 4 * away[members].max()
        near = others[between[i, others] <= radius]
        if not len(near):
            continue
        near = near[np.argsort(between[i, near], kind="stable")]
        reach = between[i, near]
        moving = members[4 * away[members] >= reach[0]]
        rings = np.searchsorted(reach, 4 * away[moving], side="right")
        # Parts of similar rings share a product: rings up to 1, 2, 4, ... neighbours.
        level = np.ceil(np.log2(np.maximum(rings, 1))).astype(np.int64)
        for one in np.unique(level).tolist():
            rows = moving[level == one]
            some = np.concatenate([[i], near[: min(1 << one, len(near))]])
            some.sort()
            squares = _squares(x[rows], c[some])
            at = squares.argmin(1)  # the first of equal ones, and ``some`` ascends
            best[rows], found[rows] = some[at], squares[np.arange(len(rows)), at]
    return best, found if found.dtype == object else found.astype(np.int64)


# ---- tasks --------------------------------------------------------------------------------

_BLOCK = "ids array<long>, labels array<{label}>, width int, vectors binary, codes binary, errors array<long>, sums binary"
_LONGEST = np.iinfo(np.int64)


def _whole(flat: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x); beyond the range of a long, its ends."""
    scaled = np.floor(flat.astype(np.float64) * scale)
    out = np.where(np.abs(scaled) < 2.0 ** 63, scaled, 0).astype(np.int64)
    out[scaled >= 2.0 ** 63] = _LONGEST.max
    out[scaled <= -(2.0 ** 63)] = _LONGEST.min
    return out


def _narrow(values: np.ndarray) -> np.ndarray:
    """The narrowest type that holds the values."""
    for kind in (np.int16, np.int32):
        if values.size == 0 or (values.min() >= np.iinfo(kind).min and values.max() <= np.iinfo(kind).max):
            return values.astype(kind)
    return values


def _block_task(width: int, scale: int, parts: int):
    """Rows to blocks, everything coded 0."""
    limit = max(1, min(BLOCK_ROWS, BLOCK_BYTES // (8 * max(1, width))))

    def run(batches):
        ids, labels, vectors, n = [], [], [], 0

        def block():
            x = np.concatenate(vectors)
            return pa.RecordBatch.from_arrays(
                [pa.array([pa.concat_arrays(ids).to_pylist()], pa.list_(pa.int64())),
                 pa.array([pa.concat_arrays(labels).to_pylist()], pa.list_(labels[0].type)),
                 pa.array([x.dtype.itemsize], pa.int32()), pa.array([x.tobytes()], pa.binary()),
                 pa.array([bytes(parts * len(x))], pa.binary()),
                 pa.array([None], pa.list_(pa.int64())), pa.array([None], pa.binary())],
                ["ids", "labels", "width", "vectors", "codes", "errors", "sums"])

        for batch in batches:
            column = batch.column(2)
            flat = column.flatten().to_numpy(zero_copy_only=False)
            x = _whole(flat, scale).reshape(len(batch), width)
            row = 0
            while row < len(batch):
                take = min(limit - n, len(batch) - row)
                ids.append(batch.column(0).slice(row, take))
                labels.append(batch.column(1).slice(row, take))
                vectors.append(x[row: row + take])
                n, row = n + take, row + take
                if n == limit:
                    vectors = [_narrow(np.concatenate(vectors))]
                    yield block()
                    ids, labels, vectors, n = [], [], [], 0
        if n:
            vectors = [_narrow(np.concatenate(vectors))]
            yield block()

    return run


_KINDS = {2: np.int16, 4: np.int32, 8: np.int64}


def _round_task(shared, parts: int, names: list[str]):
    """Each block with new codes and errors, and the sums and counts of its parts by entry."""

    def run(batches):
        books = wd.shared_value(shared)
        for batch in batches:
            for row in range(len(batch)):
                one = {name: batch.column(i).slice(row, 1) for i, name in enumerate(names)}
                kind = _KINDS[one["width"][0].as_py()]
                codes = np.frombuffer(one["codes"][0].as_py(), np.uint8).reshape(-1, parts)
                n = len(codes)
                x = np.frombuffer(one["vectors"][0].as_py(), kind).reshape(n, -1)
                bounds = part_bounds(x.shape[1], parts)
                fresh, errors, sums = np.empty_like(codes), np.zeros(n, object), []
                for p, entries in enumerate(books):
                    own = x[:, bounds[p]: bounds[p + 1]]
                    best, found = ball_assign(own, codes[:, p].astype(np.int64), entries)
                    fresh[:, p] = best
                    errors = errors + found.astype(object)
                    sums.append(_sums(own, best, len(entries)))
                capped = [min(int(e), _LONGEST.max) for e in errors]
                out = one | {
                    "codes": pa.array([fresh.tobytes()], pa.binary()),
                    "errors": pa.array([capped], pa.list_(pa.int64())),
                    "sums": pa.array([_packed(sums)], pa.binary()),
                }
                yield pa.RecordBatch.from_arrays([out[c] for c in names], names)

    return run


def _sums(x: np.ndarray, codes: np.ndarray, entries: int) -> np.ndarray:
    """Count and sum of each component of the parts of each entry, as Python numbers where long
    arithmetic could overflow."""
    most = max([1, *(abs(int(f())) for f in (x.max, x.min) if x.size)])
    kind = np.int64 if most * max(1, len(x)) < _LONGEST.max else object
    out = np.zeros((entries, x.shape[1] + 1), kind)
    np.add.at(out[:, 0], codes, 1)
    for j in range(x.shape[1]):
        np.add.at(out[:, j + 1], codes, x[:, j].astype(kind))
    return out


def _packed(sums: list[np.ndarray]) -> bytes:
    """Slots with a value, as text, which holds numbers of any length."""
    flat = [v for part in sums for v in part.ravel().tolist()]
    return " ".join(f"{i}:{v}" for i, v in enumerate(flat) if v).encode()


def _total_task(batches):
    """Slots and their totals over the blocks of a task."""
    total: dict[int, int] = {}
    for batch in batches:
        for packed in batch.column(0).to_pylist():
            for item in packed.split():
                slot, value = item.split(b":")
                total[int(slot)] = total.get(int(slot), 0) + int(value)
    if total:
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.int64()), pa.array([str(v) for v in total.values()])],
            ["slot", "value"])


def _code_task(parts: int):
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                texts = row["codes"].hex()
                n = len(row["ids"])
                code = [texts[i * 2 * parts: (i + 1) * 2 * parts] for i in range(n)]
                label = batch.schema.field("labels").type.value_type
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["ids"], pa.int64()), pa.array(row["labels"], label),
                     pa.array(code), pa.array(row["errors"], pa.int64())],
                    ["vec_id", "label", "code", "error"])

    return run


# ---- Spark --------------------------------------------------------------------------------

@dataclass(frozen=True)
class Codes:
    """Codes of the vectors, and the codebooks: per part an array of entries by components."""

    rows: DataFrame  # vec_id, label, code, error
    books: list[np.ndarray]

    def sha256(self) -> str:
        """Of all components, decimal, joined by commas."""
        flat = (str(int(v)) for book in self.books for v in book.ravel())
        return hashlib.sha256(",".join(flat).encode()).hexdigest()


def _moved(books: list[np.ndarray], totals: dict[int, int]) -> list[np.ndarray]:
    """Each used entry at the floor of the mean of its parts."""
    out, slot = [], 0
    for book in books:
        entries, size = book.shape
        new = book.copy()
        for k in range(entries):
            count = totals.get(slot, 0)
            if count:
                new[k] = [totals.get(slot + 1 + j, 0) // count for j in range(size)]
            slot += size + 1
        out.append(new)
    return out


def usable(vector: str = "embedding"):
    """The vector is there, and all its components are there and finite."""
    def finite(x):
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))

    return F.col(vector).isNotNull() & F.coalesce(F.forall(vector, finite), F.lit(False))


def fit_codes(
    embeddings: DataFrame, *, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
    scale: int = SCALE, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label",
) -> Codes:
    """Fit codebooks and code all vectors.

    Vectors that are NULL, or hold NULL or non-finite components, leave. The first codebook is
    the ``entries`` smallest ids' parts (equal ids by vector; fewer where there are fewer; a
    vector without id is coded, but is no first entry). Each of ``rounds`` rounds assigns all
    parts and moves each used entry to the floor of the mean; then parts are assigned once more.

    Vectors of another length than the first one's leave too. Where the length does not divide
    by ``parts``, the first parts are a component longer. Components beyond the range of a long
    become its ends, and so do errors. Repeated rows are coded each. An empty table has no codes
    and empty codebooks.

    A round reads and writes one table of blocks, which replaces the round's before; besides
    that only sums per entry are shuffled. The driver holds the codebooks, whose size is a
    parameter.
    """
    if not 0 < entries <= 256:
        raise ValueError("a code is one byte: 1 to 256 entries")
    spark = embeddings.sparkSession
    kept = embeddings.where(usable(vector)).select(
        F.col(vec_id).cast("long").alias("id"), F.col(label).alias("label"),
        F.col(vector).cast("array<double>").alias("v"))
    named = kept.where("id is not null").orderBy("id", "v")
    first = named.limit(entries).collect() or kept.orderBy("v").limit(1).collect()
    width = len(first[0].v) if first else 0
    whole = [r.v for r in first if len(r.v) == width]
    start = _whole(np.array(whole, np.float64).reshape(len(whole), width), scale)
    bounds = part_bounds(width, parts)
    books = [start[:, bounds[p]: bounds[p + 1]] for p in range(parts)]

    kind = kept.schema["label"].dataType.simpleString()
    schema = _BLOCK.format(label=kind)
    names = ["ids", "labels", "width", "vectors", "codes", "errors", "sums"]
    blocks = stage_table(
        kept.where(F.size("v") == width).mapInArrow(_block_task(width, scale, parts), schema), "blocks")
    for turn in range(rounds + 1):
        shared = wd.share(spark, books)
        task = _round_task(shared, parts, names)
        fresh = stage_table(blocks.mapInArrow(task, schema), "blocks")
        shared.unpersist()
        drop_staged(blocks)
        blocks = fresh
        if turn < rounds:
            totals = blocks.select("sums").mapInArrow(_total_task, "slot long, value string")
            totals = totals.groupBy("slot").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("v"))
            books = _moved(books, {r.slot: int(r.v) for r in totals.collect()})
    rows = blocks.select("ids", "labels", "codes", "errors").mapInArrow(
        _code_task(parts), f"vec_id long, label {kind}, code string, error long")
    return Codes(rows, books)


def code_report(codes: Codes) -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256``; NULL labels count as one label."""
    sums = codes.rows.groupBy("label").agg(F.sum("error").alias("label_error"))
    sums = sums.withColumnRenamed("label", "same")
    out = codes.rows.join(sums, F.col("label").eqNullSafe(F.col("same")))
    return out.select(
        "vec_id", "code", "error", "label_error", F.lit(codes.sha256()).alias("codebooks_sha256"))
