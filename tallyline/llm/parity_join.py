"""N-gram Jaccard join by parity sketches.

A document is the set of its distinct word shingles. A set is XOR-hashed into a sketch of
blocks of 64 bits: each shingle toggles one bit of one block. A shingle in only one of two
sets flips at most one bit, so the Hamming distance of two sketches never exceeds the
symmetric difference of the sets. Similarity ``p/q`` bounds that difference by
``d = (|A| + |B|) (q - p) / (q + p)``; with more than ``d`` blocks there is one that no shingle of
the difference touches (pigeonhole). Such a block also has an equal XOR of its shingles' whole
hashes, which is part of its key: blocks of few shingles, whose 64 bits alone agree by chance, then
make no candidates. Sizes are cut into bands, so partners are in the same or the next band
and the number of blocks fits the size. Documents with an equal block are candidates, and
candidates are verified on their whole sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyline.llm import words as wd
from tallyline.llm.components import components, extended
from tallyline.sources.tables import drop_staged, forget_shuffles, stage_table

WORDS, SIMILARITY = 5, (8, 10)
SPARE = 1.15
BITMAP_BITS = 1 << 25
SKETCH_WORDS = 32
FOLDED_WORDS = 8
ANCHOR_ROUNDS, REST_ROUNDS = 8, 4
ANCHORS, CHOICES = 16, 2
KEY_ROWS = 50_000
_SET, _KEY, _BAND = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F)


def shingle_sets(column: pa.Array, k: int) -> Iterator[tuple[int, np.ndarray]]:
    """Row number and sorted distinct shingle hashes of each row."""
    for row, end, data, at in wd.chunks(column):
        low = wd.LOWER[data]
        starts, ends, doc = wd.spans(low, at, wd.NOT_SPACE)
        h = wd.span_hashes(low, starts, ends)
        grams = wd.gram_hashes(h, k)
        bounds = np.searchsorted(doc, np.arange(end - row + 1))
        for i in range(end - row):
            a, b = bounds[i], bounds[i + 1]
            if b - a >= k:
                yield row + i, np.unique(grams[a: b - k + 1])
            elif b > a:
                yield row + i, wd.gram_hashes(h[a:b], b - a) ^ np.uint64(b - a)
            else:
                yield row + i, h[:0]


def fingerprint(grams: np.ndarray) -> int:
    """64-bit fingerprint of a set, as a signed long."""
    x = np.add.reduce(wd.mix(grams ^ _SET)) + np.uint64(len(grams))
    return int(wd.mix(np.array([x], np.uint64)).view(np.int64)[0])


class Bands:
    """Size bands and block counts for similarity ``p/q``, grown as sizes are met."""

    def __init__(self, p: int, q: int, spare: float):
        self.p, self.q, self.spare = p, q, spare
        self.starts = [1]

    def end(self, band: int) -> int:
        """First size beyond the band: partners of a band are in it or in the next."""
        while len(self.starts) <= band + 1:
            s = self.starts[-1]
            self.starts.append(max(s + 1, (s - 1) * self.q // self.p + 1))
        return self.starts[band + 1]

    def of(self, size: int) -> int:
        while self.starts[-1] <= size:
            self.end(len(self.starts) - 1)
        return int(np.searchsorted(self.starts, size, side="right")) - 1

    def difference(self, a: int, b: int) -> int:
        return (a + b) * (self.q - self.p) // (self.q + self.p)

    def blocks(self, band: int) -> int:
        most = self.end(band) - 1
        need = self.difference(most, most) + 1
        return need if need == 1 else int(np.ceil(need * self.spare))

    def largest_partner(self, size: int) -> int:
        return size * self.q // self.p


def block_keys(grams: np.ndarray, band: int, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of all blocks of one sketch, and how many shingles each block holds.

    A key tells apart the place, the parity bits and the XOR of the whole hashes.
    """
    where = (grams >> np.uint64(6)) % np.uint64(blocks)
    whole = np.zeros(blocks, np.uint64)
    np.bitwise_xor.at(whole, where.astype(np.int64), grams)
    bit = where * np.uint64(64) + (grams & np.uint64(63))
    parity = (np.bincount(bit.astype(np.int64), minlength=blocks * 64) & 1).astype(np.uint8)
    sketch = np.packbits(parity, bitorder="little").view("<u8")
    place = np.uint64(band << 32) + np.arange(blocks, dtype=np.uint64)
    keys = wd.mix(wd.mix(sketch * _KEY + whole) + place * _BAND)
    return keys, np.bincount(where.astype(np.int64), minlength=blocks)


def probes(grams: np.ndarray, bands: Bands) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys under which a set is found (``stored``) and looks for partners (``asks``).

    A set is stored under all blocks of its own band. It asks, in its own band and the next,
    in as many blocks as the pigeonhole argument needs for partners of at least its size. It
    picks the fullest blocks: they are the most selective, and near-empty ones are left out.
    """
    n = len(grams)
    own = bands.of(n)
    most = bands.largest_partner(n)
    out = []
    for band, stored in ((own, True), (own + 1, False)):
        low, high = max(n, bands.end(band - 1) if band else 1), min(most, bands.end(band) - 1)
        if high < low:
            continue
        keys, weight = block_keys(grams, band, bands.blocks(band))
        asks = np.zeros(len(keys), bool)
        need = min(bands.difference(n, high) + 1, len(keys))
        asks[np.argsort(-weight, kind="stable")[:need]] = True
        pick = asks if not stored else np.ones(len(keys), bool)
        out.append((keys[pick], np.full(int(pick.sum()), stored), asks[pick]))
    return tuple(np.concatenate(x) for x in zip(*out))


def _sets_task(k: int):
    def run(batches):
        for batch in batches:
            size = np.zeros(batch.num_rows, np.int64)
            print_ = np.zeros(batch.num_rows, np.int64)
            for i, grams in shingle_sets(batch.column(1), k):
                size[i] = len(grams)
                print_[i] = fingerprint(grams)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(size), pa.array(print_)], ["doc_id", "n", "f"])

    return run


def _keys_task(k: int, p: int, q: int, spare: float):
    def run(batches):
        bands, seen = Bands(p, q, spare), set()
        for batch in batches:
            parts, prints = [], []

            def flush():
                keys, stored, asks = (np.concatenate(x) for x in zip(*parts))
                f = np.repeat(np.array(prints, np.int64), [len(x[0]) for x in parts])
                return pa.RecordBatch.from_arrays(
                    [pa.array(keys.view(np.int64)), pa.array(f), pa.array(stored), pa.array(asks)],
                    ["key", "f", "stored", "asks"])

            rows = 0
            for _, grams in shingle_sets(batch.column(1), k):
                if not len(grams) or (f := fingerprint(grams)) in seen:
                    continue
                seen.add(f)
                parts.append(probes(grams, bands))
                prints.append(f)
                rows += len(parts[-1][0])
                if rows > KEY_ROWS:
                    yield flush()
                    parts, prints, rows = [], [], 0
            if parts:
                yield flush()

    return run


def _scan_task(k: int, bitmap, make_batch):
    """Sketches or sets of the documents whose fingerprint is in the bitmap."""

    def run(batches):
        bits, seen = np.frombuffer(bitmap.value, np.uint8), set()
        for batch in batches:
            prints, grams_of = [], []
            for _, grams in shingle_sets(batch.column(1), k):
                if not len(grams) or (f := fingerprint(grams)) in seen:
                    continue
                at = f % BITMAP_BITS
                if bits[at >> 3] >> (at & 7) & 1:
                    seen.add(f)
                    prints.append(f)
                    grams_of.append(grams)
                if len(prints) >= 256:
                    yield make_batch(prints, grams_of)
                    prints, grams_of = [], []
            if prints:
                yield make_batch(prints, grams_of)

    return run


def sketch_words(n: int) -> int:
    """Words of the sketch of ``n`` shingles: a power of two, with at least a bit for each. Fewer
    would be full, and would tell large sets apart no more."""
    return max(SKETCH_WORDS, 1 << max(0, n - 1 >> 6).bit_length())


def whole_sketch(grams: np.ndarray, words: int) -> np.ndarray:
    """Parity sketch of a set, as signed longs; half its words XORed with the others are the sketch
    of half the length."""
    bit = (grams >> np.uint64(20)) & np.uint64(words * 64 - 1)
    parity = (np.bincount(bit.astype(np.int64), minlength=words * 64) & 1).astype(np.uint8)
    return np.packbits(parity, bitorder="little").view("<i8")


_SKETCHES = "f long, n long, folded array<long>, sketch array<long>"


def _sketch_batch(prints, grams_of) -> pa.RecordBatch:
    sizes = np.array([len(x) for x in grams_of], np.int64)
    sketches = [whole_sketch(x, sketch_words(len(x))) for x in grams_of]
    folded = np.concatenate([np.bitwise_xor.reduce(x.reshape(-1, FOLDED_WORDS)) for x in sketches])
    return pa.RecordBatch.from_arrays(
        [pa.array(prints, pa.int64()), pa.array(sizes),
         wd.list_column(folded, np.full(len(sizes), FOLDED_WORDS), pa.int64()),
         wd.list_column(np.concatenate(sketches), np.array([len(x) for x in sketches]), pa.int64())],
        ["f", "n", "folded", "sketch"])


def _set_batch(prints, grams_of) -> pa.RecordBatch:
    sizes = np.array([len(x) for x in grams_of])
    lists = wd.list_column(np.concatenate(grams_of).view(np.int64), sizes, pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(prints, pa.int64()), lists], ["f", "grams"])


def _bitmap(prints: DataFrame):
    """A fixed-size bitmap of fingerprints, for a scan to leave most other documents out."""
    # Spark counts bitmap positions from 1.
    at = F.pmod("f", F.lit(BITMAP_BITS)) + 1
    parts = (
        prints.select(at.alias("at"))
        .groupBy((F.expr("bitmap_bucket_number(at)") - 1).alias("bucket"))
        .agg(F.expr("bitmap_construct_agg(bitmap_bit_position(at))").alias("bits"))
    )
    whole = np.zeros(BITMAP_BITS // 8, np.uint8)
    # BITMAP_BITS / 32768 rows of 4 KB at most, whatever the input.
    for row in parts.toLocalIterator():
        whole[row.bucket * 4096: row.bucket * 4096 + 4096] = np.frombuffer(row.bits, np.uint8)
    return prints.sparkSession.sparkContext.broadcast(whole.tobytes())


def _verify(pairs: DataFrame, sets: DataFrame, p: int, q: int) -> DataFrame:
    """The pairs whose sets reach the similarity: ``|A & B| (p + q) >= p (|A| + |B|)``."""
    a = sets.select(F.col("f").alias("a"), F.col("grams").alias("ga"))
    b = sets.select(F.col("f").alias("b"), F.col("grams").alias("gb"))
    common = F.size(F.array_intersect("ga", "gb")).cast("long")
    enough = common * (p + q) >= (F.size("ga") + F.size("gb")).cast("long") * p
    return pairs.join(b, "b").join(a, "a").where(enough).select("a", "b")


def jaccard_classes(
    docs: DataFrame, *, k: int = WORDS, similarity: tuple[int, int] = SIMILARITY,
    spare: float = SPARE, doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id``.

    Words are runs of other characters than ASCII white space, with A-Z lower-cased. The set
    of a document is its distinct ``k``-word shingles; a text of fewer words is one shingle. Two
    documents are linked when their Jaccard similarity is ``p/q`` or more, and ``component_id``
    is the smallest id reachable by links.

    NULL and empty texts have an empty set and are linked with nothing (``component_id`` is
    their own id). Equal sets are one node, so copies are never paired. Repeated rows each
    come back, and rows of one ``doc_id`` count as one document. A NULL ``doc_id`` gives a NULL
    component where no other row is linked. Other columns are ignored.

    Candidates of one block are first verified against one anchor each, several times with other
    anchors; documents already connected are not compared again. Blocks of the same documents have
    up to ``ANCHORS`` different anchors at a time, so that a large group whose documents are linked
    with few of the others grows together all the same. Only what is still apart in a
    block is compared pair by pair, so no link is lost. Of the pairs whose sketches are near, one for
    each document is verified at a time, and the others only while they are not connected.
    """
    p, q = similarity
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    base = docs.mapInArrow(_sets_task(k), "doc_id long, n long, f long")
    base = base.withColumn(
        "f", F.when(F.col("n") > 0, F.col("f")).otherwise(F.xxhash64(F.lit("empty"), "doc_id")))
    base = stage_table(base, "sets")

    keys = docs.mapInArrow(
        _keys_task(k, p, q, spare), "key long, f long, stored boolean, asks boolean")
    block = Window.partitionBy("key")
    shared = keys.select(
        "*", F.min("f").over(block).alias("lo"), F.max("f").over(block).alias("hi"),
        F.max("asks").over(block).alias("asked"), F.max("stored").over(block).alias("found"))
    # A block that nobody asks in (it holds next to nothing) makes no candidates.
    shared = shared.where("lo <> hi and asked and found").select("key", "f", "stored", "asks")
    shared = stage_table(shared, "blocks")
    forget_shuffles(docs.sparkSession)

    def scan(nodes: DataFrame, make_batch, schema: str, name: str) -> DataFrame:
        task = _scan_task(k, _bitmap(nodes), make_batch)
        found = docs.mapInArrow(task, schema).join(nodes, "f", "left_semi")
        return stage_table(found.dropDuplicates(["f"]), name)

    sketches = scan(
        shared.select("f").distinct(), _sketch_batch, _SKETCHES, "sketches")
    sets, tried, comps = None, None, None

    def prove(pairs: DataFrame, among: DataFrame) -> None:
        """Verify pairs on whole sets. Those of all documents in ``among`` are read at once, as
        reading them is a pass over the documents."""
        nonlocal sets, comps
        nodes = among.select(F.col("a").alias("f")).union(among.select("b")).distinct()
        if sets is not None:
            nodes = nodes.join(sets.select("f"), "f", "left_anti")
        nodes = stage_table(nodes, "nodes")
        if sets is None or not nodes.isEmpty():
            more = scan(nodes, _set_batch, "f long, grams array<long>", "grams")
            sets = more if sets is None else sets.union(more)
        found = stage_table(_verify(pairs, sets, p, q), "links")
        drop_staged(nodes)
        last = comps
        comps = components(found, "a", "b") if last is None else extended(last, found, "a", "b")
        comps = stage_table(comps, "comps")
        for old in (last, found):
            if old is not None:
                drop_staged(old)
        forget_shuffles(docs.sparkSession)

    def choose(pairs: DataFrame, times: int) -> DataFrame:
        """Verify one pair for each document, ``times`` times or until all pairs are verified or
        connected; the staged rest comes back."""
        for _ in range(times):
            if pairs.isEmpty():
                break
            chosen = stage_table(_one_each(pairs), "chosen")
            prove(chosen, pairs)
            last, pairs = pairs, stage_table(
                _unconnected(pairs.join(chosen, ["a", "b"], "left_anti"), comps), "rest")
            for old in (last, chosen):
                drop_staged(old)
        return pairs

    apart = shared.withColumn("c", F.col("f"))
    left, rounds, later = apart.count(), 0, None
    while left and rounds < ANCHOR_ROUNDS:
        pairs = _anchored(apart, rounds)
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        pairs = stage_table(pairs, "pairs")
        forget_shuffles(docs.sparkSession)
        near = _near(pairs, sketches, p, q)
        # Near pairs that a round leaves over go along to the next, so all pairs met count as tried.
        near, over = stage_table(near if later is None else near.union(later), "near"), later
        forget_shuffles(docs.sparkSession)
        tried = pairs if tried is None else tried.union(pairs)
        later = choose(near, CHOICES)
        if comps is None:
            # Not one near pair: no anchor would connect anything.
            break
        last, apart = apart, stage_table(_still_apart(shared, comps), "apart")
        for old in (over, last):
            if old is not None:
                drop_staged(old)
        before, left = left, apart.count()
        # Anchors go on as long as they connect much of what is apart.
        rounds = rounds + 1 if left < 0.8 * before else ANCHOR_ROUNDS
    if left:
        rest = _all_apart(apart, sketches, p, q)
        if tried is not None:
            rest = rest.join(tried, ["a", "b"], "left_anti").union(later)
        rest = stage_table(rest, "rest")
        forget_shuffles(docs.sparkSession)
        rest = choose(rest, REST_ROUNDS)
        if not rest.isEmpty():
            prove(rest, rest)
    if comps is None:
        comps = base.select(F.col("f").alias("node"), F.col("f").alias("component")).limit(0)

    comps = comps.select(F.col("node").alias("f"), "component")
    rows = base.join(comps, "f", "left").withColumn("c", F.coalesce("component", "f"))
    lowest = rows.groupBy("c").agg(F.min("doc_id").alias("component_id"))
    return rows.select("c", "doc_id", "n").join(lowest, "c").select(
        "doc_id", F.col("n").alias("n_shingles"), "component_id")


def _one_each(pairs: DataFrame) -> DataFrame:
    """One pair for each document that is the second of some. Its set then travels once; the other
    pairs are needed only if this one does not connect the two groups."""
    return pairs.groupBy("b").agg(F.min("a").alias("a")).select("a", "b")


def _unconnected(pairs: DataFrame, comps: DataFrame) -> DataFrame:
    """The pairs that the links found so far do not connect."""
    for side in "ab":
        own = comps.select(F.col("node").alias(side), F.col("component").alias(f"c_{side}"))
        pairs = pairs.join(own, side, "left")
    same = F.coalesce("c_a", "a") == F.coalesce("c_b", "b")
    return pairs.where(~same).select("a", "b")


def _anchored(apart: DataFrame, salt: int) -> DataFrame:
    """Each document of a block with the block's anchor, where they are not yet connected. The key
    is a hash: its remainder tells which anchor the block takes, so a document of many blocks has
    few pairs."""
    which = F.pmod("key", F.lit(ANCHORS))
    anchor = F.min(F.struct(F.xxhash64("f", which, F.lit(salt)), "f", "c")).over(Window.partitionBy("key"))
    star = apart.withColumn("anchor", anchor).where("anchor.c <> c")
    return star.select(
        F.least("f", "anchor.f").alias("a"), F.greatest("f", "anchor.f").alias("b")).distinct()


def _still_apart(shared: DataFrame, comps: DataFrame) -> DataFrame:
    """Blocks with documents of more than one component."""
    block = Window.partitionBy("key")
    now = shared.join(comps.select(F.col("node").alias("f"), "component"), "f", "left")
    now = now.withColumn("c", F.coalesce("component", "f")).drop("component")
    now = now.select("*", F.min("c").over(block).alias("lo"), F.max("c").over(block).alias("hi"))
    return now.where("lo <> hi").drop("lo", "hi")


def _folded_distance(x: str, y: str) -> Column:
    """Hamming distance of two folded sketches."""
    total = F.lit(0)
    for i in range(FOLDED_WORDS):
        total = total + F.bit_count(F.get(x, F.lit(i)).bitwiseXOR(F.get(y, F.lit(i))))
    return total


def _whole_distance(x: str, y: str) -> Column:
    """Hamming distance of two sketches, at the length of the shorter one (the other has at most
    twice its words, as sets of one link have)."""
    words = F.least(F.size(x), F.size(y))

    def short(name: str) -> Column:
        halves = F.zip_with(
            F.slice(name, F.lit(1), words), F.slice(name, words + 1, words), lambda u, v: u.bitwiseXOR(v))
        return F.when(F.size(name) == words, F.col(name)).otherwise(halves)

    apart = F.zip_with(short(x), short(y), lambda u, v: F.bit_count(u.bitwiseXOR(v)))
    return F.aggregate(apart, F.lit(0), lambda total, n: total + n)


def _similar_sizes(a: str, b: str, p: int, q: int) -> Column:
    return F.least(a, b) * q >= F.greatest(a, b) * p


def _near(pairs: DataFrame, sketches: DataFrame, p: int, q: int) -> DataFrame:
    """The pairs whose sizes are near and whose sketches are not too far apart for a link.

    Folded sketches go first, so that the rows of most pairs stay short; only what they leave meets
    the whole sketches.
    """
    for name, distance in (("folded", _folded_distance), ("sketch", _whole_distance)):
        a = sketches.select(F.col("f").alias("a"), F.col("n").alias("n_a"), F.col(name).alias("s_a"))
        b = sketches.select(F.col("f").alias("b"), F.col("n").alias("n_b"), F.col(name).alias("s_b"))
        bound = (F.col("n_a") + F.col("n_b")) * (q - p)
        near = _similar_sizes("n_a", "n_b", p, q) & (distance("s_a", "s_b") * (q + p) <= bound)
        pairs = pairs.join(a, "a").join(b, "b").where(near).select("a", "b")
    return pairs


def _all_apart(apart: DataFrame, sketches: DataFrame, p: int, q: int) -> DataFrame:
    """Pairs of a block that are in different components, one asking and the other stored, and
    whose sketches are near enough.

    The Hamming distance of two sketches is at most the symmetric difference of the sets, so it
    rules out most of these pairs inside the join: what leaves the join are nearly all links. There
    the sketches are folded (XOR of their words), which keeps the bound and the rows
    short; the whole sketches are compared afterwards.
    """
    rows = apart.join(sketches.select("f", "n", F.col("folded").alias("sketch")), "f")
    x, y = (
        rows.select("key", *(F.col(c).alias(f"{side}_{c}") for c in ("f", "c", "stored", "asks", "n", "sketch")))
        for side in "xy")

    bound = (F.col("x_n") + F.col("y_n")) * (q - p)
    met = x.join(y, (
        (x.key == y.key) & F.expr(
            "x_f < y_f and x_c <> y_c and ((x_asks and y_stored) or (y_asks and x_stored))")
        & _similar_sizes("x_n", "y_n", p, q)
        & (_folded_distance("x_sketch", "y_sketch") * (q + p) <= bound)))
    met = met.select(F.col("x_f").alias("a"), F.col("y_f").alias("b")).distinct()
    return _near(met, sketches, p, q)
