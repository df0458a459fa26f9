"""Mixing sources to target weights by Sainte-Lague apportionment of equal-token blocks.

Each source's tokens are cut into blocks of equal length. The blocks of the mix are seats: they
go to the sources with the highest quotients target / (2 seats + 1), which gives integer quotas
per source and output shard. Which blocks fill the quota is decided by a seeded permutation.
Everything is DataFrame operations; only one row per source is ever brought together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyline.sources.tables import stage_table

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
BLOCK_WORDS = 32
SHARDS = 8
ROWS_PER_RUN = 5_000
# Fixed primes for the block permutation; a source uses one that does not divide its block count.
PRIMES = (1_000_003, 1_000_033, 1_000_037, 1_000_039, 1_000_081)


def source_targets(
    sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST,
) -> DataFrame:
    """``s_key, source, source_size, s_rank, target`` per source, from rows ``source, size``.

    Sources are ranked by code point, NULL last, and their weights repeat. The mix has ``share``
    times all words. A target stops at ``most`` times its source's size; the rest goes to the
    others by weight, which is the level at which all are filled as far as they can.
    """
    key = F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n")).alias("s_key")
    out = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").isNull(), "source"))
    out = out.select(key, "source", "source_size", rank.alias("s_rank"))
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("s_rank") - 1) % len(weights) + 1)
    out = out.withColumn("weight", weight.cast("double"))
    out = out.withColumn("cap", F.col("source_size") * F.lit(float(most)))
    fullest = Window.orderBy(F.col("cap") / F.col("weight"), "s_rank")
    earlier = fullest.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    mix = F.sum("source_size").over(everything) * F.lit(float(share))
    rest = mix - F.coalesce(F.sum("cap").over(earlier), F.lit(0.0))
    open_weight = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(earlier), F.lit(0.0))
    out = out.withColumn("level", rest / open_weight)
    fits = F.when(F.col("cap") / F.col("weight") >= F.col("level"), F.struct(
        F.col("cap") / F.col("weight"), F.col("s_rank"), F.col("level").alias("level")))
    level = F.min(fits).over(everything)["level"]
    target = F.least("cap", F.coalesce(level * F.col("weight"), F.col("cap")))
    return out.select("s_key", "source", "source_size", "s_rank", target.alias("target"))


def block_quotas(
    targets: DataFrame, block: int = BLOCK_WORDS, shards: int = SHARDS, most: int = MOST,
) -> DataFrame:
    """``s_key, blocks, quota`` and ``upto``, the quota within the first 1, 2, .. shards.

    Seats are apportioned for the first shard, the first two, and so on: quotas by highest
    quotients never fall as the house grows, so the differences are each shard's quotas. A
    source surely has the seats below its exact quota less a margin; only the quotients around
    it are ranked, a number of rows that follows the sources and not their words.
    """
    everything = Window.partitionBy()
    blocks = F.ceil(F.col("source_size") / block).alias("blocks")
    total = F.sum("target").over(everything)
    base = targets.select(
        "s_key", "s_rank", "target", blocks, total.alias("total"),
        F.count("*").over(everything).alias("n"))
    base = base.select("*", F.explode(F.sequence(F.lit(1), F.lit(shards))).alias("house"))
    seats = F.round(F.col("total") / block * F.col("house") / shards).cast("long")
    part = F.when(F.col("total") > 0, F.col("target") / F.col("total")).otherwise(0.0)
    base = base.withColumns({"seats": seats, "part": part})
    exact = F.col("seats") * F.col("part")
    margin = F.ceil(F.col("part") * F.col("n")) + 1
    base = base.withColumn("sure", F.greatest(F.floor(exact) - margin, F.lit(0)).cast("long"))
    last = (F.ceil(exact) + margin).cast("long")
    asked = base.select("*", F.explode(F.sequence("sure", last)).alias("seat"))
    house = Window.partitionBy("house")
    quotient = F.col("target") / (2 * F.col("seat") + 1)
    asked = asked.withColumn(
        "place", F.row_number().over(house.orderBy(quotient.desc(), "s_rank", "seat")))
    sure = F.sum(F.when(F.col("seat") == F.col("sure"), F.col("sure"))).over(house)
    won = asked.withColumn("won", (F.col("place") <= F.col("seats") - sure) & (F.col("target") > 0))
    quota = F.least(F.first("sure") + F.sum(F.col("won").cast("long")), F.first("blocks") * most)
    out = won.groupBy("s_key", "house").agg(quota.alias("quota"), F.first("blocks").alias("blocks"))
    upto = F.transform(F.sort_array(F.collect_list(F.struct("house", "quota"))), lambda x: x["quota"])
    return out.groupBy("s_key").agg(
        F.first("blocks").alias("blocks"), F.max("quota").alias("quota"), upto.alias("upto"))


def _place(block: Column) -> Column:
    """Place of a block in its source's seeded order: an affine permutation."""
    return F.pmod(block * (F.col("factor") % F.col("blocks")) + F.col("shift"), F.col("blocks"))


def mix_documents(
    docs: DataFrame, *, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST,
    block: int = BLOCK_WORDS, shards: int = SHARDS, seed: int = 17,
    doc_id: str = "doc_id", text: str = "text", source: str = "source", keep: tuple[str, ...] = (),
) -> DataFrame:
    """Rows with ``doc_id, source, size, source_size, target, taken`` and ``pieces``.

    ``pieces`` lists what the mix takes: ``first`` and ``n`` (words of the document) and the
    output ``shard``, once for each time; ``taken`` is their words in all. A block is taken at
    most ``most`` times, so a document never exceeds ``most`` times its size. Columns named in
    ``keep`` go along in a struct ``row``.

    A NULL or empty text has size 0 and nothing taken. NULL sources are one source, ranked last.
    Repeated rows each have their own place; rows that are equal in ``doc_id``, size and text may
    swap places, which leaves the result as it is. An empty table gives no rows.
    """
    row = [F.struct(*keep).alias("row")] if keep else []
    base = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(source).alias("source"),
        F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.xxhash64(text).alias("t"), *row)
    base = stage_table(base, "sizes")
    targets = stage_table(source_targets(base.select("source", "size"), weights, share, most), "targets")
    quotas = stage_table(block_quotas(targets, block, shards, most), "quotas")
    pick = F.pmod(F.xxhash64("s_key", F.lit(seed)), F.lit(len(PRIMES))).cast("int")
    primes = F.array(*map(F.lit, PRIMES))
    prime, spare = (F.get(primes, (pick + i) % len(PRIMES)) for i in (0, 1))
    plan = targets.join(quotas, "s_key").withColumns({
        "factor": F.when(F.col("blocks") % prime != 0, prime).otherwise(spare).cast("long"),
        "shift": F.pmod(F.xxhash64("s_key", F.lit(seed + 1)), F.greatest("blocks", F.lit(1))),
    })
    plan = stage_table(plan.drop("source", "s_rank"), "plan")

    # Places of documents in their source's word stream: sums within runs of bounded size, then
    # over the runs of a source.
    runs = max(1, -(-base.count() // ROWS_PER_RUN))
    key = F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n")).alias("s_key")
    run = F.pmod(F.xxhash64("doc_id", "t"), F.lit(runs)).alias("run")
    base = base.select("*", key, run)
    lengths = base.groupBy("s_key", "run").agg(F.sum("size").alias("n"))
    earlier_runs = Window.partitionBy("s_key").orderBy("run").rowsBetween(
        Window.unboundedPreceding, -1)
    lengths = lengths.select(
        "s_key", "run", F.coalesce(F.sum("n").over(earlier_runs), F.lit(0)).alias("run_start"))
    order = Window.partitionBy("s_key", "run").orderBy("doc_id", "size", "t")
    placed = base.withColumn("at", F.coalesce(
        F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    placed = placed.join(lengths, ["s_key", "run"]).join(plan, "s_key")
    start = F.col("at") + F.col("run_start")
    placed = placed.withColumns({"start": start, "stop": start + F.col("size")})

    # Every block is taken quota / blocks times, and the first blocks in the order once more.
    places = F.transform(
        F.sequence(F.lit(0), F.lit(most - 1)), lambda c: c.cast("long") * F.col("blocks"))

    def of_block(b: Column) -> Column:
        first = F.greatest(b * block, "start")
        n = F.least((b + 1) * block, "stop") - first
        taken = F.filter(F.transform(places, lambda c: c + _place(b)), lambda r: r < F.col("quota"))
        return F.transform(taken, lambda r: F.struct(
            (first - F.col("start")).alias("first"), n.alias("n"),
            F.size(F.filter("upto", lambda u: u <= r)).alias("shard")))

    its_blocks = F.sequence(
        F.floor(F.col("start") / block), F.floor((F.col("stop") - 1) / block))
    pieces = F.when(F.col("size") > 0, F.flatten(F.transform(its_blocks, of_block)))
    placed = placed.withColumn("pieces", pieces)
    taken = F.aggregate("pieces", F.lit(0).cast("long"), lambda s, p: s + p["n"])
    return placed.select(
        "doc_id", "source", "size", "source_size", "target",
        F.coalesce(taken, F.lit(0)).cast("long").alias("taken"), "pieces", *(["row"] if keep else []))


def mixed_texts(
    docs: DataFrame, *, block: int, columns: tuple[str, ...], text: str = "text", **options,
) -> DataFrame:
    """The mix itself: a row with ``columns`` of the document and the ``text`` of each piece.

    A document of which all blocks are taken equally often is repeated whole so many times.
    Of others each taken piece is a row; it has the words as they stand, with the white space
    between them. Documents without words are not in the mix.
    """
    mixed = mix_documents(docs, block=block, text=text, keep=tuple({*columns, text}), **options)
    mixed = mixed.select("row", "size", "taken", "pieces").where("taken > 0")
    times = F.col("taken") / F.col("size")
    even = (F.col("taken") % F.col("size") == 0) & F.forall("pieces", lambda p: F.size(
        F.filter("pieces", lambda o: o["first"] == p["first"])) == times)
    whole = F.struct(F.lit(0).cast("long").alias("first"), F.col("size").alias("n"))
    parts = F.when(even, F.array_repeat(whole, times.cast("int"))).otherwise(
        F.transform("pieces", lambda p: F.struct(p["first"].alias("first"), p["n"].alias("n"))))
    out = mixed.select("row", "size", F.explode(parts).alias("part"))
    whole_text = F.col("part.n") == F.col("size")
    words = F.regexp_extract_all(f"row.{text}", F.lit(rf"[\x20\x09-\x0D]*{WORD}"), F.lit(0))
    cut = F.array_join(F.slice(words, (F.col("part.first") + 1).cast("int"), F.col("part.n").cast("int")), "")
    out = out.withColumn(
        "piece", F.when(whole_text, F.col(f"row.{text}")).otherwise(F.ltrim(cut)))
    return out.select(*(
        F.col("piece").alias(c) if c == text else F.col(f"row.{c}").alias(c) for c in columns))
