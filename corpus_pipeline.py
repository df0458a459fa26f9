"""From raw documents to packed training sequences.

Each stage reads what its predecessor kept, as Parquet, and returns the columns of ``documents``;
the last returns the pieces of the packed sequences. NULL and empty texts have no language and
leave in the first stage. Where there is nothing to learn a language or toxicity from, that stage
keeps all.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyline.llm import apportion, crf_langid, kneser_ney, parity_join, pow2_packing, words
from tallyline.sources.tables import stage_table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
LEAST_SHARE = 0.4
MIX_BLOCK_WORDS = 1024
ORACLE_SQL = None


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with letters of which one language has at least ``LEAST_SHARE``."""
    model = crf_langid.train(docs)
    if not model.languages:
        return docs.select(*COLUMNS)
    found = crf_langid.identify(docs, model, keep=COLUMNS)
    kept = found.where((F.col("lang_pred") != crf_langid.UNKNOWN) & (F.col("score") >= LEAST_SHARE))
    return kept.select("row.*")


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model does not predict as toxic."""
    rest = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(rest != 2)
    found = kneser_ney.score_toxicity(docs, kneser_ney.train(docs, labels), keep=COLUMNS)
    return found.where("predicted = 0").select("row.*")


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of 80 % alike documents (five-word shingles): that of smallest id.

    A document is an id with a text, so an id that stands on different texts is several, and each
    group keeps exactly one row: of the smallest id, then of the smallest text hash, then of the
    first source and language. Rows without an id stay.
    """
    key = F.xxhash64("doc_id", "text")
    named = docs.where("doc_id is not null").withColumn("key", key)
    classes = stage_table(parity_join.jaccard_classes(named, doc_id="key").select(
        F.col("doc_id").alias("key"), "component_id").distinct(), "classes")
    # Ids without texts: 24 bytes a row find the row to stay.
    ids = named.select("key", "doc_id").join(classes, "key")
    first = ids.groupBy("component_id").agg(F.min(F.struct("doc_id", "key")).alias("place"))
    kept = named.join(first.select(F.col("place.key").alias("key")), "key", "left_semi")
    copy = F.row_number().over(Window.partitionBy("key").orderBy("source", "lang"))
    kept = kept.withColumn("copy", copy).where("copy = 1").select(*COLUMNS)
    return kept.union(docs.where("doc_id is null").select(*COLUMNS))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights: texts are repeated, left out, or cut at block ends."""
    out = apportion.mixed_texts(docs, block=MIX_BLOCK_WORDS, columns=COLUMNS)
    return out.withColumn("n_chars", F.length("text").cast("long"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of power-of-two lengths, each a sequence of its own."""
    return pow2_packing.pack(docs, special_tokens=pow2_packing.SPECIAL_TOKENS)


STAGES = [
    ("language_id", known_language),
    ("toxicity", not_toxic),
    ("ngram_jaccard_join", one_of_each_group),
    ("source_mixing", mixed),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``, each written before the next reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        with words.sharing():
            docs = stage_table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
