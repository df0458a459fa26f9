"""The operators of this package as named queries over the test tables."""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.llm import (
    apportion,
    ball_codes,
    chat_format,
    crf_langid,
    diagonal_scan,
    differencing,
    kneser_ney,
    line_rules,
    metric_join,
    mixing_lm,
    oracles,
    parity_join,
    pow2_packing,
    veb_merkle,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def op1_parity_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    """Components of documents whose 3-word shingle sets are 90 % alike."""
    return parity_join.jaccard_classes(
        _documents(spark, folder), k=3, similarity=(9, 10), spare=1.0)


def op2_karmarkar_karp_shards(spark: SparkSession, folder: str) -> DataFrame:
    """Eight shards of equal bytes; equal texts stay together."""
    out = differencing.shard_documents(_documents(spark, folder), 8)
    return out.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int"),
        "slot", F.lit(None).cast("int").alias("grown_shard"))


def op3_sainte_lague_mix(spark: SparkSession, folder: str) -> DataFrame:
    """Words that a mix of one and a half times all words takes from each document."""
    out = apportion.mix_documents(_documents(spark, folder))
    return out.select("doc_id", "size", "source_size", "target", "taken")


def _id_rest(divisor: int):
    """crc32 of the id as text, modulo ``divisor``; NULL for a NULL id."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % divisor


def _held_out(divisor: int, rest: int):
    return F.coalesce(_id_rest(divisor) == rest, F.lit(False))


def op4_context_mixing_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Unigram and mixing-model scores of all documents, learnt outside the held-out tenth."""
    docs = _documents(spark, folder)
    train = "crc32(cast(cast(doc_id as string) as binary)) % 10 != 0"
    out = mixing_lm.score_documents(docs, train=train)
    return out.select(
        "doc_id", _held_out(10, 0).alias("held_out"), "n_tokens", "n_known", "train_tokens",
        "base_score", "score", "bits_per_byte")


def op5_kneser_ney_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of all documents, learnt from the labels outside the held-out quarter."""
    docs = _documents(spark, folder)
    labels = spark.read.parquet(f"{folder}/labels.parquet").where(_id_rest(4) != 2)
    out = kneser_ney.score_toxicity(docs, kneser_ney.train(docs, labels))
    return out.select("doc_id", _held_out(4, 2).alias("held_out"), "score", "predicted")


def op6_line_first_cleaning(spark: SparkSession, folder: str) -> DataFrame:
    """Counts and verdict of the line rules for all documents."""
    return line_rules.clean_documents(_documents(spark, folder)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept")


def op7_metric_range_join(spark: SparkSession, folder: str) -> DataFrame:
    """Links and components of all embeddings at cosine 0.98."""
    return metric_join.near_duplicates(spark.read.parquet(f"{folder}/embeddings.parquet"))


def op8_diagonal_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    """License phrases and notices in all documents."""
    return diagonal_scan.scan_licenses(_documents(spark, folder)).drop("spans")


def op9_power_of_two_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Pieces of all documents, each a sequence of a power of two of ids."""
    out = pow2_packing.pack(
        _documents(spark, folder), length=1024, special_tokens=pow2_packing.SPECIAL_TOKENS)
    return out.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
        "sequence_id", "offset")


def op10_crf_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """Language of all documents, learnt outside the held-out quarter."""
    docs = _documents(spark, folder)
    model = crf_langid.train(docs.where(_id_rest(4) != 2))
    out = crf_langid.identify(docs, model)
    return out.select("doc_id", _held_out(4, 2).alias("held_out"), "lang_pred", "score")


def op11_veb_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Proofs of all documents; in a fifth of them the text is found lower-cased."""
    found = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    found = F.when(F.coalesce(_id_rest(5) == 0, F.lit(False)), found).otherwise(F.col("text"))
    return veb_merkle.verify(veb_merkle.build(_documents(spark, folder), claimed_text=found))


def op12_token_level_chats(spark: SparkSession, folder: str) -> DataFrame:
    """All conversations and a probe, formatted, and read back from the ids."""
    rows = spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text")
    rows = rows.unionByName(chat_format.control_probe(spark))
    return chat_format.read_back(chat_format.format_chats(rows), in_order=True)


def op13_ball_k_means_codes(spark: SparkSession, folder: str) -> DataFrame:
    """Codes of all embeddings, four parts of one byte."""
    rows = spark.read.parquet(f"{folder}/embeddings.parquet")
    return ball_codes.code_report(ball_codes.fit_codes(rows))


for _make in (
    op1_parity_jaccard_join,
    op2_karmarkar_karp_shards,
    op3_sainte_lague_mix,
    op4_context_mixing_scores,
    op5_kneser_ney_toxicity,
    op6_line_first_cleaning,
    op7_metric_range_join,
    op8_diagonal_license_scan,
    op9_power_of_two_packing,
    op10_crf_language_id,
    op11_veb_merkle_manifest,
    op12_token_level_chats,
    op13_ball_k_means_codes,
):
    QUERIES[_make.__name__] = _make

ORACLES["op11_veb_merkle_manifest"] = oracles.merkle()
ORACLES["op12_token_level_chats"] = oracles.chats()
ORACLES["op13_ball_k_means_codes"] = oracles.codes()
