from __future__ import annotations

import random
from collections import Counter

import pytest
from helpers import WORDS, crc, edge_texts, frame, words
from pyspark.sql import functions as F
from test_pairs import brute_classes

import corpus_pipeline
from tallyline.llm import apportion, crf_langid, kneser_ney, pow2_packing

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What each stage keeps, each written and read again."""
    folder = tmp_path_factory.mktemp("stages")
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
        out.append(docs)
    return out


def rows_of(df):
    return Counter((r.doc_id, r.text, r.lang, r.source) for r in df.collect())


def test_every_stage_decides_as_its_operator(spark, stages):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = crf_langid.identify(docs, crf_langid.train(docs)).where("lang_pred <> 'und' and score >= 0.4")
    assert rows_of(docs.join(found.select("doc_id"), "doc_id")) == rows_of(stages[0])
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    labels = spark.createDataFrame([r for r in labels.collect() if crc(r.doc_id) % 4 != 2], labels.schema)
    found = kneser_ney.score_toxicity(stages[0], kneser_ney.train(stages[0], labels)).where("predicted = 0")
    assert rows_of(stages[0].join(found.select("doc_id"), "doc_id")) == rows_of(stages[1])
    before = [(r.doc_id, r.text) for r in stages[1].collect()]
    classes = brute_classes(before, 5, 8, 10)
    assert {r.doc_id for r in stages[2].collect()} == {i for i, (_, c) in classes.items() if i == c}
    taken = {
        r.doc_id: r.taken for r in apportion.mix_documents(
            stages[2], block=corpus_pipeline.MIX_BLOCK_WORDS).collect() if r.taken}
    mixed = Counter()
    for r in stages[3].collect():
        mixed[r.doc_id] += len(words(r.text))
        assert r.n_chars == len(r.text)
    assert mixed == Counter(taken)
    columns = ["doc_id", "start", "length", "doc_tokens"]
    assert Counter(map(tuple, stages[4].select(*columns).collect())) == Counter(
        map(tuple, pow2_packing.pack(stages[3]).select(*columns).collect()))


def test_run_equals_the_stages(spark, stages):
    got = corpus_pipeline.run(spark, SF)
    columns = ["doc_id", "start", "length", "doc_tokens", F.crc32("ids").alias("crc")]
    assert Counter(map(tuple, got.select(*columns).collect())) == Counter(
        map(tuple, stages[-1].select(*columns).collect()))


def test_each_group_keeps_one_row_also_where_an_id_has_two_texts(spark):
    rng = random.Random(1)
    a, z, other = (" ".join(rng.choice(WORDS) + str(rng.randrange(99)) for _ in range(60)) for _ in range(3))
    rows = [(5, a, "en", "s"), (5, z, "en", "s"), (7, z, "en", "s"), (7, z, "en", "s"), (8, z + " more", "en", "s"),
            (9, other, "en", "s"), (9, other, "en", "t"), (3, "", "en", "s"), (3, None, "en", "s"),
            (None, a, "en", "s"), (None, a, "en", "s")]
    got = corpus_pipeline.one_of_each_group(spark, frame(spark, rows).select(*corpus_pipeline.COLUMNS), "").collect()
    assert Counter((r.doc_id, r.text) for r in got) == Counter(
        [(5, a), (5, z), (9, other), (3, ""), (3, None), (None, a), (None, a)])


def test_edge_rows_pass_through(spark, tmp_path):
    docs = frame(spark).select(*corpus_pipeline.COLUMNS)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(5)], "doc_id long, quality int, toxic int").write.parquet(
        f"{tmp_path}/labels.parquet")
    got = {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert got <= {i for i, t, *_ in edge_texts() if t and t.strip()}
    assert 307 in got or 0 in got
    empty = str(tmp_path / "empty")
    docs.limit(0).write.parquet(f"{empty}/documents.parquet")
    spark.read.parquet(f"{tmp_path}/labels.parquet").limit(0).write.parquet(f"{empty}/labels.parquet")
    assert corpus_pipeline.run(spark, empty).collect() == []
