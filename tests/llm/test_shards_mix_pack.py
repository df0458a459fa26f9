from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from helpers import edge_texts, frame, words

from tallyline.llm import apportion, differencing, pow2_packing


def test_difference_balances_and_is_consistent():
    rng = random.Random(2)
    items = [rng.randrange(1, 5000) for _ in range(400)]
    where, total = differencing.difference([[x, 0, 0, 0] for x in items])
    sums = [0] * 4
    for x, w in zip(items, where):
        sums[w[0]] += x
    assert sums == total and max(sums) - min(sums) <= 2
    where, total = differencing.difference([[8, 0], [7, 0], [6, 0], [5, 0], [4, 0]])
    assert sorted(total) == [14, 16]


@pytest.mark.parametrize("per_task,fan,spread", [(20_000, 512, 200), (5, 2, 1500)])
def test_shards(spark, monkeypatch, per_task, fan, spread):
    monkeypatch.setattr(differencing, "GROUPS_PER_TASK", per_task)
    monkeypatch.setattr(differencing, "FAN_IN", fan)
    rng = random.Random(5)
    rows = edge_texts() + [(900 + i, "word " * rng.randrange(1, 90), "en", "s") for i in range(150)]
    rows = [r for r in rows if r[0] not in (307, 309)]
    got = differencing.shard_documents(frame(spark, rows), 4).collect()
    assert len(got) == len(rows)
    texts = Counter((i, None if t is None else zlib.crc32(t.encode()), len((t or "").encode()) + 1) for i, t, *_ in rows)
    assert Counter((r.doc_id, r.text_crc32, r.size) for r in got) == texts
    by_text, slots, sums = defaultdict(set), defaultdict(list), Counter()
    for r in got:
        by_text[r.text_crc32, r.size].add(r.shard)
        slots[r.shard].append(r.slot)
        sums[r.shard] += r.size
    assert all(len(s) == 1 for s in by_text.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(sums.values()) - min(sums.values()) <= spread
    assert differencing.shard_documents(frame(spark, [])).collect() == []


def test_a_group_beyond_a_share_is_cut(spark):
    rows = [(i, "the very same text", "en", "s") for i in range(300)] + [(1000 + i, f"text {i}", "en", "s") for i in range(100)]
    got = differencing.shard_documents(frame(spark, rows), 4).collect()
    sums = Counter()
    for r in got:
        sums[r.shard] += r.size
    assert len(sums) == 4 and max(sums.values()) < 1.15 * sum(sums.values()) / 4


def brute_targets(sizes, weights=(5, 2, 1), share=1.5, most=2):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, left, open_ = {}, share * sum(sizes.values()), set(names)
    while open_:
        level = left / sum(w[s] for s in open_)
        full = {s for s in open_ if level * w[s] > most * sizes[s]}
        if not full:
            target |= {s: level * w[s] for s in open_}
            break
        for s in full:
            target[s] = float(most * sizes[s])
            left -= target[s]
        open_ -= full
    return target


def brute_quotas(target, total, block, shards):
    """Seats one by one, each to the highest quotient."""
    names = list(target)
    out = {s: [] for s in names}
    for house in range(1, shards + 1):
        n = int(total / block * house / shards + 0.5)
        seats = dict.fromkeys(names, 0)
        for _ in range(n):
            best = max(names, key=lambda s: (target[s] / (2 * seats[s] + 1), -names.index(s)))
            seats[best] += 1
        for s in names:
            out[s].append(seats[s])
    return out


def test_mix(spark):
    rows = [r for r in edge_texts() if r[0] is not None]
    got = apportion.mix_documents(frame(spark, rows), block=8).collect()
    assert len(got) == len(rows)
    sizes = Counter()
    for i, t, _, s in rows:
        sizes[s] += len(words(t))
    want = brute_targets(dict(sizes))
    taken = Counter()
    for r in got:
        assert r.source_size == sizes[r.source] and abs(r.target - want[r.source]) < 1e-6
        assert r.taken <= 2 * r.size and r.taken == sum(p.n for p in r.pieces or [])
        assert all(0 <= p.first and p.first + p.n <= r.size and 0 <= p.shard < 8 for p in r.pieces or [])
        taken[r.source] += r.taken
    assert all(abs(taken[s] - want[s]) <= 16 for s in sizes)
    again = apportion.mix_documents(frame(spark, rows).repartition(5), block=8).collect()
    assert Counter((r.doc_id, r.size, r.taken) for r in got) == Counter((r.doc_id, r.size, r.taken) for r in again)
    assert apportion.mix_documents(frame(spark, [])).collect() == []


def test_quotas_are_the_highest_quotients(spark):
    rng = random.Random(1)
    rows = [(f"s{i:02d}", rng.randrange(0, 4000) * rng.choice([1, 1, 20])) for i in range(17)] + [(None, 77), ("zz", 0)]
    sizes = spark.createDataFrame(rows, "source string, size long")
    targets = apportion.source_targets(sizes)
    ranked = targets.orderBy("s_rank").collect()
    target = {r.s_key: r.target for r in ranked}
    want = brute_quotas(target, sum(target.values()), 64, 8)
    got = {r.s_key: (list(r.upto), r.blocks) for r in apportion.block_quotas(targets, 64, 8).collect()}
    for s, (upto, blocks) in got.items():
        assert upto == [min(x, 2 * blocks) for x in want[s]], s


def test_mixed_texts_keep_their_words(spark):
    rows = [r for r in edge_texts() if r[0] is not None]
    columns = ("doc_id", "text", "source")
    got = apportion.mixed_texts(frame(spark, rows), block=16, columns=columns).collect()
    of = defaultdict(list)
    for r in got:
        of[r.doc_id].append(r.text)
    texts = {i: t for i, t, *_ in rows}
    for i, pieces in of.items():
        for p in pieces:
            assert p in texts[i] and words(p)
    taken = Counter()
    for r in apportion.mix_documents(frame(spark, rows), block=16).collect():
        taken[r.doc_id] += r.taken
    assert {i: sum(len(words(p)) for p in ps) for i, ps in of.items()} == {i: n for i, n in taken.items() if n}


def test_packing_round_trip(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    rows = edge_texts() + [
        (800, "a <|endoftext|> b", "en", "s"), (801, "don't  stop\n\n  now\t x 　y 日本語 🙂🙂 ١٢٣", "en", "s")]
    got = pow2_packing.pack(frame(spark, rows)).collect()
    want = Counter()
    for i, t, *_ in rows:
        want[(i, (*tokenizer.encode(t or "", add_special_tokens=False).ids, 0))] += 1
    docs = defaultdict(list)
    for r in got:
        assert r.length & (r.length - 1) == 0 and r.length <= 1024 and r.offset == 0
        docs[r.doc_id].append(r)
    have = Counter()
    for i, pieces in docs.items():
        for start in range(len([p for p in pieces if p.start == 0])):
            own = sorted(pieces, key=lambda p: p.sequence_id)
            copies = [k for k, p in enumerate(own) if p.start == 0] + [len(own)]
            part = own[copies[start]: copies[start + 1]]
            ids = np.concatenate([np.frombuffer(p.ids, "<u4") for p in part])
            assert [p.start for p in part] == np.cumsum([0] + [p.length for p in part])[:-1].tolist()
            assert all(p.doc_tokens == len(ids) for p in part)
            have[(i, tuple(ids.tolist()))] += 1
    assert have == want
    assert len({r.sequence_id for r in got}) == len(got)
    assert pow2_packing.pack(frame(spark, [])).collect() == []
    assert pow2_packing.piece_lengths(2049 + 6, 1024) == [1024, 1024, 4, 2, 1]


def test_packing_queries_keep_special_tokens(spark, tmp_path):
    """The query and the stage give the ids of the tokenizer at its default settings."""
    import zlib

    import public_tokenizers
    from tokenizers import Tokenizer

    import corpus_pipeline
    from tallyline.llm import queries

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = ["end <|endoftext|>begin", "<|endoftext|><|endoftext|>", "a <|endoftext|> b\n", "<|endoftext|", "plain", None]
    frame(spark, [(i, t, "en", "s") for i, t in enumerate(texts)]).write.parquet(f"{tmp_path}/documents.parquet")
    ids = {i: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0] for i, t in enumerate(texts)}
    assert 50256 in ids[0] and 50256 not in ids[3]
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for r in queries.op9_power_of_two_packing(spark, str(tmp_path)).collect():
        own = np.array(ids[r.doc_id][r.start: r.start + r.length], "<u4")
        assert r.doc_tokens == len(ids[r.doc_id]) and r.ids_crc32 == zlib.crc32(own.tobytes())
    for r in corpus_pipeline.packed(spark, docs, str(tmp_path)).collect():
        assert np.frombuffer(r.ids, "<u4").tolist() == ids[r.doc_id][r.start: r.start + r.length]
