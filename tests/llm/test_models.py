from __future__ import annotations

import itertools
import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from helpers import crc, edge_texts, frame, words

from tallyline.llm import crf_langid, kneser_ney, mixing_lm, queries

SF = "/root/testdata/sf0.01"


def test_forward_backward_equals_enumeration():
    rng = np.random.default_rng(0)
    k, lengths = 3, [5, 1, 0, 4]
    bounds = np.cumsum([0, *lengths])
    scores = rng.normal(size=(bounds[-1], k)) * 2
    transitions = rng.normal(size=(k, k))
    marginals, expected = crf_langid.forward_backward(scores, bounds, transitions)
    want, pairs = np.zeros_like(scores), np.zeros((k, k))
    for a, b in zip(bounds, bounds[1:]):
        total = 0
        own, own_pairs = np.zeros((b - a, k)), np.zeros((k, k))
        for path in itertools.product(range(k), repeat=b - a):
            s = sum(scores[a + i, y] for i, y in enumerate(path))
            s = math.exp(s + sum(transitions[x, y] for x, y in zip(path, path[1:])))
            total += s
            for i, y in enumerate(path):
                own[i, y] += s
            for x, y in zip(path, path[1:]):
                own_pairs[x, y] += s
        if b > a:
            want[a:b] = own / total
            pairs += own_pairs / total
    assert np.allclose(marginals, want) and np.allclose(expected, pairs)


def test_forward_backward_across_blocks():
    """Long sequences agree with a step-by-step recursion."""
    rng = np.random.default_rng(1)
    bounds = np.array([0, 150, 151, 400])
    scores, t = rng.normal(size=(400, 2)), rng.normal(size=(2, 2))
    marginals, _ = crf_langid.forward_backward(scores, bounds, t)
    for a, b in zip(bounds, bounds[1:]):
        f, g = np.zeros((b - a, 2)), np.zeros((b - a, 2))
        f[0] = scores[a]
        for i in range(1, b - a):
            f[i] = scores[a + i] + np.logaddexp.reduce(f[i - 1][:, None] + t, axis=0)
        for i in range(b - a - 2, -1, -1):
            g[i] = np.logaddexp.reduce(t + (scores[a + i + 1] + g[i + 1])[None], axis=1)
        m = np.exp(f + g - np.logaddexp.reduce(f + g, axis=1)[:, None])
        assert np.allclose(marginals[a:b], m, atol=1e-9)


@pytest.fixture(scope="module")
def languages(spark):
    return queries.op10_crf_language_id(spark, SF).toPandas()


def test_language_accuracy(spark, languages):
    docs = spark.read.parquet(f"{SF}/documents.parquet").toPandas()
    both = languages.merge(docs, on="doc_id")
    assert len(both) == len(docs)
    assert (both.held_out == both.doc_id.map(lambda i: crc(i) % 4 == 2)).all()
    held = both[both.held_out]
    assert (held.lang_pred == held.lang).mean() > 0.97


def test_language_edge_rows_and_switches(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = crf_langid.train(docs, rows=400)
    got = crf_langid.identify(frame(spark), model, keep=("source",)).collect()
    assert len(got) == len(edge_texts())
    by = {r.doc_id: r for r in got}
    for i in (300, 301, 302, 306):
        assert by[i].lang_pred == "und" and by[i].score == 0.0
    assert all(0 <= r.score <= 1 and (r.lang_pred == "und" or abs(sum(r.shares) - 1) < 1e-4) for r in got)
    # Two languages in one text: each half is labelled with its own.
    texts = {r.lang: r.text for r in docs.where("length(text) between 300 and 900").collect()}
    w = [" ".join(texts[lang].split()[:40]) for lang in ("en", "fr")]
    row = crf_langid.identify(frame(spark, [(1, " ".join(w), None, None)]), model, label_words=True).first()
    half = len(row.word_langs) // 2
    assert Counter(row.word_langs[:half - 8]).most_common(1)[0][0] == "en"
    assert Counter(row.word_langs[half + 8:]).most_common(1)[0][0] == "fr"
    assert crf_langid.identify(frame(spark, []), model).collect() == []
    none = crf_langid.train(frame(spark, []))
    assert {r.lang_pred for r in crf_langid.identify(frame(spark), none).collect()} == {"und"}


def brute_ratio(seen, word):
    """Kneser-Ney spelling probabilities by dictionaries, from {word: (ordinary, toxic)}."""
    d, order, shared = kneser_ney.DISCOUNT, kneser_ney.ORDER, kneser_ney.SHARED_ORDER
    marked = {(1, *w, 2): n for w, n in seen.items()}

    def counts(n, c):
        out = Counter()
        if n == order:
            for w, k in marked.items():
                for i in range(max(n - 1, 1), len(w)):
                    out[w[i - n + 1: i + 1]] += k[c]
            return out
        kinds = set()
        for w, k in marked.items():
            for i in range(max(n - 1, 1), len(w)):
                g = w[i - n + 1: i + 1]
                if i == n - 1:
                    out[g] += k[c]
                elif k[c]:
                    kinds.add(w[i - n: i + 1])
        for g in kinds:
            out[g[1:]] += 1
        return out

    tables = {(n, c): counts(n, c) for n in range(1, order + 1) for c in (0, 1)}
    for n in range(1, shared + 1):
        both = tables[n, 0] + tables[n, 1]
        tables[n, 0] = tables[n, 1] = both

    def p(n, c, g):
        if n == 0:
            return 1 / 256
        own = {k: v for k, v in tables[n, c].items() if k[:-1] == g[:-1] and v > 0}
        total = sum(own.values())
        if not total:
            return p(n - 1, c, g[1:])
        return max(own.get(g, 0) - d, 0) / total + d * len(own) / total * p(n - 1, c, g[1:])

    w = (1, *word, 2)
    out = 0.0
    for i in range(1, len(w)):
        n = min(order, i + 1)
        if n > shared:
            g = w[i - n + 1: i + 1]
            out += math.log(p(n, 1, g) / p(n, 0, g))
    return out


def test_kneser_ney_equals_brute_force():
    seen = {b"idiot": (0, 5), b"idea": (6, 1), b"stupid": (1, 4), b"student": (7, 0), b"a": (9, 9), b"idiotic": (0, 1)}
    names = list(seen)
    low = np.frombuffer(b"".join(names), np.uint8)
    ends = np.cumsum([len(x) for x in names])
    starts = ends - np.array([len(x) for x in names])
    model = kneser_ney.count(low, starts, ends, np.array(list(seen.values())))
    other = [b"idiot", b"idiots", b"stupidity", b"a", b"zebra", b"student", b"i"]
    at = np.cumsum([len(x) for x in other])
    got = kneser_ney.log_ratios(model, np.frombuffer(b"".join(other), np.uint8), at - np.array([len(x) for x in other]), at)
    assert np.allclose(got, [brute_ratio(seen, w) for w in other], atol=1e-4)


def test_toxicity_of_held_out_documents(spark):
    got = queries.op5_kneser_ney_toxicity(spark, "/root/testdata/sf0.1").toPandas()
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").toPandas()
    assert len(got) == spark.read.parquet("/root/testdata/sf0.1/documents.parquet").count()
    held = got.merge(labels, on="doc_id")
    held = held[held.held_out]
    rank = held.score.rank()
    n1, n0 = (held.toxic == 1).sum(), (held.toxic == 0).sum()
    assert (rank[held.toxic == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * n0) > 0.9
    assert ((held.predicted == 1) == (held.score >= 0.3)).all()
    assert held[held.toxic == 0].predicted.mean() < 0.05


def test_toxicity_edge_rows(spark):
    texts = [f"you are a{' stupid' * (i % 2)} person number {i}" for i in range(60)]
    model = kneser_ney.fit(texts, [i % 2 for i in range(60)], 0.5)
    got = kneser_ney.score_toxicity(frame(spark), model, keep=("source", "lang")).collect()
    assert len(got) == len(edge_texts()) and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.doc_id in (300, 301, 302, 306)}) == 1
    two = kneser_ney.score_toxicity(frame(spark, [(1, "a stupid person", "en", "s"), (2, "a person", "en", "s")]), model)
    assert {r.doc_id: r.predicted for r in two.collect()} == {1: 1, 2: 0}
    assert kneser_ney.score_toxicity(frame(spark, []), model).collect() == []
    plain = kneser_ney.fit(texts, [0] * 60, 0.0)
    assert {r.predicted for r in kneser_ney.score_toxicity(frame(spark), plain).collect()} == {0}
    labels = spark.createDataFrame([(i, i % 2) for i in (0, 1, 2, 3, 3)], "doc_id long, toxic int")
    kneser_ney.train(frame(spark), labels)


def tokens(text):
    return [*words(text), None]


def test_base_scores_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(mixing_lm, "COMMON_WORDS", 5)
    rows = edge_texts()
    got = mixing_lm.score_documents(
        frame(spark, rows), train="doc_id % 3 <> 0", table_bits=(10, 12, 12)).collect()
    counts = Counter()
    for i, t, *_ in rows:
        if i is not None and math.fmod(i, 3) != 0:
            counts.update(tokens(t))
    n, v = sum(counts.values()), len(counts)
    assert len(got) == len(rows)
    want = Counter()
    for i, t, *_ in rows:
        own = tokens(t)
        s = sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in own)
        want[(i, len(own), sum(counts[w] > 0 for w in own), n, round(s, 5))] += 1
    assert Counter((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in got) == want
    assert all(r.score < 0 for r in got)
    size = Counter()
    for i, t, *_ in rows:
        size[(i, max(1, sum(len(w) + 1 for w in words(t))))] += 1
    assert Counter((r.doc_id, round(-r.score * math.log2(10) / r.bits_per_byte)) for r in got) == size
    assert mixing_lm.score_documents(frame(spark, []), train="true").collect() == []


def test_spelling_is_a_probability():
    tree = mixing_lm.Tree(np.bincount(np.frombuffer(b"some words and other words " * 9, np.uint8), minlength=256).astype(float))
    bits = (8, 8, 8)
    rng = np.random.default_rng(3)
    tables = [rng.integers(-60, 60, 1 << b).astype(np.int8) for b in bits]
    weights = rng.normal(size=(mixing_lm.GATES, 4, 2)).astype(np.float32)
    model = mixing_lm.Model(tree, tables, weights, bits, np.empty(0, np.uint64), np.empty(0), 1)
    for n in (0, 1, 7):  # what may follow a prefix sums to one, for each set of weights
        prefix = rng.integers(0x61, 0x7B, n, dtype=np.uint8)
        stream = np.concatenate([np.append(prefix, b) for b in np.arange(256, dtype=np.uint8)])
        scores = mixing_lm.score_streams(model, stream, np.arange(257) * (n + 1))
        start = mixing_lm.score_streams(model, prefix, np.array([0, n]))[0] if n else 0.0
        assert np.allclose(np.exp(scores - start).sum(0), 1, atol=1e-3)


def test_spelling_stream():
    low = np.frombuffer(b"ab xyz", np.uint8)
    stream, bounds = mixing_lm.spelling(low, np.array([3, 0]), np.array([6, 2]))
    assert stream.tobytes() == b"xyz ab " and bounds.tolist() == [0, 4, 7]


def test_mixing_beats_the_unigram_base_where_words_are_known(spark):
    """On held-out text of so small a corpus the base's one unknown word is cheaper than spelling."""
    got = queries.op4_context_mixing_scores(spark, SF).toPandas()
    assert (got.held_out == got.doc_id.map(lambda i: crc(i) % 10 == 0)).all()
    known, held = got[~got.held_out], got[got.held_out]
    assert known.score.sum() > known.base_score.sum()
    assert held.score.sum() > 1.05 * held.base_score.sum()


def test_texts_are_coded_in_order_with_weights_of_their_own():
    """Equals the sum decision by decision, over two blocks, with contexts across words."""
    rng = np.random.default_rng(5)
    bits = (9, 10, 10, 9)
    texts = [b"some words and other words " * 14, b"", b"short one"]
    tree = mixing_lm.Tree(np.bincount(np.frombuffer(b" ".join(texts), np.uint8), minlength=256).astype(float))
    tables = [rng.integers(-60, 60, 1 << b).astype(np.int8) for b in bits]
    weights = rng.normal(size=(mixing_lm.GATES, 5, 1)).astype(np.float32) / 3
    model = mixing_lm.Model(tree, tables, weights, bits, np.empty(0, np.uint64), np.empty(0), 1)
    at = np.cumsum([0, *map(len, texts)])
    stream, bounds, _, _ = mixing_lm.text_stream(np.frombuffer(b"".join(texts), np.uint8), at)
    assert stream.tobytes() == b"\n".join(b" ".join(t.split()) for t in texts) + b"\n"
    bases = mixing_lm.context_bases(stream, bounds)
    want = []
    for a, b in zip(bounds, bounds[1:]):
        w, total, gradient = weights[:, :, 0].astype(float), 0.0, 0.0
        for i in range(a, b):
            if i > a and (i - a) % mixing_lm.BLOCK == 0:
                w = w + mixing_lm.RATE * gradient / math.sqrt((i - a) // mixing_lm.BLOCK)
            if (i - a) % mixing_lm.BLOCK == 0:
                gradient = np.zeros_like(w)
            for d in range(tree.length[stream[i]]):
                node, bit = tree.node[d, stream[i]], tree.bit[d, stream[i]]
                x = [t[mixing_lm._cells(c[i], node, n)] / mixing_lm._SCALE for t, c, n in zip(tables, bases, bits)]
                x = np.array([*x, 0.3])
                g = mixing_lm._gate(d, x[None])[0]
                p = 1 / (1 + math.exp(-np.clip(w[g] @ x, -20, 20)))
                total += math.log(p if bit else 1 - p)
                gradient[g] += (bit - p) * x
        want.append(total)
    assert bounds[1] > mixing_lm.BLOCK
    assert np.allclose(mixing_lm.score_streams(model, stream, bounds)[:, 0], want, rtol=1e-4)


def test_bounded_steps_give_equal_scores(monkeypatch):
    """Steps hold whole rows, so any bound gives the same sums."""
    rng = np.random.default_rng(6)
    tree = mixing_lm.Tree(np.ones(256))
    bits = (9, 10, 10, 9)
    tables = [rng.integers(-60, 60, 1 << b).astype(np.int8) for b in bits]
    weights = rng.normal(size=(mixing_lm.GATES, 5, 1)).astype(np.float32) / 3
    model = mixing_lm.Model(tree, tables, weights, bits, np.empty(0, np.uint64), np.empty(0), 1)
    size = np.array([1, 700, 3, 256, 257, 40, 1, 1000])
    stream = rng.integers(32, 123, size.sum(), dtype=np.uint8)
    bounds = np.append(0, np.cumsum(size))
    whole = mixing_lm.score_streams(model, stream, bounds)
    one = [mixing_lm.score_streams(model, stream[a:b], np.array([0, b - a]))[0] for a, b in zip(bounds, bounds[1:])]
    assert np.allclose(whole, one, rtol=1e-6)
    monkeypatch.setattr(mixing_lm, "STEP_DECISIONS", 1)
    assert np.allclose(mixing_lm.score_streams(model, stream, bounds), whole, rtol=1e-9)
    monkeypatch.setattr(mixing_lm, "STEP_DECISIONS", 8 * 300)
    assert np.allclose(mixing_lm.score_streams(model, stream, bounds), whole, rtol=1e-9)


def test_equal_bytes_after_equal_contexts_are_looked_up_once(monkeypatch):
    """Also where they stand in different chunks of a task; every decision is counted, and fitted."""
    texts = [b"the old stone bridge and the old mill " * 40, b"", b" \t ", b"The old\tSTONE bridge", b"a", b"x " * 300] * 4
    batch = pa.RecordBatch.from_arrays([pa.array([t.decode() for t in texts])], ["text"])
    bits = (8, 9, 9, 8)
    data, at = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
    stream, bounds, closing, doc = mixing_lm.text_stream(data, at)
    assert stream.tobytes() == b"".join(b" ".join(t.lower().split()) + b"\n" for t in texts)
    assert np.bincount(doc, minlength=len(texts)).tolist() == [len(t.split()) for t in texts]
    assert set(stream[closing].tolist()) == {0x20, 0x0A} and np.diff(bounds).min() == 1
    tree = mixing_lm.Tree(np.bincount(stream, minlength=256).astype(float))
    want = [np.zeros(2 << b, np.int64) for b in bits]
    seen = set()
    for a, b in zip(bounds, bounds[1:]):
        for i in range(a, b):
            before = b"\n" * 5 + stream[a:i].tobytes()
            seen.add((before[-5:], before.replace(b"\n", b" ").split(b" ")[-1], stream[i]))
    bases = mixing_lm.context_bases(stream, bounds)
    for i, symbol in enumerate(stream):
        for d in range(tree.length[symbol]):
            for table, base, n in zip(want, bases, bits):
                cell = mixing_lm._cells(base[i], tree.node[d, symbol], n)
                table[2 * cell + tree.bit[d, symbol]] += 1

    met, decisions = [], mixing_lm._decisions

    def watched(tree, symbol, *rest):
        met.append(len(symbol))
        return decisions(tree, symbol, *rest)

    monkeypatch.setattr(mixing_lm, "KINDS_BYTES", 500)
    monkeypatch.setattr(mixing_lm, "_decisions", watched)
    monkeypatch.setattr(mixing_lm.wd, "shared_value", lambda value: value)
    got = [np.zeros(2 << b, np.int64) for b in bits]
    for part in mixing_lm._count_task((tree, np.empty(0, np.uint64)), bits)([batch]):
        r = part.to_pylist()[0]
        if r["table"] >= 0:
            got[r["table"]] += np.frombuffer(r["cells"], f"u{r['width']}")
    assert all((a == b).all() for a, b in zip(got, want))
    assert met == [len(seen)]

    counts, weights = [a.astype(np.uint16) for a in got], np.full((mixing_lm.GATES, 5), 0.3, np.float32)

    class Shared:
        value = counts

    one = [r["sums"] for r in next(mixing_lm._step_task((tree, weights), Shared, bits)([batch])).to_pylist()]
    assert met == [len(seen)] * 2
    monkeypatch.setattr(mixing_lm, "KINDS_HELD", 1)
    each = [r["sums"] for r in next(mixing_lm._step_task((tree, weights), Shared, bits)([batch])).to_pylist()]
    assert np.allclose(one, each, rtol=1e-4, atol=1e-2) and len(met) > 4
    Shared.value = [a.astype(np.float32) for a in got]
    wide = [r["sums"] for r in next(mixing_lm._step_task((tree, weights), Shared, bits)([batch])).to_pylist()]
    assert np.allclose(one, wide, rtol=1e-4, atol=1e-2)


def test_mixing_learns_from_texts_beyond_the_sample(spark, monkeypatch):
    """The tree counts the bytes, and the weights follow the decisions, of every training text."""
    trees, fits = [], []
    tree, refine = mixing_lm.Tree, mixing_lm.refine_weights

    def watched(base, of, counts, bits, weights):
        fits.append((weights, refine(base, of, counts, bits, weights)))
        return fits[-1][1]

    monkeypatch.setattr(mixing_lm, "SAMPLE_ROWS", 1)
    monkeypatch.setattr(mixing_lm, "refine_weights", watched)
    monkeypatch.setattr(mixing_lm, "Tree", lambda seen: trees.append(seen) or tree(seen))
    texts = ["a B  c", None, " ", "zz " * 30, *(f"word{i} and more {i}" for i in range(40))]
    mixing_lm.score_documents(
        frame(spark, [(i, t, "en", "s") for i, t in enumerate(texts)]), train="true").collect()
    stream = b"".join(b" ".join((t or "").lower().encode().split()) + b"\n" for t in texts)
    assert trees[0].tolist() == np.bincount(np.frombuffer(stream, np.uint8), minlength=256).tolist()
    before, after = fits[0]
    assert np.isfinite(after).all() and np.abs(after - before).max() > 0.01


def test_mixing_driver_holds_neither_the_sample_nor_copies_of_the_counts(spark):
    """With tables of the usual size; the whole counts as longs alone have 148 MB."""
    import tracemalloc

    rows = [(i, f"text {i} of some words", "en", "s") for i in range(20)]
    tracemalloc.start()
    try:
        got = mixing_lm.score_documents(frame(spark, rows), train="doc_id < 15").collect()
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert len(got) == 20 and peak < 100e6


def test_mixing_scores_depend_on_word_order(spark):
    """Common words are spelt as well, after the words before them."""
    learnt = "the quiet river walks over the old stone bridge every morning "
    rows = [(i, learnt * 3, "en", "s") for i in range(1, 40)]
    rows += [(100, learnt, "en", "s"), (101, " ".join(reversed(learnt.split())), "en", "s")]
    got = mixing_lm.score_documents(frame(spark, rows), train="doc_id < 100").collect()
    by = {r.doc_id: r for r in got}
    assert abs(by[100].base_score - by[101].base_score) < 1e-9
    assert by[100].score > by[101].score + 5


def test_mixing_beats_the_unigram_base_on_held_out_text(spark):
    got = queries.op4_context_mixing_scores(spark, "/root/testdata/sf0.1").toPandas()
    held = got[got.held_out]
    assert held.score.sum() > held.base_score.sum()
    known = got[~got.held_out]
    assert known.score.sum() > known.base_score.sum()


def test_rare_languages_and_those_of_long_texts_are_learnt(spark):
    """Each language has its share of the sample, however seldom it is and however long its texts."""
    near = {"fi": "hyvää huomenta talossa joki virtaa hiljaa yli kivien", "pl": "dzień dobry rzeka płynie cicho przez kamienie"}
    rows = [(i, f"the river walks over hill number{i} and bird sings", "en", "s") for i in range(3000)]
    rows += [(5000 + i, "der alte stein liegt am fluss und der vogel singt", "de", "s") for i in range(1500)]
    rows += [(9000 + i, f"{near['fi']} sana{i}", "fi", "s") for i in range(2)]
    rows += [(9100 + i, f"{near['pl']} slowo{i} " * 900, "pl", "s") for i in range(2)]
    docs = frame(spark, rows)
    model = crf_langid.train(docs, rows=40)
    assert model.languages == ["de", "en", "fi", "pl"]
    assert model.languages[model.prior.argmax()] == "de" and np.isfinite(model.prior).all()
    asked = [(1, near["fi"], None, None), (2, near["pl"], None, None), (3, "the hill and the river sings", None, None),
             (4, "der vogel am fluss", None, None)]
    got = {r.doc_id: r.lang_pred for r in crf_langid.identify(frame(spark, asked), model).collect()}
    assert got == {1: "fi", 2: "pl", 3: "en", 4: "de"}
