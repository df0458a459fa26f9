from __future__ import annotations

import itertools
import random

import numpy as np
import pytest
from helpers import components, edge_texts, frame, sentence, words

from tallyline.llm import metric_join, parity_join
from tallyline.llm.components import components as spark_components
from tallyline.llm.components import extended


def shingles(text, k):
    w = words(text)
    if len(w) < k:
        return {tuple(w)} if w else set()
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)}


def brute_classes(rows, k, p, q):
    sets = {}
    for i, t, *_ in rows:
        sets.setdefault(i, shingles(t, k))
    links = []
    for a, b in itertools.combinations(sorted(sets), 2):
        x, y = sets[a], sets[b]
        if x and y and q * len(x & y) >= p * len(x | y):
            links.append((a, b))
    return {i: (len(sets[i]), c) for i, c in components(sets, links).items()}


@pytest.mark.parametrize("k,similarity", [(3, (9, 10)), (5, (8, 10)), (1, (5, 10))])
def test_classes_equal_all_pairs(spark, k, similarity):
    rows = [r for r in edge_texts() if r[0] is not None]
    rng = random.Random(k)
    start = sentence(rng, 80).split()
    for j in range(40):  # a chain of small changes, whose ends are not alike
        start[rng.randrange(len(start))] = f"w{j}"
        rows.append((1000 + j, " ".join(start), "en", "s"))
    got = parity_join.jaccard_classes(frame(spark, rows), k=k, similarity=similarity).collect()
    assert len(got) == len(rows)
    want = brute_classes(rows, k, *similarity)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want


def test_classes_edge_rows(spark):
    got = parity_join.jaccard_classes(frame(spark)).collect()
    assert len(got) == len(edge_texts())
    empty = {r.doc_id: r for r in got if r.doc_id in (300, 301, 302)}
    assert all(r.n_shingles == 0 and r.component_id == i for i, r in empty.items())
    assert [r.component_id for r in got if r.doc_id is None] == [None]
    assert parity_join.jaccard_classes(frame(spark, [])).collect() == []
    same = {r.component_id for r in got if r.doc_id in (304, 305)}
    assert same == {304}


def test_no_block_lost_for_any_allowed_difference():
    """Pigeonhole bound: sets at the limit share a block in which the smaller asks."""
    rng = np.random.default_rng(1)
    for p, q, spare in ((9, 10, 1.0), (8, 10, 1.15), (5, 10, 1.3)):
        bands = parity_join.Bands(p, q, spare)
        for n in [1, 2, 3, 5, 8, 9, 10, 11, 30, 57, 200, 431]:
            for _ in range(20):
                a = rng.integers(0, 1 << 63, n, dtype=np.uint64)
                most = n * q // p
                b = np.append(a, rng.integers(0, 1 << 63, most - n, dtype=np.uint64))
                if q * n < p * len(b):
                    continue
                ka, sa, qa = parity_join.probes(np.unique(a), bands)
                kb, sb, qb = parity_join.probes(np.unique(b), bands)
                assert set(ka[qa]) & set(kb[sb]), (p, q, n)


def test_components_of_a_long_path(spark):
    order = list(range(200))
    random.Random(2).shuffle(order)
    links = spark.createDataFrame(list(zip(order, order[1:])), "a long, b long")
    got = {r.node: r.component for r in spark_components(links, "a", "b").collect()}
    assert got == {i: 0 for i in range(200)}
    assert spark_components(links.limit(0), "a", "b").collect() == []


def test_components_extended_link_by_link_equal_those_of_all_links(spark):
    rng = random.Random(9)
    batches = [[(rng.randrange(60), rng.randrange(60)) for _ in range(n)] for n in (12, 1, 0, 9, 14)]
    batches += [[(70, 71), (71, 70)], [(70, 3)], [(80, 80)]]
    comps, links = None, []
    for batch in batches:
        links += [(a, b) for a, b in batch if a != b]
        new = spark.createDataFrame(batch, "a long, b long")
        comps = spark_components(new, "a", "b") if comps is None else extended(comps, new, "a", "b")
        nodes = {x for pair in links for x in pair}
        got = comps.collect()
        assert len(got) == len(nodes) and {r.node: r.component for r in got} == components(nodes, links)


def brute_vectors(rows, least):
    ok = {}
    for i, v, label in rows:
        if v and None not in v and np.isfinite(v).all() and np.any(v) and label is not None:
            x = np.array(v, np.float64)
            ok[i] = (label, x / np.linalg.norm(x))
    links = [
        (a, b) for a, b in itertools.combinations(sorted(ok), 2)
        if ok[a][0] == ok[b][0] and len(ok[a][1]) == len(ok[b][1]) and ok[a][1] @ ok[b][1] >= least]
    comp = components([r[0] for r in rows], links)
    n = {r[0]: 0 for r in rows}
    for a, b in links:
        n[a] += 1
        n[b] += 1
    return {i: (n[i], comp[i], comp[i] == i) for i in n}


def vector_rows(n):
    rng = np.random.default_rng(8)
    centers = rng.normal(size=(5, 8))
    rows = []
    for i in range(n):
        v = centers[i % 5] + rng.normal(size=8) * rng.choice([0.02, 0.3])
        rows.append((i, [float(np.float32(x)) for x in v], i % 3))
    rows += [(n + j, rows[0][1], 0) for j in range(30)]
    rows += [
        (5000, None, 1), (5001, [], 1), (5002, [0.0] * 8, 1), (5003, [1.0, None], 1),
        (5004, [float("nan")] * 8, 1), (5005, [float("inf")] + [0.0] * 7, 1), (5006, rows[0][1], None),
        (5007, [1.0, 2.0], 0), (5008, [2.0, 4.0], 0),
    ]
    return rows


def test_vectors_equal_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(metric_join, "CELL_VECTORS", 15)
    monkeypatch.setattr(metric_join, "PART_VECTORS", 20)
    rows = vector_rows(300)
    df = spark.createDataFrame(
        [(*r, 1, 0.1) for r in rows], "vec_id long, embedding array<float>, label int, n int, cell double")
    got = metric_join.near_duplicates(df).collect()
    assert len(got) == len(rows)
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got} == brute_vectors(rows, 0.98)
    again = metric_join.near_duplicates(df.union(df.where("vec_id < 40"))).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in again} == {
        r.vec_id: (r.n_links, r.component_id) for r in got}
    assert metric_join.near_duplicates(df.limit(0)).collect() == []


def test_an_id_on_several_vectors_is_several(spark):
    """Links of one label do not pass to the other label of an id."""
    near = [[1.0, 0.0, 0.01 * j] for j in range(3)]
    rows = [(1, near[0], 0), (1, near[0], 1), (2, near[1], 0), (3, near[2], 0), (4, near[1], 1),
            (5, [0.0, 1.0, 0.0], 0), (2, [0.0, 1.0, 0.001], 0), (2, near[1], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = sorted((r.vec_id, r.n_links, r.component_id) for r in metric_join.near_duplicates(df).collect())
    assert got == sorted([(1, 2, 1), (1, 1, 1), (2, 2, 1), (2, 2, 1), (3, 2, 1), (4, 1, 1), (5, 1, 2), (2, 1, 2)])


def test_blocks_that_agree_by_chance_have_other_keys():
    """One shingle in a block leaves one of 64 patterns; the keys still tell shingles apart."""
    same = np.array([5, 5 + (1 << 40)], np.uint64)
    keys = [parity_join.block_keys(same[i: i + 1], 3, 1)[0][0] for i in (0, 1)]
    assert keys[0] != keys[1]
    assert (parity_join.block_keys(same, 3, 4)[0] == parity_join.block_keys(same[::-1], 3, 4)[0]).all()


def test_large_group_of_sparse_links_leaves_few_pairs_to_the_join(spark, monkeypatch):
    """Each text has three of twelve changes and is linked with an eighth of the others."""
    base = sentence(random.Random(4), 120).split()
    rows = []
    for i, changes in enumerate(itertools.combinations(range(12), 3)):
        text = list(base)
        for c in changes:
            text[10 * c + 5] = f"change{c}"
        rows.append((i, " ".join(text), "en", "s"))
    left, real = [0], parity_join._all_apart

    def counted(*args):
        pairs = real(*args)
        left[0] = pairs.count()
        return pairs

    monkeypatch.setattr(parity_join, "_all_apart", counted)
    got = parity_join.jaccard_classes(frame(spark, rows), k=3, similarity=(9, 10)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_classes(rows, 3, 9, 10)
    assert left[0] <= len(rows)


def sparse_group():
    """Each text has three of twelve changes and is linked with an eighth of the others."""
    base = sentence(random.Random(4), 120).split()
    for i, changes in enumerate(itertools.combinations(range(12), 3)):
        text = list(base)
        for c in changes:
            text[10 * c + 5] = f"change{c}"
        yield i, " ".join(text), "en", "s"


def test_pairs_of_anchors_are_not_subtracted_from_each_other(spark, monkeypatch):
    """What is left after a round goes along, so anti-joins make few of the pairs that were met."""
    rows = list(sparse_group())
    made, met, frame_class = [0], [0], type(spark.range(1))
    join, stage = frame_class.join, parity_join.stage_table

    def counted_join(self, other, on=None, how=None):
        out = join(self, other, on, how)
        if how == "left_anti" and on == ["a", "b"]:
            made[0] += out.count()
        return out

    def counted_stage(df, name):
        out = stage(df, name)
        met[0] += out.count() if name == "pairs" else 0
        return out

    monkeypatch.setattr(frame_class, "join", counted_join)
    monkeypatch.setattr(parity_join, "stage_table", counted_stage)
    got = parity_join.jaccard_classes(frame(spark, rows), k=5, similarity=(8, 10))
    monkeypatch.undo()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.collect()} == brute_classes(rows, 5, 8, 10)
    assert made[0] < met[0]


def test_shared_blocks_without_a_near_pair(spark):
    """Two texts with one block in common and nothing else near are compared and stay apart."""
    bands = parity_join.Bands(9, 10, 1.0)
    blocks = bands.blocks(bands.of(10))
    assert blocks > 1
    by_block: dict[bool, list[str]] = {True: [], False: []}
    for i in range(400):
        word = f"w{i}"
        gram = next(parity_join.shingle_sets(parity_join.pa.array([word]), 1))[1][0]
        by_block[int(gram >> np.uint64(6)) % blocks == 0].append(word)
    same, other = by_block[True][:5], by_block[False]
    rows = [(1, " ".join(same + other[:5]), "en", "s"), (2, " ".join(same + other[5:10]), "en", "s")]
    got = parity_join.jaccard_classes(frame(spark, rows), k=1, similarity=(9, 10), spare=1.0).collect()
    assert {r.doc_id: r.component_id for r in got} == {1: 1, 2: 2}
