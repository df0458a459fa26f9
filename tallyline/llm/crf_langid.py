"""Language identification by a linear-chain conditional random field over words.

Every word gets a score per language from its lexicon entry, its affixes and its character
3-grams; learned transitions tie neighbouring words together. Forward-backward gives each word
its language probabilities, so code-switched text is labelled word by word, and their mean is
the language mix of the document.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyline.llm import words as wd

TRAIN_ROWS = 1_500
LEAST_ROWS = 20
MOST_LANGUAGES = 256
TRAIN_TEXT_BYTES = 40_000
STEPS = 30
FEATURE_BITS = 18
BLOCK = 32
UNKNOWN = "und"
_TAGS = np.array([0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35, 0x27D4EB2F, 0x165667B1], np.uint64)


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray  # (features, languages)
    transitions: np.ndarray  # (languages, languages), logarithms
    prior: np.ndarray | None = None  # (languages,), added to the scores of a text's first word


def _lower(data: np.ndarray) -> np.ndarray:
    """Lower case of ASCII and of the Latin-1 letters in UTF-8."""
    low = wd.LOWER[data]
    if len(low) > 1:
        tail = low[1:]
        upper = (low[:-1] == 0xC3) & (tail >= 0x80) & (tail <= 0x9E) & (tail != 0x97)
        tail[upper] += 0x20
    return low


def _slot(code: np.ndarray, tag: int) -> np.ndarray:
    mixed = (code.astype(np.uint64) + np.uint64(tag + 1)) * _TAGS[tag] * np.uint64(0x9E3779B97F4A7C15)
    return (mixed >> np.uint64(64 - FEATURE_BITS)).astype(np.int64)


def word_features(low: np.ndarray, starts: np.ndarray, ends: np.ndarray):
    """Feature slots: (words, 5) of lexicon and affixes, and those of 3-grams with their bounds."""
    n = len(starts)
    size = ends - starts
    wide = np.zeros(len(low) + 6, np.int64)
    wide[3:-3] = low
    at, end = starts + 3, ends + 3
    whole = np.empty((n, 5), np.int64)
    whole[:, 0] = (wd.span_hashes(low, starts, ends) >> np.uint64(64 - FEATURE_BITS)).astype(np.int64)
    first, second, third = wide[at], wide[at + 1] * (size > 1), wide[at + 2] * (size > 2)
    whole[:, 1] = _slot(first | second << 8, 1)
    whole[:, 2] = _slot(first | second << 8 | third << 16 | 1 << 24, 1)
    last, before, earlier = wide[end - 1], wide[end - 2] * (size > 1), wide[end - 3] * (size > 2)
    whole[:, 3] = _slot(last | before << 8, 2)
    whole[:, 4] = _slot(last | before << 8 | earlier << 16 | 1 << 24, 2)
    # All bytes of words, with the marks 1 and 2 for what stands before and after.
    bounds = np.zeros(n + 1, np.int64)
    np.cumsum(size, out=bounds[1:])
    place = np.arange(bounds[-1]) + np.repeat(starts - bounds[:-1], size)
    left, right = wide[place + 2], wide[place + 4]
    left[bounds[:-1]] = 1
    right[bounds[1:] - 1] = 2
    grams = _slot(left | wide[place + 3] << 8 | right << 16, 3)
    return whole, grams, bounds


def emissions(weights: np.ndarray, whole: np.ndarray, grams: np.ndarray, bounds: np.ndarray):
    """Score of each word for each language: affixes and lexicon summed, 3-grams averaged."""
    out = weights[whole].sum(1)
    if len(bounds) > 1:
        out += np.add.reduceat(weights[grams], bounds[:-1]) / np.diff(bounds)[:, None]
    return out


def forward_backward(scores: np.ndarray, bounds: np.ndarray, transitions: np.ndarray):
    """Exact word marginals of sequences laid end to end, and expected transition counts.

    Sequences are cut into blocks. The transfer matrix of each block is built for all blocks at
    once, messages then step from block to block, and last through all blocks at once; so the
    number of array steps follows the longest sequence divided by the block length.
    """
    k = scores.shape[1]
    counts = np.diff(bounds)
    per = -(-counts // BLOCK)
    nb = int(per.sum())
    first_block = np.cumsum(per) - per
    word_seq = np.repeat(np.arange(len(counts)), counts)
    inside = np.arange(len(scores)) - bounds[word_seq]
    block_of, at = first_block[word_seq] + inside // BLOCK, inside % BLOCK
    e = np.exp(scores - scores.max(1, keepdims=True))
    grid = np.ones((BLOCK, nb, k), e.dtype)
    live = np.zeros((BLOCK, nb), bool)
    grid[at, block_of] = e
    live[at, block_of] = True
    t = np.exp(transitions).astype(e.dtype)

    alive = np.flatnonzero(per > 0)
    opening = first_block[alive]  # blocks that open a sequence: no transition into them
    transfer = np.broadcast_to(np.eye(k, dtype=e.dtype), (nb, k, k)).copy()
    for i in range(BLOCK):
        on = live[i] if not live[i].all() else slice(None)
        step = (transfer[on].reshape(-1, k) @ t).reshape(-1, k, k) * grid[i, on][:, None, :]
        transfer[on] = step / step.sum((1, 2), keepdims=True)
        if i == 0:
            transfer[opening] = np.eye(k, dtype=e.dtype) * grid[0, opening][:, None, :]

    into = np.empty((nb, k), e.dtype)  # message entering a block
    out_of = np.empty((nb, k), e.dtype)
    a = np.ones((len(alive), k), e.dtype)
    b = np.ones((len(alive), k), e.dtype)
    order = alive[np.argsort(-per[alive], kind="stable")]
    length = per[order]
    for j in range(int(length[0]) if len(order) else 0):
        m = int(np.searchsorted(-length, -j, side="left"))
        here = first_block[order[:m]] + j
        into[here] = a[:m]
        a[:m] = np.einsum("ni,nij->nj", a[:m], transfer[here])
        a[:m] /= a[:m].sum(1, keepdims=True)
    for j in range((int(length[0]) if len(order) else 0) - 1, -1, -1):
        m = int(np.searchsorted(-length, -j, side="left"))
        here = first_block[order[:m]] + j
        out_of[here] = b[:m]
        b[:m] = np.einsum("nij,nj->ni", transfer[here], b[:m])
        b[:m] /= b[:m].sum(1, keepdims=True)

    forward = np.empty_like(grid)
    before = np.empty_like(grid)
    a = into
    for i in range(BLOCK):
        before[i] = a
        step = (a @ t) * grid[i]
        if i == 0:
            step[opening] = grid[0, opening]
        step /= step.sum(1, keepdims=True)
        a = np.where(live[i][:, None], step, a)
        forward[i] = a
    marginals = np.empty_like(grid)
    expected = np.zeros((k, k))
    b = out_of
    first = np.zeros((BLOCK, nb), bool)
    first[0, opening] = True
    for i in range(BLOCK - 1, -1, -1):
        m = forward[i] * b
        marginals[i] = m / m.sum(1, keepdims=True)
        on = live[i] & ~first[i]
        tail = grid[i] * b
        if on.any():
            pair = before[i][on][:, :, None] * t[None] * tail[on][:, None, :]
            expected += (pair / pair.sum((1, 2), keepdims=True)).sum(0)
        back = tail @ t.T
        back /= back.sum(1, keepdims=True)
        b = np.where(live[i][:, None], back, b)
    return marginals[at, block_of], expected


def fit(texts: list[str], languages: list[str], steps: int = STEPS, seed: int = 5) -> Model:
    """Train on labelled texts. Texts follow each other in sequences of eight, in seeded order,
    so the transitions learn how seldom the language changes."""
    names = sorted(set(languages))
    k = len(names)
    weights = np.zeros((1 << FEATURE_BITS, k), np.float32)
    transitions = np.zeros((k, k))
    order = np.random.default_rng(seed).permutation(len(texts))
    column = pa.array([texts[i] for i in order], pa.large_string())
    data, at = wd.text_bytes(column)
    low = _lower(data)
    starts, ends, doc = wd.spans(low, at, wd.LETTERS)
    if not len(starts) or k < 2:
        return Model(names, weights, transitions)
    gold = np.array([names.index(languages[i]) for i in order])[doc]
    bounds = np.unique(np.append(np.searchsorted(doc, np.arange(0, len(texts), 8)), len(starts)))
    _, kind, of_kind = np.unique(
        wd.span_hashes(low, starts, ends), return_index=True, return_inverse=True)
    whole, grams, spans = word_features(low, starts[kind], ends[kind])
    flat, owner = whole.ravel(), np.repeat(np.arange(len(kind)), 5)
    gram_owner, share = np.repeat(np.arange(len(kind)), np.diff(spans)), 1.0 / np.diff(spans)
    seen = np.zeros((k, k))
    same = np.ones(len(gold), bool)
    same[bounds[:-1]] = False
    np.add.at(seen, (gold[:-1][same[1:]], gold[1:][same[1:]]), 1)
    power, t_power = np.full(weights.shape, 1e-6, np.float32), np.full((k, k), 1e-6)
    for _ in range(steps):
        scores = emissions(weights, whole, grams, spans)[of_kind]
        marginals, expected = forward_backward(scores, bounds, transitions)
        miss = -marginals.astype(np.float64)
        miss[np.arange(len(gold)), gold] += 1
        grad = np.empty(weights.shape, np.float32)
        for j in range(k):
            by_kind = np.bincount(of_kind, miss[:, j], len(kind))
            grad[:, j] = np.bincount(flat, by_kind[owner], len(weights)) + np.bincount(
                grams, (by_kind * share)[gram_owner], len(weights))
        grad -= 0.05 * weights
        t_grad = (seen + 1 / k) - expected - 0.05 * transitions
        power += grad * grad
        t_power += t_grad * t_grad
        weights += 0.3 * grad / np.sqrt(power)
        transitions += 0.3 * t_grad / np.sqrt(t_power)
    return Model(names, weights, transitions)


def train(
    docs: DataFrame, *, rows: int = TRAIN_ROWS, text_bytes: int = TRAIN_TEXT_BYTES,
    doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
) -> Model:
    """Fit on about ``rows`` labelled documents, an even share for each language.

    With ``k`` languages each gives its ``max(rows / k, LEAST_ROWS)`` texts of smallest hash; fewer
    only where it has fewer different ones. Equal texts of a language count once. Texts of at most
    ``text_bytes`` bytes come first; where a language has not enough of them, longer ones follow,
    of which a stretch of that length is taken from a place that their hash says. How often each
    language stands in the table goes into the model's prior. At most ``MOST_LANGUAGES`` are learnt;
    a table with more values of ``lang`` is an error.

    The sample is bounded by these parameters and fitted by one task; the model reaches the driver.
    """
    labelled = docs.select(F.col(text).alias("text"), F.col(lang).alias("lang")).where(
        F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = labelled.groupBy("lang").agg(F.count("*").alias("n")).limit(MOST_LANGUAGES + 1).collect()
    n = {r.lang: r.n for r in counts}
    if not n:
        return fit([], [])
    if len(n) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} values of {lang}")
    each = max(rows // len(n), LEAST_ROWS)
    keys = labelled.select(
        "lang", (F.octet_length("text") > text_bytes).alias("long"), F.xxhash64("text").alias("h")).distinct()
    number = F.row_number().over(Window.partitionBy("lang").orderBy("long", "h"))
    chosen = keys.withColumn("number", number).where(F.col("number") <= each).select("lang", "h")
    found = labelled.withColumn("h", F.xxhash64("text")).join(F.broadcast(chosen), ["lang", "h"])
    sample = found.select("lang", "h", wd.stretch("text", "h", text_bytes).alias("text"))
    sample = sample.dropDuplicates(["lang", "h"]).select("h", "lang", "text")

    def fitted(taken: list[tuple]) -> Model:
        model = fit([t for _, _, t in taken], [x for _, x, _ in taken])
        times = Counter(x for _, x, _ in taken)
        share = np.log([n[x] / times[x] for x in model.languages])
        model.prior = (share - share.max()).astype(np.float32)
        return model

    return wd.fitted_in_task(sample, ["h", "lang"], fitted)


def _label_task(shared, label_words: bool):
    def run(batches):
        model = wd.shared_value(shared)
        names, k = model.languages, len(model.languages)
        for batch in batches:
            langs, scores, shares, labels, at_label = [], [], [], [], [0]
            for row, end, data, at in wd.chunks(batch.column(1)):
                low = _lower(data)
                starts, ends, doc = wd.spans(low, at, wd.LETTERS)
                mean = np.zeros((end - row, k))
                if len(starts) and k:
                    bounds = np.searchsorted(doc, np.arange(end - row + 1))
                    s = emissions(model.weights, *word_features(low, starts, ends))
                    if model.prior is not None:
                        s[bounds[:-1][np.diff(bounds) > 0]] += model.prior
                    marginals, _ = forward_backward(s, bounds, model.transitions)
                    some = np.flatnonzero(np.diff(bounds))
                    mean[some] = np.add.reduceat(marginals, bounds[some]) / np.diff(bounds)[some, None]
                    if label_words:
                        labels += [names[j] for j in marginals.argmax(1)]
                if label_words:
                    n = np.bincount(doc, minlength=end - row) if k else np.zeros(end - row, int)
                    at_label += (np.cumsum(n) + at_label[-1]).tolist()
                letters = np.zeros(len(data) + 1, np.int64)
                np.cumsum(wd.LETTERS[data] & (data < 128), out=letters[1:])
                has = letters[at[1:]] > letters[at[:-1]]
                for i in np.flatnonzero(~has & (at[1:] > at[:-1])):
                    has[i] = any(c.isalpha() for c in data[at[i]: at[i + 1]].tobytes().decode())
                best = mean.argmax(1) if k else np.zeros(end - row, int)
                for i in range(end - row):
                    known = has[i] and k
                    langs.append(names[best[i]] if known else UNKNOWN)
                    scores.append(float(min(1.0, mean[i, best[i]])) if known else 0.0)
                    shares.append(mean[i].tolist() if known else [0.0] * k)
            columns = [batch.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64()),
                       pa.array(shares, pa.list_(pa.float64()))]
            fields = ["doc_id", "lang_pred", "score", "shares"]
            if batch.num_columns > 2:
                columns.append(batch.column(2))
                fields.append("row")
            if label_words:
                columns.append(pa.ListArray.from_arrays(pa.array(at_label, pa.int32()), pa.array(labels, pa.string())))
                fields.append("word_langs")
            yield pa.RecordBatch.from_arrays(columns, fields)

    return run


def identify(
    docs: DataFrame, model: Model, *, label_words: bool = False, doc_id: str = "doc_id",
    text: str = "text", keep: tuple[str, ...] = (),
) -> DataFrame:
    """One row per document: ``doc_id, lang_pred, score, shares`` (and ``word_langs``).

    Words are runs of letters (and other characters beyond ASCII). ``shares`` are the mean word
    probabilities in the order of ``model.languages``; ``lang_pred`` is the largest (the first by
    name in a tie) and ``score`` its share. ``word_langs`` has the best language of each word.

    A NULL text, and one without a letter, is ``und`` with score 0; so is every text where the
    model knows no language. Repeated rows and NULL ids come back as they are. Other columns
    are ignored, but those named in ``keep`` go along in a struct ``row``.
    """
    shared = wd.share(docs.sparkSession, model)
    id_type = docs.schema[doc_id].dataType.simpleString()
    schema = f"doc_id {id_type}, lang_pred string, score double, shares array<double>"
    row = [F.struct(*keep).alias("row")] if keep else []
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), *row)
    if keep:
        schema += f", row {docs.schema['row'].dataType.simpleString()}"
    if label_words:
        schema += ", word_langs array<string>"
    return docs.mapInArrow(_label_task(shared, label_words), schema)
