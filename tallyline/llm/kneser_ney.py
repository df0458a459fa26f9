"""Toxicity by two class-conditional Kneser-Ney models.

One model is counted on toxic, one on ordinary texts. Both spell words letter by letter (UTF-8
bytes, up to the end of the word) from the letters before, so they know words, stems and endings
and need no word list. Discounted counts back off to continuation counts of shorter contexts and
at last to counts shared by the classes, so an expression that is rare in both says little. A
document is scored by the difference of its length-normalised log-likelihoods, over the whole text
and over its most telling words; a logistic calibration, fitted on documents that were not
counted, turns this into a probability.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.llm import words as wd
from tallyline.sources.tables import stage_table

TRAIN_ROWS = 2_000
TRAIN_TEXT_BYTES = 40_000
ORDER = 6
SHARED_ORDER = 2
DISCOUNT = 0.75
TELLING = 2.0
THRESHOLD = 0.3
CALIBRATION_SHARE = 3  # one training document in so many is for the calibration
_START, _END = 1, 2


@dataclass
class Model:
    grams: list = field(default_factory=list)  # per order: table of log ratios
    contexts: list = field(default_factory=list)  # per order: table of back-off log ratios
    mean: np.ndarray = field(default_factory=lambda: np.zeros(4))
    scale: np.ndarray = field(default_factory=lambda: np.ones(4))
    logit: np.ndarray = field(default_factory=lambda: np.array([0.0, 0, 0, 0, -2.0]))


class Table:
    """Values by 64-bit key: sorted keys with an index of their leading bits."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        order = np.argsort(keys)
        self.keys, self.values = keys[order], values[order].astype(np.float32)
        bits = max(4, int(np.ceil(np.log2(len(keys) + 1))))
        self.shift = np.uint64(64 - bits)
        lead = (self.keys >> self.shift).astype(np.int64)
        self.first = np.searchsorted(lead, np.arange((1 << bits) + 1)).astype(np.int32)
        self.deepest = int(np.diff(self.first).max(initial=0))
        self.keys = np.append(self.keys, np.zeros(self.deepest + 1, np.uint64))
        self.values = np.append(self.values, np.zeros(self.deepest + 1, np.float32))

    def find(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Value (0 where missing), and whether the key is there."""
        lead = (wanted >> self.shift).astype(np.int64)
        at, end = self.first[lead], self.first[lead + 1]
        value, found = np.zeros(len(wanted), np.float32), np.zeros(len(wanted), bool)
        left = np.flatnonzero(at < end)
        for step in range(self.deepest):
            place = at[left] + step
            hit = self.keys[place] == wanted[left]
            value[left[hit]], found[left[hit]] = self.values[place[hit]], True
            left = left[~hit & (place + 1 < end[left])]
            if not len(left):
                break
        return value, found


def _letters(low: np.ndarray, starts: np.ndarray, ends: np.ndarray):
    """Words as one stream: a start mark, the letters, an end mark; and each symbol's place."""
    size = ends - starts + 2
    bounds = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(size, out=bounds[1:])
    word = np.repeat(np.arange(len(starts)), size)
    place = np.arange(bounds[-1]) - bounds[word]
    symbols = low[np.clip(starts[word] + place - 1, 0, max(len(low) - 1, 0))].astype(np.uint64)
    symbols[bounds[:-1]], symbols[bounds[1:] - 1] = _START, _END
    return symbols, place, word


def _gram_keys(symbols: np.ndarray, order: int) -> np.ndarray:
    """Key of the ``order`` symbols that end at each symbol (8 bytes hold them exactly)."""
    key = symbols.copy()
    for back in range(1, order):
        key[back:] |= symbols[:-back] << np.uint64(8 * back)
    return wd.mix(key + np.uint64(order * 0x9E3779B97F4A7C15 % (1 << 64)))


def count(low: np.ndarray, starts: np.ndarray, ends: np.ndarray, seen: np.ndarray) -> Model:
    """Both Kneser-Ney models from distinct words and how often each class has them."""
    symbols, place, word = _letters(low, starts, ends)
    keys, gram_of, firsts = {}, {}, {}
    for n in range(1, ORDER + 1):
        full = np.flatnonzero(place >= max(n - 1, 1))
        k, first, inverse = np.unique(
            _gram_keys(symbols, n)[full], return_index=True, return_inverse=True)
        keys[n], firsts[n] = k, full[first]
        gram_of[n] = np.full(len(symbols), -1, np.int32)
        gram_of[n][full] = inverse
    model = Model()
    p = np.ones((1, 2))
    for n in range(1, ORDER + 1):
        first = firsts[n]
        counts = np.empty((len(keys[n]), 2))
        at_start = place[first] == n - 1
        for c in (0, 1):
            raw = np.bincount(gram_of[n][gram_of[n] >= 0], seen[word[gram_of[n] >= 0], c], len(keys[n]))
            if n < ORDER:
                longer = firsts[n + 1]
                has = np.bincount(
                    gram_of[n + 1][gram_of[n + 1] >= 0],
                    seen[word[gram_of[n + 1] >= 0], c], len(keys[n + 1])) > 0
                kinds = np.bincount(gram_of[n][longer], has, len(keys[n]))
                raw = np.where(at_start, raw, kinds)
            counts[:, c] = raw
        if n <= SHARED_ORDER:
            counts[:] = counts.sum(1, keepdims=True)
        if n > 1:
            # The context of a gram is the gram of one less that ends a symbol before.
            context_key = _gram_keys(symbols, n - 1)[first - 1]
        else:
            context_key = np.zeros(len(first), np.uint64)
        contexts, head, inverse = np.unique(context_key, return_index=True, return_inverse=True)
        lower = p[gram_of[n - 1][first]] if n > 1 else np.full((len(first), 2), 1 / 256)
        p = np.empty_like(counts)
        back = np.ones((len(contexts), 2))
        for c in (0, 1):
            total = np.bincount(inverse, counts[:, c], len(contexts))
            kinds = np.bincount(inverse, counts[:, c] > 0, len(contexts))
            back[:, c] = np.where(total > 0, DISCOUNT * kinds / np.maximum(total, 1), 1.0)
            part = np.maximum(counts[:, c] - DISCOUNT, 0) / np.maximum(total, 1)[inverse]
            p[:, c] = part + back[inverse, c] * lower[:, c]
        if n > SHARED_ORDER:
            model.grams.append(Table(keys[n], np.log(p[:, 1] / p[:, 0])))
            model.contexts.append(Table(contexts, np.log(back[:, 1] / back[:, 0])))
    return model


def log_ratios(model: Model, low: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Log of toxic over ordinary probability of each word's spelling."""
    symbols, place, word = _letters(low, starts, ends)
    ratio = np.zeros(len(symbols), np.float32)
    context = _gram_keys(symbols, SHARED_ORDER)
    for n, (grams, contexts) in enumerate(zip(model.grams, model.contexts), SHARED_ORDER + 1):
        at = np.flatnonzero(place >= n - 1)
        own = _gram_keys(symbols, n)
        value, found = grams.find(own[at])
        ratio[at[found]] = value[found]
        rest = at[~found]
        ratio[rest] += contexts.find(context[rest - 1])[0]
        context = own
    return np.bincount(word, ratio, len(starts))


def word_ratios(model: Model, data: np.ndarray, at: np.ndarray):
    """Log ratio, letters and row of each word of a chunk; each distinct word is spelt once."""
    low = wd.LOWER[data]
    starts, ends, doc = wd.spans(low, at, wd.LETTERS)
    _, first, inverse = np.unique(
        wd.span_hashes(low, starts, ends), return_index=True, return_inverse=True)
    if not model.grams or not len(starts):
        return np.zeros(len(starts)), ends - starts, doc
    return log_ratios(model, low, starts[first], ends[first])[inverse], ends - starts, doc


def features(ratios: np.ndarray, size: np.ndarray, doc: np.ndarray, rows: int) -> np.ndarray:
    """Per row: mean ratio per letter, best word, best run of three, the telling words' sum."""
    out = np.zeros((rows, 4))
    if not len(ratios):
        return out
    bounds = np.searchsorted(doc, np.arange(rows + 1))
    some = np.flatnonzero(np.diff(bounds))
    at = bounds[some]
    three = ratios.astype(np.float64)
    for step in (1, 2):
        same = doc[step:] == doc[:-step]
        three[:-step][same] += ratios[step:][same]
    out[some, 0] = np.add.reduceat(ratios, at) / np.add.reduceat(size, at)
    out[some, 1] = np.maximum.reduceat(ratios, at)
    out[some, 2] = np.maximum.reduceat(three, at) / 3
    out[some, 3] = np.log1p(np.add.reduceat(np.maximum(ratios - TELLING, 0), at))
    return out


def _calibrate(model: Model, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> None:
    model.mean, model.scale = x.mean(0), x.std(0) + 1e-6
    z = np.column_stack([(x - model.mean) / model.scale, np.ones(len(x))])
    w = np.zeros(5)
    for _ in range(25):
        p = 1 / (1 + np.exp(-z @ w))
        s = weight * p * (1 - p)
        w += np.linalg.solve(
            (z * s[:, None]).T @ z + 0.5 * np.eye(5), z.T @ (weight * (y - p)) - 0.5 * w)
    model.logit = w


def probability(model: Model, x: np.ndarray) -> np.ndarray:
    z = np.column_stack([(x - model.mean) / model.scale, np.ones(len(x))])
    return 1 / (1 + np.exp(-np.clip(z @ model.logit, -40, 40)))


def fit(texts: list[str], labels: list[int], toxic_share: float) -> Model:
    """Count on two thirds of the texts (in the given order), calibrate on the others.

    ``toxic_share`` is the share of toxic documents among all labelled ones; the calibration
    is weighted to it, as the sample is not.
    """
    y = np.array(labels, np.int64)
    if not len(y) or y.min() == y.max():
        return Model()
    low, starts, ends, word, doc = wd.vocabulary(pa.array(texts, pa.large_string()), wd.LETTERS)
    held = np.arange(len(y)) % CALIBRATION_SHARE == 0
    counted = ~held[doc]
    if not counted.any():
        return Model()
    seen = np.column_stack([
        np.bincount(word[counted & (y[doc] == c)], minlength=len(starts)) for c in (0, 1)])
    used = np.flatnonzero(seen.sum(1))
    model = count(low, starts[used], ends[used], seen[used])
    ratios = log_ratios(model, low, starts, ends)[word]
    x = features(ratios, (ends - starts)[word], doc, len(y))[held]
    y = y[held].astype(float)
    share = y.mean()
    if not 0 < share < 1:
        return Model()
    weight = np.where(y == 1, toxic_share / share, (1 - toxic_share) / (1 - share))
    _calibrate(model, x, y, weight)
    return model


def train(
    docs: DataFrame, labels: DataFrame, *, rows: int = TRAIN_ROWS,
    text_bytes: int = TRAIN_TEXT_BYTES, doc_id: str = "doc_id", text: str = "text",
    label: str = "toxic",
) -> Model:
    """Fit on at most ``rows`` labelled documents per class.

    The rows are taken by a hash of their id, among the labels that have a document. Of a text with
    over ``text_bytes`` bytes a stretch of that length is taken, from a place that its hash says. A
    document with several labels is toxic when one of them says so.

    The sample is bounded by these parameters and fitted by one task; the model, and the number of
    labels per class, reach the driver.
    """
    labels = labels.select(F.col(doc_id).alias("doc_id"), F.col(label).cast("int").alias("y"))
    labels = labels.where("doc_id is not null and y in (0, 1)").groupBy("doc_id").agg(F.max("y").alias("y"))
    texts = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).where("text is not null")
    labels = stage_table(labels.join(texts.select("doc_id"), "doc_id", "left_semi"), "labels")
    n = {r.y: r.n for r in labels.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if len(n) < 2:
        return Model()
    order = F.xxhash64("doc_id")
    chosen = [labels.where(F.col("y") == c).orderBy(order).limit(rows) for c in (0, 1)]
    sample = texts.join(F.broadcast(chosen[0].union(chosen[1])), "doc_id").select(
        "y", F.xxhash64("doc_id", "text").alias("h"), F.xxhash64("text").alias("at"), "text")
    sample = stage_table(sample.select("y", "h", wd.stretch("text", "at", text_bytes).alias("text")), "sample")
    # An id may have many rows.
    sample = [sample.where(F.col("y") == c).orderBy("h").limit(rows) for c in (0, 1)]
    toxic_share = n[1] / (n[0] + n[1])
    return wd.fitted_in_task(
        sample[0].union(sample[1]), ["y", "h"],
        lambda taken: fit([t for _, _, t in taken], [y for y, _, _ in taken], toxic_share))


def _score_task(shared):
    def run(batches):
        model = wd.shared_value(shared)
        for batch in batches:
            out = []
            for row, end, data, at in wd.chunks(batch.column(1)):
                x = features(*word_ratios(model, data, at), end - row)
                out.append(probability(model, x))
            scores = np.concatenate(out) if out else np.empty(0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores), *batch.columns[2:]],
                ["doc_id", "score", *batch.schema.names[2:]])

    return run


def score_toxicity(
    docs: DataFrame, model: Model, *, threshold: float = THRESHOLD, doc_id: str = "doc_id",
    text: str = "text", keep: tuple[str, ...] = (),
) -> DataFrame:
    """One row per document: ``doc_id, score, predicted``.

    Words are runs of letters, A-Z lower-cased. A NULL or empty text, and one without words, has
    the score of features that are all 0. Repeated rows and NULL ids come back as they are; other
    columns are ignored, but those named in ``keep`` go along in a struct ``row``. A model without both classes gives every text the same low score.
    """
    shared = wd.share(docs.sparkSession, model)
    id_type = docs.schema[doc_id].dataType.simpleString()
    row = [F.struct(*keep).alias("row")] if keep else []
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), *row)
    schema = f"doc_id {id_type}, score double"
    if keep:
        schema += f", row {docs.schema['row'].dataType.simpleString()}"
    out = docs.mapInArrow(_score_task(shared), schema)
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
