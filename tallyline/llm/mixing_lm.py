"""Language-model scores by online logistic context mixing.

A text is coded as the stream of all its words in order (A-Z lower-cased, each closed by a blank,
the last by an end), byte by byte, and each byte as a path of binary decisions through a Huffman
tree. For each decision several predictors look up how often it went either way after their own
hashed context in the training corpus: the last two, three and five bytes, which reach across
words, and the word so far. Their stretched probabilities are combined by weights that a gate
(depth in the tree, experience of the long contexts) selects. The weights start from a fit on
training texts and are refined online: after each block of a text they follow the gradient of what
the block has shown, for that text alone. The sum of the logarithms is the text's log-probability.

Bytes that follow the same contexts share their look-ups, in a chunk for scoring, in as many texts of
a task as ``KINDS_HELD`` allows for counting and fitting; nothing is left out for it.

The words of the corpus are counted exactly for the unigram base score: the common ones in a table
of bounded size, all others by a shuffle, to which a batch of documents sends each of them once.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.llm import words as wd
from tallyline.sources.tables import stage_table

SAMPLE_ROWS = 2_500
SAMPLE_TEXT_BYTES = 20_000
FIT_BYTES = 300_000
COMMON_WORDS = 1 << 15
ORDERS = (2, 5, 3)
TABLE_BITS = (18, 22, 22, 20)
PART_CELLS = 1 << 15
LIST_ROWS = 10_000
BLOCK = 256
STEP_DECISIONS = 100_000
KINDS_HELD = 1 << 21
KINDS_BYTES = 1 << 18
TREE_TASKS = 64
RATE = 0.004
GATES = 12
_SCALE = 12.0
_BIAS = 0.3
_BLANK, _END_BYTE = 0x20, 0x0A
_KEYS = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xA0761D6478BD642F, 0xD6E8FEB86659FD93], np.uint64)
# A-Z lower-cased, and all white space as blanks.
_FOLDED = np.where(wd.NOT_SPACE, wd.LOWER, _BLANK).astype(np.uint8)
_NODE = wd.mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


class Tree:
    """Huffman tree over bytes: the node and the bit at each depth of each byte's path."""

    def __init__(self, frequencies: np.ndarray):
        weights = frequencies + frequencies.sum() / 20_000 + 1.0
        heap = [(float(w), i, i) for i, w in enumerate(weights)]
        heapq.heapify(heap)
        children = {}
        number = 256
        while len(heap) > 1:
            a, b = heapq.heappop(heap), heapq.heappop(heap)
            children[number] = (a[2], b[2])
            heapq.heappush(heap, (a[0] + b[0], number, number))
            number += 1
        paths, left = {}, [(heap[0][2], [])]
        while left:
            at, path = left.pop()
            if at < 256:
                paths[at] = path
            else:
                for bit, child in enumerate(children[at]):
                    left.append((child, [*path, (at - 256, bit)]))
        self.depth = max(map(len, paths.values()))
        self.length = np.array([len(paths[i]) for i in range(256)], np.int16)
        self.node = np.zeros((self.depth, 256), np.int16)
        self.bit = np.zeros((self.depth, 256), np.int8)
        for byte, path in paths.items():
            for d, (node, bit) in enumerate(path):
                self.node[d, byte], self.bit[d, byte] = node, bit
        # The paths end to end: where each byte's begins; hash of the node, bit and least gate.
        self.begin = np.cumsum(self.length, dtype=np.int64) - self.length
        depth = self.path_depth = np.concatenate([np.arange(n) for n in self.length])
        byte = np.repeat(np.arange(256), self.length)
        self.path_node = _NODE[self.node[depth, byte]]
        self.path_bit = self.bit[depth, byte].astype(bool)
        self.path_gate = _gate_of_depth(depth)


def spelling(low: np.ndarray, starts: np.ndarray, ends: np.ndarray):
    """Words end to end, each closed by a blank, and the bounds of the words: what ``text_stream``
    makes of a row, but for its end."""
    size = ends - starts
    bounds = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(size + 1, out=bounds[1:])
    stream = np.full(bounds[-1], _BLANK, np.uint8)
    before = np.cumsum(size) - size
    step = np.arange(int(size.sum()))
    stream[np.repeat(bounds[:-1] - before, size) + step] = low[np.repeat(starts - before, size) + step]
    return stream, bounds


def text_stream(data: np.ndarray, at: np.ndarray):
    """The coded stream of a chunk, the bounds of its rows, and the closing byte and row of each word."""
    rows = len(at) - 1
    low = np.insert(_FOLDED.take(data), at[1:], _BLANK)
    inside = low != _BLANK
    keep = inside.copy()
    # The blank after a word closes it; each row has one at its end.
    keep[1:] |= inside[:-1]
    upto = np.searchsorted(np.flatnonzero(keep & ~inside), at[1:] + np.arange(rows), side="right")
    n_words = np.diff(upto, prepend=0)
    stream = low[keep]
    closing = np.flatnonzero(stream == _BLANK)
    ends = np.append(0, closing + 1)[upto]
    empty = n_words == 0
    stream[ends[~empty] - 1] = _END_BYTE
    doc = np.repeat(np.arange(rows), n_words)
    if empty.any():
        stream = np.insert(stream, ends[empty], _END_BYTE)
        ends += np.cumsum(empty)
        closing += np.cumsum(empty)[doc]
    return stream, np.append(0, ends), closing, doc


def _contexts(stream: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """At each byte that byte (in the last eight bits) below the bytes before it, as many as the
    longest order, and a hash of its word so far; both start with the row."""
    n, most = len(stream), max(ORDERS)
    begin, size = bounds[:-1], np.diff(bounds)
    # The eight bytes up to each place, read as one number.
    padded = np.concatenate([np.full(7, _END_BYTE, np.uint8), stream])
    code = np.ndarray((n,), ">u8", padded, 0, (1,)).astype(np.uint64)
    code &= np.uint64((1 << 8 * (most + 1)) - 1)
    for back in range(most):
        # The first bytes of a row follow ends.
        at = begin[size > back] + back
        ends = sum(_END_BYTE << (8 * k) for k in range(back + 1, most + 1))
        code[at] = (code[at] & np.uint64((1 << 8 * (back + 1)) - 1)) | np.uint64(ends)
    # The word so far: bytes since the last blank or the start of the row.
    first = np.zeros(n, bool)
    first[1:] = stream[:-1] == _BLANK
    first[begin[size > 0]] = True
    start = np.flatnonzero(first)
    total, down = wd.running_hashes(stream)
    length = np.diff(start, append=n)
    word = total[:n] - np.repeat(total[start], length)
    word *= np.repeat(down[start], length)
    return code, word


def _bases(code: np.ndarray, word: np.ndarray) -> list[np.ndarray]:
    """Hash of each predictor's context."""
    code = code >> np.uint64(8)
    of = {
        k: wd.mix(((code & np.uint64((1 << 8 * k) - 1)) + np.uint64(k)) * _KEYS[i])
        for i, k in enumerate(ORDERS)}
    return [of[ORDERS[0]], of[ORDERS[1]], wd.mix(wd.mix(word) ^ _KEYS[3]), of[ORDERS[2]]]


def context_bases(stream: np.ndarray, bounds: np.ndarray) -> list[np.ndarray]:
    """Hash of each predictor's context at each byte; contexts start with the row."""
    return _bases(*_contexts(stream, bounds))


def _cells(base: np.ndarray, node: np.ndarray, bits: int) -> np.ndarray:
    return ((base ^ _NODE[node]) >> np.uint64(64 - bits)).astype(np.int64)


def _order(key: np.ndarray) -> np.ndarray:
    """Places in the order of hashes, equal ones in the order of places. Hashes are compared by
    their first bits: those that share them, which are very few, stand mixed."""
    low = np.uint64((1 << max(1, len(key).bit_length())) - 1)
    order = key & ~low
    order |= np.arange(len(key), dtype=np.uint64)
    order.sort()
    order &= low
    return order.view(np.int64)


def _alike(code: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Equal bytes after equal contexts put together: their places, and where each kind begins.

    The longest order determines the shorter ones, so it and the word so far tell contexts apart.
    """
    key = wd.mix(code * _KEYS[0] + word * _KEYS[1])
    order = _order(key)
    # Whole keys are compared, so keys that stand mixed are more kinds than need be.
    key = key[order]
    return order, np.flatnonzero(np.append(True, key[1:] != key[:-1])[: len(key)])


class _Kinds:
    """Bytes of a task's texts after equal contexts, as many as are held at a time, and how often
    each was met."""

    def __init__(self):
        self.held, self.size = [], 0

    def add(self, code: np.ndarray, word: np.ndarray, times: np.ndarray | None = None) -> None:
        order, first = _alike(code, word)
        if times is None:
            times = np.diff(first, append=len(order)).astype(np.int32)
        else:
            times = np.add.reduceat(times[order], first, dtype=np.int32) if len(first) else times
        place = order[first]
        self.held.append((code[place], word[place], times))
        self.size += len(place)

    def full(self) -> bool:
        return self.size >= KINDS_HELD

    def take(self):
        """The byte and the contexts of each kind, and its times; then none are held."""
        held, self.held, self.size = self.held, [], 0
        if len(held) > 1:
            parts = [np.concatenate(x) for x in zip(*held)]
            del held
            self.add(*parts)
            held, self.held, self.size = self.held, [], 0
        code, word, times = held[0]
        return (code & np.uint64(0xFF)).astype(np.uint8), _bases(code, word), times


def _numbered(stream: np.ndarray, code: np.ndarray, word: np.ndarray):
    """The byte and the contexts of each kind, and the kind of each byte. Kinds are numbered as they
    come in the texts, so what is looked up for neighbours lies together."""
    order, first = _alike(code, word)
    is_first = np.zeros(len(stream), bool)
    is_first[order[first]] = True
    number = np.cumsum(is_first) - 1
    kind = np.empty(len(stream), np.int64)
    kind[order] = np.repeat(number[order[first]], np.diff(first, append=len(order)))
    place = np.flatnonzero(is_first)
    return stream[place], _bases(code[place], word[place]), kind


def _runs(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Runs of neighbouring places, one after the other, none of them empty."""
    out = np.ones(int(size.sum()), np.int64)
    if len(out):
        out[0] = first[0]
        out[np.cumsum(size[:-1])] = first[1:] - (first + size)[:-1] + 1
    return np.cumsum(out, out=out)


def _paths(tree: Tree, symbol: np.ndarray):
    """The decisions of some bytes, one byte's after the other's: of how many each has, and where
    they stand in the tree's paths."""
    size = tree.length[symbol].astype(np.int64)
    return size, _runs(tree.begin[symbol], size)


def _decisions(tree: Tree, symbol: np.ndarray, bases: list[np.ndarray], table_bits: tuple[int, ...]):
    """Runs of bytes and their decisions, a bounded number at a time: the slice of the bytes, how
    many decisions each has, their places in the tree's paths, and a generator of their cells in
    each table."""
    most = max(1, STEP_DECISIONS // max(1, int(tree.length.min())) // 4)
    for a in range(0, len(symbol), most):
        run = slice(a, min(a + most, len(symbol)))
        size, path = _paths(tree, symbol[run])
        node = tree.path_node[path]

        def cells():
            for base, bits in zip(bases, table_bits):
                cell = np.repeat(base[run], size)
                cell ^= node
                cell >>= np.uint64(64 - bits)
                yield cell.view(np.int64)

        yield run, size, path, cells()


def _count_task(shared, table_bits: tuple[int, ...]):
    """How often each decision went either way, as parts of dense tables, and how often each common
    word occurs."""

    def run(batches):
        tree, common = wd.shared_value(shared)
        common = _Places(common)
        tables = [np.zeros(2 << b, np.int32) for b in table_bits]
        words = np.zeros(len(common.keys) + 1, np.int64)
        total = np.zeros(1, np.int64)
        kinds = _Kinds()

        def count(symbol, bases, times):
            for run, size, path, cells in _decisions(tree, symbol, bases, table_bits):
                n, bit = np.repeat(times[run], size), tree.path_bit[path]
                for table, cell in zip(tables, cells):
                    cell *= 2
                    cell += bit
                    np.add.at(table, cell, n)

        for batch in batches:
            for _, _, data, at in wd.chunks(batch.column(0), KINDS_BYTES):
                stream, bounds, closing, _ = text_stream(data, at)
                code, word = _contexts(stream, bounds)
                words += np.bincount(common.find(wd.mix(word[closing])), minlength=len(words))
                total += len(closing) + len(at) - 1
                kinds.add(code, word)
                if kinds.full():
                    count(*kinds.take())
        if kinds.size:
            count(*kinds.take())
        for i, table in enumerate(tables):
            for part in range(0, len(table), 2 * PART_CELLS):
                cells = table[part: part + 2 * PART_CELLS]
                if cells.any():
                    yield _part(i, part // (2 * PART_CELLS), cells)
        if total[0]:
            yield _part(-1, 0, np.append(words[:-1], total))

    return run


def _byte_task(batches):
    """How often the coded stream has each byte."""
    seen = np.zeros(256, np.int64)
    for batch in batches:
        for _, _, data, at in wd.chunks(batch.column(0), KINDS_BYTES):
            seen += np.bincount(text_stream(data, at)[0], minlength=256)
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.arange(256), pa.int32()), pa.array(seen)], ["byte", "n"])


def _step_task(shared, shared_counts, table_bits: tuple[int, ...]):
    """Gradient and curvature of the fit at given weights, summed over all texts of the task."""

    def run(batches):
        (tree, weights), counts = wd.shared_value(shared), shared_counts.value
        width = len(table_bits) + 1
        gradient, hessian = np.zeros((GATES, width)), np.zeros((GATES, width, width))
        kinds = _Kinds()

        def add(symbol, bases, times):
            times = times.astype(np.float32)
            for run, size, x, bit, gate in _left_out(tree, counts, table_bits, symbol, bases):
                order = np.argsort(gate, kind="stable")
                edges = np.searchsorted(gate[order], np.arange(GATES + 1))
                x, bit, n = x.take(order, axis=1), bit[order], np.repeat(times[run], size)[order]
                for g in np.flatnonzero(np.diff(edges)):
                    its = slice(edges[g], edges[g + 1])
                    own = x[:, its]
                    p = 1 / (1 + np.exp(-np.clip(weights[g] @ own, -20, 20)))
                    gradient[g] += own.astype(np.float64) @ ((bit[its] - p) * n[its])
                    hessian[g] += (own * (p * (1 - p) * n[its])) @ own.T

        for batch in batches:
            for _, _, data, at in wd.chunks(batch.column(0), KINDS_BYTES):
                stream, bounds, _, _ = text_stream(data, at)
                kinds.add(*_contexts(stream, bounds))
                if kinds.full():
                    add(*kinds.take())
        if kinds.size:
            add(*kinds.take())
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(GATES), pa.int32()),
             pa.array([np.append(a, h).tolist() for a, h in zip(gradient, hessian)], pa.list_(pa.float64()))],
            ["gate", "sums"])

    return run


def _left_out(tree, counts, table_bits, symbol: np.ndarray, bases: list[np.ndarray], kind=np.float32):
    """For runs of bytes: the slice, how many decisions each has, what the predictors say of these
    once they are taken out of the counts (a row for each predictor), their bits, and the gates."""
    for run, size, path, cells in _decisions(tree, symbol, bases, table_bits):
        bit = tree.path_bit[path]
        x = np.empty((len(table_bits) + 1, len(path)), np.float32)
        for i, (table, cell) in enumerate(zip(counts, cells)):
            if table.dtype == np.uint16:
                # Both counts of a cell at once.
                both = table.view("<u4").take(cell)
                n0, n1 = (both & np.uint32(0xFFFF)).astype(kind), (both >> np.uint32(16)).astype(kind)
            else:
                cell *= 2
                n0, n1 = table[cell].astype(kind), table[cell + 1].astype(kind)
            n0 -= ~bit
            n1 -= bit
            x[i] = _stretched(np.maximum(n0, 0), np.maximum(n1, 0))
        x[-1] = _BIAS
        yield run, size, x, bit, _gates(tree, path, x)


PARTS = "table int, part int, width int, cells binary"


def _narrow(cells: np.ndarray) -> np.ndarray:
    """Counts in the smallest type that holds them."""
    return cells.astype(np.min_scalar_type(int(cells.max(initial=0))))


def _part(table: int, part: int, cells: np.ndarray) -> pa.RecordBatch:
    cells = _narrow(cells)
    return pa.RecordBatch.from_arrays(
        [pa.array([table], pa.int32()), pa.array([part], pa.int32()), pa.array([cells.itemsize], pa.int32()),
         pa.array([cells.tobytes()], pa.binary())],
        ["table", "part", "width", "cells"])


def _sum_of_parts(parts) -> np.ndarray:
    """Sum of the partial tables of one part, whose cells have ``width`` bytes each."""
    total = 0
    for cells, width in zip(parts["cells"], parts["width"]):
        total = total + np.frombuffer(cells, f"u{width}").astype(np.int64)
    return total


def _add_parts(key, parts):
    import pandas as pd

    total = _narrow(_sum_of_parts(parts))
    return pd.DataFrame({
        "table": [key[0]], "part": [key[1]], "width": [total.itemsize], "cells": [total.tobytes()]})


def _whole_parts(key, parts):
    """A part's counts, of the smallest type that holds them, and what its cells say for scoring."""
    import pandas as pd

    total = _sum_of_parts(parts)
    said, narrow = b"", False
    if key[0] >= 0:
        said = np.rint(_stretched(total[::2], total[1::2]) * _SCALE).astype(np.int8).tobytes()
        narrow = bool(total.max() <= np.iinfo(np.uint16).max)
        total = total.astype(np.uint16 if narrow else np.float32)
    return pd.DataFrame(
        {"table": [key[0]], "part": [key[1]], "cells": [total.tobytes()], "said": [said], "narrow": [narrow]})


class _Places:
    """Finds 64-bit hashes in a sorted array of some."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys
        self.shift = np.uint64(64 - len(keys).bit_length() - 2)
        buckets = (keys >> self.shift).astype(np.int64)
        self.first = np.searchsorted(buckets, np.arange((1 << 64 - int(self.shift)) + 1))
        # Hashes are spread evenly, so a bucket has a few at most.
        self.most = int(np.diff(self.first).max())
        self.padded = np.append(keys, np.zeros(self.most, np.uint64))

    def find(self, wanted: np.ndarray) -> np.ndarray:
        """Place of each hash, or the place past the end."""
        first = self.first[(wanted >> self.shift).astype(np.int64)]
        out = np.full(len(wanted), len(self.keys))
        for i in range(self.most):
            at = first + i
            np.copyto(out, at, where=(self.padded[at] == wanted) & (at < len(self.keys)))
        return out


def _by_word(h: np.ndarray, row: np.ndarray, train: np.ndarray):
    """The distinct words of some rows, the rows that have each, how often, and the training rows'
    sum of that. A word may come more than once."""
    # Rows come in order, and stay so within a word.
    order = _order(h)
    h, row = h[order], row[order]
    pair = np.flatnonzero(np.append(True, (h[1:] != h[:-1]) | (row[1:] != row[:-1]))[: len(h)])
    times = np.diff(pair, append=len(h))
    h, row = h[pair], row[pair]
    first = np.flatnonzero(np.append(True, h[1:] != h[:-1])[: len(h)])
    learnt = np.add.reduceat(times * train[row], first) if len(first) else times
    size = np.diff(first, append=len(h))
    return (
        pa.array(h[first].view(np.int64)), wd.list_column(row, size, pa.int32()),
        wd.list_column(times, size, pa.int32()), pa.array(learnt.astype(np.int64)))


def _stretched(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    return np.clip(np.log((n1 + 0.4) / (n0 + 0.4)), -10, 10)


def _gate_of_depth(depth):
    return np.minimum(depth, GATES // 3 - 1) * 3


def _gate(depth: int, x: np.ndarray) -> np.ndarray:
    """Depth in the tree, and how many of the two longer contexts have been met."""
    met = (x[:, 1] != 0).astype(np.int64) + (x[:, 2] != 0)
    return _gate_of_depth(depth) + met


def _gates(tree: Tree, path: np.ndarray, said) -> np.ndarray:
    """The gate of each decision, from what each predictor says of it."""
    gate = tree.path_gate[path].astype(np.uint8)
    gate += said[1] != 0
    gate += said[2] != 0
    return gate


class Model:
    """What scoring needs: the tree, stretched tables, start weights, and the common words."""

    def __init__(self, tree, tables, weights, table_bits, common, common_n, n_ends):
        self.tree, self.tables, self.weights, self.table_bits = tree, tables, weights, table_bits
        self.common, self.n_ends = common, n_ends
        self.base_log = np.append(np.log10(common_n + 0.1), 0.0)
        self.known = (np.append(common_n, 0) > 0).astype(float)


def _inputs(model: Model, symbol: np.ndarray, bases: list[np.ndarray]):
    """Of each byte's decisions, one after the other: a word of what the predictors say for the way
    that was taken, a byte each, then the bit and the gate. Also where the decisions of each byte
    begin."""
    tree, predictors = model.tree, len(model.tables)
    first = np.zeros(len(symbol) + 1, np.int64)
    np.cumsum(tree.length[symbol], out=first[1:])
    out = np.empty(first[-1], np.uint64)
    for run, _, path, cells in _decisions(tree, symbol, bases, model.table_bits):
        bit = tree.path_bit[path]
        said = [table.take(cell) for table, cell in zip(model.tables, cells)]
        word = np.zeros((len(path), 8), np.int8)
        turned = bit.view(np.int8) - np.int8(1)
        for i, x in enumerate(said):
            # The other way around where the bit is 0.
            word[:, i] = (x ^ turned) - turned
        own = word.view("<u8")[:, 0]
        tail = _gates(tree, path, said).astype(np.uint64)
        tail <<= np.uint64(1)
        tail |= bit
        own |= tail << np.uint64(8 * predictors)
        out[first[run.start]: first[run.stop]] = own
    return out, first


def tree_depth(model: Model) -> int:
    """Decisions of a usual byte, rounded up."""
    return max(1, math.ceil(float(np.median(model.tree.length))))


def _steps(bounds: np.ndarray, most: int):
    """Blocks of rows, a bounded number of bytes at a time, the first blocks of all rows first: the
    number of the blocks, their rows, first bytes and sizes. Rows do not depend on each other."""
    blocks = -(-np.diff(bounds) // BLOCK)
    row = np.repeat(np.arange(len(blocks)), blocks)
    number = _runs(np.zeros(np.count_nonzero(blocks), np.int64), blocks[blocks > 0])
    order = np.argsort(number, kind="stable")
    row, number = row[order], number[order]
    first = bounds[row] + number * BLOCK
    size = np.minimum(bounds[row + 1] - first, BLOCK)
    upto = np.append(0, np.cumsum(size))
    edges = np.searchsorted(number, np.arange(number[-1] + 2) if len(number) else [0])
    for b, (at, last) in enumerate(zip(edges, edges[1:])):
        while at < last:
            end = min(max(int(np.searchsorted(upto, upto[at] + most, side="right")) - 1, at + 1), last)
            yield b, row[at:end], first[at:end], size[at:end]
            at = end


def score_streams(
    model: Model, stream: np.ndarray, bounds: np.ndarray, contexts: tuple | None = None,
) -> np.ndarray:
    """Natural log-probability of each row of a stream under each weight set; the weights are
    refined per row after each block. ``contexts`` are those of the stream, if they are there."""
    rows, sets, predictors = len(bounds) - 1, model.weights.shape[2], len(model.tables)
    symbol, bases, kind = _numbered(stream, *(contexts or _contexts(stream, bounds)))
    said, first = _inputs(model, symbol, bases)
    # Of each byte: where its decisions begin, and how many they are.
    begin_of, size_of = first[kind], model.tree.length.astype(np.int64)[stream]
    last_block = (np.diff(bounds) - 1) // BLOCK
    total = np.zeros((rows, sets))
    width = predictors + 1
    scale = np.float32([*[_SCALE] * predictors, 1 / _BIAS])
    weights = [
        np.broadcast_to(model.weights[:, :, k], (rows, GATES, width)).astype(np.float32) for k in range(sets)]
    above, gates = np.uint64(8 * predictors + 1), np.uint64(15)
    for b, own, of_text, held in _steps(bounds, STEP_DECISIONS // tree_depth(model)):
        here = _runs(of_text, held)
        size = size_of[here]
        at = _runs(begin_of[here], size)
        # Decisions in the order of row and gate: those of one weight vector are a run.
        words = said[at]
        its = np.add.reduceat(size, np.cumsum(held) - held)
        words += np.repeat(np.arange(len(own), dtype=np.uint64) << (above + np.uint64(4)), its)
        words.sort()
        group = words >> above
        run = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
        times, group = np.diff(run, append=len(words)), group[run]
        local, gate = (group >> np.uint64(4)).astype(np.int64), (group & gates).astype(np.int64)
        part = words.astype("<u8", copy=False).view(np.int8).reshape(-1, 8)
        x = [part[:, i].astype(np.float32) for i in range(predictors)]
        x.append((part[:, predictors] & 1).astype(np.float32) * 2 - 1)
        of_row = run[np.append(True, local[1:] != local[:-1])]
        more = last_block[own] > b
        for k in range(sets):
            w = weights[k][own]
            each = w[local, gate] / scale
            z = np.repeat(each[:, 0], times) * x[0]
            for i in range(1, width):
                z += np.repeat(each[:, i], times) * x[i]
            np.clip(z, -20, 20, out=z)
            e = np.exp(-z)
            total[own, k] -= np.add.reduceat(np.log1p(e), of_row, dtype=np.float64)
            if more.any():
                miss = e / (1 + e)
                gradient = np.empty((len(run), width), np.float32)
                for i in range(width):
                    gradient[:, i] = np.add.reduceat(miss * x[i], run)
                w[local, gate] += np.float32(RATE / math.sqrt(1.0 + b)) * gradient / scale
                weights[k][own[more]] = w[more]
    return total


def _score_task(shared):
    def run(batches):
        model = wd.shared_value(shared)
        common = _Places(model.common)
        for number, batch in enumerate(batches):
            out = {name: [] for name in ("n_words", "n_known", "logs", "score", "n_bytes")}
            rare_words, rare_rows = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
            for row, _, data, at in wd.chunks(batch.column(3)):
                stream, bounds, closing, doc = text_stream(data, at)
                code, word = _contexts(stream, bounds)
                h = wd.mix(word[closing])
                place = common.find(h)
                rows = len(at) - 1
                out["n_words"].append(np.bincount(doc, minlength=rows))
                out["n_known"].append(np.bincount(doc, model.known[place], rows))
                out["logs"].append(np.bincount(doc, model.base_log[place], rows))
                out["score"].append(score_streams(model, stream, bounds, (code, word))[:, 0] / np.log(10))
                out["n_bytes"].append(np.diff(bounds))
                rare = place == len(common.keys)
                rare_words.append(h[rare])
                rare_rows.append(doc[rare] + row)
            columns = {k: np.concatenate(v) if v else np.empty(0) for k, v in out.items()}
            columns = {k: pa.array(v if k in ("logs", "score") else v.astype(np.int64)) for k, v in columns.items()}
            if not len(batch):
                continue
            part = (batch.column(0)[0].as_py() << 32) + number
            yield _scored(part, len(batch), place=pa.array(np.arange(len(batch)), pa.int32()),
                          doc_id=batch.column(1), **columns)
            train = np.asarray(batch.column(2)).astype(np.int64)
            word, places, times, learnt = _by_word(
                np.concatenate(rare_words), np.concatenate(rare_rows), train)
            for at in range(0, len(word), LIST_ROWS):
                some = [x.slice(at, LIST_ROWS) for x in (word, places, times, learnt)]
                yield _scored(part, len(some[0]), **dict(zip(("word", "places", "times", "learnt"), some)))

    return run


SCORED = (
    "part long, place int, doc_id long, n_words long, n_known long, logs double, score double, "
    "n_bytes long, word long, places array<int>, times array<int>, learnt long")


def _scored(part: int, rows: int, **columns) -> pa.RecordBatch:
    """Rows of documents, or of their words that are not common, without the other kind's columns."""
    ints, lists = pa.int64(), pa.list_(pa.int32())
    kinds = dict(
        place=pa.int32(), doc_id=ints, n_words=ints, n_known=ints, logs=pa.float64(), score=pa.float64(),
        n_bytes=ints, word=ints, places=lists, times=lists, learnt=ints)
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(rows, part)), *(columns.get(n, pa.nulls(rows, kind)) for n, kind in kinds.items())],
        ["part", *kinds])


def refine_weights(base: DataFrame, tree: Tree, counts, table_bits, weights: np.ndarray) -> np.ndarray:
    """Start weights after a Newton step over every training text, from the sample's weights. The
    counts are shared.

    At a place near the optimum one step over all texts is as good an estimate as the optimum
    itself, so the sample only says where the step begins.
    """
    shared = wd.share(base.sparkSession, (tree, weights[:, :, 0]))
    sums = base.where("train").select("text").mapInArrow(
        _step_task(shared, counts, table_bits), "gate int, sums array<double>")
    sums = sums.select("gate", F.posexplode("sums").alias("at", "x")).groupBy("gate", "at").agg(
        F.sum("x").alias("x"))
    width = weights.shape[1]
    total = np.zeros((GATES, width * (width + 1)))
    for r in sums.collect():
        total[r.gate, r.at] = r.x
    start = np.full(width, 0.3)
    start[-1] = 0.0
    out = weights.astype(np.float64)
    for g in range(GATES):
        gradient, hessian = total[g, :width], total[g, width:].reshape(width, width)
        w = out[g, :, 0]
        step = np.linalg.solve(hessian + 10.0 * np.eye(width), gradient - 10.0 * (w - start))
        # A gate that the sample has hardly met begins far off; its step is kept within reach.
        out[g, :, 0] = w + step / max(1.0, np.abs(step).max())
    return out.astype(np.float32)


def _common_words(texts: list[str], most: int) -> np.ndarray:
    """Sorted hashes of the most frequent words of some texts."""
    low, starts, ends, word, _ = wd.vocabulary(pa.array(texts, pa.large_string()), wd.NOT_SPACE)
    often = np.argsort(-np.bincount(word, minlength=len(starts)), kind="stable")[:most]
    return np.sort(wd.span_hashes(low, starts, ends)[often])


def _first_texts(texts: list[str], most: int) -> list[str]:
    """As many of the first texts as have ``most`` bytes, the one that reaches them included."""
    return texts[: int(np.searchsorted(np.cumsum([len(x.encode()) for x in texts]), most)) + 1]


def fit_weights(tree: Tree, counts: list[np.ndarray], table_bits, texts: list[str]) -> np.ndarray:
    """Weights per gate to begin with: logistic regression on texts of the training corpus.

    Each decision is taken out of the counts once, so they look as they would have before it.
    """
    width = len(table_bits) + 1
    start = np.full(width, 0.3)
    start[-1] = 0.0
    weights = np.tile(start[:, None], (GATES, 1, 1))
    stream, bounds, _, _ = text_stream(*wd.text_bytes(pa.array(texts, pa.large_string())))
    bases, parts = context_bases(stream, bounds) if len(stream) else [], []
    for run, _, x, bit, gate in _left_out(tree, counts, table_bits, stream, bases, np.float64):
        parts.append((x, bit, gate, tree.path_depth[_paths(tree, stream[run])[1]]))
    for g in range(GATES if parts else 0):
        # By depth, then as they come: the sums have the last bits of one order.
        order = np.argsort(np.concatenate([depth[gate == g] for _, _, gate, depth in parts]), kind="stable")
        x = np.concatenate([x[:, gate == g].T for x, _, gate, _ in parts])[order]
        y = np.concatenate([bit[gate == g] for _, bit, gate, _ in parts])[order].astype(np.float32)
        w = start.copy()
        for _ in range(12):
            p = 1 / (1 + np.exp(-np.clip(x @ w.astype(np.float32), -20, 20)))
            s = p * (1 - p) + np.float32(1e-6)
            hessian = (x * s[:, None]).T @ x + 10.0 * np.eye(width)
            w += np.linalg.solve(hessian, x.T @ (y - p) - 10.0 * (w - start))
        weights[g, :, 0] = w
    return weights.astype(np.float32)


def score_documents(
    docs: DataFrame, *, train: str, doc_id: str = "doc_id", text: str = "text",
    table_bits: tuple[int, ...] = TABLE_BITS,
) -> DataFrame:
    """One row per document: ``doc_id, n_tokens, n_known, train_tokens, base_score, score,
    bits_per_byte``.

    ``train`` is an SQL condition on the columns of ``docs``: the documents that are learnt from.
    Tokens are the words (runs of other than ASCII white space, A-Z lower-cased) and one end.
    ``base_score`` sums ``log10((c + 0.1) / (N + 0.1 (V + 1)))`` over them, ``score`` is the mixing
    model's log10 probability of the same tokens. ``bits_per_byte`` is its total in bits over the
    coded bytes (of the words, with a blank or the end after each). ``n_known`` counts tokens with
    ``c > 0``.

    A NULL text is empty: one token, the end. Where nothing is learnt from, counts are 0 and the
    predictors say nothing. Repeated rows each come back with equal values; a NULL id is allowed
    (its row is learnt from only if the condition holds). Other columns are ignored.

    All training documents are counted, for the tree, the predictors and the words, and all of them
    give the start weights their last step. What is kept of them has a fixed size only in the hashed
    tables (``table_bits``); the vocabulary is joined by a shuffle and grows with the corpus. A
    sample of at most ``SAMPLE_ROWS`` texts of at most ``SAMPLE_TEXT_BYTES`` bytes is one task's
    work. It says which words are counted in a table rather than by the shuffle, with equal
    results, and as far as ``FIT_BYTES`` where the step of the weights begins (at fixed values where
    no training text is that short).
    """
    spark, most_common, fit_bytes = docs.sparkSession, COMMON_WORDS, FIT_BYTES
    base = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(text).alias("t"),
        F.coalesce(F.expr(train), F.lit(False)).alias("train"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    sample = base.where(F.col("train") & (F.octet_length("text") <= SAMPLE_TEXT_BYTES))
    order = F.xxhash64("doc_id", "t")
    sample = sample.select("text", order.alias("o")).orderBy("o").limit(SAMPLE_ROWS)
    sample = stage_table(sample, "sample")
    common = wd.fitted_in_task(sample, ["o"], lambda rows: _common_words([t for t, _ in rows], most_common))
    seen = np.zeros(256)
    bytes_of = base.where("train").select("text").mapInArrow(_byte_task, "byte int, n long")
    for r in bytes_of.groupBy("byte").agg(F.sum("n").alias("n")).collect():
        seen[r.byte] = r.n
    tree = Tree(seen)

    known = wd.share(spark, (tree, common))
    parts = base.where("train").select("text").mapInArrow(
        _count_task(known, table_bits), PARTS)
    # Added in a tree, as every task has its own tables: first those of a bounded number of tasks.
    some = (F.spark_partition_id() / TREE_TASKS).cast("int")
    parts = parts.withColumn("some", some).groupBy("table", "part", "some").applyInPandas(
        _add_parts, PARTS)
    parts = stage_table(parts.groupBy("table", "part").applyInPandas(
        _whole_parts, "table int, part int, cells binary, said binary, narrow boolean"), "tables")
    wide = {r.table for r in parts.where("table >= 0 and not narrow").select("table").distinct().collect()}
    counts = [np.zeros(2 << b, np.float32 if i in wide else np.uint16) for i, b in enumerate(table_bits)]
    tables = [np.zeros(1 << b, np.int8) for b in table_bits]
    common_n, n_tokens = np.zeros(len(common), np.int64), 0
    # As many rows as the tables have parts, whatever the input.
    for r in parts.toLocalIterator():
        if r.table < 0:
            cells = np.frombuffer(r.cells, np.int64)
            common_n, n_tokens = cells[:-1], int(cells[-1])
        else:
            cells = np.frombuffer(r.cells, np.uint16 if r.narrow else np.float32)
            counts[r.table][r.part * 2 * PART_CELLS: r.part * 2 * PART_CELLS + len(cells)] = cells
            said = np.frombuffer(r.said, np.int8)
            tables[r.table][r.part * PART_CELLS: r.part * PART_CELLS + len(said)] = said
    ends = base.where("train").count()
    counts = wd.share_plain(spark, counts)
    weights = wd.fitted_in_task(sample, ["o"], lambda rows: fit_weights(
        tree, counts.value, table_bits, _first_texts([t for t, _ in rows], fit_bytes)))
    weights = refine_weights(base, tree, counts, table_bits, weights)
    # Nothing reads the counts any more; the driver and the executors give them back.
    counts.destroy()
    model = Model(tree, tables, weights, table_bits, common, common_n, ends)

    # One pass gives a row for each document, and for each word that is not common a row of the
    # documents of a batch that have it.
    both = stage_table(base.select(F.spark_partition_id().alias("p"), "doc_id", "train", "text").mapInArrow(
        _score_task(wd.share(spark, model)), SCORED), "scores")
    scored = both.where("word is null").drop("word", "places", "times", "learnt")
    rare = both.where("word is not null").select("part", "word", "places", "times", "learnt")
    # Counts first, added map-side, so that a frequent word that the sample has missed is not one
    # task's work; the join can be split where such a word is skewed.
    counts = rare.where("learnt > 0").groupBy("word").agg(F.sum("learnt").alias("c"))
    counts = stage_table(counts, "rare_counts")
    kinds = counts.count() + int((common_n > 0).sum()) + (ends > 0)
    # Multiples of a power of two, whose sums are the same in any order.
    log = F.rint(F.log10(F.coalesce("c", F.lit(0)) + 0.1) * 2.0**32) / 2.0**32
    rare = rare.join(counts, "word", "left").select(
        "part", log.alias("log"), F.coalesce("c", F.lit(0)).alias("c"), F.inline(F.arrays_zip("places", "times")))
    rare = rare.groupBy("part", F.col("places").alias("place")).agg(
        F.sum(F.col("log") * F.col("times")).alias("rare_logs"),
        F.sum(F.when(F.col("c") > 0, F.col("times")).otherwise(0)).alias("rare_known"))
    out = scored.join(stage_table(rare, "rare"), ["part", "place"], "left")
    n = F.col("n_words") + 1
    logs = F.col("logs") + F.coalesce("rare_logs", F.lit(0.0)) + F.log10(F.lit(ends + 0.1))
    return out.select(
        "doc_id", n.alias("n_tokens"),
        (F.col("n_known") + F.coalesce("rare_known", F.lit(0)) + int(ends > 0)).alias("n_known"),
        F.lit(n_tokens).cast("long").alias("train_tokens"),
        (logs - n * F.log10(F.lit(n_tokens + 0.1 * (kinds + 1)))).alias("base_score"),
        "score", (-F.col("score") * math.log2(10) / F.col("n_bytes")).alias("bits_per_byte"))
