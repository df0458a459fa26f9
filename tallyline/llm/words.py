"""Words and word hashes of whole Arrow text columns, as NumPy arrays.

The helpers work inside ``mapInArrow`` tasks. They take a batch apart into chunks of a few
hundred kilobytes (a longer text is a chunk of its own), so memory follows the longest text
and not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20
_BYTES = np.arange(256)
# ASCII white space: blank and 0x09-0x0D.
NOT_SPACE = ~np.isin(_BYTES, [0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D])
LETTERS = ((_BYTES >= 65) & (_BYTES <= 90)) | ((_BYTES >= 97) & (_BYTES <= 122)) | (_BYTES >= 128)
LOWER = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES).astype(np.uint8)

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_PRIME = 0x100000001B3 | 1
_INVERSE = pow(_PRIME, -1, 1 << 64)
POSITION = np.random.default_rng(20).integers(1, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)
_BYTE_CODE = np.random.default_rng(21).integers(1, 1 << 63, 256, dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * _M1
    x ^= x >> np.uint64(27)
    x *= _M2
    x ^= x >> np.uint64(31)
    return x


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the prime and of its inverse. They are kept per process and not in this module,
    whose functions (and the globals they use) travel with every task."""
    kept = worker_store()
    if len(kept.get("powers", ((), ()))[0]) < n:
        size = max(n, CHUNK_BYTES + 1)
        tables = []
        for base in (_PRIME, _INVERSE):
            t = np.empty(size, np.uint64)
            t[0] = 1
            t[1:] = np.uint64(base)
            np.multiply.accumulate(t, out=t)
            tables.append(t)
        kept["powers"] = tuple(tables)
    return kept["powers"]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the offsets of its rows; NULL is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if len(column) == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)
    at = at[column.offset: column.offset + len(column) + 1].astype(np.int64)
    if data is None or at[-1] == at[0]:
        return np.empty(0, np.uint8), at - at[0]
    return np.frombuffer(data, np.uint8)[at[0]: at[-1]], at - at[0]


def give_back() -> None:
    """Free memory goes back to the system. Workers live on from task to task, and the allocator
    would keep for them what their largest chunk needed."""
    import ctypes

    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def chunks(column: pa.Array, most: int | None = None) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows: first row, end row, their bytes, and offsets from 0. A run of several rows has
    at most ``most`` bytes, ``CHUNK_BYTES`` if not given."""
    most = most or CHUNK_BYTES
    data, at = text_bytes(column)
    n, row = len(at) - 1, 0
    while row < n:
        end = int(np.searchsorted(at, at[row] + most, side="right")) - 1
        end = min(max(end, row + 1), n)
        yield row, end, data[at[row]: at[end]], at[row: end + 1] - at[row]
        row = end
    if len(data) >= CHUNK_BYTES:
        give_back()


def spans(data: np.ndarray, at: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, ...]:
    """Start, end and row of each maximal run of the byte class ``inside`` (256 booleans)."""
    n = len(data)
    if n == 0:
        empty = np.empty(0, np.int64)
        return empty, empty, empty
    is_in = inside[data]
    before = np.empty(n, bool)
    before[0], before[1:] = False, is_in[:-1]
    after = np.empty(n, bool)
    after[-1], after[:-1] = False, is_in[1:]
    first = at[:-1][at[:-1] < at[1:]]
    before[first] = False
    after[at[1:][at[:-1] < at[1:]] - 1] = False
    starts = np.flatnonzero(is_in & ~before)
    ends = np.flatnonzero(is_in & ~after) + 1
    return starts, ends, np.searchsorted(at, starts, side="right") - 1


def running_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums up to each place, and factors: of a span, the difference of the sums at its ends times
    the factor of its start is the same wherever the span stands."""
    n = len(data)
    up, down = _power_tables(n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE_CODE[data] * up[:n], out=total[1:])
    return total, down


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans; equal spans have equal hashes wherever they stand."""
    total, down = running_hashes(data)
    return mix((total[ends] - total[starts]) * down[starts])


def gram_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` neighbouring word hashes (runs may cross rows: slice them)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out += h[j: j + n] * POSITION[j]
    return mix(out)


def stretch(text: str, hashed: str, most: int):
    """A text, or of one with over ``most`` bytes a stretch from a place that the hash says. A
    character has at most four bytes."""
    from pyspark.sql import functions as F

    chars = most // 4
    start = F.pmod(F.col(hashed), F.greatest(F.length(text) - chars + 1, F.lit(1))) + 1
    cut = F.substring(F.col(text), start.cast("int"), F.lit(chars))
    return F.when(F.octet_length(text) > most, cut).otherwise(F.col(text))


def list_column(values: np.ndarray, lengths: np.ndarray, kind: pa.DataType) -> pa.Array:
    at = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=at[1:])
    return pa.ListArray.from_arrays(pa.array(at), pa.array(values, kind))


def worker_store() -> dict:
    """Values that a process keeps from task to task."""
    import sys
    import types

    name = "_tallyline_worker"
    return sys.modules.setdefault(name, types.ModuleType(name)).__dict__


def per_worker(key, load):
    """A value that a Python worker loads once and keeps for its later tasks."""
    kept = worker_store()
    if key not in kept:
        kept[key] = load()
    return kept[key]


def share(spark, value):
    """Broadcast a value of this package's classes, by value like its functions."""
    from pyspark import cloudpickle

    return share_plain(spark, cloudpickle.dumps(value))


def share_plain(spark, value):
    """Broadcast arrays and other values of no class of this package. They travel as they are, so
    neither the driver nor a worker holds a pickled copy beside them; tasks read ``value``."""
    out = spark.sparkContext.broadcast(value)
    if (owned := worker_store().get("shared")) is not None:
        owned.append(out)
    return out


@contextmanager
def sharing():
    """Destroys what is broadcast inside at its end; frames that use it must be written by then."""
    kept = worker_store()
    before, kept["shared"] = kept.get("shared"), []
    try:
        yield
    finally:
        for one in kept["shared"]:
            one.destroy()
        kept["shared"] = before


def fitted_in_task(sample, order: list[str], fit):
    """``fit(rows)`` of a small frame, as one Spark task computes it; only the result comes back.

    The rows, tuples in ``order``, must be a sample whose size a parameter bounds. The driver, which
    may have less memory than an executor, holds neither them nor what fitting needs.
    """
    import pickle

    from pyspark import cloudpickle

    def run(batches):
        rows = [tuple(r.values()) for batch in batches for r in batch.to_pylist()]
        yield pa.RecordBatch.from_arrays([pa.array([cloudpickle.dumps(fit(rows))], pa.binary())], ["model"])

    one = sample.repartition(1).sortWithinPartitions(*order).mapInArrow(run, "model binary")
    found = one.first()
    # An empty sample may have no task.
    return fit([]) if found is None else pickle.loads(found.model)


def shared_value(shared):
    import pickle

    return pickle.loads(shared.value)


def vocabulary(column: pa.Array, inside: np.ndarray):
    """Distinct words of some texts, A-Z lower-cased, and which word each occurrence is.

    Returns the letters of the distinct words end to end with their starts and ends, and the
    word number and row of each occurrence. Chunks bound what is held besides.
    """
    number: dict[int, int] = {}
    letters, of_word, of_row = [], [], []
    for row, _, data, at in chunks(column):
        low = LOWER[data]
        starts, ends, doc = spans(low, at, inside)
        kinds, first, inverse = np.unique(
            span_hashes(low, starts, ends), return_index=True, return_inverse=True)
        own = np.empty(len(kinds), np.int32)
        for i, kind in enumerate(kinds.tolist()):
            at_ = number.setdefault(kind, len(number))
            if at_ == len(letters):
                letters.append(low[starts[first[i]]: ends[first[i]]].tobytes())
            own[i] = at_
        of_word.append(own[inverse])
        of_row.append((doc + row).astype(np.int32))
    size = np.array([len(x) for x in letters], np.int64)
    ends = np.cumsum(size)
    low = np.frombuffer(b"".join(letters), np.uint8)
    none = np.empty(0, np.int32)
    return (low, ends - size, ends, np.concatenate([none, *of_word]), np.concatenate([none, *of_row]))
