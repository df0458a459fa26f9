"""Packing by power-of-two decomposition.

A document's ids are cut into pieces whose lengths are powers of two: as many of the longest
length as fit, then the binary digits of the rest. Each piece is a whole sequence of its length
bucket, so no sequence crosses documents and none needs padding.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.llm import bpe

LENGTH = 1024
END_ID = 0
# The added tokens of the same vocabulary's tokenizer, which maps their strings in a text to them.
SPECIAL_TOKENS = {"<|endoftext|>": 50256}


def piece_lengths(n: int, longest: int) -> list[int]:
    """``n`` as a sum of powers of two of at most ``longest``, in falling order."""
    out = [longest] * (n // longest)
    rest = n % longest
    while rest:
        out.append(1 << (rest.bit_length() - 1))
        rest -= out[-1]
    return out


def _pack_task(path: str | None, longest: int, end_id: int, special: dict[str, int]):
    def run(batches):
        encoding = bpe.loaded(path, special)
        for batch in batches:
            ids, owner, start, length, total = [], [], [], [], []
            held = 0

            def flush():
                data = np.concatenate(ids)
                at = np.zeros(len(length) + 1, np.int32)
                np.cumsum(np.array(length, np.int64) * 4, out=at[1:])
                binary = pa.Array.from_buffers(
                    pa.binary(), len(length), [None, pa.py_buffer(at), pa.py_buffer(data)])
                return pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(owner, pa.int64())), pa.array(start, pa.int64()),
                     pa.array(length, pa.int64()), pa.array(total, pa.int64()), binary],
                    ["doc_id", "start", "length", "doc_tokens", "ids"])

            for row, text in enumerate(batch.column(1)):
                text = text.as_py() or ""
                own = np.append(np.array(encoding.encode(text), "<u4"), np.uint32(end_id))
                own = own.astype("<u4")
                lengths = piece_lengths(len(own), longest)
                ids.append(own)
                owner += [row] * len(lengths)
                start += np.cumsum([0, *lengths[:-1]]).tolist()
                length += lengths
                total += [len(own)] * len(lengths)
                held += len(own)
                if held > 1 << 20:
                    yield flush()
                    ids, owner, start, length, total = [], [], [], [], []
                    held = 0
            if owner:
                yield flush()

    return run


def pack(
    docs: DataFrame, *, length: int = LENGTH, end_id: int = END_ID, ranks_path: str | None = None,
    special_tokens: dict[str, int] | None = None, doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """One row per piece: ``doc_id, start, length, doc_tokens, ids, sequence_id, offset``.

    ``ids`` holds the piece as little-endian unsigned 32-bit numbers; each document ends with
    ``end_id``. ``length`` is the bucket of the sequence: writing by it puts equal lengths
    together. ``sequence_id`` is unique, ``offset`` 0, as a piece is a whole sequence.

    A NULL or empty text is the end id alone. Strings of ``special_tokens`` in a text become their
    ids, as the tokenizer does with ``SPECIAL_TOKENS``; without, they are ordinary text. Texts with
    very long runs of white space are encoded by the slower library (``bpe``), to the same ids.
    Repeated rows are packed each; a NULL ``doc_id`` stays NULL; other columns are ignored.
    ``ranks_path`` names the vocabulary's ranks on the executors.
    """
    if length & (length - 1):
        raise ValueError("length must be a power of two")
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    pieces = docs.mapInArrow(
        _pack_task(ranks_path, length, end_id, special_tokens or {}),
        "doc_id long, start long, length long, doc_tokens long, ids binary")
    return pieces.withColumns({
        "sequence_id": F.monotonically_increasing_id(), "offset": F.lit(0).cast("long")})


def write_sequences(pieces: DataFrame, path: str) -> None:
    """Sequences as Parquet, one folder per length, so a reader gets batches without padding."""
    pieces.write.partitionBy("length").parquet(path)
