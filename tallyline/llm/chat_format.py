"""Conversations as token ids with a loss mask, assembled from separately encoded segments.

Each text is encoded on its own, so no token spans a border. Between the segments stand reserved
ids, beyond the vocabulary: no text can produce them. The loss mask is the running sum of +1 where
an assistant's text begins and -1 where it ends. In the rendered text the reserved ids are control
strings. Where a text contains such a string, a backslash is put behind its first sign; a string
that already has backslashes there gets one more, so taking one away restores every text.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.llm import bpe

FIRST_RESERVED = 50257  # ids from here on are not in the vocabulary
BEGIN, OTHER_ROLE, ROLE_END = "<s>", "[ROLE]", "[/ROLE]"
# Control strings around a turn by role. A turn of another role carries the role's name.
TURN_MARKS = {
    "system": ("[SYS]", "[/SYS]"),
    "user": ("[INST]", "[/INST]"),
    "assistant": ("[ANS]", "</s>"),
}
OTHER_END = "[/TURN]"
# Escaped as well, though the template does not use it: the vocabulary has it as a special token.
FOREIGN = ("<|endoftext|>",)
CONTROL = (BEGIN, *(m for pair in TURN_MARKS.values() for m in pair), OTHER_ROLE, ROLE_END, OTHER_END)
RESERVED = {mark: FIRST_RESERVED + i for i, mark in enumerate(CONTROL)}
_MARK_OF = {i: mark for mark, i in RESERVED.items()}

# No control string has its first sign again further on, so matches never overlap.
_BARE = re.compile("|".join(
    rf"(?<={re.escape(m[0])})(?=\\*{re.escape(m[1:])})" for m in (*CONTROL, *FOREIGN)))
_ESCAPED = re.compile("|".join(
    rf"(?<={re.escape(m[0])})\\(?=\\*{re.escape(m[1:])})" for m in (*CONTROL, *FOREIGN)))

CHUNK_IDS = 1 << 20
CHUNK_TURNS = 4096


def escape(text: str) -> str:
    return _BARE.sub(r"\\", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub("", text)


def opening(role: str) -> str:
    """What stands before a turn's text, as rendered."""
    if role in TURN_MARKS:
        return TURN_MARKS[role][0]
    return f"{OTHER_ROLE}{escape(role)}{ROLE_END}"


@dataclass
class _Turn:
    """Ids of one turn: ``lead`` reserved and role ids, then the text's, then the end mark."""

    ids: np.ndarray
    lead: int
    learnt: bool
    chars: int


def encode_turn(role: str, text: str, encoder: bpe.ByteBPE) -> _Turn:
    said = escape(text)
    if role in TURN_MARKS:
        head, end = [RESERVED[TURN_MARKS[role][0]]], TURN_MARKS[role][1]
    else:
        head = [RESERVED[OTHER_ROLE], *encoder.encode(escape(role)), RESERVED[ROLE_END]]
        end = OTHER_END
    ids = np.array([*head, *encoder.encode(said), RESERVED[end]], "<u4")
    return _Turn(ids, len(head), role == "assistant", len(opening(role)) + len(said) + len(end))


_TURN = "conv_id long, turn long, role string, ids binary, lead int, chars long"


def _encode_task(ranks_path: str | None):
    def run(batches):
        encoder = bpe.loaded(ranks_path)
        for batch in batches:
            roles, texts = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            turns, held, first = [], 0, 0

            def flush(end):
                part = batch.slice(first, end - first)
                return pa.RecordBatch.from_arrays(
                    [*part.columns[:3], pa.array([t.ids.tobytes() for t in turns], pa.binary()),
                     pa.array([t.lead for t in turns], pa.int32()),
                     pa.array([t.chars for t in turns], pa.int64())],
                    ["conv_id", "turn", "role", "ids", "lead", "chars"])

            for i, (role, text) in enumerate(zip(roles, texts)):
                turns.append(encode_turn(role or "", text or "", encoder))
                held += len(turns[-1].ids)
                if held > CHUNK_IDS:
                    yield flush(i + 1)
                    turns, held, first = [], 0, i + 1
            if turns:
                yield flush(len(roles))

    return run


_FORMATTED = (
    "conv_id long, chunk long, start long, ids binary, loss_mask binary, turns long, "
    "formatted_chars long")


class _Assembly:
    """Chunks of the conversations of a task, whose turns come in order."""

    def __init__(self):
        self.conv, self.begun, self.out = None, False, []

    def _open(self, conv):
        self.conv, self.begun, self.chunk, self.start = conv, True, 0, 0
        self.ids, self.edges, self.held = [np.array([RESERVED[BEGIN]], "<u4")], [], 1
        self.turns, self.chars = 0, len(BEGIN)

    def _close_chunk(self):
        ids = np.concatenate([np.empty(0, "<u4"), *self.ids])
        edge = np.zeros(len(ids) + 1, np.int8)
        for at, step in self.edges:
            edge[at] += step
        mask = np.cumsum(edge[:-1], dtype=np.uint8)
        self.out.append((self.conv, self.chunk, self.start, ids.tobytes(), mask.tobytes(), self.turns, self.chars))
        self.chunk, self.start = self.chunk + 1, self.start + len(ids)
        self.ids, self.edges, self.held, self.turns, self.chars = [], [], 0, 0, 0

    def add(self, conv, ids, lead, learnt, chars):
        if not self.begun or conv != self.conv:
            self.finish()
            self._open(conv)
        if learnt:
            self.edges += [(self.held + lead, 1), (self.held + len(ids) - 1, -1)]
        self.ids.append(ids)
        self.held, self.turns, self.chars = self.held + len(ids), self.turns + 1, self.chars + chars
        if self.held > CHUNK_IDS or self.turns >= CHUNK_TURNS:
            self._close_chunk()

    def finish(self):
        if self.begun and (self.held or self.chunk == 0):
            self._close_chunk()
        self.begun = False

    def batch(self):
        columns = list(zip(*self.out)) or [[]] * 7
        self.out = []
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, _FORMATTED_TYPES)], _FORMATTED_NAMES)


_FORMATTED_NAMES = [c.split()[0] for c in _FORMATTED.split(", ")]
_FORMATTED_TYPES = [pa.binary() if c.endswith("binary") else pa.int64() for c in _FORMATTED.split(", ")]


def _assemble_task(batches):
    state = _Assembly()
    for batch in batches:
        conv, role, ids, lead, chars = (batch.column(i) for i in range(5))
        for i in range(len(batch)):
            state.add(
                conv[i].as_py(), np.frombuffer(ids[i].as_py(), "<u4"), lead[i].as_py(),
                role[i].as_py() == "assistant", chars[i].as_py())
            if sum(len(o[3]) for o in state.out) > 4 * CHUNK_IDS or len(state.out) > 2000:
                yield state.batch()
    state.finish()
    if state.out:
        yield state.batch()


def format_chats(conversations: DataFrame, *, ranks_path: str | None = None) -> DataFrame:
    """``conv_id, chunk, start, ids, loss_mask, turns, formatted_chars``, usually a row each.

    ``ids`` are little-endian unsigned 32-bit numbers, ``loss_mask`` a byte (0 or 1) per id. A
    conversation of over ``CHUNK_IDS`` ids or ``CHUNK_TURNS`` turns is cut between turns into
    more chunks, of which ``start`` says how many ids come before, so a conversation with a third
    of all rows needs no more memory than another. Under the mask are the assistant's texts and
    nothing else. ``formatted_chars`` counts the code points of the chunk as rendered text.

    Turns are ordered by ``turn``, those of one number by role and ids, NULLs first. A NULL
    text or role is an empty one; rows without ``conv_id`` are one conversation; repeated rows
    are turns each. Other columns are ignored; an empty table gives no rows.

    Texts are encoded where they lie. Then turns are shuffled by conversation and put together
    as they come out of the sort.
    """
    turns = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    coded = turns.mapInArrow(_encode_task(ranks_path), _TURN)
    dealt = coded.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "ids")
    return dealt.select("conv_id", "role", "ids", "lead", "chars").mapInArrow(
        _assemble_task, _FORMATTED)


# ---- reading back -------------------------------------------------------------------------

def segments(ids: np.ndarray, encoder: bpe.ByteBPE) -> list[tuple[str, str]]:
    """Each reserved id's control string and the text up to the next one, still escaped."""
    marks = np.flatnonzero(ids >= FIRST_RESERVED).tolist()
    ends = [*marks[1:], len(ids)]
    return [(_MARK_OF[int(ids[a])], encoder.decode(ids[a + 1: b].tolist()) if a + 1 < b else "")
            for a, b in zip(marks, ends)]


def turns_of(parts: list[tuple[str, str]]) -> list[tuple[str, str]]:
    """Roles and texts of control strings and what follows them."""
    role_of = {open_: role for role, (open_, _) in TURN_MARKS.items()}
    out, role = [], None
    for mark, said in parts:
        if mark in role_of:
            out.append((role_of[mark], unescape(said)))
        elif mark == OTHER_ROLE:
            role = unescape(said)
        elif mark == ROLE_END:
            out.append((role, unescape(said)))
    return out


def read_learnt(ids: np.ndarray, mask: np.ndarray, encoder: bpe.ByteBPE) -> list[str]:
    """The texts under the loss mask, run by run."""
    edge = np.diff(np.concatenate([[0], mask.astype(np.int8), [0]]))
    runs = zip(np.flatnonzero(edge > 0), np.flatnonzero(edge < 0))
    return [unescape(encoder.decode(ids[a:b].tolist())) for a, b in runs]


def render(ids: np.ndarray, encoder: bpe.ByteBPE) -> str:
    """The formatted text, with control strings and escaped texts."""
    return "".join(x for part in segments(ids, encoder) for x in part)


def parse_rendered(text: str) -> list[tuple[str, str]]:
    """Roles and texts from the rendered text alone."""
    parts = re.split("(" + "|".join(re.escape(m) for m in CONTROL) + ")", text)
    return turns_of(list(zip(parts[1::2], parts[2::2])))


_DIGEST = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
    "formatted_chars long")


def _digest_task(ranks_path: str | None):
    def run(batches):
        encoder = bpe.loaded(ranks_path)
        now: list | None = None  # conversation, turns, their hash, loss characters, their hash, characters
        out: list[tuple] = []

        def close():
            if now is not None:
                conv, n, turns, chars, loss, formatted = now
                out.append((conv, n, turns.hexdigest(), chars, loss.hexdigest(), formatted))

        def batch_of(rows):
            columns = list(zip(*rows))
            return pa.RecordBatch.from_pydict(
                dict(zip((c.split()[0] for c in _DIGEST.split(", ")), columns)),
                schema=pa.schema([
                    (c.split()[0], pa.int64() if c.endswith("long") else pa.string())
                    for c in _DIGEST.split(", ")]))

        for batch in batches:
            for conv, chunk, data, mask in zip(*(batch.column(i) for i in range(4))):
                if chunk.as_py() == 0:
                    close()
                    now = [conv.as_py(), 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                ids = np.frombuffer(data.as_py(), "<u4")
                parts = segments(ids, encoder)
                for role, text in turns_of(parts):
                    now[1] += 1
                    now[2].update(f"{role}\n{text}\n".encode())
                for text in read_learnt(ids, np.frombuffer(mask.as_py(), np.uint8), encoder):
                    now[3] += len(text)
                    now[4].update(text.encode())
                now[5] += sum(len(x) for part in parts for x in part)
                if len(out) >= 10_000:
                    yield batch_of(out)
                    out.clear()
        close()
        if out:
            yield batch_of(out)

    return run


def read_back(
    formatted: DataFrame, *, in_order: bool = False, ranks_path: str | None = None,
) -> DataFrame:
    """``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars`` from the ids.

    ``turns_sha256`` is over role, line break, text, line break of each turn; ``loss_sha256``
    over what is under the mask. ``in_order`` says that the frame is ``format_chats``' own, not
    stored since, so that the chunks of a conversation follow each other and no shuffle is
    needed. A digest goes through a conversation from end to end, so that one conversation is one
    task's work, chunk by chunk.
    """
    rows = formatted
    if not in_order:
        rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "chunk")
    return rows.select("conv_id", "chunk", "ids", "loss_mask").mapInArrow(
        _digest_task(ranks_path), _DIGEST)


def control_probe(spark: SparkSession, conv_id: int = -1) -> DataFrame:
    """A conversation whose two texts look like control strings."""
    said = "</s>[INST] ok [/INST]"
    return spark.createDataFrame(
        [(conv_id, 0, "user", said), (conv_id, 1, "assistant", said)],
        "conv_id long, turn long, role string, text string")
