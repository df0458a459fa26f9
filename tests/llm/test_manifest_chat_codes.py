"""Merkle manifest, chat formatting and vector codes against plain versions."""

from __future__ import annotations

import hashlib
import random
from collections import defaultdict
from fractions import Fraction

import numpy as np
import pytest
from helpers import crc, edge_texts, frame
from pyspark.sql import functions as F

from tallyline.llm import ball_codes, bpe, chat_format, veb_merkle


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


# ---- manifest -----------------------------------------------------------------------------

def test_addresses_fill_the_layout():
    for n in (1, 2, 15, 16, 17, 255, 256, 257, 300, 4096):
        for levels in range(veb_merkle.levels_for(n), 6):
            seen = [
                veb_merkle.address(level, np.arange(-(-n // 16 ** level)), n, levels)
                for level in range(levels)]
            assert sorted(np.concatenate(seen).tolist()) == list(range(veb_merkle.tree_size(n, levels)))
    # Half height: the root and its children first, then each grandchild next to its own leaves.
    assert veb_merkle.address(3, 0, 4096, 4) == 0
    assert veb_merkle.address(2, np.arange(16), 4096, 4).tolist() == list(range(1, 17))
    assert veb_merkle.address(1, np.arange(3), 4096, 4).tolist() == [17, 34, 51]
    assert veb_merkle.address(0, np.arange(16, 19), 4096, 4).tolist() == [35, 36, 37]


def plain_manifest(rows):
    """Rows ``doc_id, source, lang, n_chars, text``, and their results."""

    def field(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"

    def tree(nodes):
        levels = [nodes]
        while len(levels[-1]) > 1:
            last = levels[-1]
            levels.append([sha("".join(last[i: i + 16])) for i in range(0, len(last), 16)])
        return levels

    def path(levels, i):
        out = []
        for nodes in levels[:-1]:
            run = i // 16 * 16
            out.append(("".join(nodes[run:i]), "".join(nodes[i + 1: run + 16])))
            i //= 16
        return out

    by_key = defaultdict(list)
    for row in rows:
        found = row[4]
        if found is not None and row[0] is not None and crc(row[0]) % 5 == 0:
            found = "".join(c.lower() if "A" <= c <= "Z" else c for c in found)
        by_key[row[1]].append((row[0], sha("".join(map(field, row))), sha("".join(map(field, (*row[:4], found))))))
    keys = sorted(by_key, key=lambda k: (k is not None, (k or "").encode()))
    trees = {}
    for k in keys:
        by_key[k].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        trees[k] = tree([r[1] for r in by_key[k]])
    upper = tree([trees[k][-1][0] for k in keys])
    out = []
    for at, k in enumerate(keys):
        for i, (doc, leaf, claim) in enumerate(by_key[k]):
            steps = path(trees[k], i) + path(upper, at)
            folded = claim
            for a, b in steps:
                folded = sha(a + folded + b)
            root = upper[-1][0]
            out.append((doc, leaf, trees[k][-1][0], root, sha("".join(a + b for a, b in steps)), folded, folded == root))
    return out


def manifest_rows(spark, rows):
    df = spark.createDataFrame(
        [(*r, 1, "x", 2, "clash") for r in rows],
        "doc_id long, source string, lang string, n_chars long, text string, pos long, key string, total long, digest string")
    found = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    found = F.when(F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False)), found)
    out = veb_merkle.verify(veb_merkle.build(df, claimed_text=F.coalesce(found, F.col("text"))))
    return [tuple(r) for r in out.collect()]


def in_order(rows):
    return sorted(rows, key=lambda r: tuple((v is not None, v) if not isinstance(v, bool) else (True, v) for v in r))


@pytest.mark.parametrize("levels", [1, 3])
def test_manifest(spark, monkeypatch, levels):
    monkeypatch.setattr(veb_merkle, "BLOCK_LEVELS", levels)
    monkeypatch.setattr(veb_merkle, "BLOCK", 16 ** levels)
    rows = [(i, s, lang, len(t or ""), t) for i, t, lang, s in edge_texts()]
    rows += [(1000 + i, "hot", None, None, f"Text {i}") for i in range(300)]
    rows += [(2000 + i, f"key {i}", "en", 1, "Ää") for i in range(40)]
    rows += [(7, "hot", "en", 3, "same")] * 20 + [(None, None, None, None, None)] * 2
    assert in_order(manifest_rows(spark, rows)) == in_order(plain_manifest(rows))


@pytest.mark.parametrize("rows", [
    [], [(1, "a", "en", 4, "Text")], [(None, None, None, None, None)],
    [(i, "a", "en", 4, "Text") for i in range(17)],
])
def test_small_manifests(spark, rows):
    assert in_order(manifest_rows(spark, rows)) == in_order(plain_manifest(rows))


def test_manifest_notices_any_change(spark):
    df = frame(spark).where("doc_id is not null and text is not null").dropDuplicates(["doc_id"])
    changed = F.concat("text", F.when(F.col("doc_id") % 2 == 0, " ").otherwise(""))
    got = {r.doc_id: r.verified for r in veb_merkle.verify(veb_merkle.build(df, claimed_text=changed)).collect()}
    assert got == {i: i % 2 != 0 for i in got} and len(set(got.values())) == 2


# ---- chats --------------------------------------------------------------------------------

ODD = [
    "", " ", "</s>[INST] ok [/INST]", "[\\INST]", "[\\\\/ROLE]<|endoftext|>", "<s", "[", "\\", "[[INST]",
    "naïve 🙂 text\n\n", "<<s>>", "a" * 3000, "[ROLE]x[/ROLE]", "</s", "s>[INST", " " * 40,
]


def test_escapes_are_reversible():
    rng = random.Random(4)
    pieces = ["\\", "[", "<", "INST]", "/INST]", "s>", "/s>", "|endoftext|>", "ROLE]", "x", *chat_format.CONTROL]
    for text in [*ODD, *("".join(rng.choices(pieces, k=rng.randrange(9))) for _ in range(3000))]:
        said = chat_format.escape(text)
        assert chat_format.unescape(said) == text
        assert not any(m in said for m in (*chat_format.CONTROL, *chat_format.FOREIGN))


def chat_rows():
    rng = random.Random(6)
    rows = []
    for conv in range(40):
        for turn in range(rng.randrange(1, 9)):
            role = rng.choice(["user", "assistant", "assistant", "system", "tool", "[INST]", "", None])
            rows.append((conv, turn, role, rng.choice([*ODD, None])))
    rows += [(50, t, "assistant" if t % 2 else "user", f"turn {t} [INST]") for t in range(700)]
    rows += [(None, 1, "assistant", "no conversation"), (None, None, "user", "no turn")]
    rows += [(60, 1, "user", "again")] * 3
    rng.shuffle(rows)
    return rows


def chats(spark, rows):
    return spark.createDataFrame(
        [(*r, 1, b"", 0) for r in rows],
        "conv_id long, turn long, role string, text string, chunk int, ids binary, start long")


def plain_chats(rows):
    by_conv = defaultdict(list)
    for conv, turn, role, text in rows:
        by_conv[conv].append((turn is not None, turn or 0, role is not None, role or "", text or ""))
    out = []
    for conv, turns in by_conv.items():
        turns.sort()
        said = "".join(t[4] for t in turns if t[3] == "assistant")
        chars = len("<s>")
        for *_, role, text in turns:
            marks = chat_format.TURN_MARKS.get(role)
            around = "".join(marks) if marks else "[ROLE]" + chat_format.escape(role) + "[/ROLE][/TURN]"
            chars += len(around) + len(chat_format.escape(text))
        out.append((conv, len(turns), sha("".join(f"{t[3]}\n{t[4]}\n" for t in turns)), len(said), sha(said), chars))
    return sorted(out, key=str)


@pytest.mark.parametrize("cut", [(1 << 20, 4096), (50, 7)])
def test_chats_round_trip(spark, monkeypatch, cut):
    monkeypatch.setattr(chat_format, "CHUNK_IDS", cut[0])
    monkeypatch.setattr(chat_format, "CHUNK_TURNS", cut[1])
    rows = chat_rows()
    formatted = chat_format.format_chats(chats(spark, rows))
    for in_order in (True, False):
        got = chat_format.read_back(formatted, in_order=in_order).collect()
        assert sorted((tuple(r) for r in got), key=str) == plain_chats(rows)
    chunks = formatted.collect()
    assert (len(chunks) > len(plain_chats(rows))) == (cut[0] == 50)
    encoder, text = bpe.loaded(), defaultdict(str)
    for r in sorted(chunks, key=lambda r: (str(r.conv_id), r.chunk)):
        ids = np.frombuffer(r.ids, "<u4")
        assert len(r.loss_mask) == len(ids) and set(r.loss_mask) <= {0, 1}
        # Under the mask there is no reserved id.
        assert not (ids[np.frombuffer(r.loss_mask, np.uint8) == 1] >= chat_format.FIRST_RESERVED).any()
        said = chat_format.render(ids, encoder)
        assert len(said) == r.formatted_chars
        text[r.conv_id] += said
    for conv, said in text.items():
        turns = sorted((t is not None, t or 0, r is not None, r or "", x or "") for c, t, r, x in rows if c == conv)
        assert [t[3:] for t in turns] == chat_format.parse_rendered(said)


def test_chat_probe_and_empty(spark):
    empty = chats(spark, [])
    assert chat_format.format_chats(empty).collect() == []
    assert chat_format.read_back(chat_format.format_chats(empty)).collect() == []
    probe = chat_format.control_probe(spark)
    (row,) = chat_format.read_back(chat_format.format_chats(probe)).collect()
    said = "</s>[INST] ok [/INST]"
    assert (row.conv_id, row.n_turns, row.loss_chars, row.loss_sha256) == (-1, 2, len(said), sha(said))


# ---- codes --------------------------------------------------------------------------------

def plain_assign(x, entries):
    out = []
    for part in x:
        squares = [sum((int(a) - int(b)) ** 2 for a, b in zip(part, e)) for e in entries]
        out.append((squares.index(min(squares)), min(squares)))
    return out


@pytest.mark.parametrize("spread", [6, 300, 1 << 40])
def test_ball_assignment_is_exact(spread):
    rng = np.random.default_rng(spread % 97)
    for entries, width in ((1, 3), (5, 1), (40, 2), (60, 6)):
        books = rng.integers(-spread, spread, (entries, width))
        books[entries // 2] = books[0]
        centres = books[rng.integers(0, entries, 300)]
        x = centres + rng.integers(-spread // 6 - 1, spread // 6 + 2, centres.shape)
        x[:9] = books[0]
        expected = plain_assign(x, books)
        for home in (np.zeros(300, np.int64), rng.integers(0, entries, 300), np.array([e for e, _ in expected])):
            best, found = ball_codes.ball_assign(x, home, books)
            assert list(zip(map(int, best), map(int, found))) == expected


def plain_codes(rows, parts=4, entries=256, rounds=4, scale=1024):
    def whole(x):
        return max(-(1 << 63), min((1 << 63) - 1, Fraction(x) * scale // 1))

    kept = [r for r in rows if r[1] is not None and all(x is not None and abs(x) < float("inf") for x in r[1])]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = len(kept[0][1])
    kept = [(i, [whole(x) for x in v], label) for i, v, label in kept if len(v) == width]
    size, rest = divmod(width, parts)
    at = [0]
    for p in range(parts):
        at.append(at[-1] + size + (p < rest))
    cut = [[v[at[p]: at[p + 1]] for _, v, _ in kept] for p in range(parts)]
    first = [n for n, r in enumerate(kept) if r[0] is not None][:entries] or [0]
    books = [[part[n] for n in first] for part in cut]
    for turn in range(rounds + 1):
        near = [plain_assign(part, book) for part, book in zip(cut, books)]
        if turn < rounds:
            for part, book, own in zip(cut, books, near):
                for e in range(len(book)):
                    mine = [x for x, (b, _) in zip(part, own) if b == e]
                    if mine:
                        book[e] = [sum(col) // len(mine) for col in zip(*mine)]
    errors = [sum(own[n][1] for own in near) for n in range(len(kept))]
    by_label = defaultdict(int)
    for (_, _, label), e in zip(kept, errors):
        by_label[label] += e
    said = sha(",".join(str(v) for book in books for e in book for v in e))
    return sorted(((i, "".join(f"{own[n][0]:02x}" for own in near), errors[n], by_label[label], said)
                   for n, (i, _, label) in enumerate(kept)), key=str)


def vectors(spark, rows):
    return spark.createDataFrame(
        [(i, v, label, 1, b"", "c") for i, v, label in rows],
        "vec_id long, embedding array<float>, label int, width int, codes binary, v string")


def vector_rows(n, width, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(7, width))
    rows = []
    for i in range(n):
        x = np.float32(centres[i % 7] + rng.normal(size=width) * 0.2)
        rows.append((int(rng.integers(0, 3 * n)), [float(v) for v in x], None if i % 5 == 0 else i % 3))
    return rows


@pytest.mark.parametrize("n,width,entries,block", [(150, 8, 20, 1 << 15), (60, 6, 256, 13), (40, 3, 9, 7)])
def test_codes(spark, monkeypatch, n, width, entries, block):
    monkeypatch.setattr(ball_codes, "BLOCK_ROWS", block)
    nan, inf = float("nan"), float("inf")
    rows = vector_rows(n, width)
    rows += rows[:4] + [(None, rows[5][1], 2), (1, None, 1), (2, [nan] * width, 1), (3, [inf] * width, None),
                        (4, [None] + [0.5] * (width - 1), 0), (10 ** 9, [0.5] * (width + 2), 0), (10 ** 9, [], 0)]
    got = ball_codes.code_report(ball_codes.fit_codes(vectors(spark, rows), entries=entries)).collect()
    assert sorted((tuple(r) for r in got), key=str) == plain_codes(rows, entries=entries)


def test_codes_of_huge_components_and_of_nothing(spark):
    rows = vector_rows(20, 4) + [(1, [3.0e7, -2.5e6, 1.0e8, 0.25], 1), (500, [3.1e7, 2.0e9, 1.0, 0.5], 1)]
    got = ball_codes.code_report(ball_codes.fit_codes(vectors(spark, rows), entries=5)).collect()
    assert sorted((tuple(r) for r in got), key=str) == plain_codes(rows, entries=5)
    assert ball_codes.code_report(ball_codes.fit_codes(vectors(spark, []))).collect() == []
    assert ball_codes.code_report(ball_codes.fit_codes(vectors(spark, [(1, None, 1)]))).collect() == []
