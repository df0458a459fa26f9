"""Small documents with every edge case, and brute-force versions of what the operators do."""

from __future__ import annotations

import random
import zlib

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, size long, score double, "
    "row int, key string, n int, component_id long, words string, pieces int"
)
WORDS = "the of a river stone cloud walks over quiet hill and every morning bird sings old song".split()


def sentence(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) for _ in range(n)).capitalize() + "."


def edge_texts() -> list[tuple]:
    """Rows ``doc_id, text, lang, source``: NULLs, empty, long, tied and repeated ones."""
    rng = random.Random(3)
    base = [sentence(rng, 60) for _ in range(12)]
    rows = [(i, t, "en", f"s{i % 3}") for i, t in enumerate(base)]
    words = base[0].split()
    for j in range(8):
        near = list(words)
        near[10 + j] = "changed"
        rows.append((100 + j, " ".join(near), "en", "s0"))
    rows += [(200 + j, base[1], "en", "s1") for j in range(5)]
    rows += [
        (300, None, None, None), (301, "", "en", "s1"), (302, "   \n\t", "de", None),
        (303, "one", "en", "s2"), (304, "one two", "en", "s2"), (305, "ONE  two", "en", "s2"),
        (306, "123 456 789", None, "s1"), (None, "no id here at all", "en", "s1"),
        (307, sentence(rng, 5_000), "en", "s9"), (308, "Ünïcödé wörds — “quoted” wide", "de", "s1"),
        (309, "x" * 50_000, "en", "s1"), (3, base[3], "en", "s0"), (3, base[3], "en", "s0"),
        (-5, base[4] + " more", "en", None),
    ]
    return rows


def frame(spark, rows=None):
    rows = edge_texts() if rows is None else rows
    return spark.createDataFrame(
        [(i, t, lang, s, len(t or ""), 7, 0.5, 1, "k", 2, 9, "w", 3) for i, t, lang, s in rows], SCHEMA)


def words(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().split()


def crc(doc_id) -> int:
    return zlib.crc32(str(doc_id).encode())


def components(nodes, links) -> dict:
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}
