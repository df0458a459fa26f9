from __future__ import annotations

import random
import re
import string
import textwrap
import unicodedata
from collections import Counter

from helpers import edge_texts, frame, sentence
from pyspark.sql import functions as F

from tallyline.llm import diagonal_scan, line_rules


def brute_counts(text):
    text = text or ""
    w = [x.decode() for x in text.encode().split()]
    grams = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    covered = set()
    for i in range(len(w) - 2):
        if grams[tuple(w[i:i + 3])] > 1:
            covered |= {i, i + 1, i + 2}
    lines = [x for x in text.split("\n") if x.encode().split()]
    return (
        len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)),
        len(covered), len(w) < 50 or 100 * len(covered) > 50 * len(w))


def test_line_counts_equal_brute_force(spark):
    rng = random.Random(7)
    rows = edge_texts()
    rows += [(500 + i, sentence(rng, n) + "\n" + sentence(rng, n), "en", "s") for i, n in enumerate((3, 40, 400, 4000))]
    rows.append((600, "same line here\n" * 30 + "# * | <x>\nsame line here", "en", "s"))
    got = line_rules.clean_documents(frame(spark, rows)).collect()
    have = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got)
    assert have == Counter((i, *brute_counts(t)) for i, t, *_ in rows)
    assert all(not r.kept for r in got if r.base_failed)
    assert line_rules.clean_documents(frame(spark, [])).collect() == []


def test_line_verdicts(spark):
    rng = random.Random(1)
    prose = "\n".join(" ".join(f"{w}{i}{j}" for j, w in enumerate(sentence(rng, 30).split())) + "." for i in range(4))
    menu = "\n".join(" | ".join(f"page{i}{j} item" for j in range(12)) for i in range(6))
    noise = " ".join(f"w{i}***" for i in range(120))
    rows = [
        (1, prose, "en", "s"), (2, menu, "en", "s"), (3, noise, "en", "s"),
        (4, prose + "\nAll rights reserved.\nHome | About | Contact | Help", "en", "s"),
        (5, " ".join(f"word{i}" for i in range(90)), "en", "s"),
    ]
    got = {r.doc_id: r for r in line_rules.clean_documents(frame(spark, rows)).collect()}
    assert {i for i, r in got.items() if r.kept} == {1, 4}
    assert got[4].clean_text == prose and got[4].n_lines_removed == 2


def brute_failure(line, below):
    tokens = [t.decode() for t in line.encode().split()]
    separators = sum(t in "|>»·•/–-" and len(t) == 1 for t in tokens)
    if separators >= 3 and separators * 4 >= len(tokens):
        return "navigation"
    if sum(c in string.punctuation for c in line) > len(tokens):
        return "punctuation"
    bare = [t.rstrip("\"'”’»)]") for t in tokens]
    ended = any(b and b[-1] in ".!?…。！？:;\u0964\u0965\u061F\u06D4\u1362\u104B" for b in bare)
    first = unicodedata.category((below.lstrip(" \t").lstrip("\"'“„‘«([") or " ")[0])
    wraps = first == "Ll" or (len(line) >= 55 and first[0] in "LN")
    if len(tokens) >= 5 and not ended and not wraps:
        return "punctuation"
    if len(tokens) <= 30 and any(p in line.lower() for p in line_rules.BOILERPLATE):
        return "boilerplate"
    return None


def brute_clean(text):
    lines = (text or "").split("\n")
    good = [
        x for x, below in zip(lines, [*lines[1:], ""])
        if x.encode().split() and brute_failure(x, below) is None]

    def size(x):
        return sum(len(t.decode()) for t in x.encode().split())

    kept = not brute_counts(text)[-1] and size("\n".join(good)) >= 0.5 * size(text or "")
    return kept, "\n".join(good)


def test_verdicts_equal_brute_force(spark):
    rng = random.Random(11)
    tails = ["", ".", "!", '."', "?)", " |", ";", "…", " »"]
    heads = ["", "“", "(", "- ", "| ", "Home | ", "3 ", "É", "é", "\t", "#"]

    def line():
        kind = rng.random()
        if kind < 0.1:
            return rng.choice(["", " ", "\t "])
        if kind < 0.2:
            return rng.choice(["Home | About | Contact | Help", "Click here to read more", "a / b / c / d", "*** --- ###"])
        words = [f"w{rng.randrange(4000)}" for _ in range(rng.choice((1, 4, 5, 9, 14, 35)))]
        words[0] = rng.choice((str.upper, str.lower))(words[0])
        return rng.choice(heads) + " ".join(words) + rng.choice(tails)

    rows = edge_texts() + [
        (1000 + i, "\n".join(line() for _ in range(rng.randrange(1, 25))), "en", "s") for i in range(400)]
    got = Counter((r.doc_id, r.kept, r.clean_text) for r in line_rules.clean_documents(frame(spark, rows)).collect())
    assert got == Counter((i, *brute_clean(t)) for i, t, *_ in rows)
    assert {k for _, k, _ in got} == {True, False}


def test_hard_wrapped_prose_stays(spark):
    """Lines of wrapped prose are one sentence; headlines and open last lines still fail."""
    rng = random.Random(5)
    prose = " ".join(
        " ".join(f"{w}{i}{j}" for j, w in enumerate(sentence(rng, 30).split())) + "." for i in range(6))
    nouns = re.sub(r"\b[a-z]+(\d*[02468])\b", lambda m: m.group().capitalize(), prose)
    headlines = "\n".join(f"Ten things to know about item{i}" for i in range(20))
    rows = [
        (1, "\n".join(textwrap.wrap(prose, 70)), "en", "s"), (2, "\n".join(textwrap.wrap(nouns, 70)), "de", "s"),
        (3, headlines, "en", "s"),
        (4, "\n\n".join(textwrap.wrap(prose, 70)), "en", "s"),
    ]
    got = {r.doc_id: r for r in line_rules.clean_documents(frame(spark, rows)).collect()}
    assert got[1].kept and got[1].n_lines_removed == 0
    assert got[2].kept and got[2].n_lines_removed <= 2
    assert not got[3].kept and got[3].clean_text == ""
    assert not got[4].kept


def test_windows_with_equal_short_keys(spark):
    """Hashes that agree in their leading bits are told apart by the wider keys."""
    from pyspark.sql import functions as F

    a, b = 1 << 40, (1 << 40) + 1
    df = spark.createDataFrame([([a, b, a, 5, b, a],), ([a, b],), ([7, 7],)], "h array<long>")
    got = [r.p for r in df.select(line_rules._repeated_places(F.col("h")).alias("p")).collect()]
    assert got == [[0, 1, 2, 4, 5], [], [0, 1]]


def brute_base(text):
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    w = re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    found = [
        (i, label) for phrase, label in diagonal_scan.PHRASES.items()
        for i in range(len(w)) if w[i:i + len(phrase.split())] == phrase.split()]
    places = [i for i, _ in found]
    return (
        len(w), len(found), min(places, default=None), max(places, default=None),
        ",".join(sorted({label for _, label in found})))


def license_rows():
    rng = random.Random(4)
    t = sentence(rng, 40)
    return edge_texts() + [
        (700, t + " Licensed under CC BY-NC 4.0. cc by cc by", "en", "s"),
        (701, "ALL RIGHTS RESERVED " + t + " all rights reserved, GNU General Public License", "en", "s"),
        (702, t + "\nLicensed under the Apache License, Version 2.0.", "en", "s"),
        (703, t + " This work is licensed, kindly, under the GNU General Public License, version 3.", "en", "s"),
        (704, "cc", "en", "s"), (705, "cc by", "en", "s"), (706, "rights reserved all", "en", "s"),
        (707, "CC BKY CC İ BY", "en", "s"), (708, "cc by " * 400, "en", "s"),
        (702, t + "\nLicensed under the Apache License, Version 2.0.", "en", "s"),
    ]


def test_license_places_equal_brute_force(spark):
    rows = license_rows()
    got = diagonal_scan.scan_licenses(frame(spark, rows)).collect()
    have = Counter((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got)
    assert have == Counter((i, *brute_base(t)) for i, t, *_ in rows)
    by = {r.doc_id: r for r in got}
    assert by[702].labels == "apache-2.0" and by[702].score == 1.0
    assert by[703].labels == "gpl,gpl-2.0,gpl-3.0" or by[703].labels == "gpl,gpl-3.0"
    assert "cc-by-nc" in by[700].labels and by[700].base_labels == "cc-by"
    assert by[0].labels == "" and by[0].score == 0.0
    assert all(set(r.base_labels.split(",")) - {""} <= set(r.labels.split(",")) for r in got)
    assert diagonal_scan.scan_licenses(frame(spark, [])).collect() == []


def test_licenses_that_differ_in_a_deciding_word(spark):
    """A notice gets its own label and not that of a near one."""
    gpl = "This work is licensed under the GNU General Public License"
    cc = "This work is licensed under a Creative Commons Attribution"
    notices = [
        (f"{gpl} version 3", "gpl,gpl-3.0"), (f"{gpl}, version 2.", "gpl,gpl-2.0"), (f"{gpl} version", "gpl"),
        ("under the terms of the GNU General Public License", "gpl"),
        ("under the terms of the GNU Lesser General Public License", "gpl,lgpl"),
        ("under the terms of the GNU Affero General Public License", "agpl,gpl"),
        (f"{cc} 4.0 International License", "cc-by"),
        (f"{cc} NonCommercial ShareAlike 4.0 International License", ""),
        (f"{cc}-NonCommercial 4.0 International License", ""),
        ("Licensed under CC BY-NC 4.0", "cc-by,cc-by-nc"), ("Licensed under CC BY-SA 4.0", "cc-by,cc-by-sa"),
        ("Licensed under CC BY-ND 4.0", "cc-by,cc-by-nd"), ("Licensed under CC BY-NC-SA 4.0", "cc-by"),
        ("Licensed under the Apache License, Version 2.0", "apache-2.0"),
        ("This work is kindly licensed under the GNU General Public License version 3", "gpl,gpl-3.0"),
        ("subject to the terms of the Mozilla Public License, v. 2.0", "mpl-2.0"),
        ("dedicated to the public domain under CC0 1.0 Universal", "cc0-1.0"),
    ]
    rows = [
        (len(notices) * k + i, lead + text + tail, "en", "s")
        for k, (lead, tail) in enumerate((("", ""), ("river stone cloud " * 30, " walks over 3 hills")))
        for i, (text, _) in enumerate(notices)]
    rows.append((None, notices[0][0], "en", "s"))
    got = {r.doc_id: r.labels for r in diagonal_scan.scan_licenses(frame(spark, rows)).collect()}
    assert got.pop(None) == "gpl,gpl-3.0"
    assert [got[i] for i in range(2 * len(notices))] == [label for _, label in notices] * 2


def test_sentences_of_other_scripts_end(spark):
    """A line of five words ends with the mark of its script; without one it fails."""
    marks = "\u0964\u0965\u061F\u06D4\u1362\u104B"
    line = "नदी आज धीरे धीरे बहती है"
    got = line_rules.line_failure
    rows = [(line + m,) for m in marks] + [(line + "\u0964\u201D",), (line + " ",)]
    found = [r.f for r in spark.createDataFrame(rows, "x string").select(got(F.col("x")).alias("f")).collect()]
    assert found == [None] * 7 + ["punctuation"]


def test_common_short_notices_and_bodies(spark):
    gpl = "you can redistribute it and/or modify it under the terms of the GNU {}General Public License as published by the Free Software Foundation, either version {} of the License, or (at your option) any later version."
    notices = [
        ("Licensed under the Apache License 2.0", "apache-2.0"),
        ("Apache License, Version 1.1", ""),
        ("SPDX-License-Identifier: Apache-2.0", "apache-2.0"), ("SPDX-License-Identifier: GPL-2.0-only", "gpl-2.0"),
        ("SPDX-License-Identifier: GPL-3.0-or-later", "gpl-3.0"), ("SPDX-License-Identifier: MIT", "mit"),
        ("SPDX-License-Identifier: BSD-2-Clause", "bsd-2-clause"),
        ("This project uses the MIT License", "mit"), ("distributed under the MIT license.", "mit"),
        ("GNU GPL version 3", "gpl-3.0"), ("GNU GPL version 2", "gpl-2.0"), ("GNU GPL version", ""),
        ("GNU General Public License, version 3", "gpl,gpl-3.0"),
        ("GNU Lesser General Public License version 3", "gpl,lgpl"),
        ("GNU Affero General Public License version 3", "agpl,gpl"),
        ("BSD 3-Clause License", "bsd-3-clause"), ("BSD 2-Clause License", "bsd-2-clause"),
        ("Creative Commons Attribution-ShareAlike 4.0 International", "cc-by-sa"),
        ("Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International", ""),
        ("This program is free software: " + gpl.format("", 3), "gpl,gpl-3.0"),
        ("This program is free software; " + gpl.format("", 2), "gpl,gpl-2.0"),
        ("This program is free software; " + gpl.format("Lesser ", 2), "gpl,lgpl"),
        ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted", "isc"),
        ("the terms of the contract and the name of the holder", ""),
    ]
    rows = [
        (len(notices) * k + i, lead + text + tail, "en", "s")
        for k, (lead, tail) in enumerate((("", ""), ("river stone cloud " * 30, " walks over 3 hills")))
        for i, (text, _) in enumerate(notices)]
    got = {r.doc_id: r.labels for r in diagonal_scan.scan_licenses(frame(spark, rows)).collect()}
    wrong = [(text, got[k * len(notices) + i]) for k in (0, 1) for i, (text, label) in enumerate(notices)
             if got[k * len(notices) + i] != label]
    assert wrong == []
