"""License scans by diagonal voting.

Each text becomes a row per word 2-gram, which is joined to the places where that 2-gram stands
in the license templates. A hit votes for the diagonal ``place in text - place in template``. A
diagonal with all votes is an exact occurrence; neighbouring diagonals are merged, so a template
with a few words added, left out or changed is found by the share of it that is covered. The
words of each hit are compared with the template's, so spans are verified word by word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyline.sources.tables import stage_table

GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MOST_TEMPLATE_WORDS = 20_000
# Fixed phrases and labels whose exact places are reported.
PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}
# Wordings of license notices.
NOTICES = {
    "licensed under the apache license version 2 0": "apache-2.0",
    "released under the mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy of this software": "mit",
    "licensed under cc by nc 4 0": "cc-by-nc",
    "licensed under cc by sa 4 0": "cc-by-sa",
    "licensed under cc by nd 4 0": "cc-by-nd",
    "this work is licensed under the gnu general public license version 3": "gpl-3.0",
    "this work is licensed under the gnu general public license version 2": "gpl-2.0",
    "under the terms of the gnu lesser general public license": "lgpl",
    "under the terms of the gnu affero general public license": "agpl",
    "redistribution and use in source and binary forms with or without modification are permitted": "bsd",
    "subject to the terms of the mozilla public license v 2 0": "mpl-2.0",
    "this work is licensed under a creative commons attribution 4 0 international license": "cc-by",
    "dedicated to the public domain under cc0 1 0 universal": "cc0-1.0",
    "apache license version 2 0": "apache-2.0",
    "apache license 2 0": "apache-2.0",
    "under the mit license": "mit",
    "uses the mit license": "mit",
    "bsd 2 clause license": "bsd-2-clause",
    "bsd 3 clause license": "bsd-3-clause",
    "gnu gpl version 2": "gpl-2.0",
    "gnu gpl version 3": "gpl-3.0",
    "gnu general public license version 2": "gpl-2.0",
    "gnu general public license version 3": "gpl-3.0",
    "gnu lesser general public license version 3": "lgpl",
    "gnu affero general public license version 3": "agpl",
    "mozilla public license version 2 0": "mpl-2.0",
    "creative commons attribution 4 0 international": "cc-by",
    "creative commons attribution sharealike 4 0 international": "cc-by-sa",
    "creative commons attribution noderivatives 4 0 international": "cc-by-nd",
    "spdx license identifier apache 2 0": "apache-2.0",
    "spdx license identifier mit": "mit",
    "spdx license identifier isc": "isc",
    "spdx license identifier unlicense": "unlicense",
    "spdx license identifier bsd 2 clause": "bsd-2-clause",
    "spdx license identifier bsd 3 clause": "bsd-3-clause",
    "spdx license identifier gpl 2 0": "gpl-2.0",
    "spdx license identifier gpl 3 0": "gpl-3.0",
    "spdx license identifier lgpl 3 0": "lgpl",
    "spdx license identifier agpl 3 0": "agpl",
    "spdx license identifier mpl 2 0": "mpl-2.0",
    "unless required by applicable law or agreed to in writing software distributed under the license is"
    " distributed on an as is basis without warranties or conditions of any kind": "apache-2.0",
    "the above copyright notice and this permission notice shall be included in all copies or substantial"
    " portions of the software": "mit",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or"
    " promote products derived from this software without specific prior written permission": "bsd-3-clause",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is"
    " hereby granted": "isc",
    "this is free and unencumbered software released into the public domain": "unlicense",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu"
    " general public license as published by the free software foundation either version 2 of the license"
    " or at your option any later version": "gpl-2.0",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu"
    " general public license as published by the free software foundation either version 3 of the license"
    " or at your option any later version": "gpl-3.0",
}
# Words that tell licenses apart; a number does so after a word of the second kind.
DECIDING = (
    "lesser", "library", "affero", "nc", "sa", "nd", "noncommercial", "commercial", "sharealike", "alike",
    "noderivatives", "noderivs", "derivatives", "derivs",
)
NUMBERED = (*DECIDING, "version", "v", "by", "attribution", "license", "cc0", "gpl", "bsd")
NUMBERS = tuple("123456789")
BUCKET_WORDS = 64


def _deciding(words: list[str]) -> list[str]:
    """The distinct words of a template that tell licenses apart, sorted."""
    return sorted({
        w for before, w in zip(["", *words], words)
        if w in DECIDING or (w in NUMBERS and before in NUMBERED)})


def _template_rows(phrases: dict[str, str], notices: dict[str, str]) -> list[tuple]:
    """A row per 2-gram of each template: template, exact, label, words, place, its two words."""
    rows, total = [], 0
    for exact, wordings in ((True, phrases), (False, notices)):
        for wording, label in wordings.items():
            w = wording.split()
            total += len(w)
            if len(w) < 2:
                raise ValueError(f"a template needs two words: {wording}")
            rows += [
                (wording, exact, label, len(w), i, w[i], w[i + 1]) for i in range(len(w) - 1)]
    if total > MOST_TEMPLATE_WORDS:
        raise ValueError(f"templates have {total} words; the broadcast is for {MOST_TEMPLATE_WORDS}")
    return rows


def _words(text: Column) -> Column:
    """Words with only A-Z lower-cased: ``lower`` does that where all characters are ASCII."""
    ascii_only = F.length(text) == F.octet_length(text)
    low = F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    return F.array_remove(F.split(low, GAP), "")


def scan_licenses(
    docs: DataFrame, *, phrases: dict[str, str] | None = None, notices: dict[str, str] | None = None,
    least: float = 0.75, drift: int = 3, doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """One row per document with counts, places, labels and ``spans``.

    ``n_base``, ``first_word``, ``last_word`` and ``base_labels`` describe the exact places of
    ``phrases``; ``labels`` adds those of ``notices`` of which ``least`` of the 2-grams are covered
    on diagonals at most ``drift`` apart, with just the template's deciding words where it would
    stand. ``score`` is the best coverage, 0 without a find. ``spans`` lists each find as ``label, first, last, coverage`` (word numbers from 0, both included).

    NULL and empty texts have no words and no finds (labels empty, places NULL). Repeated rows
    each get the result of their text. NULL ids are kept. Other columns are ignored.
    """
    notices = NOTICES if notices is None else notices
    rows = _template_rows(PHRASES if phrases is None else phrases, notices)
    # A deciding word is found like a template of its own, whose second word is empty.
    rows += [(w, None, "", 1, 0, w, "") for w in (*DECIDING, *NUMBERS)]
    templates = F.broadcast(docs.sparkSession.createDataFrame(
        rows, "template string, exact boolean, label string, n int, at int, w0 string, w1 string"
    ).withColumn("gram", F.xxhash64("w0", "w1")))
    base = docs.select(
        F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    base = base.select("doc_id", F.xxhash64("text").alias("t"), _words(F.col("text")).alias("words"))

    # The templates' hashes are known, so places without any of them need not become rows. A row
    # carries its two words and not the text's: exploding copies what stands beside the array.
    words = F.col("words")

    def gram(i: Column) -> Column:
        return F.xxhash64(F.get(words, i), F.get(words, i + 1))

    def decides(i: Column) -> Column:
        word = F.get(words, i)
        return word.isin(*DECIDING) | (word.isin(*NUMBERS) & F.get(words, i - 1).isin(*NUMBERED))

    known = [r.g for r in templates.where("exact is not null").select(F.col("gram").alias("g")).distinct().collect()]
    places = F.filter(F.sequence(F.lit(0), F.size(words) - 2), lambda i: gram(i).isin(known))
    grams = F.when(F.size(words) > 1, F.transform(places, lambda i: F.struct(
        i.alias("place"), gram(i).alias("gram"), F.get(words, i).alias("t0"), F.get(words, i + 1).alias("t1"))))
    single = F.filter(F.sequence(F.lit(0), F.size(words) - 1), decides)
    single = F.when(F.size(words) > 1, F.transform(single, lambda i: F.struct(
        i.alias("place"), F.xxhash64(F.get(words, i), F.lit("")).alias("gram"), F.get(words, i).alias("t0"),
        F.lit("").alias("t1"))))
    grams = F.concat(grams, single)
    # An outer explode: for an inner one Spark infers a filter on the array, pushes it below the
    # words, and would split the text anew for every word.
    hits = base.select("doc_id", "t", grams.alias("grams"))
    hits = hits.select("doc_id", "t", F.inline_outer("grams"))
    hits = hits.join(templates, "gram").where("t0 = w0 and t1 = w1")
    votes = hits.groupBy(
        "doc_id", "t", "template", "exact", "label", "n", (F.col("place") - F.col("at")).alias("diagonal")
    ).agg(F.collect_set("at").alias("ats"))
    votes = stage_table(votes, "votes")

    own = ["doc_id", "t", "template", "exact", "label", "n"]
    whole = votes.where(F.col("exact") & (F.size("ats") == F.col("n") - 1)).select(
        "doc_id", "t", "label", F.lit(True).alias("exact"), F.col("diagonal").alias("first"),
        (F.col("diagonal") + F.col("n") - 1).alias("last"), F.lit(1.0).alias("coverage"))
    along = Window.partitionBy(*own).orderBy("diagonal")
    new = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(along) > drift, F.lit(True))
    merged = votes.where(~F.col("exact")).withColumn("new", new.cast("int"))
    merged = merged.withColumn("island", F.sum("new").over(along)).groupBy(*own, "island").agg(
        F.min(F.col("diagonal") + F.array_min("ats")).alias("first"),
        F.max(F.col("diagonal") + F.array_max("ats") + 1).alias("last"),
        F.greatest(F.min("diagonal"), F.lit(0)).alias("from"), (F.max("diagonal") + F.col("n") - 1).alias("to"),
        F.size(F.array_distinct(F.flatten(F.collect_list("ats")))).alias("covered"))
    merged = merged.withColumn("coverage", F.col("covered") / (F.col("n") - 1)).where(F.col("coverage") >= least)
    # Spans meet the deciding words of their text in buckets of places, so that a text of many spans
    # does not pair each of them with each word. Words are looked for where the whole template would
    # stand, as a word put in near its start or end leaves the span short of it.
    spans = merged.withColumn("bucket", F.explode(F.expr(
        f"sequence(`from` div {BUCKET_WORDS}, `to` div {BUCKET_WORDS})")))
    said = votes.where("exact is null").select(
        F.col("doc_id").alias("d_id"), F.col("t").alias("d_t"), F.col("template").alias("word"),
        F.col("diagonal").alias("place"), F.expr(f"cast(diagonal div {BUCKET_WORDS} as bigint)").alias("d_bucket"))
    spans = spans.join(said, (
        spans.doc_id.eqNullSafe(said.d_id) & (spans.t == said.d_t) & (spans.bucket == said.d_bucket)
        & (said.place >= spans["from"]) & (said.place <= spans["to"])), "left")
    spans = spans.groupBy("doc_id", "t", "template", "label", "first", "last", "coverage").agg(
        F.sort_array(F.collect_set("word")).alias("said"))
    wanted = F.lit(None).cast("array<string>")
    if notices:
        wanted = F.create_map(*(
            x for w in notices for x in (F.lit(w), F.array(*map(F.lit, _deciding(w.split()))).cast("array<string>"))))
        wanted = F.element_at(wanted, F.col("template"))
    merged = spans.where(F.col("said") == wanted).select(
        "doc_id", "t", "label", F.lit(False).alias("exact"), "first", "last", "coverage")

    def joined(x: Column) -> Column:
        return F.array_join(F.sort_array(x), ",")

    found = whole.union(merged).groupBy("doc_id", "t").agg(
        F.count(F.when(F.col("exact"), 1)).alias("n_base"),
        F.min(F.when(F.col("exact"), F.col("first"))).cast("long").alias("first_word"),
        F.max(F.when(F.col("exact"), F.col("first"))).cast("long").alias("last_word"),
        joined(F.collect_set(F.when(F.col("exact"), F.col("label")))).alias("base_labels"),
        joined(F.collect_set("label")).alias("labels"),
        F.max("coverage").alias("score"),
        F.sort_array(F.collect_set(F.struct("first", "last", "label", "coverage"))).alias("spans"))
    found = found.withColumnsRenamed({"doc_id": "f_id", "t": "f_t"})
    rows = base.select("doc_id", "t", F.size("words").cast("long").alias("n_words"))
    rows = rows.join(found, rows.doc_id.eqNullSafe(found.f_id) & (rows.t == found.f_t), "left")
    none = F.array().cast(found.schema["spans"].dataType)
    return rows.select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        "first_word", "last_word", F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"), F.coalesce("spans", none).alias("spans"))
