"""Line-first cleaning: rules per line, removal of failed lines, then a verdict per document.

Everything is expressions over one row (arrays of lines and words), without a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = r"[^#*$%&|<>]+"
# Fixed phrases of page furniture, matched in lower case.
BOILERPLATE = (
    "all rights reserved", "terms of use", "terms of service", "privacy policy", "cookie policy",
    "use of cookies", "accept cookies", "enable javascript", "lorem ipsum", "sign up for",
    "subscribe to our", "follow us on", "click here", "read more", "powered by", "back to top",
    "licensed under", "released under the", "skip to content",
)
# Also danda and double danda, Arabic question mark, Urdu, Ethiopic and Myanmar full stops.
SENTENCE_END = r"[.!?…。！？:;\u0964\u0965\u061F\u06D4\u1362\u104B][\"'”’»)\]]*(?:\s|$)"
MARKS = r"[^!-/:-@\[-`{-~]+"
SEPARATORS = r"(?:^|\s)[|>»·•/–-](?=\s|$)"
# How a line begins that carries on the one above: in lower case, or, below a full line, with any
# letter or digit (a noun or a name).
GOES_ON = r"^[ \t]*[\"'“„‘«(\[]*\p{Ll}"
GOES_ON_BELOW_FULL = r"^[ \t]*[\"'“„‘«(\[]*[\p{L}\p{N}]"
FULL_LINE = 55


def _wraps(line: Column, below: Column) -> Column:
    """Whether the sentence of ``line`` goes on in the line ``below``, as in hard-wrapped prose."""
    full = F.length(line) >= FULL_LINE
    return F.coalesce(below.rlike(GOES_ON) | (full & below.rlike(GOES_ON_BELOW_FULL)), F.lit(False))


def line_failure(line: Column, below: Column | None = None) -> Column:
    """Name of the rule that a line with words fails; NULL for a good line.

    Navigation: three or more stand-alone separators, at least one per four words. Punctuation:
    more marks than words, or five or more words without the end of a sentence, unless the line
    directly ``below`` carries the sentence on. Boilerplate: a phrase of page furniture in a line of
    at most 30 words.
    """
    words = F.regexp_count(line, F.lit(WORD))
    separators = F.regexp_count(line, F.lit(SEPARATORS))
    marks = F.length(F.regexp_replace(line, MARKS, ""))
    phrase = F.lower(line).rlike("|".join(BOILERPLATE))
    open_end = (words >= 5) & ~line.rlike(SENTENCE_END)
    if below is not None:
        open_end = open_end & ~_wraps(line, below)
    return (
        F.when((separators >= 3) & (separators * 4 >= words), "navigation")
        .when(marks > words, "punctuation")
        .when(open_end, "punctuation")
        .when((words <= 30) & phrase, "boilerplate")
    )


def _windows(words: Column) -> Column:
    """Hashes of all 3-word windows in their order."""
    return F.when(F.size(words) >= 3, F.transform(
        F.sequence(F.lit(0), F.size(words) - 3),
        lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)),
    )).otherwise(F.array().cast("array<bigint>"))


def _covered(places: Column) -> Column:
    """Words covered by windows of three at the given ascending places."""
    gaps = F.transform(
        places, lambda p, i: F.least(F.coalesce(F.get(places, i + 1) - p, F.lit(3)), F.lit(3)))
    return F.aggregate(gaps, F.lit(0).cast("long"), lambda s, g: s + g)


def _repeated_places(hashes: Column) -> Column:
    """Ascending places of the windows that occur twice or more.

    Windows are sorted by hash and place, so equal windows are neighbours. Hash and place share
    a long (40 + 24 bits), which sorts as a primitive; where two different windows agree in the
    40 bits, or a text is too long for 24, the wider keys are sorted instead.
    """
    mask = ~0xFFFFFF
    packed = F.sort_array(F.transform(hashes, lambda h, i: h.bitwiseAND(F.lit(mask)) + i))

    def full(e: Column) -> Column:
        return F.get(hashes, e.bitwiseAND(F.lit(0xFFFFFF)).cast("int"))

    def with_sorted(e: Column) -> Column:
        def repeated(x: Column, i: Column) -> Column:
            own = full(x)
            return F.coalesce((i > 0) & (full(F.get(e, i - 1)) == own), F.lit(False)) | F.coalesce(
                full(F.get(e, i + 1)) == own, F.lit(False))

        places = F.transform(
            F.filter(e, repeated), lambda x: x.bitwiseAND(F.lit(0xFFFFFF)).cast("long"))
        return F.sort_array(places)

    def clash(e: Column) -> Column:
        def differs(x: Column, i: Column) -> Column:
            prior = F.get(e, i - 1)
            return (i > 0) & (prior.bitwiseAND(F.lit(mask)) == x.bitwiseAND(F.lit(mask))) & (full(prior) != full(x))

        return F.size(F.filter(e, differs)) > 0

    wide = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.cast("long").alias("i"))))

    def wide_places(e: Column) -> Column:
        def repeated(x: Column, i: Column) -> Column:
            return F.coalesce((i > 0) & (F.get(e, i - 1)["h"] == x["h"]), F.lit(False)) | F.coalesce(
                F.get(e, i + 1)["h"] == x["h"], F.lit(False))

        return F.sort_array(F.transform(F.filter(e, repeated), lambda x: x["i"]))

    # One-element arrays bind the sorted keys to a name, so that they are computed once.
    narrow = F.transform(F.array(packed), lambda e: F.when(~clash(e), with_sorted(e)))[0]
    fits = F.size(hashes) < (1 << 24)
    return F.coalesce(
        F.when(fits, narrow), F.transform(F.array(wide), wide_places)[0])


def clean_documents(
    docs: DataFrame, *, least_kept: float = 0.5, least_words: int = 50, most_repeated: int = 50,
    doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """One row per document: ``doc_id``, counts, ``base_failed``, ``kept`` and ``clean_text``.

    Counts are taken on the whole text: ``n_words`` (runs of other than ASCII white space),
    ``word_chars`` (code points in words), ``n_symbols`` (characters ``#*$%&|<>``), ``n_dup_lines``
    (lines with a word that equal an earlier line), ``n_repeat_words`` (words in 3-word windows
    that occur twice or more). ``base_failed``: fewer than ``least_words`` words, or more than
    ``most_repeated`` % of them repeated.

    Then each line is judged by ``line_failure``, with the line below it, and failed lines are removed,
    which gives ``clean_text``. A document is kept when it has not failed and its good lines hold at least
    ``least_kept`` of its word characters.

    A NULL or empty text has no words: counts 0, ``base_failed``, not kept, empty clean text.
    Repeated rows and NULL ids come back as they are; other columns are ignored.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    base = docs.select(F.col(doc_id).alias("doc_id"), body.alias("text"))
    base = base.select(
        "doc_id", "text", F.array_remove(F.split("text", SPACE), "").alias("words"),
        F.split("text", "\n").alias("lines"))
    words, lines = F.col("words"), F.col("lines")
    # Lines without words are NULL here and leave; they still part what is above from what is below.
    judged = F.filter(F.transform(lines, lambda x, i: F.when(x.rlike(WORD), F.struct(
        x.alias("line"), line_failure(x, F.get(lines, i + 1)).alias("failed")))), lambda x: x.isNotNull())
    base = base.select(
        "doc_id", "words", judged.alias("judged"), _windows(words).alias("windows"),
        F.length(F.regexp_replace("text", SYMBOLS, "")).cast("long").alias("n_symbols"))
    good = F.transform(
        F.filter("judged", lambda x: x["failed"].isNull()), lambda x: x["line"])
    own = F.transform("judged", lambda x: x["line"])
    windows = F.col("windows")
    repeated = F.when(
        F.size(F.array_distinct(windows)) < F.size(windows),
        F.transform(F.array(_repeated_places(windows)), _covered)[0],
    ).otherwise(F.lit(0))
    base = base.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        "n_symbols",
        (F.size(own) - F.size(F.array_distinct(own))).cast("long").alias("n_dup_lines"),
        repeated.cast("long").alias("n_repeat_words"),
        F.array_join(good, "\n").alias("clean_text"),
        (F.size("judged") - F.size(good)).cast("long").alias("n_lines_removed"),
    )
    failed = (F.col("n_words") < least_words) | (
        100 * F.col("n_repeat_words") > most_repeated * F.col("n_words"))
    good_chars = F.length(F.regexp_replace("clean_text", SPACE, ""))
    kept = ~F.col("base_failed") & (good_chars >= least_kept * F.col("word_chars"))
    return base.withColumn("base_failed", failed).withColumn("kept", kept)
