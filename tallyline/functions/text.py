"""Text clean-up as native column expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The field texts that a raw file uses for "no value".
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
WHITESPACE = " \t\n\r\f\v"


def strip(c: Column) -> Column:
    """Trim every kind of blank; Spark's own ``trim`` removes spaces only."""
    return F.btrim(c, F.lit(WHITESPACE))


def na_to_null(c: Column) -> Column:
    return F.when(~c.isin(*NA_TOKENS), c)


def title_case(c: Column) -> Column:
    """Capital after every non-letter ("north-east" → "North-East"), as raw files expect.

    ``initcap`` alone starts a word only after a blank, so it is applied per run of letters.
    """
    runs = F.regexp_extract_all(c, F.lit(r"(\p{L}+|\P{L}+)"), F.lit(1))
    return F.array_join(F.transform(runs, F.initcap), "")


def canonical(c: Column, values: Iterable[str], unknown: Column | None = None) -> Column:
    """The canonical spelling of a value in any case or padding, else ``unknown``
    (default: the value itself, trimmed)."""
    spellings = F.create_map(*(F.lit(t) for v in values for t in (v.lower(), v)))
    known = F.try_element_at(spellings, F.lower(strip(c)))
    return F.coalesce(known, strip(c) if unknown is None else unknown)
