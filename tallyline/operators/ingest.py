"""Ingest: raw text rows to validated, repaired, typed staging rows.

Everything is one projection and one predicate over the raw frame. A row is rejected for at
least one listed reason or accepted, so ``accepted + rejected = read`` always holds.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.functions.numbers import to_number
from tallyline.functions.text import canonical, strip, title_case
from tallyline.schemas import (
    MALFORMED,
    MONEY,
    NUMERIC_COLUMNS,
    PERCENT,
    PRICE,
    STAGED_SALES,
    TEXT_COLUMNS,
)
from tallyline.settings import Domains


def _present(df: DataFrame, names) -> list[str]:
    return [c for c in names if c in df.columns]


def coerce_numbers(raw: DataFrame) -> DataFrame:
    """Numeric text columns to numbers, NULL when not a number."""
    return raw.withColumns({c: to_number(F.col(c)) for c in _present(raw, NUMERIC_COLUMNS)})


def parse_dates(raw: DataFrame, formats: Sequence[str] = ()) -> DataFrame:
    """Add ``record_date``; the text ``date`` stays, to tell absent from unreadable.

    ISO dates are read first, then each of ``formats`` in order. Day-first and month-first
    forms cannot be told apart, so which one a source uses has to be said.
    """
    text = strip(F.col("date"))
    forms = (F.try_to_date(text, form) for form in formats)
    return raw.withColumn("record_date", F.coalesce(text.try_cast("date"), *forms))


# Staged type of each amount, rounded to its places. Repairs bound the discount.
STAGED_TYPES = {
    name: STAGED_SALES[name].dataType for name in ("units_sold", "unit_price", "revenue", "cost")
}


def _unfit(name: str) -> Column:
    """The amount is there, but its staged column cannot hold it (once rounded)."""
    c = F.col(name)
    return c.isNotNull() & c.try_cast(STAGED_TYPES[name]).isNull()


def reject_tests(parsed: DataFrame) -> dict[str, Column]:
    """Why a row cannot be loaded, by reason. Together they are never NULL: a test that
    compares a missing value comes with the test that the value is there."""
    tid, revenue = F.col("transaction_id"), F.col("revenue")
    tests = {} if MALFORMED not in parsed.columns else {
        "MALFORMED_ROW": F.col(MALFORMED).isNotNull()}
    tests |= {
        "NULL_TRANSACTION_ID": tid.isNull(),
        "BLANK_TRANSACTION_ID": strip(tid) == "",
        "NULL_DATE": F.col("date").isNull(),
        "INVALID_DATE": F.col("date").isNotNull() & F.col("record_date").isNull(),
        "NULL_REVENUE": revenue.isNull(),
        "NEGATIVE_REVENUE": revenue < 0,
    }
    for name in _present(parsed, ("units_sold", "unit_price", "revenue", "cost")):
        tests[f"OUT_OF_RANGE_{name.upper()}"] = _unfit(name)
    return tests


def is_accepted(parsed: DataFrame) -> Column:
    """No reject test holds. A filter evaluates a parsed column anew for each mention, so
    this says it in as few as possible; a comparison with a missing value rejects."""
    tests = [
        strip(F.col("transaction_id")) != "",
        F.col("record_date").isNotNull(),
        (F.col("revenue") >= 0) & ~_unfit("revenue"),
    ]
    for name in _present(parsed, ("units_sold", "unit_price", "cost")):
        tests.append(~_unfit(name))
    if MALFORMED in parsed.columns:
        tests.append(F.col(MALFORMED).isNull())
    return F.coalesce(reduce(and_, tests), F.lit(False))


def parse(raw: DataFrame, date_formats: Sequence[str] = ()) -> DataFrame:
    """Numbers and dates read; the input of everything below."""
    return parse_dates(coerce_numbers(raw), date_formats)


def evaluated_once(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """The same rows, with the named columns read from one struct of each row.

    Spark would move a filter below the projection that makes its columns, and evaluate them for
    every mention in the filter and again in the projection. It moves none below a generator, which
    hands out each row's values once.
    """
    others = [c for c in df.columns if c not in names]
    return df.select(*others, F.inline(F.array(F.struct(*names)))).select(*df.columns)


def accepted(parsed: DataFrame) -> DataFrame:
    names = _present(parsed, ("record_date", "units_sold", "unit_price", "revenue", "cost"))
    return evaluated_once(parsed, names).filter(is_accepted(parsed))


def rejected(parsed: DataFrame) -> DataFrame:
    """Rejected rows with the list of their ``reject_reasons``."""
    tests = reject_tests(parsed)
    reasons = F.array_compact(F.array(*(F.when(test, name) for name, test in tests.items())))
    return parsed.filter(~is_accepted(parsed)).withColumn("reject_reasons", reasons)


def fixed_discount(c: Column) -> Column:
    """Clamp to 0..100, NULL to 0."""
    zero, hundred = F.lit(0), F.lit(100)
    return F.coalesce(F.least(F.greatest(c, zero), hundred), zero)


def fixed_units(c: Column) -> Column:
    """NULL or less than one becomes one; the rest is truncated to a whole number."""
    return F.greatest(F.coalesce(c, F.lit(1)), F.lit(1)).cast("int")


def fixed_cost(c: Column) -> Column:
    """NULL to 0. A negative cost is kept, and reported by the quality checks."""
    return F.coalesce(c, F.lit(0))


# Repairs of values that do not justify a reject, by column.
REPAIRS = {"discount_pct": fixed_discount, "units_sold": fixed_units, "cost": fixed_cost}


def repair(df: DataFrame) -> DataFrame:
    """Mend what does not justify a reject, and round money to two places."""
    places = {"discount_pct": PERCENT, "cost": MONEY, "unit_price": PRICE, "revenue": MONEY}

    def fixed(name: str):
        def fix(c: Column) -> Column:
            mended = REPAIRS[name](c) if name in REPAIRS else c
            return mended.cast(places[name]) if name in places else mended

        return fix

    fixes = {name: fixed(name) for name in (*REPAIRS, "unit_price", "revenue")}
    return df.withColumns({n: fixes[n](F.col(n)) for n in _present(df, fixes)})


def strip_text(df: DataFrame) -> DataFrame:
    """Trim the text columns; NULL stays NULL."""
    return df.withColumns({c: strip(F.col(c)) for c in _present(df, TEXT_COLUMNS)})


# Columns with canonical spellings: where they are listed, and whether others are title-cased.
STANDARDISED = {
    "region": ("regions", True), "channel": ("channels", True),
    "customer_segment": ("segments", False),
}


def standard_spelling(name: str, domains: Domains) -> Column:
    listed, recase = STANDARDISED[name]
    unknown = title_case(strip(F.col(name))) if recase else None
    return canonical(F.col(name), getattr(domains, listed), unknown)


def standardise(df: DataFrame, domains: Domains = Domains()) -> DataFrame:
    """Canonical region, channel and segment; an unknown region or channel is title-cased,
    an unknown segment only trimmed."""
    return df.withColumns({n: standard_spelling(n, domains) for n in _present(df, STANDARDISED)})


def add_lineage(
    df: DataFrame, source_system: str = "CSV_LOAD", loaded_at: dt.datetime | None = None
) -> DataFrame:
    """Source and load time: one value per load. A ``loaded_at`` of the file is kept."""
    stamped = df.withColumn("source_system", F.lit(source_system))
    if "loaded_at" in df.columns:
        return stamped
    stamp = F.current_timestamp() if loaded_at is None else F.lit(loaded_at)
    return stamped.withColumn("loaded_at", stamp)


def to_staging(
    parsed: DataFrame,
    domains: Domains = Domains(),
    source_system: str = "CSV_LOAD",
    loaded_at: dt.datetime | None = None,
) -> DataFrame:
    """Accepted rows, repaired and standardised, in staging form."""
    good = accepted(parsed).drop("date", MALFORMED)
    clean = standardise(strip_text(repair(good)), domains)
    return add_lineage(clean, source_system, loaded_at)


def both_kinds(
    parsed: DataFrame, domains: Domains = Domains(), source_system: str = "CSV_LOAD",
    loaded_at: dt.datetime | None = None,
) -> DataFrame:
    """Accepted and rejected rows of one parse, told apart by ``is_rejected``.

    An accepted row has its staging columns, a rejected one the struct ``rejected`` of the parsed
    columns and ``reject_reasons``; the other kind's columns are NULL. Values of rejected rows
    do not reach the casts, which they could break.
    """
    tests = reject_tests(parsed)
    reasons = F.array_compact(F.array(*(F.when(test, name) for name, test in tests.items())))
    told = parsed.withColumn("is_rejected", ~is_accepted(parsed))
    bad = F.struct(*parsed.columns, reasons.alias("reject_reasons"))
    ok = ~F.col("is_rejected")
    names = [c for c in parsed.columns if c not in ("date", MALFORMED)]
    cut = told.select(
        *(F.when(ok, F.col(c)).alias(c) for c in names),
        F.when(F.col("is_rejected"), bad).alias("rejected"), "is_rejected")
    clean = standardise(strip_text(repair(cut)), domains)
    return add_lineage(clean, source_system, loaded_at)


def ingest_counts(parsed: DataFrame) -> DataFrame:
    """Rows read, loaded and rejected in one pass. ``rows_rejected_strict`` leaves out rows
    whose date is present but unreadable, which the old loader dropped without counting."""
    tests = reject_tests(parsed)
    bad = ~is_accepted(parsed)
    other = reduce(or_, (t for name, t in tests.items() if name != "INVALID_DATE"))
    only_date = tests["INVALID_DATE"] & ~other
    return parsed.agg(
        F.count("*").alias("rows_read"),
        F.count_if(~bad).alias("rows_loaded"),
        F.count_if(bad).alias("rows_rejected"),
        F.count_if(bad & ~only_date).alias("rows_rejected_strict"),
        F.count_if(only_date).alias("rows_invalid_date"),
    ).withColumn("success", F.col("rows_loaded") > 0)
