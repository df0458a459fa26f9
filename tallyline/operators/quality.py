"""Data-quality reports. Each is one scan with many conditional counts, unpivoted last."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline.functions.numbers import percent
from tallyline.functions.text import strip
from tallyline.operators.ingest import (
    REPAIRS,
    STANDARDISED,
    is_accepted,
    reject_tests,
    standard_spelling,
)
from tallyline.schemas import SALES_CHECKS, ColumnCheck
from tallyline.settings import Domains


def unpivot(row: DataFrame, key: str, value: str, names: Sequence[str]) -> DataFrame:
    """Columns of a one-row frame to ``(key, value)`` rows."""
    return row.unpivot([], list(names), key, value)


def duplicate_ids(df: DataFrame, key: str = "transaction_id") -> DataFrame:
    """Rows beyond the first of each key; every row without a key counts."""
    return df.agg(
        F.count("*").alias("total_rows"),
        (F.count("*") - F.countDistinct(key)).alias("duplicate_rows"),
    )


def _checks() -> dict[str, Column]:
    tid = F.col("transaction_id")
    return {
        "NULL_TRANSACTION_ID": F.count_if(tid.isNull() | (strip(tid) == "")),
        "NULL_RECORD_DATE": F.count_if(F.col("record_date").isNull()),
        "NULL_REVENUE": F.count_if(F.col("revenue").isNull()),
        "NEGATIVE_REVENUE": F.count_if(F.col("revenue") < 0),
        "NEGATIVE_COST": F.count_if(F.col("cost") < 0),
        "INVALID_DISCOUNT": F.count_if(
            (F.col("discount_pct") < 0) | (F.col("discount_pct") > 100)
        ),
        "ZERO_UNITS": F.count_if(F.col("units_sold") <= 0),
        "DUPLICATE_TXN_IDS": F.count("*") - F.countDistinct("transaction_id"),
    }


def check_report(df: DataFrame) -> DataFrame:
    """``(check_name, affected_rows)`` for the eight staging checks."""
    checks = _checks()
    row = df.agg(*(c.alias(n) for n, c in checks.items()))
    return unpivot(row, "check_name", "affected_rows", list(checks))


def domain_check(df: DataFrame, domains: Domains = Domains()) -> DataFrame:
    """Rows per categorical column whose value is outside its domain."""
    sets = {
        "region": domains.regions,
        "channel": domains.channels,
        "customer_segment": domains.segments,
        "product_category": domains.categories,
    }
    row = df.agg(*(F.count_if(~F.col(c).isin(*v)).alias(c) for c, v in sets.items()))
    return unpivot(row, "column_name", "out_of_domain_rows", list(sets))


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, with their row count."""
    return df.groupBy(*keys).agg(F.count("*").alias("row_count")).filter("row_count > 1")


def key_report(tables: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """``(table_name, repeated_keys, extra_rows)``: all zero when every key is unique."""
    out = None
    for name, (df, keys) in tables.items():
        one = repeated_keys(df, keys).agg(
            F.count("*").alias("repeated_keys"),
            F.coalesce(F.sum(F.col("row_count") - 1), F.lit(0)).alias("extra_rows"),
        ).select(F.lit(name).alias("table_name"), "repeated_keys", "extra_rows")
        out = one if out is None else out.unionByName(one)
    return out


def constraint_violations(
    df: DataFrame, checks: Iterable[ColumnCheck] = SALES_CHECKS
) -> DataFrame:
    """``(constraint_name, violations)`` of NOT NULL, text length and numeric range."""
    counts: dict[str, Column] = {}
    for check in checks:
        if check.name not in df.columns:
            continue
        c = F.col(check.name)
        if not check.nullable:
            counts[f"{check.name}:not_null"] = F.count_if(c.isNull())
        if check.max_len is not None:
            counts[f"{check.name}:max_len_{check.max_len}"] = F.count_if(
                F.length(c) > check.max_len
            )
        if check.digits is not None:
            limit = F.lit(10 ** check.digits).cast(T.DecimalType(20, 0))
            counts[f"{check.name}:digits_{check.digits}"] = F.count_if(F.abs(c) >= limit)
    row = df.agg(*(v.alias(k) for k, v in counts.items()))
    return unpivot(row, "constraint_name", "violations", [f"`{k}`" for k in counts])


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    row = df.agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in columns))
    return unpivot(row, "column_name", "null_count", columns)


def completeness(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Share of rows with a value, in percent, per column."""
    row = df.agg(*(percent(F.count(c), F.count(F.lit(1)), 4).alias(c) for c in columns))
    return unpivot(row, "column_name", "completeness_pct", columns)


def validation_results(parsed: DataFrame, domains: Domains = Domains()) -> DataFrame:
    """``(check_name, rows_affected, action_taken, result)``: what the load does to its rows.

    One line per reject reason and one per repaired or re-spelt column, taken from the load's own
    rules, so a rule added there shows here. Repairs count on accepted rows, where the value that
    the rule gives differs (rounding aside). A column is ``UNKNOWN VALUES`` when some of its
    values have no canonical spelling. A CLEAN line concerns no row.
    """
    good = is_accepted(parsed)
    lines: dict[str, tuple[Column, str, Column]] = {}

    def add(name: str, rows: Column, action: str, result: Column) -> None:
        lines[name] = (F.count_if(rows), action, result)

    for reason, test in reject_tests(parsed).items():
        add(f"reject {reason}", test, "row rejected", F.lit("REJECTED"))
    for column, fix in REPAIRS.items():
        c = F.col(column)
        add(f"repair {column}", good & ~fix(c).eqNullSafe(c), "value replaced", F.lit("REPAIRED"))
    unknown = {}
    for column, (listed, _) in STANDARDISED.items():
        spelt, c = standard_spelling(column, domains), F.col(column)
        left = F.col(f"unknown {column}") > 0
        unknown[f"unknown {column}"] = F.count_if(good & ~spelt.isin(*getattr(domains, listed)))
        add(f"repair {column}", good & ~spelt.eqNullSafe(c), "spelling replaced",
            F.when(left, "UNKNOWN VALUES").otherwise("REPAIRED"))
    row = parsed.agg(
        *(rows.alias(name) for name, (rows, _, _) in lines.items()),
        *(rows.alias(name) for name, rows in unknown.items()))
    return row.select(F.inline(F.array(*(
        F.struct(
            F.lit(name).alias("check_name"), F.col(name).alias("rows_affected"),
            F.lit(action).alias("action_taken"),
            F.when(F.col(name) == 0, "CLEAN").otherwise(result).alias("result"))
        for name, (_, action, result) in lines.items()))))


def quality_score(counts: DataFrame, threshold: float = 98.0) -> DataFrame:
    """Loaded share of the rows read, from ``ingest.ingest_counts``."""
    loaded, bad = F.col("rows_loaded"), F.col("rows_rejected")
    return counts.select(
        "rows_loaded",
        "rows_rejected",
        percent(loaded, loaded + bad, 4).alias("quality_score_pct"),
    ).withColumn("meets_threshold", F.col("quality_score_pct") >= threshold)


def issue_totals(parsed: DataFrame, key: str = "transaction_id") -> DataFrame:
    """Rows rejected, values repaired on accepted rows, and duplicates among those."""
    good = is_accepted(parsed)
    discount, units = F.col("discount_pct"), F.col("units_sold")
    clean_id = F.when(good, strip(F.col(key)))
    return parsed.agg(
        F.count_if(~good).alias("rows_rejected"),
        F.count_if(good & ((discount < 0) | (discount > 100) | discount.isNull())).alias(
            "discounts_fixed"
        ),
        F.count_if(good & (units.isNull() | (units < 1))).alias("units_fixed"),
        F.count_if(good & F.col("cost").isNull()).alias("costs_fixed"),
        (F.count(clean_id) - F.countDistinct(clean_id)).alias("duplicates_removed"),
    ).withColumn(
        "issues_auto_fixed", F.col("discounts_fixed") + F.col("units_fixed") + F.col("costs_fixed")
    )
