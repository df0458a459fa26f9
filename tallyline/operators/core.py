"""The enriched core fact: one projection over staging, no shuffle.

Casts to a decimal type round half away from zero, so they are all the rounding there is.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.functions.calendar import month_label
from tallyline.functions.numbers import mean, quotient, zero_if_null
from tallyline.functions.text import strip
from tallyline.schemas import CORE_SALES, MARGIN, MONEY

DIMENSIONS = (
    "product_name", "product_category", "region", "sales_rep", "customer_id",
    "customer_segment", "channel",
)


def date_parts(d: Column) -> dict[str, Column]:
    return {
        "txn_date": d,
        "txn_year": F.year(d),
        "txn_quarter": F.quarter(d),
        "txn_month": F.month(d),
        "txn_month_label": month_label(d),
    }


def gross_profit(revenue: Column, cost: Column) -> Column:
    return (revenue - cost).cast("decimal(15,2)")


def profit_margin(revenue: Column, cost: Column) -> Column:
    """Profit over revenue to six places, 0 without revenue. Wide, as it is unbounded:
    a cost of 500 on a revenue of 1 is a margin of -499."""
    exact = (revenue - cost) / F.nullif(revenue, F.lit(Decimal(0)))
    return zero_if_null(exact).cast(MARGIN)


def as_percent(margin: Column, places: int = 2) -> Column:
    """A six-place margin as a percentage."""
    return (margin * 100).cast(f"decimal(24,{places})")


def discount_amount(price: Column, units: Column, discount_pct: Column) -> Column:
    """``price * units * discount%`` in exact decimals."""
    gross = price * units.cast("decimal(10,0)")
    return (gross * discount_pct * F.lit("0.01").cast("decimal(2,2)")).cast("decimal(24,2)")


def is_profitable(revenue: Column, cost: Column) -> Column:
    return F.when(revenue - cost > 0, 1).otherwise(0)


def enrich(staged: DataFrame) -> DataFrame:
    """Staging rows with an id, a date and a revenue, enriched.

    A frame that carries only some of the staging columns gets the derived columns those
    allow, so that a query need not read what it does not use.
    """
    have = set(staged.columns)
    revenue, cost = F.col("revenue"), F.col("cost")
    out: dict[str, Column] = {"transaction_id": F.col("transaction_id")}
    out |= date_parts(F.col("record_date"))
    out |= {c: strip(F.col(c)) for c in DIMENSIONS if c in have}
    out |= {c: F.col(c) for c in ("units_sold", "unit_price") if c in have}
    out["revenue"] = revenue.cast(MONEY)
    if "cost" in have:
        out["cost"] = cost.cast(MONEY)
        out["gross_profit"] = gross_profit(revenue, cost)
        out["profit_margin"] = profit_margin(revenue, cost)
        out["is_profitable"] = is_profitable(revenue, cost)
    if "discount_pct" in have:
        out["discount_pct"] = F.col("discount_pct")
        if {"unit_price", "units_sold"} <= have:
            out["discount_amount"] = discount_amount(
                F.col("unit_price"), F.col("units_sold"), F.col("discount_pct")
            )
    ordered = [f.name for f in CORE_SALES.fields if f.name in out]
    return staged.filter(
        F.col("transaction_id").isNotNull()
        & F.col("record_date").isNotNull()
        & F.col("revenue").isNotNull()
    ).select(*(out[c].alias(c) for c in ordered))


def core_summary(core: DataFrame) -> DataFrame:
    """One row about the core fact.

    Grouping by the counted columns first keeps the exact distinct counts off the fact,
    where Spark would expand every row once per counted column.
    """
    parts = core.groupBy("txn_year", "region", "product_category", "sales_rep").agg(
        F.count("*").alias("n"),
        F.sum("revenue").alias("revenue"),
        F.sum("gross_profit").alias("profit"),
        F.sum("profit_margin").alias("margin"),
        F.count_if(F.col("is_profitable") == 0).alias("unprofitable"),
    )
    return parts.agg(
        F.lit("CORE_SUMMARY").alias("layer"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
        F.countDistinct("txn_year").alias("years_loaded"),
        F.countDistinct("region").alias("regions"),
        F.countDistinct("product_category").alias("categories"),
        F.countDistinct("sales_rep").alias("sales_reps"),
        F.sum("revenue").cast("decimal(24,2)").alias("total_revenue"),
        F.sum("profit").cast("decimal(25,2)").alias("total_gross_profit"),
        as_percent(quotient(F.sum("margin"), F.sum("n"), 6)).alias("avg_profit_margin_pct"),
        F.coalesce(F.sum("unprofitable"), F.lit(0)).alias("unprofitable_txns"),
    )


def core_by_year(core: DataFrame) -> DataFrame:
    return (
        core.groupBy("txn_year")
        .agg(
            F.count("*").alias("transactions"),
            F.sum("revenue").alias("total_revenue"),
            F.sum("gross_profit").alias("total_gross_profit"),
            as_percent(mean(F.col("profit_margin"), 6)).alias("avg_margin_pct"),
        )
        .orderBy("txn_year")
    )


def annual_core(core: DataFrame) -> DataFrame:
    return core.groupBy("txn_year").agg(
        F.sum("revenue").alias("revenue"),
        F.sum("gross_profit").alias("profit"),
        F.count("*").alias("transactions"),
    )
