"""Reporting marts: partial and final hash aggregation, one shuffle each.

Each mart can be made from the core fact, or from the revenue cube that all of them are
roll-ups of. Sums are decimal and means are kept as sum and count, so both ways give the same
numbers to the last digit; with the cube, the fact is read once for all marts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.functions.numbers import quotient
from tallyline.operators.core import as_percent
from tallyline.schemas import TOTAL
from tallyline.sources.tables import row_counts

CUBE_KEYS = (
    "txn_month_label", "txn_year", "txn_month", "region", "product_category", "product_name",
)
# Sum of each measure of a cube row, by column name.
CUBE_SUMS = {
    "revenue": TOTAL,
    "cost": TOTAL,
    "gross_profit": "decimal(25,2)",
    "profit_margin": "decimal(32,6)",
    "margin_rows": "bigint",
    "units_sold": "bigint",
    "transactions": "bigint",
}


def _single(core: DataFrame) -> DataFrame:
    """The fact with the counting columns of the cube, which it does not carry itself."""
    if "transactions" in core.columns:
        return core
    return core.withColumns({
        "transactions": F.lit(1).cast("bigint"),
        "margin_rows": F.col("profit_margin").isNotNull().cast("bigint"),
    })


def revenue_cube(core: DataFrame, keys: Sequence[str] = CUBE_KEYS) -> DataFrame:
    return _single(core).groupBy(*keys).agg(
        *(F.sum(c).cast(t).alias(c) for c, t in CUBE_SUMS.items())
    )


def _measures(*names: str) -> list[Column]:
    measures = {
        "total_revenue": F.sum("revenue").cast(TOTAL),
        "total_cost": F.sum("cost").cast(TOTAL),
        "total_gross_profit": F.sum("gross_profit").cast("decimal(25,2)"),
        "avg_profit_margin": quotient(F.sum("profit_margin"), F.sum("margin_rows"), 6),
        "transaction_count": F.sum("transactions"),
        "units_sold": F.sum(F.col("units_sold").cast("bigint")),
    }
    return [measures[n].alias(n) for n in names]


def monthly_revenue(source: DataFrame) -> DataFrame:
    """From the fact or the cube, like the other marts."""
    return (
        _single(source)
        .withColumnRenamed("txn_month_label", "month_label")
        .groupBy("month_label", "txn_year", "txn_month")
        .agg(*_measures(
            "total_revenue", "total_cost", "total_gross_profit", "avg_profit_margin",
            "transaction_count", "units_sold",
        ))
    )


def regional_summary(source: DataFrame) -> DataFrame:
    return _single(source).groupBy("region", "txn_year").agg(*_measures(
        "total_revenue", "total_cost", "total_gross_profit", "avg_profit_margin",
        "transaction_count",
    ))


def product_summary(source: DataFrame) -> DataFrame:
    """Keyed by category as well: one product name may appear in several categories."""
    return _single(source).groupBy("product_category", "product_name", "txn_year").agg(*_measures(
        "total_revenue", "total_gross_profit", "avg_profit_margin", "units_sold",
        "transaction_count",
    ))


def all_marts(source: DataFrame) -> dict[str, DataFrame]:
    return {
        "rpt_monthly_revenue": monthly_revenue(source),
        "rpt_regional_summary": regional_summary(source),
        "rpt_product_summary": product_summary(source),
    }


def reporting_row_counts(marts: dict[str, DataFrame]) -> DataFrame:
    return row_counts(marts).select("table_name", "row_count")


def top_months(monthly: DataFrame, n: int = 5) -> DataFrame:
    """The best months by revenue in whole money units; equal months by label."""
    return (
        monthly.orderBy(F.desc("total_revenue"), "month_label")
        .limit(n)
        .select(
            "month_label",
            F.round("total_revenue").cast("decimal(22,0)").alias("revenue"),
            F.round("total_gross_profit").cast("decimal(22,0)").alias("gross_profit"),
            "transaction_count",
        )
    )


def regional_overview(regional: DataFrame) -> DataFrame:
    return regional.orderBy("txn_year", F.desc("total_revenue"), "region").select(
        "region",
        "txn_year",
        F.round("total_revenue").cast("decimal(22,0)").alias("revenue"),
        as_percent(F.col("avg_profit_margin"), 1).alias("margin_pct"),
    )
