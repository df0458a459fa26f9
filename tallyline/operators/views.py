"""Analytical views over the marts and the core fact.

Prior-year values come from a one-row RANGE frame over the mart ("the row whose year is
exactly one less"), which equals a left self-join on ``year - 1`` and reads the mart once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyline.functions.calendar import month_label
from tallyline.functions.numbers import growth_pct, mean, percent, quotient, zero_if_null
from tallyline.functions.ranking import rank_descending, with_group_total
from tallyline.operators.core import as_percent
from tallyline.schemas import TOTAL
from tallyline.sources.tables import stage_table


def prior_year(value: str, *keys: str, year: str = "txn_year") -> Column:
    """The value of the same keys one calendar year earlier, NULL when there is none."""
    w = Window.partitionBy(*keys).orderBy(year).rangeBetween(-1, -1)
    return F.max(value).over(w)


def previous_month(value: str) -> Column:
    """The value of the last month that has rows, which may lie several months back."""
    return F.lag(value).over(Window.orderBy("txn_year", "txn_month"))


def year_to_date(value: str) -> Column:
    w = Window.partitionBy("txn_year").orderBy("txn_month")
    return F.sum(value).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))


def share_pct(value: str, *keys: str, places: int = 2) -> Column:
    """Share in the total of ``keys`` (of everything without keys), in percent."""
    return percent(F.col(value), F.sum(value).over(Window.partitionBy(*keys)), places)


def revenue_trends(monthly: DataFrame) -> DataFrame:
    with_prior = monthly.withColumns({
        "_previous": previous_month("total_revenue"),
        "_prior_year": prior_year("total_revenue", "txn_month"),
        "_ytd": year_to_date("total_revenue"),
    })
    revenue = F.col("total_revenue")
    return with_prior.select(
        "month_label",
        "txn_year",
        "txn_month",
        "total_revenue",
        "total_cost",
        "total_gross_profit",
        as_percent(F.col("avg_profit_margin")).alias("profit_margin_pct"),
        "transaction_count",
        "units_sold",
        growth_pct(revenue, F.col("_previous")).alias("mom_growth_pct"),
        growth_pct(revenue, F.col("_prior_year")).alias("yoy_growth_pct"),
        F.col("_ytd").cast("decimal(28,2)").alias("ytd_revenue"),
    )


def trends_preview(trends: DataFrame, n: int = 12) -> DataFrame:
    return trends.orderBy("txn_year", "txn_month").limit(n)


def rep_revenue(core: DataFrame) -> DataFrame:
    return core.groupBy("region", "txn_year", "sales_rep").agg(
        F.sum("revenue").cast(TOTAL).alias("rep_revenue")
    )


def rep_leaderboard(core: DataFrame) -> DataFrame:
    """All reps ranked within their region and year."""
    return rank_descending(rep_revenue(core), ["region", "txn_year"], "rep_revenue", "rep_rank")


def top_reps(core: DataFrame) -> DataFrame:
    """The best rep of each region and year, all of them when tied. The filter on the rank
    becomes a group limit before the shuffle, so a region never lands whole in one task."""
    w = Window.partitionBy("region", "txn_year").orderBy(F.desc("rep_revenue"))
    ranked = rep_revenue(core).withColumn("_rank", F.rank().over(w))
    return ranked.filter("_rank = 1").drop("_rank")


def regional_performance(regional: DataFrame, core: DataFrame) -> DataFrame:
    """Regional mart with growth, share and best rep; tied best reps repeat the row."""
    with_prior = regional.withColumns({
        "_prior_year": prior_year("total_revenue", "region"),
        "_share": share_pct("total_revenue", "txn_year"),
    })
    best = top_reps(core).select(
        F.col("region").alias("_region"), F.col("txn_year").alias("_year"),
        "sales_rep", "rep_revenue",
    )
    joined = with_prior.join(
        best,
        F.col("region").eqNullSafe(F.col("_region")) & (F.col("txn_year") == F.col("_year")),
        "left",
    )
    revenue, count = F.col("total_revenue"), F.col("transaction_count")
    return joined.select(
        "region",
        "txn_year",
        "total_revenue",
        "total_cost",
        "total_gross_profit",
        as_percent(F.col("avg_profit_margin")).alias("profit_margin_pct"),
        "transaction_count",
        growth_pct(revenue, F.col("_prior_year")).alias("yoy_revenue_growth_pct"),
        F.col("_share").alias("region_revenue_share_pct"),
        quotient(revenue, count, 2).alias("avg_transaction_value"),
        F.col("sales_rep").alias("top_sales_rep"),
        F.col("rep_revenue").alias("top_rep_revenue"),
    )


def product_analysis(core: DataFrame) -> DataFrame:
    """Products with ranks and share, from one aggregation of the fact, which is staged."""
    totals = core.groupBy("product_category", "product_name", "txn_year").agg(
        F.sum("revenue").alias("total_revenue"),
        F.sum("gross_profit").alias("total_gross_profit"),
        as_percent(mean(F.col("profit_margin"), 6)).alias("profit_margin_pct"),
        F.sum(F.col("units_sold").cast("long")).alias("units_sold"),
        F.count("*").alias("transaction_count"),
        mean(F.col("discount_pct"), 2).alias("avg_discount_pct"),
    )
    category = ["product_category", "txn_year"]
    base = stage_table(totals, "product-totals")
    table = rank_descending(base, category, "total_revenue", "rank_in_category", base)
    table = rank_descending(table, ["txn_year"], "total_revenue", "overall_rank", base)
    table = with_group_total(table, category, "total_revenue", "_total", base)
    share = percent(F.col("total_revenue"), F.col("_total"))
    return table.withColumn("category_share_pct", share).drop("_total")


def monthly_stats(core: DataFrame) -> DataFrame:
    """Monthly revenue statistics, with the two-sigma band taken from the rounded values."""
    stats = core.groupBy("txn_month_label", "txn_year", "txn_month").agg(
        F.count("*").alias("txn_count"),
        F.sum("revenue").alias("total_revenue"),
        mean(F.col("revenue"), 2).alias("avg_revenue"),
        F.min("revenue").alias("min_revenue"),
        F.max("revenue").alias("max_revenue"),
        F.round(F.stddev_samp(F.col("revenue").cast("double")), 2)
        .cast("decimal(16,2)")
        .alias("stddev_revenue"),
    )
    spread = zero_if_null(F.col("stddev_revenue")) * 2
    return stats.withColumns({
        "lower_bound_2sd": (F.col("avg_revenue") - spread).cast(TOTAL),
        "upper_bound_2sd": (F.col("avg_revenue") + spread).cast(TOTAL),
    })


def anomalies_per_month(anomalies: DataFrame) -> DataFrame:
    return anomalies.groupBy(month_label(F.col("txn_date")).alias("txn_month_label")).agg(
        F.count("*").alias("anomaly_count"),
        F.sum("revenue").cast(TOTAL).alias("anomalous_revenue"),
    )


def anomaly_band(core: DataFrame, anomalies: DataFrame) -> DataFrame:
    """Monthly band with the month's anomalies: both sides are aggregated before the join."""
    zero = F.lit(0).cast(TOTAL)
    return (
        monthly_stats(core)
        .join(anomalies_per_month(anomalies), "txn_month_label", "left")
        .withColumns({
            "anomaly_count": F.coalesce("anomaly_count", F.lit(0)),
            "anomalous_revenue": F.coalesce("anomalous_revenue", zero),
        })
    )


def outside_band(core: DataFrame, stats: DataFrame) -> DataFrame:
    """Fact rows beyond their month's band. Pass ``stats`` staged: its size then decides
    between a broadcast and a shuffled join."""
    band = stats.select("txn_month_label", "lower_bound_2sd", "upper_bound_2sd")
    revenue = F.col("revenue")
    return (
        core.join(band, "txn_month_label")
        .filter((revenue < F.col("lower_bound_2sd")) | (revenue > F.col("upper_bound_2sd")))
        .select(
            "transaction_id", "txn_month_label", "revenue", "lower_bound_2sd", "upper_bound_2sd"
        )
    )


def orphan_counts(source: DataFrame, tables: dict[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    """Rows of the fact without a partner in each mart, ``(relation, orphan_rows)``.

    The fact (or its cube, whose rows stand for ``transactions``) is read once: grouping sets count
    the rows of every relation's key values in one pass. The counts are staged and meet each mart
    in an anti-join.
    """
    keys = list(dict.fromkeys(k for _, names in tables.values() for k in names))
    sets = list(dict.fromkeys(tuple(names) for _, names in tables.values()))
    rows = F.sum("transactions") if "transactions" in source.columns else F.count("*")
    counted = source.groupingSets([list(s) for s in sets], *keys).agg(
        F.grouping_id(*keys).alias("_set"), rows.alias("_n"))
    counted = stage_table(counted, "keys")
    out = None
    for name, (mart, names) in tables.items():
        own = sum(1 << (len(keys) - 1 - i) for i, k in enumerate(keys) if k not in names)
        on = [F.col(f"f.{k}").eqNullSafe(F.col(f"m.{k}")) for k in names]
        one = (
            counted.filter(F.col("_set") == own).alias("f")
            .join(mart.select(*names).alias("m"), on, "left_anti")
            .agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("orphan_rows"))
            .select(F.lit(name).alias("relation"), "orphan_rows")
        )
        out = one if out is None else out.unionByName(one)
    return out
