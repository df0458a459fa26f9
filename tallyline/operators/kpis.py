"""Dashboard measures. Each takes the frame it aggregates; slicing filters that frame first."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyline.functions.numbers import growth_pct, mean, percent, quotient, zero_if_null
from tallyline.operators.views import prior_year, share_pct


def in_years(years: Iterable[int], column: str = "txn_date") -> Column:
    """The years as ranges of dates: runs of years are one range each."""
    found, ranges = sorted(set(years)), []
    for year in found:
        if ranges and ranges[-1][1] == year - 1:
            ranges[-1][1] = year
        else:
            ranges.append([year, year])
    day = F.col(column)
    return reduce(or_, (
        (day >= F.lit(dt.date(low, 1, 1))) & (day <= F.lit(dt.date(high, 12, 31)))
        for low, high in ranges))


def years_of(years: Iterable[int]) -> Column:
    """Rows of these years; of none, no rows."""
    found = list(years)
    return F.col("txn_year").isin(*found) if found else F.lit(False)


def sliced(core: DataFrame, **equal) -> DataFrame:
    """Filter by column values (one or a list each), ahead of any aggregation.

    Where the fact is stored by year, a slice by ``txn_year`` prunes its partitions. Where the year
    is computed from the date, a scan cannot use it, so the slice says the same as a range of
    dates, which reaches the scan.
    """
    for name, wanted in equal.items():
        values = wanted if isinstance(wanted, (list, tuple, set)) else [wanted]
        core = core.filter(F.col(name).isin(*values))
        if name == "txn_year" and "txn_date" in core.columns and values and None not in values:
            core = core.filter(in_years(values))
    return core


def totals(monthly: DataFrame) -> DataFrame:
    return monthly.agg(
        F.sum("total_revenue").cast("decimal(28,2)").alias("total_revenue"),
        F.sum("total_gross_profit").cast("decimal(28,2)").alias("gross_profit"),
    )


def _margin_pct(places: int = 2) -> Column:
    """Ratio of sums, 0 without revenue (the marts hold the mean of ratios instead)."""
    return zero_if_null(percent(F.sum("gross_profit"), F.sum("revenue"), places))


def profit_margin(core: DataFrame) -> DataFrame:
    return core.agg(_margin_pct().alias("profit_margin_pct"))


def yoy_growth(core: DataFrame) -> DataFrame:
    """The latest year against the calendar year before it."""
    yearly = core.groupBy("txn_year").agg(F.sum("revenue").alias("revenue"))
    return (
        yearly.withColumn("prior_revenue", prior_year("revenue"))
        .orderBy(F.desc("txn_year"))
        .limit(1)
        .select(
            F.col("txn_year").alias("current_year"),
            F.col("revenue").alias("current_revenue"),
            "prior_revenue",
            growth_pct(F.col("revenue"), F.col("prior_revenue")).alias("yoy_growth_pct"),
        )
    )


def mom_growth(trends: DataFrame, label: str) -> DataFrame:
    return trends.filter(F.col("month_label") == label).agg(
        mean(F.col("mom_growth_pct"), 2).alias("mom_growth_pct")
    )


def latest_yoy(trends: DataFrame) -> DataFrame:
    """Year-over-year growth of the latest month."""
    return (
        trends.orderBy(F.desc("txn_year"), F.desc("txn_month"))
        .limit(1)
        .select("month_label", "yoy_growth_pct")
    )


def data_freshness(core: DataFrame) -> DataFrame:
    latest = F.date_format(F.max("txn_date"), "yyyy-MM-dd")
    return core.agg(F.concat(F.lit("Data as of: "), latest).alias("data_freshness"))


def pipeline_status(log: DataFrame, as_of: dt.date | Column) -> DataFrame:
    """The highest status text among the runs of one day."""
    return log.filter(F.col("run_date") == as_of).agg(
        F.max("status").alias("pipeline_status"), F.count("*").alias("runs")
    )


def pipeline_status_rows(log: DataFrame, as_of: dt.date | Column) -> DataFrame:
    return log.filter(F.col("run_date") == as_of).select(
        "log_id", "stage", "status", "records_processed", "duration_seconds"
    )


def revenue_by(core: DataFrame, dimension: str) -> DataFrame:
    return core.groupBy(dimension).agg(F.sum("revenue").alias("total_revenue"))


def mart_revenue_by(mart: DataFrame, dimension: str) -> DataFrame:
    return mart.groupBy(dimension).agg(
        F.sum("total_revenue").cast("decimal(28,2)").alias("total_revenue")
    )


def margin_trend(trends: DataFrame) -> DataFrame:
    return trends.select("month_label", "profit_margin_pct")


def annual_kpis(core: DataFrame, anomalies: DataFrame, segment: str = "Enterprise") -> DataFrame:
    """Eight measures per year, each with its change against the previous year."""
    in_segment = F.when(F.col("customer_segment") == segment, F.col("revenue"))
    yearly = core.groupBy("txn_year").agg(
        F.sum("revenue").alias("revenue"),
        F.sum("gross_profit").alias("gross_profit"),
        _margin_pct().alias("margin_pct"),
        F.count("*").alias("transactions"),
        quotient(F.sum("revenue"), F.count("*"), 2).alias("revenue_per_transaction"),
        zero_if_null(percent(F.sum(in_segment), F.sum("revenue"))).alias("segment_share_pct"),
        mean(F.col("discount_pct"), 4).alias("avg_discount_pct"),
    )
    flagged = anomalies.groupBy(F.year("txn_date").alias("txn_year")).agg(
        F.count("*").alias("anomaly_count")
    )
    table = yearly.join(flagged, "txn_year", "left").withColumn(
        "anomaly_count", F.coalesce("anomaly_count", F.lit(0))
    )
    before = Window.orderBy("txn_year")
    measures = [c for c in table.columns if c != "txn_year"]
    return table.withColumns({
        f"{c}_change": (F.col(c) - F.lag(c).over(before)).cast("decimal(28,4)")
        for c in measures
    })


def quarterly_revenue(monthly: DataFrame) -> DataFrame:
    quarter = F.ceil(F.col("txn_month") / 3).cast("int")
    return monthly.groupBy("txn_year", quarter.alias("txn_quarter")).agg(
        F.sum("total_revenue").cast("decimal(28,2)").alias("total_revenue")
    )


def quarterly_revenue_wide(monthly: DataFrame) -> DataFrame:
    """One row per year with a column per quarter, from one aggregation."""
    quarter = F.ceil(F.col("txn_month") / 3)
    return monthly.groupBy("txn_year").agg(*(
        F.sum(F.when(quarter == q, F.col("total_revenue"))).cast("decimal(28,2)").alias(f"q{q}")
        for q in (1, 2, 3, 4)
    ))


def margin_by_channel(core: DataFrame) -> DataFrame:
    """Mean of the transaction margins per channel, as a ratio."""
    return core.groupBy("channel").agg(
        mean(F.col("profit_margin"), 6).alias("avg_profit_margin")
    )


def top_products(core: DataFrame, n: int = 5) -> DataFrame:
    """Best products over all categories and years; equal products by name."""
    return (
        core.groupBy("product_name")
        .agg(
            F.sum("revenue").alias("total_revenue"),
            F.sum("gross_profit").alias("total_gross_profit"),
            mean(F.col("profit_margin"), 6).alias("avg_profit_margin"),
            F.sum(F.col("units_sold").cast("long")).alias("units_sold"),
        )
        .orderBy(F.desc("total_revenue"), "product_name")
        .limit(n)
    )


def regional_share(regional: DataFrame) -> DataFrame:
    """Share of each region in the revenue of all years."""
    by_region = mart_revenue_by(regional, "region")
    return by_region.withColumn("revenue_share_pct", share_pct("total_revenue"))


def revenue_per_unit(core: DataFrame) -> DataFrame:
    units = F.sum(F.col("units_sold").cast("long"))
    return core.agg(quotient(F.sum("revenue"), units, 4).alias("revenue_per_unit"))


def avg_discount(core: DataFrame) -> DataFrame:
    return core.agg(mean(F.col("discount_pct"), 2).alias("avg_discount_pct"))


def kpi_set(core: DataFrame) -> DataFrame:
    """The scalar measures together in one pass, for any slice."""
    units = F.sum(F.col("units_sold").cast("long"))
    return core.agg(
        F.sum("revenue").alias("total_revenue"),
        F.sum("gross_profit").alias("gross_profit"),
        _margin_pct().alias("profit_margin_pct"),
        F.count("*").alias("transactions"),
        quotient(F.sum("revenue"), units, 4).alias("revenue_per_unit"),
        mean(F.col("discount_pct"), 4).alias("avg_discount_pct"),
    )


def segment_share(core: DataFrame) -> DataFrame:
    return revenue_by(core, "customer_segment").withColumn(
        "revenue_share_pct", share_pct("total_revenue")
    )


def regional_table(core: DataFrame, year: int) -> DataFrame:
    """Regions of one year with growth, margin and share, and a TOTAL row.

    Both years are summed in one ``rollup``; the filter on the two years reaches the scan.
    """

    def in_year(c: Column, y: int) -> Column:
        return F.sum(F.when(F.col("txn_year") == y, c))

    sums = (
        sliced(core, txn_year=[year, year - 1])
        .rollup("region")
        .agg(
            F.grouping("region").alias("_total"),
            in_year(F.col("revenue"), year).alias("total_revenue"),
            in_year(F.col("revenue"), year - 1).alias("prior_revenue"),
            in_year(F.col("gross_profit"), year).alias("gross_profit"),
            F.count_if(F.col("txn_year") == year).alias("transactions"),
        )
    )
    revenue = F.col("total_revenue")
    whole = F.max(F.when(F.col("_total") == 1, revenue)).over(Window.partitionBy())
    return sums.select(
        F.when(F.col("_total") == 1, "TOTAL").otherwise(F.col("region")).alias("region"),
        "total_revenue",
        "prior_revenue",
        growth_pct(revenue, F.col("prior_revenue")).alias("yoy_growth_pct"),
        percent(F.col("gross_profit"), revenue).alias("profit_margin_pct"),
        "transactions",
        percent(revenue, whole).alias("revenue_share_pct"),
    )


def executive_summary(annual: DataFrame) -> DataFrame:
    """Annual figures with margin and growth to one place, in year order."""
    before = F.lag("revenue").over(Window.orderBy("txn_year"))
    revenue = F.col("revenue")
    return annual.select(
        "txn_year",
        revenue.alias("total_revenue"),
        F.col("profit").alias("gross_profit"),
        zero_if_null(percent(F.col("profit"), revenue, 1)).alias("profit_margin_pct"),
        "transactions",
        growth_pct(revenue, before, 1).alias("yoy_growth_pct"),
    ).orderBy("txn_year")


# The published columns of the report tabs.
REPORT_COLUMNS: Mapping[str, tuple[str, ...]] = {
    "monthly": (
        "month_label", "txn_year", "txn_month", "total_revenue", "total_gross_profit",
        "profit_margin_pct", "transaction_count", "mom_growth_pct", "yoy_growth_pct",
        "ytd_revenue",
    ),
    "regional": (
        "region", "txn_year", "total_revenue", "total_gross_profit", "profit_margin_pct",
        "transaction_count", "yoy_revenue_growth_pct", "region_revenue_share_pct",
        "avg_transaction_value", "top_sales_rep",
    ),
}


def report_monthly(trends: DataFrame) -> DataFrame:
    return trends.select(*REPORT_COLUMNS["monthly"]).orderBy("txn_year", "txn_month")


def report_regional(regional_view: DataFrame) -> DataFrame:
    return regional_view.select(*REPORT_COLUMNS["regional"]).orderBy(
        "txn_year", F.desc("total_revenue"), "region", "top_sales_rep"
    )


def report_products(product: DataFrame) -> DataFrame:
    return product.orderBy(
        "txn_year", F.desc("total_revenue"), "product_category", "product_name"
    )


def report_anomalies(anomalies: DataFrame) -> DataFrame:
    """Findings by revenue z-score, or one row that says there are none."""
    spark = anomalies.sparkSession
    nothing = spark.range(1).select(F.lit("No anomalies detected.").alias("_message"))
    any_row = anomalies.agg(F.count("*").alias("n")).scalar()
    notice = nothing.filter(any_row == 0).select(
        F.col("_message").alias("message"),
        *(F.lit(None).cast(f.dataType).alias(f.name) for f in anomalies.schema.fields),
    )
    rows = anomalies.withColumn("message", F.lit(None).cast("string"))
    return rows.unionByName(notice).orderBy(
        F.desc_nulls_last("revenue_zscore"), "transaction_id"
    )
