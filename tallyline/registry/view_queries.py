"""Analytical views, and the joins and windows they are made of."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.operators import marts, views
from tallyline.registry.base import Inputs, query
from tallyline.registry.sql import as_percent, mean, pct, sql
from tallyline.sources.tables import stage_table


def _monthly(src: Inputs) -> DataFrame:
    return marts.monthly_revenue(src.core("part"))


def trends(src: Inputs) -> DataFrame:
    return views.revenue_trends(_monthly(src))


def regional_view(src: Inputs) -> DataFrame:
    """Mart and best reps from one staged aggregation per region, year and rep."""
    per_rep = stage_table(
        marts.revenue_cube(src.core("customer", "part", "supplier"), ("region", "txn_year", "sales_rep")),
        "regional-reps")
    return views.regional_performance(marts.regional_summary(per_rep), per_rep)


@query("vw_revenue_trends", sql("SELECT * FROM trends", "trends"))
def vw_revenue_trends(src: Inputs) -> DataFrame:
    return trends(src)


@query(
    "trends_preview",
    sql("SELECT * FROM trends ORDER BY txn_year, txn_month LIMIT 12", "trends"),
)
def trends_preview(src: Inputs) -> DataFrame:
    return views.trends_preview(trends(src))


@query("vw_regional_performance", sql("SELECT * FROM regional_view", "regional_view"))
def vw_regional_performance(src: Inputs) -> DataFrame:
    return regional_view(src)


@query("rep_leaderboard", sql("SELECT * FROM reps", "reps"))
def rep_leaderboard(src: Inputs) -> DataFrame:
    return views.rep_leaderboard(src.core("customer", "supplier"))


@query(
    "top_reps",
    sql("SELECT region, txn_year, sales_rep, rep_revenue FROM reps WHERE rep_rank = 1", "reps"),
)
def top_reps(src: Inputs) -> DataFrame:
    return views.top_reps(src.core("customer", "supplier"))


_PRODUCTS = f"""SELECT product_category, product_name, txn_year,
    cast(sum(revenue) AS decimal(24,2)) AS total_revenue,
    cast(sum(gross_profit) AS decimal(25,2)) AS total_gross_profit,
    {as_percent(mean('profit_margin', 6))} AS profit_margin_pct,
    cast(sum(units_sold) AS bigint) AS units_sold, count(*) AS transaction_count,
    {mean('discount_pct', 2)} AS avg_discount_pct,
    cast(rank() OVER (PARTITION BY product_category, txn_year ORDER BY sum(revenue) DESC) AS int)
        AS rank_in_category,
    cast(rank() OVER (PARTITION BY txn_year ORDER BY sum(revenue) DESC) AS int) AS overall_rank,
    {pct('sum(revenue)', 'sum(sum(revenue)) OVER (PARTITION BY product_category, txn_year)')}
        AS category_share_pct
    FROM core GROUP BY product_category, product_name, txn_year"""


@query("vw_product_analysis", sql(_PRODUCTS, "core"))
def vw_product_analysis(src: Inputs) -> DataFrame:
    return views.product_analysis(src.core("part"))


BAND_SQL = f"""SELECT *,
    cast(avg_revenue - 2 * coalesce(stddev_revenue, 0) AS decimal(24,2)) AS lower_bound_2sd,
    cast(avg_revenue + 2 * coalesce(stddev_revenue, 0) AS decimal(24,2)) AS upper_bound_2sd
    FROM (SELECT txn_month_label, txn_year, txn_month, count(*) AS txn_count,
        cast(sum(revenue) AS decimal(24,2)) AS total_revenue,
        {mean('revenue', 2)} AS avg_revenue,
        min(revenue) AS min_revenue, max(revenue) AS max_revenue,
        cast(round(stddev_samp(cast(revenue AS double)), 2) AS decimal(16,2)) AS stddev_revenue
        FROM clean_core GROUP BY txn_month_label, txn_year, txn_month)"""


@query(
    "vw_anomaly_detection",
    sql(f"""SELECT b.*,
        (SELECT count(*) FROM anomalies a
         WHERE strftime(a.txn_date, '%Y-%m') = b.txn_month_label) AS anomaly_count,
        coalesce((SELECT cast(sum(a.revenue) AS decimal(24,2)) FROM anomalies a
         WHERE strftime(a.txn_date, '%Y-%m') = b.txn_month_label), 0) AS anomalous_revenue
        FROM ({BAND_SQL}) b""", "anomalies"),
)
def vw_anomaly_detection(src: Inputs) -> DataFrame:
    from tallyline.operators.anomalies import detect_all

    fact = src.clean_core(
        "transaction_id", "txn_date", "txn_year", "txn_month", "txn_month_label", "product_name",
        "product_category", "region", "revenue", "cost", "discount_pct",
        dimensions=("customer", "part"),
    )
    return views.anomaly_band(fact, detect_all(fact))


@query(
    "monthly_band",
    sql(f"""SELECT transaction_id, c.txn_month_label, revenue, lower_bound_2sd, upper_bound_2sd
        FROM clean_core c JOIN ({BAND_SQL}) b ON b.txn_month_label = c.txn_month_label
        WHERE revenue < lower_bound_2sd OR revenue > upper_bound_2sd""", "clean_core"),
)
def monthly_band(src: Inputs) -> DataFrame:
    fact = src.clean_core(
        "transaction_id", "txn_year", "txn_month", "txn_month_label", "revenue",
        dimensions=("part",),
    )
    return views.outside_band(fact, stage_table(views.monthly_stats(fact), "band"))


@query(
    "yoy_month_join",
    sql("""SELECT m.txn_year, m.txn_month, m.total_revenue,
        py.total_revenue AS prior_year_revenue FROM monthly m LEFT JOIN monthly py
        ON py.txn_year = m.txn_year - 1 AND py.txn_month = m.txn_month""", "monthly"),
)
def yoy_month_join(src: Inputs) -> DataFrame:
    return _monthly(src).select(
        "txn_year", "txn_month", "total_revenue",
        views.prior_year("total_revenue", "txn_month").alias("prior_year_revenue"),
    )


@query(
    "yoy_region_join",
    sql("""SELECT r.region, r.txn_year, r.total_revenue,
        py.total_revenue AS prior_year_revenue, py.total_gross_profit AS prior_year_profit
        FROM regional r LEFT JOIN regional py
        ON py.region = r.region AND py.txn_year = r.txn_year - 1""", "regional"),
)
def yoy_region_join(src: Inputs) -> DataFrame:
    mart = marts.regional_summary(src.core("customer", "part"))
    return mart.select(
        "region", "txn_year", "total_revenue",
        views.prior_year("total_revenue", "region").alias("prior_year_revenue"),
        views.prior_year("total_gross_profit", "region").alias("prior_year_profit"),
    )


@query(
    "mom_lag",
    sql("""SELECT month_label, total_revenue, lag(total_revenue) OVER
        (ORDER BY txn_year, txn_month) AS prev_month_revenue FROM monthly""", "monthly"),
)
def mom_lag(src: Inputs) -> DataFrame:
    return _monthly(src).select(
        "month_label", "total_revenue",
        views.previous_month("total_revenue").alias("prev_month_revenue"),
    )


@query(
    "ytd_running_sum",
    sql("SELECT month_label, ytd_revenue FROM trends", "trends"),
)
def ytd_running_sum(src: Inputs) -> DataFrame:
    return _monthly(src).select(
        "month_label",
        views.year_to_date("total_revenue").cast("decimal(28,2)").alias("ytd_revenue"),
    )


@query(
    "region_share_by_year",
    sql("SELECT DISTINCT region, txn_year, region_revenue_share_pct FROM regional_view",
        "regional_view"),
)
def region_share_by_year(src: Inputs) -> DataFrame:
    mart = marts.regional_summary(src.core("customer", "part"))
    return mart.select(
        "region", "txn_year",
        views.share_pct("total_revenue", "txn_year").alias("region_revenue_share_pct"),
    )


@query(
    "anomalies_per_month",
    sql("""SELECT strftime(txn_date, '%Y-%m') AS txn_month_label, count(*) AS anomaly_count,
        cast(sum(revenue) AS decimal(24,2)) AS anomalous_revenue
        FROM anomalies GROUP BY 1""", "anomalies"),
)
def anomalies_per_month(src: Inputs) -> DataFrame:
    return views.anomalies_per_month(src.anomalies())


@query(
    "rel_orphans",
    sql("""SELECT 'rpt_monthly_revenue' AS relation, count(*) AS orphan_rows FROM core
            WHERE NOT EXISTS (SELECT 1 FROM monthly m WHERE m.month_label = txn_month_label)
        UNION ALL SELECT 'rpt_regional_summary', count(*) FROM core c
            WHERE NOT EXISTS (SELECT 1 FROM regional r
                WHERE r.region = c.region AND r.txn_year = c.txn_year AND r.txn_year > 1996)
        UNION ALL SELECT 'rpt_product_summary', count(*) FROM core c
            WHERE NOT EXISTS (SELECT 1 FROM product p WHERE p.product_name = c.product_name
                AND p.txn_year = c.txn_year)""", "monthly", "regional", "product"),
)
def rel_orphans(src: Inputs) -> DataFrame:
    """Facts without a mart row, by the cube. The regional mart lacks its first years here, so
    that there is something to find."""
    cube = src.cube()
    monthly = marts.monthly_revenue(cube).withColumnRenamed("month_label", "txn_month_label")
    regional = marts.regional_summary(cube).filter(F.col("txn_year") > 1996)
    return views.orphan_counts(cube, {
        "rpt_monthly_revenue": (monthly, ["txn_month_label"]),
        "rpt_regional_summary": (regional, ["region", "txn_year"]),
        "rpt_product_summary": (marts.product_summary(cube), ["product_name", "txn_year"]),
    })
