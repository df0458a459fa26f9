"""Dashboard measures and report tabs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.operators import anomalies, core, kpis, marts
from tallyline.registry.base import ANOMALY_INPUT, Inputs, query
from tallyline.registry.sql import mean, pct, q, sql
from tallyline.registry.view_queries import regional_view, trends

MONTH = "1998-06"
YEAR = 2000
SEGMENT = "BUILDING"


def _money(expr: str, digits: int = 24) -> str:
    return f"cast({expr} AS decimal({digits},2))"


def _latest_run_date(src: Inputs):
    return src.run_log().agg(F.max("run_date").alias("d")).scalar()


def _monthly(src: Inputs) -> DataFrame:
    return marts.monthly_revenue(src.core("part"))


@query(
    "kpi_totals",
    sql(f"""SELECT {_money('sum(total_revenue)', 28)} AS total_revenue,
        {_money('sum(total_gross_profit)', 28)} AS gross_profit FROM monthly""", "monthly"),
)
def kpi_totals(src: Inputs) -> DataFrame:
    return kpis.totals(_monthly(src))


@query(
    "kpi_profit_margin",
    sql(f"""SELECT coalesce({pct('sum(gross_profit)', 'sum(revenue)')}, 0)
        AS profit_margin_pct FROM core""", "core"),
)
def kpi_profit_margin(src: Inputs) -> DataFrame:
    return kpis.profit_margin(src.core("part"))


@query(
    "kpi_yoy_growth",
    sql(f"""SELECT y AS current_year, cur AS current_revenue, prior AS prior_revenue,
        {pct('cur - prior', 'prior')} AS yoy_growth_pct
        FROM (SELECT y, {_money('sum(revenue) FILTER (txn_year = y)')} AS cur,
                     {_money('sum(revenue) FILTER (txn_year = y - 1)')} AS prior
              FROM core, (SELECT max(txn_year) AS y FROM core) GROUP BY y)""", "core"),
)
def kpi_yoy_growth(src: Inputs) -> DataFrame:
    return kpis.yoy_growth(src.core("part"))


@query(
    "kpi_mom_growth",
    sql(f"""SELECT {mean('mom_growth_pct', 2)} AS mom_growth_pct FROM trends
        WHERE month_label = '{MONTH}'""", "trends"),
)
def kpi_mom_growth(src: Inputs) -> DataFrame:
    return kpis.mom_growth(trends(src), MONTH)


@query(
    "kpi_latest_yoy",
    sql("""SELECT month_label, yoy_growth_pct FROM trends
        ORDER BY txn_year DESC, txn_month DESC LIMIT 1""", "trends"),
)
def kpi_latest_yoy(src: Inputs) -> DataFrame:
    return kpis.latest_yoy(trends(src))


@query(
    "kpi_data_freshness",
    sql("""SELECT concat('Data as of: ', strftime(max(txn_date), '%Y-%m-%d')) AS data_freshness
        FROM core""", "core"),
)
def kpi_data_freshness(src: Inputs) -> DataFrame:
    return kpis.data_freshness(src.core("part"))


@query(
    "kpi_pipeline_status",
    sql("""SELECT max(status) AS pipeline_status, count(*) AS runs FROM run_log
        WHERE run_date = (SELECT max(run_date) FROM run_log)""", "run_log"),
)
def kpi_pipeline_status(src: Inputs) -> DataFrame:
    return kpis.pipeline_status(src.run_log(), _latest_run_date(src))


@query(
    "kpi_pipeline_status_rows",
    sql("""SELECT log_id, stage, status, records_processed, duration_seconds FROM run_log
        WHERE run_date = (SELECT max(run_date) FROM run_log)""", "run_log"),
)
def kpi_pipeline_status_rows(src: Inputs) -> DataFrame:
    return kpis.pipeline_status_rows(src.timed_log(), _latest_run_date(src))


def _revenue_by_sql(column: str) -> str:
    return sql(
        f"SELECT {column}, {_money('sum(revenue)')} AS total_revenue FROM core GROUP BY {column}",
        "core",
    )


@query("revenue_by_segment", _revenue_by_sql("customer_segment"))
def revenue_by_segment(src: Inputs) -> DataFrame:
    return kpis.revenue_by(src.core("customer"), "customer_segment")


@query("revenue_by_channel", _revenue_by_sql("channel"))
def revenue_by_channel(src: Inputs) -> DataFrame:
    return kpis.revenue_by(src.core("part"), "channel")


@query(
    "revenue_by_region",
    sql(f"""SELECT region, {_money('sum(total_revenue)', 28)} AS total_revenue
        FROM regional GROUP BY region""", "regional"),
)
def revenue_by_region(src: Inputs) -> DataFrame:
    mart = marts.regional_summary(src.core("customer", "part"))
    return kpis.mart_revenue_by(mart, "region")


@query(
    "revenue_by_category",
    sql(f"""SELECT product_category, {_money('sum(total_revenue)', 28)} AS total_revenue
        FROM product GROUP BY product_category""", "product"),
)
def revenue_by_category(src: Inputs) -> DataFrame:
    return kpis.mart_revenue_by(marts.product_summary(src.core("part")), "product_category")


@query("margin_trend", sql("SELECT month_label, profit_margin_pct FROM trends", "trends"))
def margin_trend(src: Inputs) -> DataFrame:
    return kpis.margin_trend(trends(src))


_ANNUAL_MEASURES = (
    "revenue", "gross_profit", "margin_pct", "transactions", "revenue_per_transaction",
    "segment_share_pct", "avg_discount_pct", "anomaly_count",
)
_CHANGES = ", ".join(
    f"cast({m} - lag({m}) OVER (ORDER BY txn_year) AS decimal(28,4)) AS {m}_change"
    for m in _ANNUAL_MEASURES
)


@query(
    "annual_kpi",
    sql(f"""SELECT *, {_CHANGES} FROM (
        SELECT y.*, coalesce(n, 0) AS anomaly_count FROM (
            SELECT txn_year, {_money('sum(revenue)')} AS revenue,
            {_money('sum(gross_profit)', 25)} AS gross_profit,
            coalesce({pct('sum(gross_profit)', 'sum(revenue)')}, 0) AS margin_pct,
            count(*) AS transactions,
            {q('sum(revenue)', 'count(*)', 2)} AS revenue_per_transaction,
            coalesce({pct(f"sum(CASE WHEN customer_segment = '{SEGMENT}' THEN revenue END)",
                           'sum(revenue)')}, 0) AS segment_share_pct,
            {mean('discount_pct', 4)} AS avg_discount_pct
            FROM clean_core GROUP BY txn_year) y
        LEFT JOIN (SELECT year(txn_date) AS ay, count(*) AS n FROM anomalies GROUP BY 1)
        ON ay = txn_year)""", "anomalies"),
)
def annual_kpi(src: Inputs) -> DataFrame:
    fact = src.clean_core(
        *ANOMALY_INPUT, "txn_year", "customer_segment", "gross_profit",
        dimensions=("customer", "part"),
    )
    return kpis.annual_kpis(fact, anomalies.detect_all(fact), SEGMENT)


@query(
    "quarterly_revenue",
    sql(f"""SELECT txn_year, cast(ceil(txn_month / 3.0) AS int) AS txn_quarter,
        {_money('sum(total_revenue)', 28)} AS total_revenue FROM monthly GROUP BY 1, 2""",
        "monthly"),
)
def quarterly_revenue(src: Inputs) -> DataFrame:
    return kpis.quarterly_revenue(_monthly(src))


@query(
    "quarterly_revenue_wide",
    sql("SELECT txn_year, " + ", ".join(
        _money(f"sum(total_revenue) FILTER (ceil(txn_month / 3.0) = {q})", 28) + f" AS q{q}"
        for q in (1, 2, 3, 4)
    ) + " FROM monthly GROUP BY txn_year", "monthly"),
)
def quarterly_revenue_wide(src: Inputs) -> DataFrame:
    return kpis.quarterly_revenue_wide(_monthly(src))


@query(
    "margin_by_channel",
    sql(f"""SELECT channel, {mean('profit_margin', 6)} AS avg_profit_margin
        FROM core GROUP BY channel""", "core"),
)
def margin_by_channel(src: Inputs) -> DataFrame:
    return kpis.margin_by_channel(src.core("part"))


@query(
    "top5_products",
    sql(f"""SELECT product_name, {_money('sum(revenue)')} AS total_revenue,
        {_money('sum(gross_profit)', 25)} AS total_gross_profit,
        {mean('profit_margin', 6)} AS avg_profit_margin,
        cast(sum(units_sold) AS bigint) AS units_sold FROM core GROUP BY product_name
        ORDER BY sum(revenue) DESC, product_name LIMIT 5""", "core"),
)
def top5_products(src: Inputs) -> DataFrame:
    return kpis.top_products(src.core("part"))


@query(
    "regional_share",
    sql(f"""SELECT region, {_money('sum(total_revenue)', 28)} AS total_revenue,
        {pct('sum(total_revenue)', 'sum(sum(total_revenue)) OVER ()')} AS revenue_share_pct
        FROM regional GROUP BY region""", "regional"),
)
def regional_share(src: Inputs) -> DataFrame:
    return kpis.regional_share(marts.regional_summary(src.core("customer", "part")))


@query(
    "revenue_per_unit",
    sql(f"""SELECT {q('sum(revenue)', 'sum(units_sold)', 4)} AS revenue_per_unit
        FROM core""", "core"),
)
def revenue_per_unit(src: Inputs) -> DataFrame:
    return kpis.revenue_per_unit(src.core("part"))


@query(
    "avg_discount",
    sql(f"SELECT {mean('discount_pct', 2)} AS avg_discount_pct FROM core", "core"),
)
def avg_discount(src: Inputs) -> DataFrame:
    return kpis.avg_discount(src.core("part"))


@query(
    "sliced_kpis",
    sql(f"""SELECT {_money('sum(revenue)')} AS total_revenue,
        {_money('sum(gross_profit)', 25)} AS gross_profit,
        coalesce({pct('sum(gross_profit)', 'sum(revenue)')}, 0) AS profit_margin_pct,
        count(*) AS transactions,
        {q('sum(revenue)', 'sum(units_sold)', 4)} AS revenue_per_unit,
        {mean('discount_pct', 4)} AS avg_discount_pct FROM core
        WHERE txn_year IN (1999, {YEAR}) AND product_category = 'PROMO' AND channel = 'Direct'
          AND customer_segment = '{SEGMENT}'""", "core"),
)
def sliced_kpis(src: Inputs) -> DataFrame:
    return kpis.kpi_set(kpis.sliced(
        src.core("customer", "part"), txn_year=[1999, YEAR], product_category="PROMO",
        channel="Direct", customer_segment=SEGMENT,
    ))


@query(
    "exec_summary",
    sql(f"""SELECT txn_year, rev AS total_revenue, profit AS gross_profit,
        coalesce({pct('profit', 'rev', 1)}, 0) AS profit_margin_pct, transactions,
        {pct('rev - lag(rev) OVER (ORDER BY txn_year)', 'lag(rev) OVER (ORDER BY txn_year)', 1)}
            AS yoy_growth_pct
        FROM (SELECT txn_year, {_money('sum(revenue)')} AS rev,
              {_money('sum(gross_profit)', 25)} AS profit, count(*) AS transactions
              FROM core GROUP BY txn_year) ORDER BY txn_year""", "core"),
)
def exec_summary(src: Inputs) -> DataFrame:
    return kpis.executive_summary(core.annual_core(src.core("part")))


@query(
    "report_monthly",
    sql(f"""SELECT {', '.join(kpis.REPORT_COLUMNS['monthly'])} FROM trends
        ORDER BY txn_year, txn_month""", "trends"),
)
def report_monthly(src: Inputs) -> DataFrame:
    return kpis.report_monthly(trends(src))


@query(
    "report_regional",
    sql(f"""SELECT {', '.join(kpis.REPORT_COLUMNS['regional'])} FROM regional_view
        ORDER BY txn_year, total_revenue DESC""", "regional_view"),
)
def report_regional(src: Inputs) -> DataFrame:
    return kpis.report_regional(regional_view(src))


@query(
    "report_products",
    sql("SELECT * FROM product ORDER BY txn_year, total_revenue DESC", "product"),
)
def report_products(src: Inputs) -> DataFrame:
    return kpis.report_products(marts.product_summary(src.core("part")))


@query(
    "report_anomalies",
    sql("""SELECT *, cast(NULL AS varchar) AS message FROM anomalies
        ORDER BY revenue_zscore DESC NULLS LAST""", "anomalies"),
)
def report_anomalies(src: Inputs) -> DataFrame:
    return kpis.report_anomalies(src.anomalies())


@query(
    "report_no_anomalies",
    sql("SELECT 'No anomalies detected.' AS message, * FROM "
        "(SELECT cast(NULL AS varchar) AS transaction_id, "
        "cast(NULL AS date) AS txn_date, cast(NULL AS varchar) AS product_name, "
        "cast(NULL AS varchar) AS region, "
        "cast(NULL AS decimal(14,2)) AS revenue, cast(NULL AS decimal(14,2)) AS cost, "
        "cast(NULL AS double) AS revenue_zscore, cast(NULL AS double) AS cost_zscore, "
        "cast(NULL AS varchar) AS anomaly_type) WHERE (SELECT count(*) FROM clean_core WHERE revenue < 0) = 0",
        "clean_core"),
)
def report_no_anomalies(src: Inputs) -> DataFrame:
    """The notice row of the anomaly tab, for a fact in which nothing is left to flag."""
    return kpis.report_anomalies(anomalies.detect_all(src.nothing_to_flag()))


@query(
    "enterprise_share",
    sql(f"""SELECT customer_segment, {_money('sum(revenue)')} AS total_revenue,
        {pct('sum(revenue)', 'sum(sum(revenue)) OVER ()')} AS revenue_share_pct
        FROM core GROUP BY customer_segment""", "core"),
)
def enterprise_share(src: Inputs) -> DataFrame:
    return kpis.segment_share(src.core("customer"))


@query(
    "regional_table_total",
    sql(f"""SELECT region, total_revenue, prior_revenue,
        {pct('total_revenue - prior_revenue', 'prior_revenue')} AS yoy_growth_pct,
        {pct('profit', 'total_revenue')} AS profit_margin_pct, transactions,
        {pct('total_revenue', 'max(CASE WHEN is_total = 1 THEN total_revenue END) OVER ()')}
            AS revenue_share_pct
        FROM (SELECT CASE WHEN grouping(region) = 1 THEN 'TOTAL' ELSE region END AS region,
              grouping(region) AS is_total,
              {_money(f'sum(revenue) FILTER (txn_year = {YEAR})')} AS total_revenue,
              {_money(f'sum(revenue) FILTER (txn_year = {YEAR - 1})')} AS prior_revenue,
              sum(gross_profit) FILTER (txn_year = {YEAR}) AS profit,
              count(*) FILTER (txn_year = {YEAR}) AS transactions
              FROM core WHERE txn_year IN ({YEAR}, {YEAR - 1}) GROUP BY ROLLUP (region))""",
        "core"),
)
def regional_table_total(src: Inputs) -> DataFrame:
    return kpis.regional_table(src.core("customer", "part"), YEAR)
