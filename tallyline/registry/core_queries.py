"""Core enrichment and the reporting marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.operators import core, marts, metrics
from tallyline.registry.base import Inputs, query
from tallyline.registry.sql import as_percent, mean, sql
from tallyline.schemas import CORE_SALES


def _part(name: str, columns: str, *dimensions: str) -> None:
    """A projection of the core fact, keyed so that rows can be compared."""
    names = [c.strip() for c in columns.split(",")]
    text = sql(f"SELECT transaction_id, {columns} FROM core", "core")

    @query(name, text)
    def part(src: Inputs) -> DataFrame:
        return src.core(*dimensions).select("transaction_id", *names)


@query("core_sales", sql(f"SELECT {', '.join(CORE_SALES.fieldNames())} FROM core", "core"))
def core_sales(src: Inputs) -> DataFrame:
    return src.core()


_part("core_date_parts", "txn_date, txn_year, txn_quarter, txn_month, txn_month_label", "part")
_part(
    "core_trimmed_dimensions",
    "product_name, product_category, region, sales_rep, customer_id, customer_segment, channel",
    "customer", "part", "supplier",
)
_part("core_gross_profit", "revenue, cost, gross_profit", "part")
_part("core_profit_margin", "revenue, cost, profit_margin", "part")
_part("core_discount_amount", "unit_price, units_sold, discount_pct, discount_amount", "part")
_part("core_is_profitable", "revenue, cost, is_profitable", "part")
_part("core_rounded_money", "revenue, cost", "part")


@query(
    "core_summary",
    sql(f"""SELECT 'CORE_SUMMARY' AS layer, count(*) AS total_rows,
        count(DISTINCT txn_year) AS years_loaded, count(DISTINCT region) AS regions,
        count(DISTINCT product_category) AS categories,
        count(DISTINCT sales_rep) AS sales_reps,
        cast(sum(revenue) AS decimal(24,2)) AS total_revenue,
        cast(sum(gross_profit) AS decimal(25,2)) AS total_gross_profit,
        {as_percent(mean('profit_margin', 6))} AS avg_profit_margin_pct,
        count_if(is_profitable = 0) AS unprofitable_txns FROM core""", "core"),
)
def core_summary(src: Inputs) -> DataFrame:
    return core.core_summary(src.core())


@query(
    "core_by_year",
    sql(f"""SELECT txn_year, count(*) AS transactions,
        cast(sum(revenue) AS decimal(24,2)) AS total_revenue,
        cast(sum(gross_profit) AS decimal(25,2)) AS total_gross_profit,
        {as_percent(mean('profit_margin', 6))} AS avg_margin_pct
        FROM core GROUP BY txn_year ORDER BY txn_year""", "core"),
)
def core_by_year(src: Inputs) -> DataFrame:
    return core.core_by_year(src.core("part"))


@query("rpt_monthly_revenue", sql("SELECT * FROM monthly", "monthly"))
def rpt_monthly_revenue(src: Inputs) -> DataFrame:
    return marts.monthly_revenue(src.core("part"))


@query("rpt_regional_summary", sql("SELECT * FROM regional", "regional"))
def rpt_regional_summary(src: Inputs) -> DataFrame:
    return marts.regional_summary(src.core("customer", "part"))


@query("rpt_product_summary", sql("SELECT * FROM product", "product"))
def rpt_product_summary(src: Inputs) -> DataFrame:
    return marts.product_summary(src.core("part"))


@query(
    "reporting_row_counts",
    sql("""SELECT 'rpt_monthly_revenue' AS table_name, count(*) AS row_count FROM monthly
        UNION ALL SELECT 'rpt_regional_summary', count(*) FROM regional
        UNION ALL SELECT 'rpt_product_summary', count(*) FROM product""",
        "monthly", "regional", "product"),
)
def reporting_row_counts(src: Inputs) -> DataFrame:
    return marts.reporting_row_counts(marts.all_marts(src.cube()))


@query(
    "annual_core",
    sql("""SELECT txn_year, cast(sum(revenue) AS decimal(24,2)) AS revenue,
        cast(sum(gross_profit) AS decimal(25,2)) AS profit, count(*) AS transactions
        FROM core GROUP BY txn_year""", "core"),
)
def annual_core(src: Inputs) -> DataFrame:
    return core.annual_core(src.core("part"))


@query(
    "rpt_marts_from_cube",
    sql("""SELECT 'month' AS mart, month_label AS label, total_revenue, avg_profit_margin,
            transaction_count FROM monthly
        UNION ALL SELECT 'region', concat(region, '/', txn_year), total_revenue,
            avg_profit_margin, transaction_count FROM regional
        UNION ALL SELECT 'product', concat(product_category, '/', product_name, '/', txn_year),
            total_revenue, avg_profit_margin, transaction_count FROM product""",
        "monthly", "regional", "product"),
)
def rpt_marts_from_cube(src: Inputs) -> DataFrame:
    """All marts from one reading of the fact."""
    tables = marts.all_marts(src.cube())

    def lines(kind: str, table: str, *keys: str) -> DataFrame:
        return tables[table].select(
            F.lit(kind).alias("mart"), F.concat_ws("/", *keys).alias("label"), "total_revenue",
            "avg_profit_margin", "transaction_count",
        )

    return (
        lines("month", "rpt_monthly_revenue", "month_label")
        .unionByName(lines("region", "rpt_regional_summary", "region", "txn_year"))
        .unionByName(lines(
            "product", "rpt_product_summary", "product_category", "product_name", "txn_year"
        ))
    )


_SUMMARY_SQL = f"""SELECT record_date AS report_date, entity_id, metric_name,
    cast(sum(metric_value) AS decimal(28,4)) AS total_value,
    {mean('metric_value', 4)} AS avg_value,
    count(metric_value) AS record_count FROM {{}} GROUP BY record_date, entity_id, metric_name"""


@query("reporting_summary", sql(_SUMMARY_SQL.format("op_metrics"), "op_metrics"))
def reporting_summary(src: Inputs) -> DataFrame:
    return metrics.summarise(src.op_metrics(), "record_date").withColumnRenamed(
        "record_date", "report_date"
    )


def _filled(column: str) -> str:
    return f"""last_value({column} IGNORE NULLS) OVER (PARTITION BY record_date, entity_id, metric_name
        ORDER BY loaded_at, staging_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS {column}"""


@query(
    "metric_forward_fill",
    sql(f"""SELECT record_date, entity_id, metric_name, staging_id, {_filled('metric_value')},
        {_filled('source_system')}, {_filled('batch')} FROM (SELECT *,
            CASE WHEN staging_id % 3 > 0 THEN 'EVENTS' || (staging_id % 5)::varchar END AS source_system,
            CASE WHEN staging_id % 4 = 1 THEN staging_id // 100 END AS batch FROM gap_metrics)""",
        "gap_metrics"),
)
def metric_forward_fill(src: Inputs) -> DataFrame:
    """Gaps in the value, the source and the number of the batch."""
    number = F.col("staging_id")
    gaps = src.op_metrics(with_gaps=True).withColumns({
        "source_system": F.when(
            number % 3 > 0, F.concat("source_system", (number % 5).cast("string"))),
        "batch": F.when(number % 4 == 1, F.floor(number / 100)),
    })
    return metrics.forward_fill(
        gaps, keys=("record_date", *metrics.SERIES), tie_break=("staging_id",)).drop("loaded_at")


@query("metric_rollup_all_days", sql(_SUMMARY_SQL.format("filled"), "filled"))
def metric_rollup_all_days(src: Inputs) -> DataFrame:
    filled = metrics.forward_fill(
        src.op_metrics(with_gaps=True),
        keys=("record_date", *metrics.SERIES),
        tie_break=("staging_id",),
    )
    return metrics.summarise(filled, "record_date").withColumnRenamed(
        "record_date", "report_date"
    )


@query(
    "top5_months",
    sql("""SELECT month_label, cast(round(total_revenue, 0) AS decimal(22,0)) AS revenue,
        cast(round(total_gross_profit, 0) AS decimal(22,0)) AS gross_profit, transaction_count
        FROM monthly ORDER BY total_revenue DESC, month_label LIMIT 5""", "monthly"),
)
def top5_months(src: Inputs) -> DataFrame:
    return marts.top_months(marts.monthly_revenue(src.core("part")))


@query(
    "regional_overview",
    sql(f"""SELECT region, txn_year, cast(round(total_revenue, 0) AS decimal(22,0)) AS revenue,
        {as_percent('avg_profit_margin', 1)} AS margin_pct FROM regional
        ORDER BY txn_year, total_revenue DESC, region""", "regional"),
)
def regional_overview(src: Inputs) -> DataFrame:
    return marts.regional_overview(marts.regional_summary(src.core("customer", "part")))


