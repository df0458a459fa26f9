"""Readers, writers, load modes."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.operators import marts, staging
from tallyline.registry.base import Inputs, query
from tallyline.registry.sql import CTES, _core, sql
from tallyline.schemas import OPERATIONAL, RAW_SALES_COLUMNS, STAGED_SALES
from tallyline.sources.operational import extract_day
from tallyline.sources.sales_csv import read_sales_csv, require_columns
from tallyline.sources.snapshots import TableStore
from tallyline.sources.tables import (
    conform,
    forget_shuffles,
    full_refresh,
    new_path,
    replace_dates,
    row_counts,
    write_csv,
)
from tallyline.sources.warehouse import LOAD_ORDER
from tallyline.streaming import incremental

DAY = dt.date(2024, 1, 10)
MARKS = (dt.datetime(1995, 1, 1), dt.datetime(1998, 6, 30))

RAW_PROFILE = ", ".join(f"count({c}) AS {c}" for c in RAW_SALES_COLUMNS)


FILE_ROWS = 500_000


def written_csv(src: Inputs) -> str:
    """Raw files of the sales, compressed; nothing of the joins that made them stays on disk."""
    path = new_path(src.spark, "sales-csv")
    write_csv(src.sales_raw(), path, "gzip", FILE_ROWS)
    forget_shuffles(src.spark)
    return path


def profile(df: DataFrame) -> DataFrame:
    """Values present per column, and rows."""
    return df.agg(
        F.count("*").alias("row_count"), *(F.count(c).alias(c) for c in RAW_SALES_COLUMNS)
    )


@query(
    "src_sales_csv",
    sql(f"""SELECT count(*) AS row_count, {RAW_PROFILE.replace(
        'count(revenue)', "count(CASE WHEN revenue <> 'n/a' THEN 1 END)")} FROM raw""", "raw"),
)
def src_sales_csv(src: Inputs) -> DataFrame:
    return profile(read_sales_csv(src.spark, written_csv(src)))


@query(
    "src_required_columns",
    sql("SELECT region, channel, count(*) AS row_count FROM raw GROUP BY ALL", "raw"),
)
def src_required_columns(src: Inputs) -> DataFrame:
    raw = require_columns(src.sales_raw())
    return raw.groupBy("region", "channel").agg(F.count("*").alias("row_count"))


@query(
    "src_operational_by_date",
    sql(f"""SELECT record_date, entity_id, metric_name, metric_value, source_system, staging_id
        FROM op_metrics WHERE record_date = DATE '{DAY}'""", "op_metrics"),
)
def src_operational_by_date(src: Inputs) -> DataFrame:
    return extract_day(src.op_metrics(), DAY).drop("loaded_at")


@query("sink_full_refresh", sql("SELECT * FROM monthly", "monthly"))
def sink_full_refresh(src: Inputs) -> DataFrame:
    path = new_path(src.spark, "monthly")
    mart = marts.monthly_revenue(src.core("part"))
    full_refresh(mart.filter("txn_year < 1998"), path)
    return full_refresh(mart, path)


@query(
    "sink_append_by_date",
    sql("""SELECT record_date, count(*) AS row_count,
        cast(sum(metric_value) AS decimal(28,4)) AS total_value
        FROM op_metrics GROUP BY record_date""", "op_metrics"),
)
def sink_append_by_date(src: Inputs) -> DataFrame:
    """Every day is written, then some days again; each day is there once."""
    path = new_path(src.spark, "operational")
    source = src.op_metrics().select(*OPERATIONAL.fieldNames())
    replace_dates(source, path, "record_date")
    replace_dates(source.filter(F.col("record_date") >= F.lit(DAY)), path, "record_date")
    return src.spark.read.parquet(path).groupBy("record_date").agg(
        F.count("*").alias("row_count"), F.sum("metric_value").alias("total_value")
    )


@query(
    "sink_anomalies_csv",
    sql("""SELECT anomaly_type, count(*) AS anomaly_count,
        cast(sum(revenue) AS decimal(24,2)) AS total_revenue
        FROM anomalies GROUP BY anomaly_type""", "anomalies"),
)
def sink_anomalies_csv(src: Inputs) -> DataFrame:
    path = new_path(src.spark, "anomalies-csv")
    found = src.anomalies()
    write_csv(found, path)
    back = src.spark.read.option("header", True).schema(found.schema).csv(path)
    return back.groupBy("anomaly_type").agg(
        F.count("*").alias("anomaly_count"), F.sum("revenue").alias("total_revenue")
    )


_FULL_REFRESH = """SELECT transaction_id, revenue, discount_pct, loaded_at FROM (
    SELECT *, row_number() OVER (PARTITION BY transaction_id
        ORDER BY loaded_at {0}, l_partkey {0}, l_suppkey {0}, revenue {0}, units_sold {0}) AS rn
    FROM sales) WHERE rn = 1"""


def _in_three_batches(src: Inputs, policy: str) -> DataFrame:
    """Loads up to the first mark, from there to the second, and the rest, merged in turn."""
    source = src.sales("part").select(
        "transaction_id", "revenue", "discount_pct", "loaded_at", "l_partkey", "l_suppkey",
        "units_sold",
    )
    current = source.limit(0)
    for low, high in zip((None, *MARKS), (*MARKS, None)):
        batch = source if low is None else incremental.changes_since(source, low)
        batch = batch if high is None else batch.filter(F.col("loaded_at") <= F.lit(high))
        current = incremental.merge_by_key(current, batch, order=LOAD_ORDER, policy=policy)
    return current.select("transaction_id", "revenue", "discount_pct", "loaded_at")


@query("src_incremental_hwm", sql(_FULL_REFRESH.format("ASC"), "sales"))
def src_incremental_hwm(src: Inputs) -> DataFrame:
    return _in_three_batches(src, "keep_first")


@query("src_incremental_latest", sql(_FULL_REFRESH.format("DESC"), "sales"))
def src_incremental_latest(src: Inputs) -> DataFrame:
    return _in_three_batches(src, "keep_latest")


_MART_LINES = """SELECT 'month' AS mart, month_label AS label, total_revenue, avg_profit_margin,
        transaction_count FROM monthly
    UNION ALL SELECT 'region', concat(region, '/', txn_year), total_revenue, avg_profit_margin,
        transaction_count FROM regional
    UNION ALL SELECT 'product', concat(product_category, '/', product_name, '/', txn_year),
        total_revenue, avg_profit_margin, transaction_count FROM product"""


def _marts_sql(direction: str) -> str:
    """The marts over the sales without copies."""
    single = f"""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY transaction_id
        ORDER BY loaded_at {direction}, l_partkey {direction}, l_suppkey {direction},
        revenue {direction}, units_sold {direction}) AS rn FROM sales) WHERE rn = 1"""
    tables = {"sales": CTES["sales"][0], "single": single, "core": _core("single")}
    tables |= {name: CTES[name][0] for name in ("monthly", "regional", "product")}
    ctes = ", ".join(f"{name} AS MATERIALIZED ({text})" for name, text in tables.items())
    return f"WITH {ctes} {_MART_LINES}"


def _incremental_marts(src: Inputs, policy: str) -> DataFrame:
    """Fact and marts after three batches, each mart read from the published snapshot."""
    store = TableStore(src.spark, new_path(src.spark, "sales-store"))
    source = src.sales("customer", "part", "supplier")
    for low, high in zip((None, *MARKS), (*MARKS, None)):
        batch = source if low is None else incremental.changes_since(source, low)
        batch = batch if high is None else batch.filter(F.col("loaded_at") <= F.lit(high))
        incremental.apply_batch(store, batch, order=LOAD_ORDER, policy=policy)
    published = store.snapshot()

    def lines(kind: str, table: str, *keys: str) -> DataFrame:
        return published.read(table).select(
            F.lit(kind).alias("mart"), F.concat_ws("/", *keys).alias("label"), "total_revenue",
            "avg_profit_margin", "transaction_count")

    return (
        lines("month", "rpt_monthly_revenue", "month_label")
        .unionByName(lines("region", "rpt_regional_summary", "region", "txn_year"))
        .unionByName(lines(
            "product", "rpt_product_summary", "product_category", "product_name", "txn_year"))
    )


@query("marts_incremental_first", _marts_sql("ASC"))
def marts_incremental_first(src: Inputs) -> DataFrame:
    return _incremental_marts(src, "keep_first")


@query("marts_incremental_latest", _marts_sql("DESC"))
def marts_incremental_latest(src: Inputs) -> DataFrame:
    return _incremental_marts(src, "keep_latest")


@query(
    "src_high_water_mark",
    "SELECT max(l_shipdate) AS high_water_mark FROM lineitem",
)
def src_high_water_mark(src: Inputs) -> DataFrame:
    return incremental.high_water_mark(src.sales("part"))


@query(
    "table_row_counts",
    sql("""SELECT table_name, row_count,
        CASE WHEN row_count > 0 THEN 'OK' ELSE 'EMPTY' END AS status FROM (
        SELECT 'stg_sales_raw' AS table_name, count(*) AS row_count FROM sales
        UNION ALL SELECT 'core_sales', count(*) FROM core
        UNION ALL SELECT 'rpt_monthly_revenue', count(*) FROM monthly
        UNION ALL SELECT 'rpt_regional_summary', count(*) FROM regional
        UNION ALL SELECT 'rpt_product_summary', count(*) FROM product
        UNION ALL SELECT 'rpt_anomalies', count(*) FROM anomalies
        UNION ALL SELECT 'not_there', -1)""",
        "sales", "core", "monthly", "regional", "product", "anomalies"),
)
def table_row_counts(src: Inputs) -> DataFrame:
    """Counts of the six layers; a table that is not there counts -1."""
    return row_counts({
        "stg_sales_raw": src.sales("part"),
        "core_sales": src.core("part"),
        **marts.all_marts(src.cube()),
        "rpt_anomalies": src.anomalies(),
        "not_there": None,
    })


@query(
    "conform_schema",
    sql("""SELECT transaction_id, try_cast(date AS date) AS record_date, product_name,
        product_category, region, sales_rep, customer_id, customer_segment, channel,
        try_cast(units_sold AS int) AS units_sold,
        try_cast(unit_price AS decimal(12,2)) AS unit_price,
        try_cast(revenue AS decimal(14,2)) AS revenue, try_cast(cost AS decimal(14,2)) AS cost,
        try_cast(discount_pct AS decimal(6,2)) AS discount_pct FROM raw""", "raw"),
)
def conform_schema(src: Inputs) -> DataFrame:
    raw = src.sales_raw().withColumnRenamed("date", "record_date")
    raw = raw.withColumn("source_system", F.lit("CSV_LOAD"))
    return conform(raw, STAGED_SALES).drop("source_system", "loaded_at")


