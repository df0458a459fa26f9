"""Ingest validation and staging clean-up."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.functions.text import strip, title_case
from tallyline.operators import ingest, staging
from tallyline.registry.base import Inputs, query
from tallyline.registry.sql import mean, sql
from tallyline.registry.sql import title_case as sql_title_case
from tallyline.schemas import RAW_SALES_COLUMNS, STAGED_SALES
from tallyline.sources.sales_csv import read_sales_csv
from tallyline.sources.tables import new_path

STAGED = tuple(c for c in STAGED_SALES.fieldNames() if c not in ("source_system", "loaded_at"))
STAGED_SQL = ", ".join(STAGED)


@query(
    "ingest_numeric_coerce",
    sql("""SELECT count(*) AS row_count, count(units_sold) AS units_sold,
        count(unit_price) AS unit_price, count(revenue) AS revenue, count(cost) AS cost,
        count(discount_pct) AS discount_pct,
        cast(sum(revenue) AS decimal(38,6)) AS total_revenue FROM parsed""", "parsed"),
)
def ingest_numeric_coerce(src: Inputs) -> DataFrame:
    numbers = ingest.coerce_numbers(src.sales_raw("part"))
    names = ("units_sold", "unit_price", "revenue", "cost", "discount_pct")
    return numbers.agg(
        F.count("*").alias("row_count"),
        *(F.count(c).alias(c) for c in names),
        F.sum("revenue").cast("decimal(38,6)").alias("total_revenue"),
    )


@query(
    "ingest_rejects",
    sql("""SELECT reason, count(*) AS row_count FROM (
        SELECT unnest(list_filter([
            CASE WHEN transaction_id IS NULL THEN 'NULL_TRANSACTION_ID' END,
            CASE WHEN trim(transaction_id) = '' THEN 'BLANK_TRANSACTION_ID' END,
            CASE WHEN date IS NULL THEN 'NULL_DATE' END,
            CASE WHEN date IS NOT NULL AND record_date IS NULL THEN 'INVALID_DATE' END,
            CASE WHEN revenue IS NULL THEN 'NULL_REVENUE' END,
            CASE WHEN revenue < 0 THEN 'NEGATIVE_REVENUE' END], lambda x: x IS NOT NULL))
            AS reason FROM parsed) GROUP BY reason""", "parsed"),
)
def ingest_rejects(src: Inputs) -> DataFrame:
    bad = ingest.rejected(src.parsed("part"))
    return bad.select(F.explode("reject_reasons").alias("reason")).groupBy("reason").agg(
        F.count("*").alias("row_count")
    )


@query(
    "ingest_invalid_date",
    sql("""SELECT date, count(*) AS row_count FROM parsed
        WHERE date IS NOT NULL AND record_date IS NULL GROUP BY date""", "parsed"),
)
def ingest_invalid_date(src: Inputs) -> DataFrame:
    bad = ingest.rejected(src.parsed("part")).filter(
        F.array_contains("reject_reasons", "INVALID_DATE")
    )
    return bad.groupBy("date").agg(F.count("*").alias("row_count"))


def _by_value(src: Inputs, column: str) -> DataFrame:
    return ingest.repair(ingest.accepted(src.parsed("part"))).groupBy(column).agg(
        F.count("*").alias("row_count")
    )


def _by_value_sql(column: str) -> str:
    return sql(f"SELECT {column}, count(*) AS row_count FROM staged GROUP BY {column}", "staged")


@query("ingest_fix_discount", _by_value_sql("discount_pct"))
def ingest_fix_discount(src: Inputs) -> DataFrame:
    return _by_value(src, "discount_pct")


@query("ingest_fix_units", _by_value_sql("units_sold"))
def ingest_fix_units(src: Inputs) -> DataFrame:
    return _by_value(src, "units_sold")


@query("ingest_fix_cost", _by_value_sql("cost"))
def ingest_fix_cost(src: Inputs) -> DataFrame:
    return _by_value(src, "cost")


@query(
    "ingest_titlecase",
    sql(f"""SELECT {sql_title_case('trim(region)')} AS region,
        {sql_title_case('trim(channel)')} AS channel,
        {sql_title_case('trim(product_name)')} AS product_name, count(*) AS row_count
        FROM raw GROUP BY ALL""", "raw"),
)
def ingest_titlecase(src: Inputs) -> DataFrame:
    names = ("region", "channel", "product_name")
    raw = src.sales_raw("customer", "part")
    return raw.groupBy(*(title_case(strip(F.col(c))).alias(c) for c in names)).agg(
        F.count("*").alias("row_count")
    )


@query(
    "ingest_strip",
    sql("""SELECT trim(region) AS region, trim(channel) AS channel,
        trim(customer_segment) AS customer_segment, count(*) AS row_count,
        count(nullif(trim(transaction_id), '')) AS with_id FROM raw GROUP BY ALL""", "raw"),
)
def ingest_strip(src: Inputs) -> DataFrame:
    clean = ingest.strip_text(src.sales_raw("customer"))
    return clean.groupBy("region", "channel", "customer_segment").agg(
        F.count("*").alias("row_count"),
        F.count(F.nullif("transaction_id", F.lit(""))).alias("with_id"),
    )


@query(
    "ingest_round2",
    sql("""SELECT transaction_id, unit_price, revenue, cost, discount_pct, l_partkey, l_suppkey
        FROM staged""", "staged"),
)
def ingest_round2(src: Inputs) -> DataFrame:
    fixed = ingest.repair(ingest.accepted(src.parsed("part")))
    return ingest.strip_text(fixed).select(
        "transaction_id", "unit_price", "revenue", "cost", "discount_pct", "l_partkey",
        "l_suppkey",
    )


@query(
    "ingest_lineage",
    sql("""SELECT 'CSV_LOAD' AS source_system, loaded_at, min(record_date) AS first_date,
        count(*) AS row_count FROM staged GROUP BY loaded_at""", "staged"),
)
def ingest_lineage(src: Inputs) -> DataFrame:
    return src.staged("part").groupBy("source_system", "loaded_at").agg(
        F.min("record_date").alias("first_date"), F.count("*").alias("row_count")
    )


@query(
    "ingest_counts",
    sql("""SELECT count(*) AS rows_read, count_if(NOT is_bad) AS rows_loaded,
        count_if(is_bad) AS rows_rejected,
        count_if(is_bad) - count_if(only_date) AS rows_rejected_strict,
        count_if(only_date) AS rows_invalid_date, count_if(NOT is_bad) > 0 AS success
        FROM (SELECT is_bad, coalesce(date IS NOT NULL AND record_date IS NULL
              AND transaction_id IS NOT NULL AND trim(transaction_id) <> ''
              AND revenue >= 0, false) AS only_date FROM tagged)""", "tagged"),
)
def ingest_counts(src: Inputs) -> DataFrame:
    return ingest.ingest_counts(src.parsed("part"))


@query("stg_sales", sql(f"SELECT {STAGED_SQL} FROM staged", "staged"))
def stg_sales(src: Inputs) -> DataFrame:
    return src.staged().select(*STAGED)


@query("dedup_keep_first", sql(f"SELECT {STAGED_SQL} FROM clean", "clean"))
def dedup_keep_first(src: Inputs) -> DataFrame:
    return src.clean().select(*STAGED)


@query(
    "dedup_drop_all",
    sql(f"""SELECT {STAGED_SQL} FROM (SELECT *, count(*) OVER (PARTITION BY transaction_id)
        AS copies FROM staged) WHERE copies = 1""", "staged"),
)
def dedup_drop_all(src: Inputs) -> DataFrame:
    return staging.drop_all_copies(src.staged().select(*STAGED))


@query(
    "stg_remove_invalid",
    sql("""SELECT record_date, count(*) AS row_count,
        cast(sum(revenue) AS decimal(38,6)) AS total_revenue FROM parsed
        WHERE transaction_id IS NOT NULL AND trim(transaction_id) <> ''
          AND record_date IS NOT NULL AND revenue >= 0 GROUP BY record_date""", "parsed"),
)
def stg_remove_invalid(src: Inputs) -> DataFrame:
    parsed = src.parsed("part")
    return staging.remove_invalid(parsed).groupBy("record_date").agg(
        F.count("*").alias("row_count"),
        F.sum("revenue").cast("decimal(38,6)").alias("total_revenue"),
    )


def _canonical_query(column: str) -> None:
    body = (
        f"SELECT {column}, count(*) AS row_count, "
        f"cast(sum(revenue) AS decimal(24,2)) AS total_revenue FROM staged GROUP BY {column}"
    )

    @query(f"stg_canonical_{column.removeprefix('customer_')}", sql(body, "staged"))
    def canonical(src: Inputs) -> DataFrame:
        dims = ("customer", "part") if column != "channel" else ("part",)
        return src.staged(*dims).groupBy(column).agg(
            F.count("*").alias("row_count"), F.sum("revenue").alias("total_revenue")
        )


for _column in ("region", "channel", "customer_segment"):
    _canonical_query(_column)


@query(
    "stg_summary",
    sql(f"""SELECT 'STAGING_SUMMARY' AS layer, count(*) AS total_rows,
        min(record_date) AS earliest_date, max(record_date) AS latest_date,
        cast(sum(revenue) AS decimal(24,2)) AS total_revenue,
        {mean('revenue', 2)} AS avg_revenue,
        count(DISTINCT region) AS region_count, count(DISTINCT product_name) AS product_count
        FROM clean""", "clean"),
)
def stg_summary(src: Inputs) -> DataFrame:
    return staging.staging_summary(src.clean("customer", "part"))




# Amounts of very different sizes, around and beyond what the staged columns hold.
_WIDE_SQL = """SELECT concat(l_orderkey, '-', l_linenumber) AS transaction_id,
    concat(cast(l_quantity AS int), repeat('0', cast(l_orderkey % 10 AS int))) AS units_sold,
    concat(cast(l_partkey AS bigint), repeat('9', cast(l_orderkey % 12 AS int)), '.995') AS revenue,
    concat('9', repeat('9', cast(l_suppkey % 13 AS int)), '.99', cast(l_linenumber % 10 AS int))
        AS cost FROM lineitem"""


def _beyond(column: str, kind: str) -> str:
    number = f"try_cast({column} AS decimal(30,6))"
    return f"{number} IS NOT NULL AND try_cast({number} AS {kind}) IS NULL"


@query("ingest_range_rejects", f"""SELECT reason, count(*) AS row_count FROM (
    SELECT unnest(list_filter([
        CASE WHEN {_beyond('units_sold', 'int')} THEN 'OUT_OF_RANGE_UNITS_SOLD' END,
        CASE WHEN {_beyond('revenue', 'decimal(14,2)')} THEN 'OUT_OF_RANGE_REVENUE' END,
        CASE WHEN {_beyond('cost', 'decimal(14,2)')} THEN 'OUT_OF_RANGE_COST' END],
        lambda x: x IS NOT NULL)) AS reason FROM ({_WIDE_SQL})) GROUP BY reason""")
def ingest_range_rejects(src: Inputs) -> DataFrame:
    lines = src.table("lineitem")

    def digits(digit: str, by: str, modulus: int):
        return F.repeat(F.lit(digit), (F.col(by) % modulus).cast("int"))

    raw = lines.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("transaction_id"),
        F.lit("2024-01-31").alias("date"),
        F.concat(F.col("l_quantity").cast("int").cast("string"), digits("0", "l_orderkey", 10))
        .alias("units_sold"),
        F.concat(F.col("l_partkey").cast("string"), digits("9", "l_orderkey", 12), F.lit(".995"))
        .alias("revenue"),
        F.concat(F.lit("9"), digits("9", "l_suppkey", 13), F.lit(".99"),
                 (F.col("l_linenumber") % 10).cast("int").cast("string")).alias("cost"),
    )
    bad = ingest.rejected(ingest.parse(raw))
    return bad.select(F.explode("reject_reasons").alias("reason")).groupBy("reason").agg(
        F.count("*").alias("row_count"))


@query("ingest_malformed_rows", """SELECT CASE WHEN l_orderkey % 50 IN (0, 1) THEN 'MALFORMED_ROW'
        ELSE 'loaded' END AS outcome, count(*) AS row_count FROM lineitem GROUP BY outcome""")
def ingest_malformed_rows(src: Inputs) -> DataFrame:
    """Lines with a field too many or too few, written and read as a sales file."""
    path = new_path(src.spark, "malformed")
    line = F.concat_ws(
        ",", F.col("l_orderkey").cast("string"), F.lit("2024-01-31"), *(F.lit("a") for _ in range(7)),
        *(F.lit("1") for _ in range(4)))
    end = F.when(F.col("l_orderkey") % 50 == 0, ",1,more").when(
        F.col("l_orderkey") % 50 == 1, "").otherwise(",1")
    lines = src.table("lineitem").select(F.concat(line, end).alias(",".join(RAW_SALES_COLUMNS)))
    lines.write.option("header", True).option("sep", "\u0001").option("quote", "").csv(path)
    parsed = ingest.parse(read_sales_csv(src.spark, path))
    loaded = ingest.accepted(parsed).select(F.lit("loaded").alias("outcome"))
    bad = ingest.rejected(parsed).select(F.explode("reject_reasons").alias("outcome"))
    return loaded.union(bad).groupBy("outcome").agg(F.count("*").alias("row_count"))
