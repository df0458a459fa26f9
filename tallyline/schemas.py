"""Declared table schemas.

``SALES_CHECKS`` keeps the width limits the target tables put on each column, so that
``quality.constraint_violations`` can test a frame against them. Totals in the marts are
``decimal(24,2)``: the sum of ``decimal(14,2)`` needs the ten extra digits at large volumes.
Margins keep the six places of the old tables with room in front: a ratio has no upper bound.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

MONEY = T.DecimalType(14, 2)
PRICE = T.DecimalType(12, 2)
PERCENT = T.DecimalType(6, 2)
TOTAL = T.DecimalType(24, 2)
MARGIN = T.DecimalType(22, 6)
AVERAGE = T.DecimalType(24, 6)

# The columns a raw sales file must carry, in file order.
RAW_SALES_COLUMNS = (
    "transaction_id", "date", "product_name", "product_category", "region", "sales_rep",
    "customer_id", "customer_segment", "channel", "units_sold", "unit_price", "revenue",
    "cost", "discount_pct",
)
TEXT_COLUMNS = (
    "transaction_id", "product_name", "product_category", "region", "sales_rep",
    "customer_id", "customer_segment", "channel",
)
NUMERIC_COLUMNS = ("units_sold", "unit_price", "revenue", "cost", "discount_pct")
# Whole line of a raw row with more or fewer fields than the header, else NULL.
MALFORMED = "_malformed_row"


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in fields])


RAW_SALES = _struct(*((c, T.StringType()) for c in RAW_SALES_COLUMNS))

STAGED_SALES = _struct(
    ("transaction_id", T.StringType()),
    ("record_date", T.DateType()),
    ("product_name", T.StringType()),
    ("product_category", T.StringType()),
    ("region", T.StringType()),
    ("sales_rep", T.StringType()),
    ("customer_id", T.StringType()),
    ("customer_segment", T.StringType()),
    ("channel", T.StringType()),
    ("units_sold", T.IntegerType()),
    ("unit_price", PRICE),
    ("revenue", MONEY),
    ("cost", MONEY),
    ("discount_pct", PERCENT),
    ("source_system", T.StringType()),
    ("loaded_at", T.TimestampType()),
)

CORE_SALES = _struct(
    ("transaction_id", T.StringType()),
    ("txn_date", T.DateType()),
    ("txn_year", T.IntegerType()),
    ("txn_quarter", T.IntegerType()),
    ("txn_month", T.IntegerType()),
    ("txn_month_label", T.StringType()),
    ("product_name", T.StringType()),
    ("product_category", T.StringType()),
    ("region", T.StringType()),
    ("sales_rep", T.StringType()),
    ("customer_id", T.StringType()),
    ("customer_segment", T.StringType()),
    ("channel", T.StringType()),
    ("units_sold", T.IntegerType()),
    ("unit_price", PRICE),
    ("revenue", MONEY),
    ("cost", MONEY),
    ("gross_profit", T.DecimalType(15, 2)),
    ("profit_margin", MARGIN),
    ("discount_pct", PERCENT),
    ("discount_amount", T.DecimalType(24, 2)),
    ("is_profitable", T.IntegerType()),
)

MONTHLY_REVENUE = _struct(
    ("month_label", T.StringType()),
    ("txn_year", T.IntegerType()),
    ("txn_month", T.IntegerType()),
    ("total_revenue", TOTAL),
    ("total_cost", TOTAL),
    ("total_gross_profit", T.DecimalType(25, 2)),
    ("avg_profit_margin", AVERAGE),
    ("transaction_count", T.LongType()),
    ("units_sold", T.LongType()),
)

REGIONAL_SUMMARY = _struct(
    ("region", T.StringType()),
    ("txn_year", T.IntegerType()),
    ("total_revenue", TOTAL),
    ("total_cost", TOTAL),
    ("total_gross_profit", T.DecimalType(25, 2)),
    ("avg_profit_margin", AVERAGE),
    ("transaction_count", T.LongType()),
)

PRODUCT_SUMMARY = _struct(
    ("product_category", T.StringType()),
    ("product_name", T.StringType()),
    ("txn_year", T.IntegerType()),
    ("total_revenue", TOTAL),
    ("total_gross_profit", T.DecimalType(25, 2)),
    ("avg_profit_margin", AVERAGE),
    ("units_sold", T.LongType()),
    ("transaction_count", T.LongType()),
)

ANOMALIES = _struct(
    ("transaction_id", T.StringType()),
    ("txn_date", T.DateType()),
    ("product_name", T.StringType()),
    ("region", T.StringType()),
    ("revenue", MONEY),
    ("cost", MONEY),
    ("revenue_zscore", T.DoubleType()),
    ("cost_zscore", T.DoubleType()),
    ("anomaly_type", T.StringType()),
)

OPERATIONAL = _struct(
    ("record_date", T.DateType()),
    ("entity_id", T.StringType()),
    ("metric_name", T.StringType()),
    ("metric_value", T.DecimalType(18, 4)),
    ("source_system", T.StringType()),
    ("loaded_at", T.TimestampType()),
    ("staging_id", T.LongType()),
)

REPORTING_SUMMARY = _struct(
    ("report_date", T.DateType()),
    ("entity_id", T.StringType()),
    ("metric_name", T.StringType()),
    ("total_value", T.DecimalType(28, 4)),
    ("avg_value", T.DecimalType(24, 4)),
    ("record_count", T.LongType()),
)

RUN_LOG = _struct(
    ("log_id", T.LongType()),
    ("run_date", T.DateType()),
    ("stage", T.StringType()),
    ("status", T.StringType()),
    ("message", T.StringType()),
    ("records_processed", T.LongType()),
    ("start_time", T.TimestampType()),
    ("end_time", T.TimestampType()),
    ("error_message", T.StringType()),
)


@dataclass(frozen=True)
class ColumnCheck:
    """Limits on one column: ``max_len`` for text, ``digits`` whole digits for numbers."""

    name: str
    nullable: bool = False
    max_len: int | None = None
    digits: int | None = None


# Width limits of the staged sales columns.
SALES_CHECKS = (
    ColumnCheck("transaction_id", max_len=20),
    ColumnCheck("record_date"),
    ColumnCheck("product_name", max_len=100),
    ColumnCheck("product_category", max_len=50),
    ColumnCheck("region", max_len=50),
    ColumnCheck("sales_rep", max_len=100),
    ColumnCheck("customer_id", max_len=20),
    ColumnCheck("customer_segment", max_len=30),
    ColumnCheck("channel", max_len=30),
    ColumnCheck("units_sold", digits=10),
    ColumnCheck("unit_price", digits=10),
    ColumnCheck("revenue", digits=12),
    ColumnCheck("cost", digits=12),
    ColumnCheck("discount_pct", digits=4),
)

# Key of each table, for the uniqueness check.
TABLE_KEYS = {
    "stg_sales_raw": ("transaction_id",),
    "core_sales": ("transaction_id",),
    "rpt_monthly_revenue": ("month_label",),
    "rpt_regional_summary": ("region", "txn_year"),
    "rpt_product_summary": ("product_category", "product_name", "txn_year"),
    "rpt_anomalies": ("transaction_id",),
}
