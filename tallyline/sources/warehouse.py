"""Sales, operational-metric and run-log inputs derived from the TPC-H-like test tables.

Dimensions are attached by left joins, so a fact row without its dimension is kept and
shows up in the quality checks. Only the dimensions a query asks for are joined: Spark
cannot drop an unused outer join by itself, because it does not know the keys are unique.
The customer chain is joined onto ``orders`` first, which is a quarter of the fact, so the
fact itself is shuffled once per remaining large dimension and once for ``orders``. No broadcast
is hinted: region and nation, and any dimension under the broadcast threshold, are broadcast by
size.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.settings import Domains

# Columns of the test tables.
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, "
    "value double, props string",
}
DIMENSIONS = ("customer", "part", "supplier")

# Domain values of the test tables, passed where the default domains would be.
TEST_DOMAINS = Domains(
    regions=("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"),
    channels=("Direct", "Partner", "Online"),
    segments=("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"),
    categories=("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"),
)
# Later-loaded copies of a transaction lose; the other columns settle equal load times.
LOAD_ORDER = ("loaded_at", "l_partkey", "l_suppkey", "revenue", "units_sold")
# Types of those that are not staging columns; a written file has them as text.
LOAD_TYPES = {"l_partkey": "long", "l_suppkey": "long"}


class Warehouse:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def table(self, name: str) -> DataFrame:
        """A test table. Its schema is declared, so building a plan runs no job."""
        return self.spark.read.schema(TABLES[name]).parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def _orders(self) -> DataFrame:
        return self.table("orders").select("o_orderkey", "o_custkey", "o_orderdate")

    def _orders_with_customer(self) -> DataFrame:
        place = self.table("nation").join(
            self.table("region"), F.col("n_regionkey") == F.col("r_regionkey"), "left"
        )
        customer = (
            self.table("customer")
            .select("c_custkey", "c_nationkey", "c_mktsegment")
            .join(place, F.col("c_nationkey") == F.col("n_nationkey"), "left")
            .select("c_custkey", "c_mktsegment", "r_name")
        )
        return self._orders.join(customer, F.col("o_custkey") == F.col("c_custkey"), "left")

    def _fact(self, dimensions: Iterable[str]) -> DataFrame:
        wanted = set(dimensions)
        unknown = wanted - set(DIMENSIONS)
        if unknown:
            raise ValueError(f"unknown dimensions: {sorted(unknown)}")
        fact = self.table("lineitem")
        if "part" in wanted:
            part = self.table("part").select("p_partkey", "p_name", "p_type", "p_retailprice")
            fact = fact.join(part, F.col("l_partkey") == F.col("p_partkey"), "left")
        orders = self._orders_with_customer() if "customer" in wanted else self._orders
        # Both sides grow with the data, so at size this is a sort-merge join in any case. The
        # hint keeps it one on small data too, where it spreads single-row-group files. After it
        # the lines of an order stay together, which shortens what is written and shuffled later.
        fact = fact.join(orders.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey"), "left")
        if "supplier" in wanted:
            supplier = self.table("supplier").select("s_suppkey", "s_name")
            fact = fact.join(supplier, F.col("l_suppkey") == F.col("s_suppkey"), "left")
        return fact

    @staticmethod
    def _dimension_columns(wanted: set[str]) -> dict[str, Column]:
        out: dict[str, Column] = {}
        if "part" in wanted:
            out["product_name"] = F.col("p_name")
            out["product_category"] = F.col("p_type")
            out["unit_price"] = F.col("p_retailprice").cast("decimal(12,2)")
        if "customer" in wanted:
            out["region"] = F.col("r_name")
            out["customer_id"] = F.concat(F.lit("CUST-"), F.col("c_custkey").cast("string"))
            out["customer_segment"] = F.col("c_mktsegment")
        if "supplier" in wanted:
            out["sales_rep"] = F.col("s_name")
        return out

    @staticmethod
    def _transaction_id() -> Column:
        return F.concat(
            F.lit("TXN-"), F.col("l_orderkey").cast("string"), F.lit("-"),
            F.col("l_linenumber").cast("string"),
        )

    @staticmethod
    def _money(factor: Column) -> tuple[Column, Column]:
        """Revenue and cost, with every input cast to decimal before it is multiplied."""
        discount = F.col("l_discount").cast("decimal(4,2)")
        price = F.col("l_extendedprice").cast("decimal(14,2)")
        revenue = price * (F.lit(1).cast("decimal(1,0)") - discount)
        cost = (
            F.col("p_retailprice").cast("decimal(12,2)")
            * F.col("l_quantity").cast("int").cast("decimal(10,0)")
            * F.lit("0.5").cast("decimal(2,1)")
        )
        return revenue * factor, cost

    def sales(self, *dimensions: str) -> DataFrame:
        """Typed clean sales with natural duplicate ids. ``part`` brings cost and price."""
        wanted = set(dimensions or DIMENSIONS)
        revenue, cost = self._money(F.lit(1).cast("decimal(1,0)"))
        channel = (
            F.when(F.col("l_returnflag") == "A", "Direct")
            .when(F.col("l_returnflag") == "N", "Partner")
            .otherwise("Online")
        )
        columns = {
            "transaction_id": self._transaction_id(),
            "record_date": F.col("o_orderdate").cast("date"),
            **self._dimension_columns(wanted),
            "channel": channel,
            "units_sold": F.col("l_quantity").cast("int"),
            "revenue": revenue.cast("decimal(14,2)"),
            "discount_pct": (
                F.col("l_discount").cast("decimal(4,2)") * F.lit(100).cast("decimal(3,0)")
            ).cast("decimal(6,2)"),
            "source_system": F.lit("CSV_LOAD"),
            "loaded_at": F.col("l_shipdate").cast("timestamp"),
            "l_partkey": F.col("l_partkey"),
            "l_suppkey": F.col("l_suppkey"),
        }
        if "part" in wanted:
            columns["cost"] = cost.cast("decimal(14,2)")
        return self._fact(wanted).select(*(c.alias(n) for n, c in columns.items()))

    def sales_raw(self, *dimensions: str) -> DataFrame:
        """The same sales as text, with faults and spikes placed by residues of the key."""
        wanted = set(dimensions or DIMENSIONS)
        key = F.col("l_orderkey")

        def on(divisor: int, rest: int) -> Column:
            return key % divisor == rest

        line = F.col("l_linenumber") % 3
        spiked = F.when(on(50, 7), F.lit("4.2").cast("decimal(2,1)")).otherwise(
            F.lit("1.0").cast("decimal(2,1)")
        )
        revenue, cost = self._money(spiked)
        revenue = revenue.cast("decimal(14,2)")
        cost_factor = F.when(
            (key % 100).isin(9, 57), F.lit("4.0").cast("decimal(2,1)")
        ).otherwise(F.lit("1.0").cast("decimal(2,1)"))
        columns = {
            "transaction_id": F.when(on(97, 3), F.lit(None).cast("string"))
            .when(on(89, 3), "  ")
            .otherwise(self._transaction_id()),
            "date": F.when(on(83, 3), F.lit(None).cast("string"))
            .when(on(79, 3), "not-a-date")
            .otherwise(F.col("o_orderdate").cast("date").cast("string")),
            **self._dimension_columns(wanted),
            "channel": F.when(F.col("l_returnflag") == "A", "direct")
            .when(F.col("l_returnflag") == "N", " PARTNER")
            .otherwise("Online"),
            "units_sold": F.when(on(61, 3), "0")
            .when(on(59, 3), F.lit(None).cast("string"))
            .otherwise(F.col("l_quantity").cast("int").cast("string")),
            "revenue": F.when(on(73, 3), "n/a")
            .when(on(71, 3), (-revenue).cast("string"))
            .otherwise(revenue.cast("string")),
            "discount_pct": F.when(on(53, 3), "150")
            .when(on(47, 3), "-5")
            .when(on(43, 3), "60")
            .otherwise(
                (F.col("l_discount").cast("decimal(4,2)") * F.lit(100).cast("decimal(3,0)"))
                .cast("decimal(6,2)")
                .cast("string")
            ),
            "loaded_at": F.col("l_shipdate").cast("timestamp"),
            "l_partkey": F.col("l_partkey"),
            "l_suppkey": F.col("l_suppkey"),
        }
        if "customer" in wanted:
            name = F.col("r_name")
            columns["region"] = (
                F.when(line == 0, F.upper(name))
                .when(line == 1, F.concat(F.lit("  "), F.lower(name)))
                .otherwise(F.concat(name, F.lit(" ")))
            )
        if "part" in wanted:
            columns["unit_price"] = columns["unit_price"].cast("string")
            columns["cost"] = F.when(on(67, 3), F.lit(None).cast("string")).otherwise(
                (cost * cost_factor).cast("decimal(14,2)").cast("string")
            )
        return self._fact(wanted).select(*(c.alias(n) for n, c in columns.items()))

    def op_metrics(self, with_gaps: bool = False) -> DataFrame:
        """Long-format metrics from the events; ``with_gaps`` blanks the large values."""
        value = F.col("value").cast("decimal(18,4)")
        if with_gaps:
            value = F.when(F.col("value") <= 100, value)
        return self.table("events").select(
            F.col("ts").cast("date").alias("record_date"),
            F.concat(F.lit("USER-"), F.col("user_id").cast("string")).alias("entity_id"),
            F.col("event_type").alias("metric_name"),
            value.alias("metric_value"),
            F.lit("EVENTS").alias("source_system"),
            F.col("ts").cast("timestamp").alias("loaded_at"),
            F.col("event_id").alias("staging_id"),
        )

    def run_log(self) -> DataFrame:
        """One finished run per event."""
        failed = F.col("event_type") == "error"
        stage = F.element_at(
            F.array(*(F.lit(s) for s in ("Extraction", "Staging", "Transformation", "Reporting"))),
            (F.col("user_id") % 4 + 1).cast("int"),
        )
        start = F.col("ts").cast("timestamp")
        seconds = F.floor("value").cast("int")
        return self.table("events").select(
            F.col("event_id").alias("log_id"),
            F.col("ts").cast("date").alias("run_date"),
            stage.alias("stage"),
            F.when(failed, "Failed").otherwise("Completed").alias("status"),
            F.when(failed, F.lit(None).cast("string"))
            .otherwise(F.concat(stage, F.lit(" complete")))
            .alias("message"),
            F.when(failed, F.lit(0).cast("long"))
            .otherwise(F.floor(F.col("value") * 100))
            .cast("long")
            .alias("records_processed"),
            start.alias("start_time"),
            F.timestamp_add("SECOND", seconds, start).alias("end_time"),
            F.when(failed, "run failed").alias("error_message"),
        )
