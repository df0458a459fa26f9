"""Registration, and the shared inputs of the named queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallyline.operators import anomalies, core, ingest, marts, runlog, staging
from tallyline.session import compile_wide_projections
from tallyline.sources.tables import stage_table
from tallyline.sources.warehouse import LOAD_ORDER, TEST_DOMAINS, Warehouse

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

ANOMALY_INPUT = (
    "transaction_id", "txn_date", "product_name", "product_category", "region", "revenue",
    "cost", "discount_pct",
)


class Inputs(Warehouse):
    """The layers of the sales chain, derived from the test tables."""

    def core(self, *dimensions: str) -> DataFrame:
        """Core fact over the typed sales, with the columns of the named dimensions."""
        return core.enrich(self.sales(*dimensions))

    def cube(self) -> DataFrame:
        """Revenue cube over the typed sales, staged for the marts that share it."""
        return stage_table(marts.revenue_cube(self.core("customer", "part")), "cube")

    def parsed(self, *dimensions: str) -> DataFrame:
        return ingest.parse(self.sales_raw(*dimensions))

    def staged(self, *dimensions: str) -> DataFrame:
        return ingest.to_staging(self.parsed(*dimensions), TEST_DOMAINS)

    def clean(self, *dimensions: str) -> DataFrame:
        return staging.keep_first(self.staged(*dimensions), order=LOAD_ORDER)

    def clean_core(self, *columns: str, dimensions: tuple[str, ...] = ()) -> DataFrame:
        """Core fact over the cleaned raw sales, staged because detection reads it twice."""
        fact = core.enrich(self.clean(*dimensions))
        return stage_table(fact.select(*columns) if columns else fact, "core")

    def anomaly_core(self) -> DataFrame:
        return self.clean_core(*ANOMALY_INPUT, dimensions=("customer", "part"))

    def nothing_to_flag(self) -> DataFrame:
        """The input of detection without a row; filtered before it is staged."""
        fact = core.enrich(self.clean("customer", "part")).select(*ANOMALY_INPUT)
        return stage_table(fact.filter("revenue < 0"), "core")

    def anomalies(self) -> DataFrame:
        return anomalies.detect_all(self.anomaly_core())

    def timed_log(self) -> DataFrame:
        return runlog.with_duration(self.run_log())


def query(name: str, sql: str | None = None):
    """Register a function of ``Inputs`` under ``name``, with the SQL it must equal."""

    def register(make: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")

        def run(spark: SparkSession, folder: str) -> DataFrame:
            compile_wide_projections(spark)
            return make(Inputs(spark, folder))

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return make

    return register
