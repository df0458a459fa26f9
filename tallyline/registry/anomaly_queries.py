"""Outlier detection."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.operators import anomalies
from tallyline.registry.base import Inputs, query
from tallyline.registry.sql import pct, sql
from tallyline.settings import AnomalySettings

COLUMNS = (
    "transaction_id, txn_date, product_name, region, revenue, cost, revenue_zscore, "
    "cost_zscore, anomaly_type"
)


@query(
    "anomaly_zscore_revenue",
    sql(f"SELECT {COLUMNS} FROM findings WHERE place = 0", "findings"),
)
def anomaly_zscore_revenue(src: Inputs) -> DataFrame:
    return anomalies.detect_zscore(src.anomaly_core(), "revenue")


@query(
    "anomaly_zscore_cost",
    sql(f"SELECT {COLUMNS} FROM findings WHERE place = 1", "findings"),
)
def anomaly_zscore_cost(src: Inputs) -> DataFrame:
    return anomalies.detect_zscore(src.anomaly_core(), "cost")


@query(
    "anomaly_iqr_discount",
    sql(f"SELECT {COLUMNS} FROM findings WHERE place = 2", "findings"),
)
def anomaly_iqr_discount(src: Inputs) -> DataFrame:
    return anomalies.detect_iqr(src.anomaly_core())


@query("anomaly_fences", sql("SELECT lower, upper FROM fences", "fences"))
def anomaly_fences(src: Inputs) -> DataFrame:
    return anomalies.fences(src.anomaly_core(), "discount_pct", 1.5)


@query(
    "anomaly_group_stats",
    sql("""SELECT g AS product_category, round(rm, 4) AS revenue_mean, round(rs, 4) AS revenue_sd,
        round(cm, 4) AS cost_mean, round(cs, 4) AS cost_sd FROM stats""", "stats"),
)
def anomaly_group_stats(src: Inputs) -> DataFrame:
    stats = anomalies.category_stats(src.anomaly_core(), ("revenue", "cost"))
    return stats.select(
        F.col("_group").alias("product_category"),
        *(
            F.round(f"_{c}_{s}", 4).alias(f"{c}_{s}")
            for c in ("revenue", "cost")
            for s in ("mean", "sd")
        ),
    )


@query("rpt_anomalies", sql(f"SELECT {COLUMNS} FROM anomalies", "anomalies"))
def rpt_anomalies(src: Inputs) -> DataFrame:
    return src.anomalies()


@query(
    "anomaly_parameters",
    sql("""SELECT anomaly_type, count(*) AS anomaly_count FROM (
        SELECT CASE WHEN cz > 0 THEN 'HIGH_COST' ELSE 'LOW_COST' END AS anomaly_type
        FROM scored WHERE abs(cz) > 2
        UNION ALL SELECT 'DISCOUNT_OUTLIER' FROM scored,
            (SELECT q[1] - 3 * (q[2] - q[1]) AS lo, q[2] + 3 * (q[2] - q[1]) AS hi
             FROM (SELECT quantile_cont(cast(discount_pct AS double), [0.25, 0.75]) AS q
                   FROM clean_core))
        WHERE abs(cz) <= 2 AND (cast(discount_pct AS double) < lo
                                OR cast(discount_pct AS double) > hi))
        GROUP BY anomaly_type""", "scored"),
)
def anomaly_parameters(src: Inputs) -> DataFrame:
    """Other settings: costs only, two deviations, fences of three inter-quartile ranges."""
    settings = AnomalySettings(zscore_threshold=2.0, iqr_multiplier=3.0, columns=("cost",))
    found = anomalies.detect_all(src.anomaly_core(), settings)
    return found.groupBy("anomaly_type").agg(F.count("*").alias("anomaly_count"))


@query(
    "anomaly_empty_input",
    sql(f"SELECT {COLUMNS} FROM anomalies WHERE false", "anomalies"),
)
def anomaly_empty_input(src: Inputs) -> DataFrame:
    """Detection over a fact whose every row is filtered out: no rows, right columns."""
    return anomalies.detect_all(src.nothing_to_flag())


@query(
    "anomaly_summary",
    sql("""SELECT anomaly_type, count(*) AS anomaly_count,
        cast(sum(revenue) AS decimal(24,2)) AS total_revenue
        FROM anomalies GROUP BY anomaly_type""", "anomalies"),
)
def anomaly_summary(src: Inputs) -> DataFrame:
    return anomalies.anomaly_summary(src.anomalies())


@query(
    "anomaly_rate",
    sql(f"""SELECT *, {pct('anomalous_transactions', 'total_transactions', 4)}
            AS anomaly_rate_pct
        FROM (SELECT (SELECT count(*) FROM clean_core) AS total_transactions,
                     (SELECT count(*) FROM anomalies) AS anomalous_transactions)""",
        "anomalies"),
)
def anomaly_rate(src: Inputs) -> DataFrame:
    fact = src.anomaly_core()
    return anomalies.anomaly_rate(fact, anomalies.detect_all(fact))
