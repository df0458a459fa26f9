from __future__ import annotations

import datetime as dt
from decimal import Decimal as D

import numpy as np
import pandas as pd
import pytest
from conftest import one, rows

from tallyline.operators import anomalies, kpis, views
from tallyline.schemas import ANOMALIES
from tallyline.settings import AnomalySettings

COLUMNS = (
    "transaction_id string, txn_date date, product_name string, product_category string, "
    "region string, revenue decimal(14,2), cost decimal(14,2), discount_pct decimal(6,2)"
)


def fact(spark, revenue, cost=None, discount=None, category=None, ids=None):
    n = len(revenue)
    cost = [100] * n if cost is None else cost
    discount = [5] * n if discount is None else discount
    category = ["Electronics"] * n if category is None else category
    ids = [f"TXN-{i:05d}" for i in range(n)] if ids is None else ids
    return spark.createDataFrame(
        [(ids[i], dt.date(2023, 6, 15), "Laptop", category[i], "North",
          D(str(round(float(revenue[i]), 2))), D(str(round(float(cost[i]), 2))),
          D(str(round(float(discount[i]), 2)))) for i in range(n)],
        COLUMNS,
    )


@pytest.fixture(scope="session")
def normal():
    rng = np.random.RandomState(7)
    return rng.normal(5000, 500, 100), rng.uniform(0, 20, 100)


def flagged(df):
    return sorted(rows(df, "transaction_id", "anomaly_type"))


def test_high_revenue(spark, normal):
    revenue = normal[0].copy()
    revenue[:3] = 50000, 55000, 60000
    found = anomalies.detect_zscore(fact(spark, revenue), "revenue")
    assert flagged(found) == [(f"TXN-0000{i}", "HIGH_REVENUE") for i in range(3)]
    assert all(r.revenue_zscore > 2.5 and r.cost_zscore is None for r in found.collect())


def test_low_revenue_and_cost(spark, normal):
    low = np.append(normal[0][:50], 5.0)
    found = anomalies.detect_zscore(fact(spark, low), "revenue")
    assert flagged(found) == [("TXN-00050", "LOW_REVENUE")]
    found = anomalies.detect_zscore(fact(spark, [9] * 51, cost=low), "cost")
    assert flagged(found) == [("TXN-00050", "LOW_COST")]


@pytest.mark.parametrize("values", [[7.0] * 10, [0.0] * 10, [5.0]])
def test_no_deviation_no_flags(spark, values):
    assert anomalies.detect_all(fact(spark, values)).count() == 0


def test_scores_match_pandas(spark, normal):
    category = ["A", "B"] * 50
    revenue = normal[0].round(2)
    revenue[[4, 5]] = 9000, 1000
    found = anomalies.detect_zscore(fact(spark, revenue, category=category), "revenue", 2.0)
    frame = pd.DataFrame({"c": category, "v": revenue})
    z = (frame.v - frame.groupby("c").v.transform("mean")) / frame.groupby("c").v.transform("std")
    want = sorted(
        (f"TXN-{i:05d}", round(float(v), 4)) for i, v in z.items() if abs(v) > 2.0
    )
    got = sorted(rows(found, "transaction_id", "revenue_zscore"))
    assert [i for i, _ in got] == [i for i, _ in want] and len(got) >= 2
    assert [v for _, v in got] == pytest.approx([v for _, v in want], abs=1e-4)


def test_iqr_matches_pandas(spark, normal):
    discount = normal[1].round(2)
    discount[0] = 99
    found = anomalies.detect_iqr(fact(spark, normal[0], discount=discount))
    assert flagged(found) == [("TXN-00000", "DISCOUNT_OUTLIER")]
    q1, q3 = pd.Series(discount).quantile([0.25, 0.75])
    limits = one(anomalies.fences(fact(spark, normal[0], discount=discount), "discount_pct", 1.5))
    assert limits.lower == pytest.approx(q1 - 1.5 * (q3 - q1))
    assert limits.upper == pytest.approx(q3 + 1.5 * (q3 - q1))


def test_approximate_fences_are_close(spark, normal):
    df = fact(spark, normal[0], discount=normal[1])
    exact, near = (one(anomalies.quartiles(df, "revenue", a)) for a in (False, True))
    assert near.q1 == pytest.approx(exact.q1, rel=0.02)


def test_one_finding_per_transaction(spark, normal):
    revenue, cost, discount = normal[0].copy(), normal[0].copy(), [5.0] * 99 + [80.0]
    revenue[0], cost[0], cost[99] = 60000, 60000, 60000
    found = anomalies.detect_all(fact(spark, revenue, cost, discount))
    assert flagged(found) == [("TXN-00000", "HIGH_REVENUE"), ("TXN-00099", "HIGH_COST")]


def test_strongest_of_repeated_ids(spark, normal):
    revenue = normal[0].copy()
    revenue[0], revenue[1] = 50000, 60000
    ids = ["same", "same", *(f"t{i}" for i in range(98))]
    found = anomalies.detect_all(fact(spark, revenue, ids=ids))
    assert rows(found, "transaction_id", "revenue") == [("same", D("60000.00"))]


def test_parameters(spark, normal):
    df = fact(spark, normal[0], normal[0] / 2, normal[1])
    strict, loose = (
        anomalies.detect_all(df, AnomalySettings(zscore_threshold=t)).count() for t in (3.0, 1.5)
    )
    assert loose > strict
    only_cost = anomalies.detect_all(df, AnomalySettings(1.0, columns=("cost",)))
    assert {t for _, t in flagged(only_cost)} <= {"HIGH_COST", "LOW_COST", "DISCOUNT_OUTLIER"}


def test_empty_fact(spark):
    found = anomalies.detect_all(fact(spark, []))
    assert found.count() == 0 and found.columns == ANOMALIES.fieldNames()
    report = kpis.report_anomalies(found)
    assert rows(report, "message", "transaction_id") == [("No anomalies detected.", None)]
    assert one(anomalies.anomaly_rate(fact(spark, []), found)).anomaly_rate_pct is None


def test_report_without_notice(spark, normal):
    revenue = normal[0].copy()
    revenue[0] = 60000
    report = kpis.report_anomalies(anomalies.detect_all(fact(spark, revenue)))
    assert rows(report, "message", "transaction_id") == [(None, "TXN-00000")]


def test_small_statistics_are_broadcast_by_size(spark, normal):
    df = anomalies.with_zscores(fact(spark, normal[0]), ["revenue"])
    assert "BroadcastHashJoin" in df._jdf.queryExecution().executedPlan().toString()


def test_large_statistics_are_not_broadcast(spark):
    """Many categories: the join is shuffled, the result the same."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    category = [f"c{i // 20}" for i in range(400)]
    revenue = [10.0 + i % 2 for i in range(400)]
    revenue[7] = 99
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        found = anomalies.detect_zscore(fact(spark, revenue, category=category), "revenue")
        assert flagged(found) == [("TXN-00007", "HIGH_REVENUE")]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_month_without_findings_counts_zero(spark, normal):
    from tallyline.functions.calendar import month_label
    from pyspark.sql import functions as F

    df = fact(spark, normal[0]).withColumns({
        "txn_year": F.year("txn_date"), "txn_month": F.month("txn_date"),
        "txn_month_label": month_label(F.col("txn_date")),
    })
    band = one(views.anomaly_band(df, anomalies.empty_anomalies(df)))
    assert (band.anomaly_count, band.anomalous_revenue) == (0, 0)
    single = one(views.monthly_stats(df.limit(1)))
    assert single.stddev_revenue is None and single.lower_bound_2sd == single.avg_revenue
