from __future__ import annotations

import datetime as dt

import pytest
from conftest import SALES, one, rows, staged_frame
from pyspark.sql import functions as F

from tallyline.operators import ingest, quality, staging
from tallyline.schemas import ColumnCheck
from tallyline.settings import Settings
from tallyline.plans.jobs import clean_staging

COPIES = [("a", 1, "x"), ("a", 2, "y"), ("a", 3, "z"), ("b", 1, "b"), (None, 1, "n"),
          (None, 2, "m")]


@pytest.fixture
def copies(spark):
    return spark.createDataFrame(COPIES, "transaction_id string, loaded_at int, tag string")


def test_keep_first(copies):
    out = staging.deduplicate(copies.filter("transaction_id IS NOT NULL"))
    assert sorted(rows(out)) == [("a", 1, "x"), ("b", 1, "b")]


def test_drop_all_keeps_rows_without_key(copies):
    out = staging.deduplicate(copies, "drop_all")
    assert sorted(rows(out, "tag")) == [("b",), ("m",), ("n",)]


def test_unknown_policy(copies):
    with pytest.raises(ValueError):
        staging.deduplicate(copies, "keep_last")


def test_keep_first_limits_groups_before_the_shuffle(spark, copies):
    df = staging.keep_first(copies)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert plan.index("Final") < plan.index("Exchange") < plan.rindex("Partial")


def test_hot_key_gives_one_row(spark):
    df = spark.range(200_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias(
            "transaction_id"
        ),
        F.col("id").alias("loaded_at"),
    )
    first = staging.keep_first(df).filter("transaction_id = 'hot'")
    assert rows(first) == [("hot", 0)]
    assert staging.drop_all_copies(df).filter("transaction_id = 'hot'").count() == 0


def test_duplicate_count_includes_missing_ids(copies):
    assert tuple(one(quality.duplicate_ids(copies))) == (6, 4)


def test_remove_invalid(spark):
    bad = [
        (None, *SALES[0][1:]), (" ", *SALES[0][1:]), ("x", None, *SALES[0][2:]),
        ("y", *SALES[0][1:11], None, *SALES[0][12:]), ("z", *SALES[0][1:11], "-1", *SALES[0][12:]),
    ]
    df = staged_frame(spark, [*SALES, *bad])
    assert staging.remove_invalid(df).count() == len(SALES)


@pytest.mark.parametrize("policy, left", [("keep_first", len(SALES)), ("drop_all", len(SALES) - 1)])
def test_clean_staging(spark, policy, left):
    again = (*SALES[0][:4], " NORTH", *SALES[0][5:])
    df = staged_frame(spark, [*SALES, again, (None, *SALES[1][1:])])
    df = df.withColumn("loaded_at", F.lit(dt.datetime(2024, 1, 1)))
    out = clean_staging(df, Settings(dedup=policy))
    assert out.count() == left
    assert out.filter("region = ' NORTH'").count() == 0


def test_check_report(spark):
    df = staged_frame(spark, [*SALES, SALES[0]])
    report = dict(rows(quality.check_report(df)))
    assert report.pop("DUPLICATE_TXN_IDS") == 1
    assert set(report.values()) == {0} and len(report) == 7


def test_report_reads_its_input_once(staged):
    plan = quality.check_report(staged)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") + plan.count("LocalRelation") == 1


def test_constraints(spark, staged):
    checks = (ColumnCheck("product_name", max_len=5), ColumnCheck("revenue", digits=3))
    found = dict(rows(quality.constraint_violations(staged, checks)))
    assert found == {
        "product_name:not_null": 0, "product_name:max_len_5": 1,
        "revenue:not_null": 0, "revenue:digits_3": 1,
    }


def test_repeated_keys(staged):
    assert rows(quality.repeated_keys(staged, ["customer_id"])) == [("C1", 2)]


def test_validation_results(raw):
    parsed = ingest.parse(raw(
        {}, {"discount_pct": "101"}, {"discount_pct": "-1", "units_sold": "2.5"}, {"cost": None},
        {"region": " WEST"}, {"channel": "fax"}, {"transaction_id": None, "cost": None},
        {"revenue": "-1", "date": None}, {"customer_segment": "consumer"}, {"cost": "40.254"},
    ))
    found = {r.check_name: (r.rows_affected, r.action_taken, r.result)
             for r in quality.validation_results(parsed).collect()}
    assert set(found) == {
        *(f"reject {name}" for name in ingest.reject_tests(parsed)),
        *(f"repair {name}" for name in (*ingest.REPAIRS, *ingest.STANDARDISED))}
    assert found["reject NULL_TRANSACTION_ID"] == (1, "row rejected", "REJECTED")
    assert found["reject NEGATIVE_REVENUE"] == found["reject NULL_DATE"] == (1, "row rejected", "REJECTED")
    assert found["reject NULL_REVENUE"] == (0, "row rejected", "CLEAN")
    # Rejected rows are not repaired, and rounding is no repair.
    assert found["repair cost"] == (1, "value replaced", "REPAIRED")
    assert found["repair discount_pct"] == (2, "value replaced", "REPAIRED")
    assert found["repair units_sold"] == (1, "value replaced", "REPAIRED")
    assert found["repair region"] == (1, "spelling replaced", "REPAIRED")
    assert found["repair channel"] == (1, "spelling replaced", "UNKNOWN VALUES")
    assert found["repair customer_segment"] == (1, "spelling replaced", "REPAIRED")


def test_profile(raw):
    parsed = ingest.parse(raw({}, {"cost": None}, {"cost": "x"}, {}))
    assert dict(rows(quality.null_counts(parsed, ["cost", "revenue"]))) == {
        "cost": 2, "revenue": 0}
    done = dict(rows(quality.completeness(parsed, ["cost", "revenue"])))
    assert (float(done["cost"]), float(done["revenue"])) == (50.0, 100.0)


def test_quality_score_of_nothing_is_null(raw):
    counts = ingest.ingest_counts(ingest.parse(raw({}).limit(0)))
    assert one(quality.quality_score(counts)).quality_score_pct is None


def test_staging_summary(staged):
    row = one(staging.staging_summary(staged))
    assert (row.total_rows, row.region_count, row.product_count) == (8, 5, 5)
    assert float(row.total_revenue) == 2925.0 and float(row.avg_revenue) == 365.63
    empty = one(staging.staging_summary(staged.limit(0)))
    assert (empty.total_rows, empty.total_revenue) == (0, None)
