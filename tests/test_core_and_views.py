from __future__ import annotations

from decimal import Decimal as D

import pytest
from conftest import SALES, one, rows, staged_frame
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyline import schemas
from tallyline.functions.numbers import quotient
from tallyline.functions.ranking import rank_descending
from tallyline.operators import core, kpis, marts, views


@pytest.fixture(scope="session")
def fact(staged):
    return core.enrich(staged).cache()


@pytest.fixture(scope="session")
def monthly(fact):
    return marts.monthly_revenue(fact)


def test_enrichment(fact):
    by_id = {r.transaction_id: r for r in fact.collect()}
    assert len(by_id) == len(SALES)
    for name, year, quarter, label in (
        ("first-day", 2019, 1, "2019-01"), ("leap-day", 2020, 1, "2020-02"),
        ("free", 2020, 2, "2020-06"), ("break-even", 2020, 4, "2020-12"),
    ):
        row = by_id[name]
        assert (row.txn_year, row.txn_quarter, row.txn_month_label) == (year, quarter, label)
    assert by_id["leap-day"].discount_amount == D("180.00")
    margins = {n: (by_id[n].gross_profit, by_id[n].profit_margin, by_id[n].is_profitable)
               for n in ("first-day", "loss", "free", "break-even")}
    assert margins == {
        "first-day": (D("40"), D("0.4"), 1), "loss": (D("-30"), D("-0.6"), 0),
        "free": (D("-5"), D("0"), 0), "break-even": (D("0"), D("0"), 0)}


def test_margin_extremes(spark):
    df = staged_frame(spark, [
        ("a", *SALES[0][1:11], "1", "500", "0"), ("b", *SALES[0][1:11], "0", "5", "0"),
        ("c", *SALES[0][1:11], "0.01", "999999999999", "0"),
    ])
    margins = dict(rows(core.enrich(df), "transaction_id", "profit_margin"))
    assert margins["a"] == D("-499") and margins["b"] == 0
    assert margins["c"] == D("-99999999999899")


def test_rows_without_key_fields_are_left_out(spark):
    df = staged_frame(spark, [SALES[0], (None, *SALES[0][1:]), ("x", None, *SALES[0][2:])])
    assert core.enrich(df).count() == 1


def test_marts_keep_totals(fact, monthly):
    want = one(fact.agg(F.sum("revenue"), F.count("*")))
    for mart in (monthly, marts.regional_summary(fact), marts.product_summary(fact)):
        got = one(mart.agg(F.sum("total_revenue"), F.sum("transaction_count")))
        assert tuple(got) == tuple(want)
    assert sorted(rows(monthly, "month_label")) == [
        ("2019-01",), ("2019-03",), ("2020-02",), ("2020-06",), ("2020-12",)]


def test_marts_from_the_cube_are_the_same(fact):
    cube = marts.revenue_cube(fact)
    for name, direct in marts.all_marts(fact).items():
        rolled = marts.all_marts(cube)[name]
        assert sorted(rows(rolled)) == sorted(rows(direct)), name
        assert rolled.dtypes == direct.dtypes


def test_tables_have_their_declared_types(fact):
    def types(schema):
        return [(f.name, f.dataType) for f in schema.fields]

    assert types(fact.schema) == types(schemas.CORE_SALES)
    declared = {
        "rpt_monthly_revenue": schemas.MONTHLY_REVENUE,
        "rpt_regional_summary": schemas.REGIONAL_SUMMARY,
        "rpt_product_summary": schemas.PRODUCT_SUMMARY,
    }
    for name, df in marts.all_marts(fact).items():
        assert types(df.schema) == types(declared[name]), name


def test_month_growth_skips_gaps(monthly):
    growth = dict(rows(views.revenue_trends(monthly), "month_label", "mom_growth_pct"))
    assert growth["2019-01"] is None
    assert growth["2019-03"] == D("-85.71")  # against January, the last month with rows
    assert growth["2020-06"] == D("-100.00") and growth["2020-12"] is None  # after no revenue


def test_year_to_date(monthly):
    ytd = dict(rows(views.revenue_trends(monthly), "month_label", "ytd_revenue"))
    assert ytd["2019-03"] == D("400.00") and ytd["2020-02"] == D("1200.00")
    assert ytd["2020-12"] == D("2525.00")


MART = (
    "month_label string, txn_year int, txn_month int, total_revenue decimal(24,2), "
    "total_cost decimal(24,2), total_gross_profit decimal(25,2), "
    "avg_profit_margin decimal(24,6), transaction_count long, units_sold long"
)


def test_growth_without_prior(spark):
    def line(label, revenue):
        return (label, int(label[:4]), int(label[5:]), D(revenue), D(1), D(1), D("0.5"), 1, 1)

    mart = spark.createDataFrame(
        [line("2021-01", 0), line("2022-01", 100), line("2024-01", 50), line("2025-01", 75)], MART
    )
    got = {r.month_label: (r.mom_growth_pct, r.yoy_growth_pct)
           for r in views.revenue_trends(mart).collect()}
    assert got["2022-01"] == (None, None)  # the prior revenue is zero
    assert got["2024-01"] == (D("-50.00"), None)  # no row for 2023
    assert got["2025-01"] == (D("50.00"), D("50.00"))


def test_tied_reps_repeat_the_region(spark):
    tied = ("tied", *SALES[0][1:5], "Zoe", *SALES[0][6:])
    fact = core.enrich(staged_frame(spark, [SALES[0], tied]))
    view = views.regional_performance(marts.regional_summary(fact), fact)
    assert sorted(rows(view, "region", "top_sales_rep")) == [("North", "Ann"), ("North", "Zoe")]


def test_shares_add_up(fact):
    view = views.regional_performance(marts.regional_summary(fact), fact)
    for year, share in rows(view.groupBy("txn_year").agg(F.sum("region_revenue_share_pct"))):
        assert abs(share - 100) < D("0.1"), year


def test_product_ranks(fact):
    ranks = rows(views.product_analysis(fact).filter("txn_year = 2020"), "product_name",
                 "overall_rank", "rank_in_category")
    assert sorted(ranks) == [("Chair", 1, 1), ("Desk", 1, 1), ("Ink", 3, 1), ("Sample", 4, 2)]


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.integers(-50, 50)),
                min_size=1, max_size=60))
def test_split_ranks_equal_plain_ranks(spark, pairs):
    df = spark.createDataFrame([(g, D(v).scaleb(-1)) for g, v in pairs], "g string, v decimal(9,1)")
    plain = df.withColumn("r", F.rank().over(Window.partitionBy("g").orderBy(F.desc("v"))))
    split = rank_descending(df, ["g"], "v", "r")
    assert sorted(map(str, rows(split))) == sorted(map(str, rows(plain)))


def test_group_limit_for_top_reps(fact):
    plan = views.top_reps(fact)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_orphans(fact):
    regional = marts.regional_summary(fact).filter("region <> 'South'")
    found = views.orphan_counts(fact, {"regional": (regional, ["region", "txn_year"])})
    assert rows(found) == [("regional", 2)]


def test_kpis(fact, monthly):
    assert one(kpis.profit_margin(fact)).profit_margin_pct == D("36.07")
    growth = one(kpis.yoy_growth(fact))
    assert (growth.current_year, growth.yoy_growth_pct) == (2020, D("531.25"))
    assert one(kpis.data_freshness(fact))[0] == "Data as of: 2020-12-31"
    assert one(kpis.totals(monthly)).total_revenue == D("2925.00")
    assert rows(kpis.quarterly_revenue_wide(monthly).orderBy("txn_year"))[1] == (
        2020, D("1200.00"), D("0.00"), None, D("1325.00"))
    shares = dict(rows(kpis.segment_share(fact), "customer_segment", "revenue_share_pct"))
    assert shares["Enterprise"] == D("82.05") and shares["Consumer"] == 0


def test_annual_kpis_count_years_without_findings(spark, fact):
    none = spark.createDataFrame([], "txn_date date")
    table = kpis.annual_kpis(fact, none).orderBy("txn_year").collect()
    assert [r.anomaly_count for r in table] == [0, 0]
    assert table[0].transactions_change is None and table[1].transactions_change == 2


def test_regional_table_has_a_total(fact):
    table = {r.region: r for r in kpis.regional_table(fact, 2020).collect()}
    assert table["TOTAL"].total_revenue == D("2525.00")
    assert table["TOTAL"].revenue_share_pct == 100
    assert table["North"].total_revenue is None and table["South"].yoy_growth_pct == D("-50.00")


def test_executive_summary_is_in_year_order(fact):
    table = rows(kpis.executive_summary(core.annual_core(fact)), "txn_year", "yoy_growth_pct")
    assert table == [(2019, None), (2020, D("531.3"))]


def test_slices_reach_the_scan(spark, fact, tmp_path):
    path = str(tmp_path / "core")
    fact.write.parquet(path)
    df = kpis.kpi_set(kpis.sliced(spark.read.parquet(path), txn_year=2020, channel="Direct"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(txn_year,2020)" in plan and "product_name" not in plan
    assert one(df).transactions == 1


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.integers(-10**9, 10**9), st.integers(-10**6, 10**6)),
                min_size=1, max_size=30))
def test_quotient_is_exact(spark, pairs):
    df = spark.createDataFrame(
        [(D(n).scaleb(-2), d) for n, d in pairs], "n decimal(14,2), d long"
    )
    got = rows(df.select("n", "d", quotient(F.col("n"), F.col("d"), 4)))
    for n, d, value in got:
        if d == 0:
            assert value is None
        else:
            scaled = abs(int(n * 100)) * 100
            whole = (2 * scaled + abs(d)) // (2 * abs(d))
            sign = -1 if (n < 0) != (d < 0) else 1
            assert value == D(sign * whole).scaleb(-4)
