from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from conftest import GOOD_ROWS, PLAIN, one, rows
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tallyline.functions.text import strip, title_case
from tallyline.operators import ingest
from tallyline.schemas import RAW_SALES, RAW_SALES_COLUMNS
from tallyline.sources.sales_csv import read_sales_csv, require_columns


def staged(raw_df):
    return ingest.to_staging(ingest.parse(raw_df), loaded_at=dt.datetime(2024, 1, 1))


def test_good_rows_pass(spark):
    raw = spark.createDataFrame(GOOD_ROWS, RAW_SALES)
    assert staged(raw).count() == 3
    assert ingest.rejected(ingest.parse(raw)).count() == 0


@pytest.mark.parametrize(
    "change, reason",
    [
        ({"transaction_id": None}, "NULL_TRANSACTION_ID"),
        ({"transaction_id": " \t"}, "BLANK_TRANSACTION_ID"),
        ({"date": None}, "NULL_DATE"),
        ({"date": "not-a-date"}, "INVALID_DATE"),
        ({"revenue": "n/a"}, "NULL_REVENUE"),
        ({"revenue": "inf"}, "NULL_REVENUE"),
        ({"revenue": "-500"}, "NEGATIVE_REVENUE"),
        ({"revenue": "-0.001"}, "NEGATIVE_REVENUE"),
        ({"revenue": "1e13"}, "OUT_OF_RANGE_REVENUE"),
        ({"cost": "-1e12"}, "OUT_OF_RANGE_COST"),
        ({"units_sold": "2147483648"}, "OUT_OF_RANGE_UNITS_SOLD"),
        ({"revenue": "999999999999.995"}, "OUT_OF_RANGE_REVENUE"),
        ({"cost": "999999999999.995"}, "OUT_OF_RANGE_COST"),
        ({"unit_price": "9999999999.995"}, "OUT_OF_RANGE_UNIT_PRICE"),
    ],
)
def test_rejects_name_their_reason(raw, change, reason):
    parsed = ingest.parse(raw(change, {}))
    assert rows(ingest.rejected(parsed), "reject_reasons") == [([reason],)]
    assert ingest.accepted(parsed).count() == 1


def test_a_row_lists_all_reasons(raw):
    parsed = ingest.parse(raw({"transaction_id": None, "date": None, "revenue": "-1"}))
    (reasons,) = one(ingest.rejected(parsed).select("reject_reasons"))
    assert reasons == ["NULL_TRANSACTION_ID", "NULL_DATE", "NEGATIVE_REVENUE"]


def test_repairs(raw):
    out = staged(raw(
        {"transaction_id": "a", "discount_pct": "150", "units_sold": None, "cost": None},
        {"transaction_id": "b", "discount_pct": "-10", "units_sold": "0", "cost": "-3"},
        {"transaction_id": "c", "discount_pct": "x", "units_sold": "2.9", "cost": " 12 "},
        {"transaction_id": "d", "discount_pct": "7.005", "units_sold": "1e3", "revenue": "1e3"},
    )).orderBy("transaction_id")
    assert rows(out, "discount_pct", "units_sold", "cost") == [
        (Decimal("100.00"), 1, Decimal("0.00")),
        (Decimal("0.00"), 1, Decimal("-3.00")),
        (Decimal("0.00"), 2, Decimal("12.00")),
        (Decimal("7.01"), 1000, Decimal("40.25")),
    ]


def test_categories_are_standardised(raw):
    out = staged(raw(
        {"transaction_id": "a", "region": " north ", "channel": "DIRECT",
         "customer_segment": "smb"},
        {"transaction_id": "b", "region": "\tnorth-east", "channel": "o'brien",
         "customer_segment": " public SECTOR "},
        {"transaction_id": "c", "region": None, "channel": None, "customer_segment": None},
    )).orderBy("transaction_id")
    assert rows(out, "region", "channel", "customer_segment") == [
        ("North", "Direct", "SMB"),
        ("North-East", "O'Brien", "public SECTOR"),
        (None, None, None),
    ]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(alphabet="abcXYZ -'09_.", max_size=12), min_size=1, max_size=20))
def test_title_case_is_pythons(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert rows(df.select("t", title_case(F.col("t")))) == [(t, t.title()) for t in texts]


def test_strip_takes_every_blank(spark):
    df = spark.createDataFrame([(" \t\n\r\f\va b\n",)], "t string")
    assert one(df.select(strip(F.col("t"))))[0] == "a b"


def test_lineage(raw):
    row = one(staged(raw({})))
    assert row.source_system == "CSV_LOAD"
    assert row.loaded_at == dt.datetime(2024, 1, 1)


def test_counts_add_up(raw):
    counts = one(ingest.ingest_counts(ingest.parse(raw(
        {}, {"date": "31/31"}, {"revenue": "-1"}, {"revenue": "-1", "date": "?"}, {},
    ))))
    assert counts.asDict() == {
        "rows_read": 5, "rows_loaded": 2, "rows_rejected": 3, "rows_rejected_strict": 2,
        "rows_invalid_date": 1, "success": True,
    }


def test_no_rows_loaded_is_no_success(raw):
    assert one(ingest.ingest_counts(ingest.parse(raw({"date": None})))).success is False


def test_missing_columns_raise_without_a_job(spark):
    raw = spark.createDataFrame(GOOD_ROWS, RAW_SALES).drop("revenue")
    with pytest.raises(ValueError, match="Missing required columns.*revenue"):
        require_columns(raw)
    assert len(RAW_SALES_COLUMNS) == 14


def test_csv_reading(spark, tmp_path):
    path = tmp_path / "sales.csv"
    names = list(RAW_SALES_COLUMNS)
    moved = names[1:] + names[:1] + ["extra"]
    values = {n: v for n, v in zip(names, GOOD_ROWS[0])} | {"extra": "x"}
    values |= {"product_name": '"Desk, 5"" wide"', "cost": "NA", "channel": "", "region": "None"}
    path.write_text(",".join(moved) + "\n" + ",".join(values[c] for c in moved) + "\n")
    row = one(require_columns(read_sales_csv(spark, str(path))))
    assert row.product_name == 'Desk, 5" wide'
    assert (row.cost, row.channel, row.region) == (None, None, None)
    assert row.transaction_id == PLAIN["transaction_id"] and row.extra == "x"


def test_amounts_at_the_edge_are_loaded(raw):
    out = one(staged(raw({
        "units_sold": "2147483647", "revenue": "999999999999.99", "cost": "999999999999.994",
        "unit_price": "9999999999.99"})))
    assert (out.units_sold, out.revenue) == (2147483647, Decimal("999999999999.99"))
    assert (out.cost, out.unit_price) == (Decimal("999999999999.99"), Decimal("9999999999.99"))


def test_date_forms_are_tried_in_order(raw):
    df = raw(*({"transaction_id": t, "date": d} for t, d in (
        ("a", "2021-03-04"), ("b", "03/04/2021"), ("c", "20210304"), ("d", "4 Mar 2021"),
        ("e", "13/13/2021"))))
    parsed = ingest.parse(df, ("dd/MM/yyyy", "MM/dd/yyyy", "yyyyMMdd", "d MMM yyyy"))
    got = dict(rows(parsed, "transaction_id", "record_date"))
    assert got == {
        "a": dt.date(2021, 3, 4), "b": dt.date(2021, 4, 3), "c": dt.date(2021, 3, 4),
        "d": dt.date(2021, 3, 4), "e": None}
    assert dict(rows(ingest.parse(df), "transaction_id", "record_date"))["b"] is None


def write_lines(path, *rows_):
    path.write_text("\n".join(",".join(r) for r in rows_) + "\n")


def test_files_with_other_headers_fail(spark, tmp_path):
    names = list(RAW_SALES_COLUMNS)
    write_lines(tmp_path / "a.csv", names, GOOD_ROWS[0])
    write_lines(tmp_path / "b.csv", names, GOOD_ROWS[1])
    assert read_sales_csv(spark, str(tmp_path / "*.csv")).count() == 2
    moved = [*names[:-3], names[-2], names[-3], names[-1]]
    write_lines(tmp_path / "c.csv", moved, GOOD_ROWS[2])
    with pytest.raises(Exception, match="(?i)header"):
        read_sales_csv(spark, str(tmp_path / "*.csv")).collect()


def test_malformed_rows_are_rejected(spark, tmp_path):
    long, short = (*GOOD_ROWS[1], "surplus"), GOOD_ROWS[2][:-2]
    write_lines(tmp_path / "a.csv", RAW_SALES_COLUMNS, GOOD_ROWS[0], long, short)
    parsed = ingest.parse(read_sales_csv(spark, str(tmp_path / "a.csv")))
    assert rows(ingest.accepted(parsed), "transaction_id") == [(PLAIN["transaction_id"],)]
    assert rows(ingest.rejected(parsed), "reject_reasons") == [(["MALFORMED_ROW"],)] * 2
    counts = one(ingest.ingest_counts(parsed))
    assert (counts.rows_read, counts.rows_loaded, counts.rows_rejected) == (3, 1, 2)


def test_missing_file(spark, tmp_path):
    with pytest.raises(AnalysisException):
        read_sales_csv(spark, str(tmp_path / "none.csv"))


def test_accepting_reads_each_value_once(spark):
    """A filter that is moved below the parse would read every value again for each mention."""
    raw = spark.range(4).select(
        F.concat(F.lit("T"), F.col("id")).alias("transaction_id"),
        F.when(F.col("id") == 0, "x").otherwise("2024-01-01").alias("date"),
        F.col("id").cast("string").alias("units_sold"),
        F.when(F.col("id") == 1, "-1").otherwise(F.concat(F.col("id"), F.lit(".005"))).alias("revenue"),
    )
    good = ingest.accepted(ingest.parse(raw))
    plan = good._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("as decimal(30,6))") == 2
    assert sorted(r.transaction_id for r in good.collect()) == ["T2", "T3"]
    assert good.columns == ingest.parse(raw).columns
