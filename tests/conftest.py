from __future__ import annotations

import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tallyline.schemas import RAW_SALES  # noqa: E402
from tallyline.session import local_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "tests", memory="6g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


# Accepted without a repair: what a rule needs is changed in one column at a time.
PLAIN = dict(
    transaction_id="P-1", date="2019-10-05", product_name="Gravel", product_category="Bulk",
    region="West", sales_rep="Q. Ferro", customer_id="c/77", customer_segment="Consumer",
    channel="Partner", units_sold="12", unit_price="3.5", revenue="42", cost="40.25",
    discount_pct="1.5")
VARIANTS = (
    {}, {"transaction_id": "P-2", "units_sold": "1", "discount_pct": "0"},
    {"transaction_id": "P-3", "cost": "0", "revenue": "0", "region": "International"},
)
GOOD_ROWS = [tuple((PLAIN | v)[c] for c in RAW_SALES.fieldNames()) for v in VARIANTS]


def raw_row(**changes):
    names = RAW_SALES.fieldNames()
    row = dict(zip(names, GOOD_ROWS[0]))
    row.update(changes)
    return tuple(row[n] for n in names)


@pytest.fixture
def raw(spark):
    """Raw sales from dictionaries of changes to one good row."""

    def make(*changes):
        return spark.createDataFrame([raw_row(**c) for c in changes], RAW_SALES)

    return make


STAGED_COLUMNS = (
    "transaction_id string, record_date date, product_name string, product_category string, "
    "region string, sales_rep string, customer_id string, customer_segment string, "
    "channel string, units_sold int, unit_price decimal(12,2), revenue decimal(14,2), "
    "cost decimal(14,2), discount_pct decimal(6,2)"
)
# One staged row per rule: first and last days of a year and a quarter, a leap day, a loss, a row
# without revenue, one that breaks even, a discount, a tie of two products, a month before a gap.
SALES = [
    ("first-day", "2019-01-01", "Paper", "Office", "North", "Ann", "C1", "SMB", "Online",
     4, "25", "100", "60", "0"),
    ("same-month", "2019-01-31", "Ink", "Office", "South", "Bo", "C2", "SMB", "Partner",
     1, "250", "250", "100", "0"),
    ("loss", "2019-03-31", "Paper", "Office", "North", "Cy", "C3", "SMB", "Partner",
     2, "25", "50", "80", "0"),
    ("leap-day", "2020-02-29", "Chair", "Rooms", "West", "Ann", "C1", "Enterprise", "Direct",
     3, "300", "900", "300", "20"),
    ("product-again", "2020-02-01", "Chair", "Rooms", "West", "Bo", "C4", "Enterprise", "Online",
     1, "300", "300", "100", "0"),
    ("free", "2020-06-30", "Sample", "Office", "East", "Cy", "C5", "Consumer", "Online",
     1, "0", "0", "5", "0"),
    ("break-even", "2020-12-31", "Desk", "Rooms", "International", "Dee", "C6", "Enterprise",
     "Partner", 1, "1200", "1200", "1200", "0"),
    ("region-again", "2020-12-01", "Ink", "Office", "South", "Bo", "C7", "SMB", "Partner",
     1, "125", "125", "25", "0"),
]


def staged_frame(spark, rows):
    from decimal import Decimal

    typed = [
        (r[0], dt.date.fromisoformat(r[1]) if r[1] else None, *r[2:10],
         *(None if v is None else Decimal(v) for v in r[10:]))
        for r in rows
    ]
    return spark.createDataFrame(typed, STAGED_COLUMNS)


@pytest.fixture(scope="session")
def staged(spark):
    return staged_frame(spark, SALES)


def rows(df, *columns):
    return [tuple(r) for r in (df.select(*columns) if columns else df).collect()]


def one(df):
    (row,) = df.collect()
    return row
