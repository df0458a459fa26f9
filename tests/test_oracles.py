"""Every named query against its SQL in DuckDB, value by value."""

from __future__ import annotations

import os
import sys

import pytest
from conftest import SF

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(__file__)), "tools"))

from check_queries import connect, spark_type, table_of  # noqa: E402

from __spark_entry__ import entry, oracle_sql, queries  # noqa: E402
from tallyline.registry import ORACLES, QUERIES  # noqa: E402


@pytest.fixture(scope="session")
def duck():
    return connect(SF)


def test_every_query_of_the_registry_has_its_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(queries()) and set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, duck, name):
    df = queries()[name](spark, SF)
    got = table_of(df.columns, [tuple(r) for r in df.collect()])
    result = duck.execute(oracle_sql()[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == sorted(df.columns)
    assert got == table_of(names, result.fetchall())
    types = {d[0]: str(d[1]) for d in result.description}
    assert {c: spark_type(t) for c, t in df.dtypes} == types
