"""Every registered query with SQL against DuckDB."""

import pytest

import __spark_entry__ as entry
from tests.oracle import compare, connect


@pytest.fixture(scope="module")
def duck(medium):
    return connect(medium)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_equals_sql(spark, duck, medium, name):
    difference = compare(spark, duck, entry.queries()[name], entry.oracle_sql()[name], medium)
    assert difference is None, difference


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_flagship(spark):
    rows = entry.entry(spark).collect()
    assert [r["pickup_hour"] for r in rows] == list(range(24))
