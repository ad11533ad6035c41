"""Every query that has SQL must give the same rows as DuckDB on the smallest scale."""

import pytest

import __spark_entry__ as entry
from tests.compare import connect, mismatch

FOLDER = "/root/testdata/sf0.001"
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, duck, name):
    assert mismatch(entry.queries()[name](spark, FOLDER), duck, SQL[name]) is None


def test_sql_only_for_registered_queries():
    assert set(SQL) <= set(entry.queries())


def test_entry_has_rows(spark):
    assert entry.entry(spark).limit(1).count() == 1
