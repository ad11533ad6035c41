"""More rows a day than on the given scales: a column that most days lack then must stay where SQL names it."""

from datetime import datetime

import pytest

import __spark_entry__ as entry
from tests.compare import connect, mismatch
from panelcraft.operators import clean

DAYS, CUSTOMERS = 12, 40


@pytest.fixture(scope="module")
def dense(spark, tmp_path_factory):
    """A debtor among the customers of every day but the first: gdp_per_capita is missing on 11 of 12 days."""
    folder = str(tmp_path_factory.mktemp("dense"))
    day = lambda d: datetime(1996, 1, 1 + d)
    tables = {
        "nation": ([(0, "N")], "n_nationkey int, n_name string"),
        "customer": ([(c, 0, -5.0 if c == 0 else 10.0 * c) for c in range(CUSTOMERS)], "c_custkey long, c_nationkey int, c_acctbal double"),
        "supplier": ([(1, 0)], "s_suppkey long, s_nationkey int"),
        "orders": (
            [(d * CUSTOMERS + c, c, "OFP"[c % 3], 400.0 * (c + d + 1), day(d)) for d in range(DAYS) for c in range(CUSTOMERS) if c or d],
            "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp",
        ),
        "lineitem": (
            [(1, "ANR"[i % 3], float(i % 7 + 1), i, day(d)) for d in range(DAYS) for i in range(9)],
            "l_suppkey long, l_returnflag string, l_quantity double, l_linenumber int, l_shipdate timestamp",
        ),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/{name}.parquet")
    return folder


@pytest.fixture(scope="module")
def duck(dense):
    con = connect("/root/testdata/sf0.001")
    for name in ("nation", "customer", "supplier", "orders", "lineitem"):
        con.execute(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM '{dense}/{name}.parquet/*.parquet'")
    return con


@pytest.mark.parametrize("name", ["j4_integrate", "f12_engineer_features", "f13_regression_rows", "g1_data_engineering"])
def test_sparse_column_that_sql_names(spark, dense, duck, name):
    assert mismatch(entry.queries()[name](spark, dense), duck, entry.oracle_sql()[name]) is None


def test_kept_columns_are_not_sparse():
    counts = {"": 10, "a": 9, "b": 9, "c": 1}
    assert clean.sparse_columns(counts) == ["a", "b"] and clean.sparse_columns(counts, keep=["b", "z"]) == ["a"]
