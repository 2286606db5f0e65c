"""Every query against its SQL in DuckDB, on the smallest tables."""

import glob
import os

import duckdb
import pytest

from __spark_entry__ import entry
from check_sql import comparable
from clicklake.plans.registry import QUERIES, SQL
from conftest import SMALL



@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in glob.glob(f"{SMALL}/*.parquet"):
        connection.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return connection


def test_all_have_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    kinds, rows = comparable(QUERIES[name](spark, SMALL).toArrow())
    want_kinds, want = comparable(duck.execute(SQL[name]).to_arrow_table())
    assert kinds == want_kinds
    assert rows == want


def test_entry(spark):
    result = entry(spark)
    assert result.columns == ["channel", "category", "distinctUserCount"]
    assert result.count() > 0


# Sorting queries, and the order their rows must come in.
ORDERS = {
    "sort_desc": "c_acctbal DESC, c_custkey",
    "sort_asc": "o_orderdate, o_orderkey",
    "limit_topk": "value DESC, event_id",
    "sort_by_value": "count, word",
    "sort_by_key_desc": "word DESC",
}


@pytest.mark.parametrize("name", sorted(ORDERS))
def test_order_of_rows(spark, duck, name):
    got = [tuple(row) for row in QUERIES[name](spark, SMALL).collect()]
    want = duck.execute(f"SELECT * FROM ({SQL[name]}) ORDER BY {ORDERS[name]}").fetchall()
    assert got == want


@pytest.mark.parametrize(
    "name, column, falling", [("sort_by_value", "count", False), ("sort_by_key_desc", "word", True), ("sort_desc", "c_acctbal", True)]
)
def test_direction_of_rows(spark, name, column, falling):
    values = [row[column] for row in QUERIES[name](spark, SMALL).collect()]
    keys = [v.encode() if isinstance(v, str) else v for v in values]
    assert len(set(keys)) > 10
    assert keys == sorted(keys, reverse=falling) and keys != sorted(keys, reverse=not falling)
