"""Every registered query against its SQL, on the smallest tables."""

import glob

import pytest

import __spark_entry__ as entry
from check_oracle import compare, duck

SMALL = "/root/testdata/sf0.001"
# The queries of the llm subpackage have their tests in tests/llm.
QUERIES, SQL = entry.QUERIES, entry.ORACLE


@pytest.fixture(scope="module")
def con():
    if not glob.glob(f"{SMALL}/*.parquet"):
        pytest.skip("no test tables")
    return duck(SMALL)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    problem, rows = compare(spark, con, SMALL, QUERIES[name], SQL.get(name))
    assert problem is None
    assert rows > 0 or name == "missing_splits"


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["metric", "field", "correct", "denom", "pct"] and df.count() == 12
