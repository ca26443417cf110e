"""The driver contract: entry, queries and oracle SQL, checked against DuckDB at sf0.001."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
import check_oracle

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


def test_entry_returns_rows(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["symbol", "date", "open", "high", "low", "close", "adj_close", "volume"]


#: The corpus queries have their own tests, beside their subpackage.
CORE = sorted(set(entry.queries()) - set(entry.LLM_QUERIES))


def test_every_query_has_an_oracle():
    assert set(CORE) == set(entry.oracle_sql()) - set(entry.LLM_QUERIES)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in check_oracle.TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


# Operators that must never appear: all-pairs joins and row-at-a-time Python.
FORBIDDEN = ("BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython", "ArrowEvalPython")


@pytest.mark.parametrize("name", CORE)
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    got = df.toPandas()
    want = duck.execute(entry.oracle_sql()[name]).df()
    assert check_oracle._rows(got) == check_oracle._rows(want)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [op for op in FORBIDDEN if op in plan]
