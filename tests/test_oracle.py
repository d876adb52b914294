"""Every registered query against its SQL counterpart in DuckDB on the same files."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as registered
import oracle_queries

TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
KEYS = list(registered._core_queries())
SLOW = ("train_forest", "train_gbt", "train_all", "grid_search_forest", "ml_run", "ml_pipeline")


def _normal(value):
    return repr(value + 0.0 if isinstance(value, float) and value == 0 else value)


def _compare(spark, folder, key):
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        con.sql(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    result = registered.queries()[key](spark, folder)
    expected = con.sql(oracle_queries.all_queries()[key])
    names = sorted(result.columns)
    assert names == sorted(expected.columns)
    kinds = dict(zip(expected.columns, map(str, expected.types)))
    assert {n: TYPES[t] for n, t in result.dtypes} == kinds
    got = sorted(tuple(_normal(row[n]) for n in names) for row in result.collect())
    at = [expected.columns.index(n) for n in names]
    want = sorted(tuple(_normal(row[i]) for i in at) for row in expected.fetchall())
    assert got == want


def test_every_query_has_an_oracle():
    assert set(KEYS) == set(oracle_queries.all_queries())


@pytest.mark.parametrize("key", [k for k in KEYS if k not in SLOW])
def test_query_matches_sql(spark, sf_check, key):
    _compare(spark, sf_check, key)


@pytest.mark.slow
@pytest.mark.parametrize("key", SLOW)
def test_slow_query_matches_sql(spark, sf_check, key):
    _compare(spark, sf_check, key)


def test_entry(spark):
    result = registered.entry(spark)
    assert result.columns == ["hour_of_day", "total_transactions", "fraud_count", "fraud_rate_pct"]
    assert result.count() == 24
