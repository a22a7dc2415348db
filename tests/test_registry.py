"""Registered queries against their SQL, on the smallest tables."""

import glob
import os

import duckdb
import pytest

from notice_engine import registry

DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in glob.glob(f"{DIR}/*.parquet"):
        c.sql(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return c


def rows_of(df):
    k = sorted(df.columns)
    return df[k].astype(str).sort_values(k).reset_index(drop=True)


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_same_rows_as_sql(spark, duck, name):
    got, want = registry.QUERIES[name](spark, DIR).toPandas(), duck.sql(registry.ORACLE_SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows_of(got).equals(rows_of(want))


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLE_SQL)))
def test_runs(spark, name):
    assert registry.QUERIES[name](spark, DIR).count() > 0


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
