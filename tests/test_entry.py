"""Every registered query over the smallest tables, those with SQL against DuckDB."""

import glob
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry

SMALL = entry.SMALL
pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for p in glob.glob(f"{SMALL}/*.parquet"):
        c.sql(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    return c


def normal(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    return v if v is None else str(v)


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted((tuple(normal(r[i]) for i in order) for r in rows), key=str)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, con, name):
    df = entry.queries()[name](spark, SMALL)
    rows = [tuple(r) for r in df.collect()]
    sql = entry.oracle_sql().get(name)
    if sql is not None:
        want = con.sql(sql)
        assert table(df.columns, rows) == table(want.columns, want.fetchall())


def test_names_match():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() == 1
