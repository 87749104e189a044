"""Registered queries beside their DuckDB statements, at the smallest size."""

import glob
import os

import duckdb
import pytest

import __spark_entry__
import quillon.queries as q

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for p in glob.glob(f"{SF}/*.parquet"):
        con.sql(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    return con


def plain(v):
    if v is None or v != v:
        return "-"
    if isinstance(v, float):
        return repr(round(v, 6) + 0.0)
    return str(v)


@pytest.mark.parametrize("name", sorted(q.SQL))
def test_equals_duckdb(spark, duck, name):
    df = q.QUERIES[name](spark, SF)
    got = duck.sql(q.SQL[name])
    cols = sorted(df.columns)
    assert cols == sorted(got.columns)
    a = sorted(tuple(plain(r[c]) for c in cols) for r in df.collect())
    b = sorted(tuple(plain(r[got.columns.index(c)]) for c in cols) for r in got.fetchall())
    assert a == b


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
