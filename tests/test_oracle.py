"""Every driver query against its DuckDB SQL on the sf0.001 tables.

The same comparison the driver makes (row count, column names, sorted
values)."""

import datetime as dt
import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from wattgrid.plans.catalog import QUERIES
from wattgrid.plans.oracle import SQL

SF = "/root/testdata/sf0.001"
TABLES = ["part", "events", "lineitem"]

pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="driver tables missing")


def norm(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    return v


def key(row):
    return tuple((0, "") if x is None else (1, str(x)) for x in row)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(E.queries()) and set(SQL) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, con, name):
    df = E.queries()[name](spark, SF)
    cols = df.columns
    got = [tuple(norm(r[c]) for c in sorted(cols)) for r in df.collect()]
    cur = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    assert sorted(cols) == sorted(ocols)
    order = sorted(range(len(ocols)), key=lambda i: ocols[i])
    exp = [tuple(norm(r[i]) for i in order) for r in cur.fetchall()]
    assert len(got) == len(exp)
    assert sorted(got, key=key) == sorted(exp, key=key)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "hour_sin" in df.columns
