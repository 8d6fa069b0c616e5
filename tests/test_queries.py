"""Every checked query against its DuckDB oracle, on the smallest tables."""

import collections
import datetime as dt
import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from lakestrata.plans.registry import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "events customer orders".split()


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return str(v)


def bag(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return collections.Counter(tuple(norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF, t + '.parquet')}')")
    return c


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["date", "deviceid", "NullCount", "NegCount", "ZeroCount", "LargeCount", "TotalCount"]
    assert df.count() > 0


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    sql = E.oracle_sql().get(name)
    assert sql is not None, "every query here has an oracle"
    res = con.execute(sql)
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    assert bag(df.columns, rows) == bag(ocols, res.fetchall())
