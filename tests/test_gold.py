"""One-aggregation gold against the literal five-aggregate / four-join form."""

import datetime as dt
import random

from lakestrata.operators import gold

D1, D2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
EDGE = [0.0, -0.0, 100000.0, 100000.5, float("nan"), -1.0, None, 5.5, 250000.0]


def readings_df(spark, rows):
    return spark.createDataFrame(rows, "date date, deviceid string, runninghour double")


def fixture_rows(seed=7, n=3000):
    rnd = random.Random(seed)
    rows = []
    for _ in range(n):
        date = rnd.choice([D1, D2, None])
        dev = rnd.choice(["a", "b", "c", None])
        v = rnd.choice(EDGE + [rnd.uniform(-10, 200000) for _ in range(3)])
        rows.append((date, dev, v))
    rows.append((D1, "only-null", None))
    return rows


def as_set(df):
    cols = sorted(df.columns)
    return {tuple(str(r[c]) for c in cols) for r in df.collect()}


def test_counts_equal_join_form(spark):
    df = readings_df(spark, fixture_rows())
    assert as_set(gold.counts(df)) == as_set(gold.counts_join_form(df))


def test_null_not_zero_and_null_keys(spark):
    df = readings_df(spark, [(D1, "x", 5.0), (None, "x", -1.0), (D1, None, 0.0)])
    out = {(r["date"], r["deviceid"]): r for r in gold.counts(df).collect()}
    assert out[(D1, "x")]["NegCount"] is None and out[(D1, "x")]["TotalCount"] == 1
    # a NULL key never matches in the join form: counts NULL, total kept
    assert out[(None, "x")]["NegCount"] is None and out[(None, "x")]["TotalCount"] == 1
    assert out[(D1, None)]["ZeroCount"] is None


def test_class_rows_unpivot_equals_groupby(spark):
    df = readings_df(spark, fixture_rows(11))
    direct = gold.class_rows(df)
    unpivot = gold.class_rows_from_daily(gold.daily_counts(df)).select(*direct.columns)
    assert as_set(direct) == as_set(unpivot)


def test_severity_table_and_summaries(spark):
    df = readings_df(spark, fixture_rows(3, 500))
    sev = gold.severity(gold.class_rows_from_daily(gold.daily_counts(df)), "2024-01-31")
    assert sev.columns == ["date", "deviceid", "valuetype", "count", "severity", "severity_moy"]
    means = gold.severity_means(sev)
    assert means.columns == ["date", "deviceid", "avg_count", "avg_severity", "avg_severity_moy"]
    summary = [r["summary"] for r in gold.severity_describe(sev).collect()]
    assert summary == ["count", "mean", "stddev", "min", "max"]


def test_percent_keeps_null(spark):
    df = readings_df(spark, [(D1, "x", 5.0), (D1, "x", -1.0)])
    r = gold.percent(gold.counts(df)).first()
    assert r["NegPercent"] == 50.0 and r["NullPercent"] is None
