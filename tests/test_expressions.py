"""Value classes and severity scores against numbers worked out by hand."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakestrata.functions import expressions as X

AS_OF = dt.date(2024, 1, 31)


CLASSES = ("normal", "large", "negative", "null", "zero")


def scores(spark, rows):
    """(s1, s2) of (age in days, class, count) rows, in order."""
    data = [(i, AS_OF - dt.timedelta(days=a), vt, n) for i, (a, vt, n) in enumerate(rows)]
    df = spark.createDataFrame(data, "i int, date date, valuetype string, count bigint")
    out = df.select(
        "i",
        X.severity_v1("count", "valuetype", "date", AS_OF).alias("s1"),
        X.severity_v2("count", "valuetype", "date", AS_OF).alias("s2"),
    )
    return [(r["s1"], r["s2"]) for r in out.orderBy("i").collect()]


def test_value_class_boundaries(spark):
    expected = [
        (0.0, "zero"), (-0.0, "zero"), (100000.0, "normal"), (100000.5, "large"), (float("nan"), "large"), (-1.0, "negative"),
        (None, "null"), (1.5, "normal"), (float("inf"), "large"), (-float("inf"), "negative"), (5e-324, "normal"), (-5e-324, "negative"),
    ]
    df = spark.createDataFrame([(v,) for v, _ in expected], T.StructType([T.StructField("v", T.DoubleType())]))
    assert [r["c"] for r in df.select(X.value_class("v").alias("c")).collect()] == [c for _, c in expected]


def test_severity_numbers(spark):
    """Scores worked out by hand: (age, class, count) -> (first score, second score)."""
    expected = {
        (0, "normal", 10): (17.0, 0.0),
        (0, "large", 2880): (4896.5, 50.0),
        (3, "negative", 2880): (4899.7, 50.0),
        (4, "negative", 2880): (4900.7, 75.0),
        (7, "zero", 1440): (2455.3, 30.0),
        (8, "zero", 1440): (2456.3, 36.0),
        (14, "null", 2880): (4910.3, 54.0),
        (15, "null", 2880): (4911.3, 60.0),
        (-1, "large", 288): (489.1, 5.0),
        (40, "large", 5760): (9832.5, 200.0),
        (0, "null", 48): (81.9, 0.0),
        (0, "null", 144): (245.1, 2.0),
        (15, "zero", 108): (198.9, 3.0),
    }
    got = scores(spark, list(expected))
    for key, (s1, s2) in zip(expected, got, strict=True):
        assert s1 == pytest.approx(expected[key][0], rel=1e-6), key
        assert s2 == expected[key][1], key


def test_second_score_rounds_half_to_even(spark):
    # 1 * 30 * 48 / 2880 = 0.5 and 1 * 30 * 144 / 2880 = 1.5, 240 rows: 2.5
    assert [s2 for _, s2 in scores(spark, [(0, "null", 48), (0, "null", 144), (0, "null", 240)])] == [0.0, 2.0, 2.0]


def test_severity_properties(spark):
    """Linear in the count, rising with age, ordered by class; not clamped at 100."""
    by_count = scores(spark, [(5, "large", n) for n in (2880, 5760, 11520)])
    assert [s2 for _, s2 in by_count] == [75.0, 150.0, 300.0]
    by_age = scores(spark, [(a, "negative", 2880) for a in range(-2, 60)])
    assert all(a[0] < b[0] and a[1] <= b[1] for a, b in zip(by_age, by_age[1:]))
    assert len({s2 for _, s2 in by_age}) == 4
    base = dict(zip(CLASSES, scores(spark, [(0, c, 2880) for c in CLASSES]), strict=True))
    assert base["normal"][0] < base["null"][0] == base["zero"][0] < base["large"][0] < base["negative"][0]
    assert base["normal"][1] < base["null"][1] < base["zero"][1] < base["large"][1] == base["negative"][1]


def test_severity_null_date(spark):
    df = spark.createDataFrame([(None, "large", 5)], "date date, valuetype string, count bigint")
    r = df.select(X.severity_v1("count", "valuetype", "date", AS_OF).alias("a"),
                  X.severity_v2("count", "valuetype", "date", AS_OF).alias("b")).first()
    assert r["a"] is None and r["b"] is None


def test_minutes_between_truncates(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 0, 59), dt.datetime(2024, 1, 1, 0, 2, 58))], "a timestamp, b timestamp")
    assert df.select(X.minutes_between("a", "b").alias("m")).first()["m"] == 1


def test_evaluate_once_keeps_filter_above_parse(spark):
    df = spark.createDataFrame([('{"a": 1}',), ("x",)], "body string")
    out = X.evaluate_once(df, {"j": F.from_json("body", "a int")}).filter(F.col("j.a").isNotNull())
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Filter") < plan.index("Generate")
    assert out.count() == 1


def test_severity_v0_time_of_day(spark):
    """By hand: 30 rows 11 days ago give 30 + weight + 11 + 21 + the squared distance from noon."""
    expected = [(12, "normal", 62.0), (0, "normal", 206.0), (23, "normal", 183.0), (12, "large", 62.5), (7, "null", 87.3)]
    rows = [(dt.datetime(2024, 1, 20, h, 30), vt, 30) for h, vt, _ in expected]
    df = spark.createDataFrame(rows, "ts timestamp, valuetype string, count bigint")
    got = [r["s"] for r in df.select(X.severity_v0("count", "valuetype", "ts", AS_OF).alias("s")).collect()]
    assert got == pytest.approx([s for *_, s in expected], rel=1e-6)


def test_field_text():
    from lakestrata.schemas import field_text
    assert field_text(T.StructField("X", T.DoubleType(), True)) == "StructField('X', DoubleType(), True)"
