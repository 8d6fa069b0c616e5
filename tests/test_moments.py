"""Moments per partition, combined, against one pass over all rows."""

import math
import random

from pyspark.sql import functions as F

from lakestrata.operators import gold, moments

SCHEMA = "day int, name string, x double, k long"


def rows(shift=0.0):
    rng = random.Random(1)
    out = [(rng.choice([1, 2, 3, None]), rng.choice("ab"), rng.choice([None, rng.gauss(0, 5) + shift]), rng.randint(-9, 9)) for _ in range(400)]
    return [*out, (4, "a", None, None), (5, "b", 2.5, 1)]


def near(a, b):
    return a == b or (a is not None and b is not None and math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9))


def test_combined_moments_equal_one_pass(spark):
    for shift in (0.0, 1e9):  # large values keep their digits
        df = spark.createDataFrame(rows(shift), SCHEMA)
        parts = moments.moments(df, ["day", "name"])
        for keys in ([], ["name"], ["day"]):
            got = {(*(r[k] for k in keys), r["column"]): r for r in moments.describe(parts, keys).collect()}
            for c in ("x", "k"):
                want = df.groupBy(*keys).agg(F.count(c).alias("count"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("stddev"), F.min(c).cast("double").alias("min"), F.max(c).cast("double").alias("max")).collect()
                for w in want:
                    key = (*(w[k] for k in keys), c)
                    if not w["count"]:
                        assert key not in got
                        continue
                    assert got[key]["count"] == w["count"]
                    assert all(near(got[key][m], w[m]) for m in ("mean", "min", "max"))
                    assert (w["stddev"] is None and got[key]["stddev"] is None) or math.isclose(got[key]["stddev"], w["stddev"], rel_tol=1e-6)


def test_every_numeric_column_is_summarised(spark):
    df = spark.createDataFrame(rows(), SCHEMA).withColumns({"d": F.col("k").cast("decimal(10,2)"), "f": F.col("x").cast("float"), "t": F.lit("text")})
    assert moments.numeric_columns(df, ["day"]) == ["x", "k", "d", "f"]
    out = gold.means(df, ["day", "name"])
    assert out.columns == ["day", "name", "avg_x", "avg_k", "avg_d", "avg_f"]
    assert moments.moments(df.limit(0), ["day"]).count() == 0


def test_changed_partitions_are_computed_anew(spark):
    """Replacing one partition's moments equals a full scan of the changed rows."""
    data = rows()
    old = moments.moments(spark.createDataFrame(data, SCHEMA), ["day"])
    changed = [r if r[0] != 2 else (2, r[1], 100.0, 7) for r in data]
    new = moments.moments(spark.createDataFrame([r for r in changed if r[0] == 2], SCHEMA), ["day"])
    both = old.where("day IS DISTINCT FROM 2").unionByName(new)
    full = moments.moments(spark.createDataFrame(changed, SCHEMA), ["day"])
    as_text = lambda df: sorted(str([round(v, 6) if isinstance(v, float) else v for v in r]) for r in moments.describe(df).collect())
    assert as_text(both) == as_text(full)
