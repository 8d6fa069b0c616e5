"""Gold: per device and day anomaly counts and severity scores.

Both gold outputs come from ONE aggregation over silver, keyed by
``(date, deviceid)``: a total, the four anomaly-predicate counts and the
four value-class counts (conditional counts, combined map-side before the
shuffle, so a device-day holding a third of all rows costs one partial
aggregate per task, not one hot reducer).  The anomaly counts table is a
projection of it; the severity rows are an unpivot of it.  The
four-left-join form is kept for parity checks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestrata.functions.expressions import (
    LARGE_THRESHOLD,
    ROWS_PER_DAY,
    severity_v1,
    severity_v2,
    value_class,
)
from lakestrata.operators.moments import numeric_columns

KEYS = ("date", "deviceid")


def readings(silver: DataFrame, field: str = "RUNNINGHR") -> DataFrame:
    """``(date, deviceid, runninghour)`` from a silver table; only 3 columns are read."""
    return silver.select(
        F.col("Device_Date").alias("date"),
        F.col("DeviceId").alias("deviceid"),
        F.col(field).alias("runninghour"),
    )


def _predicates(v: Column, large_threshold: float) -> dict[str, Column]:
    return {
        "NullCount": v.isNull(),
        "NegCount": v < 0,
        "ZeroCount": v == 0,
        "LargeCount": v > F.lit(large_threshold),
    }


def daily_counts(readings_df: DataFrame, large_threshold: float = LARGE_THRESHOLD,
                 value_col: str = "runninghour") -> DataFrame:
    """One row per ``(date, deviceid)``: total, predicate counts, class counts.

    Null keys form their own groups, as in ``groupBy``.
    """
    v = F.col(value_col)
    cls = value_class(v, large_threshold)
    aggs = [F.count(F.lit(1)).alias("TotalCount")]
    aggs += [F.count_if(p).alias(f"n_{name}") for name, p in _predicates(v, large_threshold).items()]
    aggs += [F.count_if(cls == c).alias(f"c_{c}") for c in ("large", "zero", "negative", "null")]
    return readings_df.groupBy(*KEYS).agg(*aggs)


def counts_from_daily(daily: DataFrame) -> DataFrame:
    """Anomaly counts table: ``date, deviceid, NullCount, NegCount, ZeroCount, LargeCount, TotalCount``.

    A count is NULL (not 0) when no row qualifies, and all four are NULL for
    a group with a NULL key - exactly what the chained left joins give.
    """
    keyed = F.col("date").isNotNull() & F.col("deviceid").isNotNull()
    cols = [
        F.when(keyed, F.nullif(F.col(f"n_{name}"), F.lit(0))).alias(name)
        for name in ("NullCount", "NegCount", "ZeroCount", "LargeCount")
    ]
    return daily.select(*KEYS, *cols, "TotalCount")


def counts(readings_df: DataFrame, large_threshold: float = LARGE_THRESHOLD) -> DataFrame:
    return counts_from_daily(daily_counts(readings_df, large_threshold))


def counts_join_form(readings_df: DataFrame, large_threshold: float = LARGE_THRESHOLD) -> DataFrame:
    """The join form: totals left-joined with each anomaly's counts on (date, deviceid).

    All five sides are projections of one aggregation, whose shuffle they
    share; the joins need no other.
    """
    daily = daily_counts(readings_df, large_threshold)
    out = daily.select(*KEYS, "TotalCount")
    names = list(_predicates(F.col("runninghour"), large_threshold))
    for name in names:
        part = daily.filter(F.col(f"n_{name}") > 0).select(
            F.col("date").alias("_date"), F.col("deviceid").alias("_device"), F.col(f"n_{name}").alias(name))
        out = out.join(part, (F.col("date") == F.col("_date")) & (F.col("deviceid") == F.col("_device")), "left").drop("_date", "_device")
    return out.select(*KEYS, *names, "TotalCount")


def percent(counts_df: DataFrame) -> DataFrame:
    """Share of each anomaly class in the day's rows, in percent (NULL stays NULL)."""
    t = F.col("TotalCount")
    return counts_df.select(
        *KEYS,
        (F.col("NullCount") / t * 100).alias("NullPercent"),
        (F.col("NegCount") / t * 100).alias("NegPercent"),
        (F.col("ZeroCount") / t * 100).alias("ZeroPercent"),
        (F.col("LargeCount") / t * 100).alias("LargePercent"),
        t,
    )


def class_rows(readings_df: DataFrame, large_threshold: float = LARGE_THRESHOLD) -> DataFrame:
    """``(date, deviceid, valuetype, count)`` by direct three-key aggregation."""
    return (
        readings_df.withColumn("valuetype", value_class(F.col("runninghour"), large_threshold))
        .groupBy("date", "deviceid", "valuetype")
        .count()
    )


def class_rows_from_daily(daily: DataFrame) -> DataFrame:
    """The same rows by unpivoting the daily counts: no second pass over silver."""
    normal = F.col("TotalCount") - F.col("c_large") - F.col("c_zero") - F.col("c_negative") - F.col("c_null")
    wide = daily.select(
        *KEYS,
        F.col("c_large").alias("large"),
        F.col("c_zero").alias("zero"),
        F.col("c_negative").alias("negative"),
        F.col("c_null").alias("null"),
        normal.alias("normal"),
    )
    return (
        wide.unpivot(list(KEYS), ["large", "zero", "negative", "null", "normal"], "valuetype", "count")
        .filter(F.col("count") > 0)
    )


def severity(class_rows_df: DataFrame, as_of, rows_per_day: int = ROWS_PER_DAY) -> DataFrame:
    """Adds ``severity`` (v1) and ``severity_moy`` (v2), both FLOAT, as of a date."""
    return class_rows_df.withColumns(
        {
            "severity": severity_v1("count", "valuetype", "date", as_of),
            "severity_moy": severity_v2("count", "valuetype", "date", as_of, rows_per_day),
        }
    )


def means(df: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Mean of every numeric column that is no key, as ``avg_<column>``, per key."""
    return df.groupBy(*keys).agg(*[F.avg(f"`{c}`").alias(f"avg_{c}") for c in numeric_columns(df, keys)])


def severity_means(severity_df: DataFrame) -> DataFrame:
    """Mean of every numeric column per (date, deviceid)."""
    return means(severity_df)


def severity_describe(severity_df: DataFrame) -> DataFrame:
    """count, mean, stddev, min, max of the two scores (as strings)."""
    return severity_df.describe("severity_moy", "severity").select("summary", "severity_moy", "severity")
