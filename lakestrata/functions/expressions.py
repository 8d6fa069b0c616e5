"""Column expressions shared by the jobs.

All of them are built-in Spark expressions, so they stay inside
whole-stage code generation; none needs a Python UDF.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the gold job.
LARGE_THRESHOLD = 100000
ROWS_PER_DAY = 2880  # one reading every 30 seconds

# Severity v1: weight per value class, added once per group.
SEVERITY_V1_CLASS_WEIGHT = {"normal": 0.0, "large": 0.5, "negative": 0.7, "null": 0.3, "zero": 0.3}
SEVERITY_V1_DEVICE_WEIGHT = 1  # multiplies the row count
SEVERITY_V1_DAY_WEIGHT = 1
SEVERITY_V1_COUNT_WEIGHT = 0.7

# Severity v2: weight per value class and multiplier by age in days.
SEVERITY_V2_CLASS_WEIGHT = {"large": 50, "negative": 50, "null": 30, "zero": 40, "normal": 0}
SEVERITY_V2_AGE_STEPS = ((3, 1), (7, 1.5), (14, 1.8))  # (up to N days, multiplier)
SEVERITY_V2_OLDER = 2.0


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def value_class(value: str | Column, large_threshold: float = LARGE_THRESHOLD) -> Column:
    """large -> zero -> negative -> null -> normal; first match wins.

    NaN compares greater than every number in Spark, so NaN is "large".
    """
    v = _col(value)
    return (
        F.when(v > F.lit(large_threshold), "large")
        .when(v == 0, "zero")
        .when(v < 0, "negative")
        .when(v.isNull(), "null")
        .otherwise("normal")
    )


def _as_date(as_of: str | dt.date | Column) -> Column:
    if isinstance(as_of, Column):
        return as_of
    return F.lit(str(as_of)).cast("date")


def days_since(date: str | Column, as_of: str | dt.date | Column) -> Column:
    """Whole days from ``date`` to ``as_of`` (negative for future dates)."""
    return F.datediff(_as_date(as_of), _col(date))


def _class_weight(valuetype: Column, weights: dict) -> Column:
    expr = None
    for name, weight in weights.items():
        expr = (F.when if expr is None else expr.when)(valuetype == name, F.lit(weight))
    return expr


def severity_v1(count: str | Column, valuetype: str | Column, date: str | Column, as_of) -> Column:
    """count*1 + class weight + days*1 + 0.7*count, summed in that order, as FLOAT.

    NULL when the date is NULL.
    """
    n = _col(count)
    w = _class_weight(_col(valuetype), SEVERITY_V1_CLASS_WEIGHT).otherwise(F.lit(0.0))
    days = days_since(date, as_of)
    score = (
        (n * F.lit(SEVERITY_V1_DEVICE_WEIGHT) + w)
        + days * F.lit(SEVERITY_V1_DAY_WEIGHT)
        + F.lit(SEVERITY_V1_COUNT_WEIGHT) * n
    )
    return F.when(_col(date).isNotNull(), score).cast("float")


def severity_v2(count: str | Column, valuetype: str | Column, date: str | Column, as_of,
                rows_per_day: int = ROWS_PER_DAY) -> Column:
    """rint(multiplier(age) * class weight * count / rows_per_day), as FLOAT.

    Not clamped: counts above ``rows_per_day`` give scores above 100.
    NULL when the date is NULL.
    """
    n = _col(count)
    vt = _col(valuetype)
    days = days_since(date, as_of)
    w = _class_weight(vt, SEVERITY_V2_CLASS_WEIGHT)

    def scaled(mult) -> Column:
        return (F.lit(mult) * w) * n / F.lit(rows_per_day)

    raw = None
    for limit, mult in SEVERITY_V2_AGE_STEPS:
        raw = (F.when if raw is None else raw.when)(days <= limit, scaled(mult))
    raw = raw.otherwise(scaled(SEVERITY_V2_OLDER))
    return F.when(_col(date).isNotNull(), F.rint(raw)).cast("float")


def severity_v0(count: str | Column, valuetype: str | Column, ts: str | Column, as_of) -> Column:
    """The earlier severity with a time-of-day term, on ungrouped rows.

    count + class weight + days + (hour - 12)^2 + 0.7*count, as FLOAT.
    """
    n = _col(count)
    t = _col(ts)
    w = _class_weight(_col(valuetype), SEVERITY_V1_CLASS_WEIGHT).otherwise(F.lit(0.0))
    hour_term = F.pow(F.hour(t) - F.lit(12), F.lit(2))
    score = ((n + w) + days_since(F.to_date(t), as_of)) + hour_term + F.lit(SEVERITY_V1_COUNT_WEIGHT) * n
    return F.when(t.isNotNull(), score).cast("float")


def minutes_between(start: str | Column, end: str | Column) -> Column:
    """Whole elapsed minutes from ``start`` to ``end``, truncated (BIGINT)."""
    return F.timestamp_diff("MINUTE", _col(start), _col(end))


def parse_failed(parsed: str | Column, body: str | Column) -> Column:
    """The reference flag rule: the message did not parse, or has no telemetry."""
    p = _col(parsed)
    return (p.isNull() & _col(body).isNotNull()) | p.getField("telemetry").isNull()


def evaluate_once(df, exprs: dict[str, Column]):
    """Add costly columns (JSON parses) computed exactly once per row.

    Catalyst pushes filters below projections by inlining the projected
    expressions, so a filter on a parse result would parse the body again
    in the Filter and then in the Project above it.  Producing the columns
    from a one-row ``inline`` generator keeps them as real attributes: later
    filters stop at the Generate and read the parsed values, and the
    operators above it stay in whole-stage code generation.
    """
    packed = F.struct(*[e.alias(name) for name, e in exprs.items()])
    return df.select("*", F.inline(F.array(packed)))
