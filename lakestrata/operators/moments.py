"""Mergeable moments: count, mean, squared deviations, least and greatest per partition.

Summaries of a whole table then need the partitions' moments only, a few
numbers each, and a run that changes some partitions computes theirs anew.
Deviations are combined around the common mean (not as sums of squares), so
large values lose no digits.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

PARTS = ("n", "mean", "m2", "least", "greatest")


def numeric_columns(df: DataFrame, keys: Sequence[str] = ()) -> list[str]:
    """Every numeric column that is no key."""
    named = {k.lower() for k in keys}
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name.lower() not in named]


def moments(df: DataFrame, keys: Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """(keys, column, n, mean, m2, least, greatest): a row per key and numeric column; NULLs are not counted."""
    columns = numeric_columns(df, keys) if columns is None else list(columns)
    value = {c: F.col(f"`{c}`").cast("double") for c in columns}
    each = [
        F.struct(F.lit(c).alias("column"), F.count(v).alias("n"), F.avg(v).alias("mean"), (F.var_pop(v) * F.count(v)).alias("m2"), F.min(v).alias("least"), F.max(v).alias("greatest"))
        for c, v in value.items()
    ]
    if not each:
        raise ValueError("no numeric column")
    return df.groupBy(*keys).agg(F.array(*each).alias("each")).select(*keys, F.inline("each"))


def combine(parts: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """The moments of coarser groups (``keys``; none: of everything) from those of finer ones."""
    group = [*keys, "column"]
    held = parts.filter(F.col("n") > 0)
    over = W.partitionBy(*group)
    common = F.sum(F.col("n") * F.col("mean")).over(over) / F.sum("n").over(over)
    apart = held.withColumn("__common", common).withColumn("__m2", F.col("m2") + F.col("n") * F.pow(F.col("mean") - F.col("__common"), F.lit(2)))
    return apart.groupBy(*group).agg(
        F.sum("n").alias("n"), F.first("__common").alias("mean"), F.sum("__m2").alias("m2"),
        F.min("least").alias("least"), F.max("greatest").alias("greatest"),
    )


def describe(parts: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """(keys, column, count, mean, stddev, min, max): the sample deviation, as ``DataFrame.describe`` has it."""
    whole = combine(parts, keys)
    stddev = F.when(F.col("n") > 1, F.sqrt(F.col("m2") / (F.col("n") - 1)))
    return whole.select(*keys, "column", F.col("n").alias("count"), "mean", stddev.alias("stddev"), F.col("least").alias("min"), F.col("greatest").alias("max"))
