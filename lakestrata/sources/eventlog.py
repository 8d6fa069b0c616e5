"""Event-log and table scans (bounded, rolling, incremental, streaming).

An event-log row carries at least ``body`` (binary or string JSON) and
``enqueuedTime`` (timestamp); every other column passes through.  The
format is a parameter: Parquet or JSON files here, a log connector in
production.  Time bounds are plain filters on ``enqueuedTime`` so that
they reach the file scan as pushed filters.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TimeLike = str | dt.datetime | Column


def _ts(value: TimeLike) -> Column:
    if isinstance(value, Column):
        return value
    if isinstance(value, dt.datetime):
        value = value.isoformat(sep=" ")
    # ISO strings such as 2024-01-01T00:00:00.000000Z cast directly.
    return F.lit(value).cast("timestamp")


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Spread a source of fewer files than cores over all cores.

    The per-row work after a scan (JSON parsing, hashing) runs in the scan's
    tasks; a source of a few files may give only a few.  The file list is
    read from the plan: nothing is executed, and plans over other sources
    than files are left as they are.
    """
    if df.isStreaming:
        return df
    try:
        want = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    except Exception:  # a session without a SparkContext (Spark Connect)
        return df
    return df.repartition(want) if 0 < len(df.inputFiles()) < want else df


def with_string_body(df: DataFrame) -> DataFrame:
    """Body as text: binary bodies are cast, string bodies kept."""
    if isinstance(df.schema["body"].dataType, T.BinaryType):
        return df.withColumn("body", F.col("body").cast("string"))
    return df


def bounded(df: DataFrame, start: TimeLike, end: TimeLike | None = None,
            time_col: str = "enqueuedTime") -> DataFrame:
    """Rows with ``start <= time <= end`` (both inclusive); no end means now."""
    t = F.col(time_col)
    cond = t >= _ts(start)
    cond = cond & (t <= (_ts(end) if end is not None else F.current_timestamp()))
    return df.filter(cond)


def read_bounded(spark: SparkSession, path: str, start: TimeLike, end: TimeLike | None = None,
                 fmt: str = "parquet", schema: T.StructType | None = None, **options) -> DataFrame:
    """Bounded event-log read: ``format(fmt).load(path)`` then the time window."""
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return with_string_body(spread(bounded(reader.load(path), start, end)))


def rolling(df: DataFrame, minutes: int = 3000, as_of: TimeLike | None = None,
            time_col: str = "enqueuedTime") -> DataFrame:
    """Events of the last ``minutes`` minutes up to ``as_of`` (default now), UTC."""
    end = _ts(as_of) if as_of is not None else F.current_timestamp()
    start = end - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(minutes))
    t = F.col(time_col)
    return df.filter((t >= start) & (t <= end))


def rolling_start(minutes: int, as_of: dt.datetime | None = None) -> str:
    """Start-time string ``now - minutes`` in the log's ISO format."""
    as_of = as_of or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    return (as_of - dt.timedelta(minutes=minutes)).strftime("%Y-%m-%dT%H:%M:%S.%fZ")


def incremental(df: DataFrame, start: TimeLike | None, time_col: str = "enqueuedTime") -> DataFrame:
    """``time >= start`` when a start is given (incremental), else the whole table."""
    if start is None:
        return df
    return df.filter(F.col(time_col) >= _ts(start))


def not_null_time(df: DataFrame, time_col: str = "enqueuedTime") -> DataFrame:
    """``time >= time - 60 minutes`` holds for every non-null time: only nulls drop."""
    return df.filter(F.col(time_col).isNotNull())


def read_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
                watermark: str | None = "1 minute", time_col: str = "enqueuedTime",
                **options) -> DataFrame:
    """Unbounded event-log read with an optional watermark on the event time."""
    df = spark.readStream.format(fmt).schema(schema).options(**options).load(path)
    df = with_string_body(df)
    if watermark:
        df = df.withWatermark(time_col, watermark)
    return df
