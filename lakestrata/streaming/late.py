"""Streams that keep their late rows: first rows, copies and late rows, each marked.

A watermark bounds the state of a de-duplication, and Spark's own operators
drop the rows that come after it.  Here a processor with keyed state and
timers judges every row itself: a row older than the watermark is ``late``,
otherwise the first row of a body is ``first`` and each further one is a
``copy`` as long as its state lives.  A timer ends the state when the
watermark reaches the first row's time plus the delay.  Keys are dealt into
buckets by their hash, and a bucket's state is one value.  No row is lost: rows
in = first + copy + late, and the late rows have a folder of their own, from
which they can be merged into bronze at leisure.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

STATE = "seen"
SEEN = T.StructType([
    T.StructField("rowhash", T.ArrayType(T.StringType())),
    T.StructField("first_ms", T.ArrayType(T.LongType())),
])
BUCKET = "rowhash_bucket"
#: Buckets that a stream's keys are dealt into, fixed for a checkpoint: a task holds one bucket's state (about 200
#: bytes a key) and one frame of its rows.  Size it so that a bucket has some 100,000 keys within a delay.
BUCKETS = 128
FIRST, COPY, LATE = "first", "copy", "late"
SHUFFLE = "spark.sql.shuffle.partitions"
#: Keyed state of processors needs this store (a setting of Spark).
STORE = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


class FirstRows(StatefulProcessor):
    """Judges the rows of one bucket of keys; its state is the time of each key's first row.

    A call into the state store costs milliseconds, so a bucket's times are
    read and written as one value: a few calls per bucket and batch, whatever
    number of keys it holds.  One timer per bucket, at the end of its oldest
    state, ends all states whose time has passed.
    """

    def __init__(self, time_col: str, delay_ms: int):
        self.time_col, self.delay_ms = time_col, delay_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getValueState(STATE, SEEN)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        watermark = timerValues.getCurrentWatermarkInMs()
        keys, times = map(list, self.seen.get() or ((), ()))
        held, due, before = set(keys), min(times, default=None), len(keys)
        for pdf in rows:  # a frame at a time: a body may have any number of copies
            at = pdf["at_ms"]
            late = at < watermark
            verdict = late.map({True: LATE, False: COPY})
            fresh = ~late & pd.Series([k not in held for k in pdf["rowhash"]], index=pdf.index, dtype=bool)
            first = pdf.loc[fresh, ["rowhash", "at_ms"]].drop_duplicates("rowhash")
            verdict.loc[first.index] = FIRST
            held.update(first["rowhash"])
            keys += first["rowhash"].tolist()
            times += first["at_ms"].tolist()
            yield pdf.drop(columns=["at_ms", BUCKET]).assign(verdict=verdict)
        if len(keys) > before:
            self.seen.update((keys, times))
            if due is None or min(times) < due:
                self.handle.registerTimer(min(times) + self.delay_ms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        oldest = timerValues.getCurrentWatermarkInMs() - self.delay_ms
        held = [(k, t) for k, t in zip(*(self.seen.get() or ((), ()))) if t > oldest]
        if held:
            keys, times = map(list, zip(*held))
            self.seen.update((keys, times))
            self.handle.registerTimer(min(times) + self.delay_ms)
        else:
            self.seen.clear()
        yield from ()

    def close(self) -> None:
        pass


def milliseconds(delay: str) -> int:
    """A delay such as ``"1 minute"`` or ``"3 days"``."""
    count, unit = delay.split()
    known = {"second": 1_000, "minute": 60_000, "hour": 3_600_000, "day": 86_400_000}
    return int(count) * known[unit.rstrip("s")]


def judged(stream: DataFrame, delay: str = "1 minute", time_col: str = "enqueuedTime", body_col: str = "body",
           buckets: int = BUCKETS) -> DataFrame:
    """The rows of an event-log stream with ``rowhash`` and ``verdict``: first, copy or late.

    The watermark trails the greatest ``time_col`` of the batches before by
    ``delay``.  Rows without a body have no copies, rows without a time no
    watermark to be compared with: both are ``first``.  A query over this needs
    the state store that ``STORE`` names (:func:`start_split` sets it).
    """
    if time_col not in stream.columns or {"rowhash", "verdict", "at_ms", BUCKET} & set(stream.columns):
        raise ValueError(f"a stream with {time_col} and without rowhash, verdict, at_ms and {BUCKET}")
    if any(c.startswith("_") for c in stream.columns):
        raise ValueError("a processor's rows cannot have names that begin with an underscore")
    watched = stream.withWatermark(time_col, delay)
    # computed columns do not carry the watermark's mark: Spark then hands late rows to the processor
    plain = [(F.col(c) + F.expr("INTERVAL 0 SECONDS")).alias(c) if c == time_col else F.col(c) for c in stream.columns]
    rows = watched.select(*plain, F.sha2(F.col(body_col).cast("string"), 256).alias("rowhash"), F.unix_millis(F.col(time_col)).alias("at_ms"))
    out = T.StructType([*rows.drop("at_ms").schema.fields, T.StructField("verdict", T.StringType())])
    keyed = rows.filter(F.col("rowhash").isNotNull() & F.col("at_ms").isNotNull())
    keyed = keyed.withColumn(BUCKET, F.pmod(F.xxhash64("rowhash"), F.lit(buckets))).groupBy(BUCKET)
    seen = keyed.transformWithStateInPandas(FirstRows(time_col, milliseconds(delay)), out, "Append", "EventTime")
    alone = rows.filter(F.col("rowhash").isNull() | F.col("at_ms").isNull()).drop("at_ms").withColumn("verdict", F.lit(FIRST))
    return seen.unionByName(alone)


def start_split(stream: DataFrame, path: str, checkpoint: str, delay: str = "1 minute", time_col: str = "enqueuedTime",
                body_col: str = "body", available_now: bool = True, buckets: int = BUCKETS,
                partitions: int | None = None) -> StreamingQuery:
    """Write the judged stream to Parquet below ``path``, a folder for each verdict.

    The file sink commits a batch's files at once, so a replayed batch is not
    written twice.  ``partitions`` of the state are fixed for a checkpoint;
    each costs about a second per batch for its store and worker, so that by
    default they are the session's shuffle partitions, at most four per core.
    """
    writer = judged(stream, delay, time_col, body_col, buckets).writeStream.partitionBy("verdict").option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    spark, (key, store) = stream.sparkSession, STORE
    wanted = partitions or min(int(spark.conf.get(SHUFFLE)), 4 * spark.sparkContext.defaultParallelism)
    settings = {key: store, SHUFFLE: str(wanted)}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():  # a query takes the settings over when it starts
        spark.conf.set(k, v)
    try:
        return writer.format("parquet").option("path", path).start()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v else spark.conf.unset(k)


def rows_of(spark: SparkSession, path: str, verdict: str | None = None) -> DataFrame:
    """What :func:`start_split` has written: all rows, or those of one verdict."""
    rows = spark.read.parquet(path)
    return rows if verdict is None else rows.filter(F.col("verdict") == verdict).drop("verdict")


def state(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The live state of a split: (rowhash, first_ms), read from its checkpoint."""
    held = spark.read.format("statestore").option("stateVarName", STATE).load(checkpoint)
    return held.select(F.inline(F.arrays_zip("value.rowhash", "value.first_ms"))).toDF("rowhash", "first_ms")
