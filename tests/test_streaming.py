"""Structured Streaming forms against the batch results."""

import datetime as dt

from pyspark.sql import functions as F

from lakestrata.operators import bronze
from lakestrata.plans import daily
from lakestrata.plans.tables import Lakehouse
from lakestrata.session import scratch_path
from lakestrata.sources import eventlog
from lakestrata.sources.envelope import read_envelope
from lakestrata.streaming import ingest

SF = "/root/testdata/sf0.001"


def _log_folder(spark):
    """A folder of event-log files (body, enqueuedTime, event_id) derived from events."""
    path = scratch_path(spark, "test-log")
    read_envelope(spark, SF).repartition(3).write.parquet(path)
    return path, spark.read.parquet(path).schema


def test_discover_types_memory_sink(spark):
    path, schema = _log_folder(spark)
    stream = eventlog.read_stream(spark, path, schema)
    query, table = ingest.discover_types(stream, scratch_path(spark, "types-ckpt"), sink="memory", query_name="types_test")
    query.awaitTermination()
    got = {r["TemplateName"] for r in spark.table(table).collect()}
    expected = {r["TemplateName"] for r in bronze.template_names(bronze.enrich(read_envelope(spark, SF))).collect()}
    assert got == expected


def test_stream_ingest_equals_batch_and_is_idempotent(spark):
    path, schema = _log_folder(spark)
    lh = Lakehouse(spark, scratch_path(spark, "test-stream") + "/lake", "test_stream_ingest")
    layout = daily.Layout(buckets=4)
    ckpt = scratch_path(spark, "test-stream-ckpt")
    stream = eventlog.read_stream(spark, path, schema, watermark=None)
    ingest.start_bronze_ingest(stream, lh, ckpt, layout, "2024-01-31 00:00:00").awaitTermination()
    got = lh.read(layout.bronze_spec())
    batch = bronze.enrich(read_envelope(spark, SF), "2024-01-31 00:00:00")
    cols = sorted(batch.columns)
    assert got.select(cols).exceptAll(batch.select(cols)).count() == 0
    assert batch.select(cols).exceptAll(got.select(cols)).count() == 0
    # a second stream over the same files (new checkpoint) adds nothing
    ingest.start_bronze_ingest(eventlog.read_stream(spark, path, schema, watermark=None), lh,
                               scratch_path(spark, "test-stream-ckpt2"), layout, "2024-01-31 00:00:00"
                               ).awaitTermination()
    assert lh.read(layout.bronze_spec()).count() == batch.count()


def test_dedup_within_watermark(spark):
    root = scratch_path(spark, "test-log-copies")
    env = read_envelope(spark, SF)
    env.write.parquet(f"{root}/a")
    # every message twice, the copy one second later
    env.withColumn("enqueuedTime", F.col("enqueuedTime") + F.expr("INTERVAL 1 SECOND")).write.parquet(f"{root}/b")
    path, schema = f"{root}/a", spark.read.parquet(f"{root}/a").schema
    stream = eventlog.read_stream(spark, f"{root}/*", schema, watermark=None)
    deduped = ingest.dedup_within_watermark(stream, "10 minutes")
    q = deduped.writeStream.format("memory").queryName("dedup_test").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("dedup_test").count() == spark.read.parquet(path).count()


def test_rolling_and_bounded(spark):
    env = read_envelope(spark, SF)
    end = dt.datetime(2024, 1, 20)
    a = eventlog.bounded(env, "2024-01-10T00:00:00Z", end).count()
    b = env.filter((F.col("enqueuedTime") >= "2024-01-10") & (F.col("enqueuedTime") <= "2024-01-20")).count()
    assert a == b
    r = eventlog.rolling(env, 1440, end).count()
    assert r == env.filter((F.col("enqueuedTime") >= "2024-01-19") & (F.col("enqueuedTime") <= "2024-01-20")).count()
    assert eventlog.rolling_start(60, dt.datetime(2024, 1, 1, 1, 0)) == "2024-01-01T00:00:00.000000Z"


def test_stream_ingest_with_processing_time_trigger(spark):
    path, schema = _log_folder(spark)
    lh = Lakehouse(spark, scratch_path(spark, "test-stream-pt") + "/lake", "test_stream_pt")
    layout = daily.Layout(buckets=4)
    query = ingest.start_bronze_ingest(eventlog.read_stream(spark, path, schema, watermark=None), lh,
                                       scratch_path(spark, "test-stream-pt-ckpt"), layout, "2024-01-31 00:00:00",
                                       available_now=False, processing_time="1 second")
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    assert lh.read(layout.bronze_spec()).count() == read_envelope(spark, SF).count()


def test_start_time_format_with_fraction_and_zone(spark):
    env = read_envelope(spark, SF)
    start = eventlog.rolling_start(60 * 24 * 10, dt.datetime(2024, 1, 25))  # "...T00:00:00.000000Z"
    assert start == "2024-01-15T00:00:00.000000Z"
    got = eventlog.incremental(env, start).count()
    assert got == env.filter(F.col("enqueuedTime") >= "2024-01-15").count() > 0
