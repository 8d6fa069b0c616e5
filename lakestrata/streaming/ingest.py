"""Structured Streaming forms of the bronze ingest and the type discovery.

* :func:`discover_types` - distinct device types seen on the log, each
  written once: a micro-batch is reduced map-side, then compared with the
  types already in the sink.
* :func:`start_bronze_ingest` - each micro-batch is enriched and merged
  insert-only into bronze through ``foreachBatch``.  A ledger of batches per
  stream makes a replayed batch add nothing, messages without a body (which
  have no key to compare) included.
* :func:`dedup_within_watermark` - the state-store alternative: drop
  repeated bodies seen within the watermark delay.

A stream's checkpoint is always named by the caller: a new one would read
the log again from its start.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lakestrata.operators import bronze
from lakestrata.plans.daily import Layout, compact_loads, merge_into, record_load
from lakestrata.plans.tables import Lakehouse
from lakestrata.session import scratch_path


def _trigger(writer, available_now: bool, processing_time: str | None):
    if available_now:
        return writer.trigger(availableNow=True)
    if processing_time:
        return writer.trigger(processingTime=processing_time)
    return writer


def types_of(messages: DataFrame) -> DataFrame:
    """Distinct template names of messages (combined map-side in a batch)."""
    parsed = messages.select(
        F.from_json(F.col("body").cast("string"), "templateName string").getField("templateName").alias("TemplateName")
    )
    return parsed.distinct()


def discover_types(stream: DataFrame, checkpoint: str, sink_path: str | None = None,
                   available_now: bool = True, processing_time: str | None = None,
                   sink: str = "parquet", query_name: str = "device_types_seen") -> tuple[StreamingQuery, str]:
    """Write the distinct device types of the stream to a sink, each once.

    ``sink="parquet"`` (default) appends files under ``sink_path`` and returns
    their path; ``sink="memory"`` keeps the rows in the in-memory table
    ``query_name`` and returns that name (a stateful distinct: for tests and
    small logs, since it shuffles the rows on the type).
    """
    spark = stream.sparkSession
    if sink == "memory":
        names = types_of(stream).writeStream.outputMode("append")
        writer, where = names.format("memory").queryName(query_name), query_name
    else:
        where = f"{sink_path or scratch_path(spark, 'types')}/data"

        def write(batch: DataFrame, batch_id: int) -> None:
            seen, session = types_of(batch), batch.sparkSession
            try:
                known = session.read.parquet(where).withColumnRenamed("TemplateName", "known")
                seen = seen.join(known, F.col("TemplateName").eqNullSafe(F.col("known")), "left_anti")
            except AnalysisException:  # nothing written yet
                pass
            seen.coalesce(1).write.mode("append").parquet(where)

        writer = stream.writeStream.foreachBatch(write)
    return _trigger(writer.option("checkpointLocation", checkpoint), available_now, processing_time).start(), where


class PartlyWritten(RuntimeError):
    """A batch whose write broke off between its files."""


class BatchLedger:
    """Which micro-batches of a stream are in bronze, so that a replay adds nothing.

    Spark replays the last batch of a stream when it was not committed.  Its
    non-NULL bodies are found by the merge; messages without a body have no
    key.  Before a batch is written its begin is noted, with the number of
    NULL-key rows that bronze holds; afterwards its end.  A batch that has
    ended is skipped.  One that has only begun is written again, without its
    NULL-key rows if bronze already holds that many more.  Bronze has one
    writer.  Streams are told apart by the id that Spark keeps in the
    checkpoint: a new checkpoint is a new stream, which reads the log anew.
    """

    BEGUN, DONE = "batch-begun", "batch-done"

    def __init__(self, lh: Lakehouse, stream_id: str):
        self.lh, self.stream = lh, stream_id

    def is_done(self, batch_id: int) -> bool:
        last = self.lh.notes.latest(self.DONE, self.stream)
        return last is not None and last[0] >= batch_id

    def begin(self, batch_id: int, spec, nulls: int, key: str = "rowhash") -> bool:
        """Note the begin of a batch with ``nulls`` NULL keys; True when those are in the table already."""
        last = self.lh.notes.latest(self.BEGUN, self.stream)
        held = self.lh.read(spec).filter(F.col(key).isNull()).count() if nulls and self.lh.exists(spec) else 0
        if last is None or last[0] != batch_id:
            self.lh.notes.put(self.BEGUN, self.stream, batch_id, {"null_rows": held})
            return False
        added = held - last[1]["null_rows"]
        if added not in (0, nulls):
            raise PartlyWritten(f"batch {batch_id} of stream {self.stream}: {added} of {nulls} messages without a body were written")
        return added > 0

    def end(self, batch_id: int) -> None:
        self.lh.notes.put(self.DONE, self.stream, batch_id, {})
        for kind in (self.BEGUN, self.DONE):
            self.lh.notes.forget(kind, self.stream, below=batch_id)


# Micro-batches after which the load index is written anew, a row per partition.
COMPACT_EVERY = 50


def bronze_batch_writer(lh: Lakehouse, layout: Layout | None = None, load_ts=None,
                        dedup_source: bool = False) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function: enrich the micro-batch and merge it into bronze, once."""
    layout = layout or Layout()
    spec = layout.bronze_spec()

    def write(batch: DataFrame, batch_id: int) -> None:
        tables = lh.bound_to(batch.sparkSession)
        ledger = BatchLedger(tables, batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId"))
        if ledger.is_done(batch_id):
            return
        enriched = bronze.enrich(batch, load_ts).persist()
        try:
            keyless = F.col("rowhash").isNull()
            touched = record_load(tables, enriched, layout)  # index first (see ingest_bronze)
            written = ledger.begin(batch_id, spec, enriched.filter(keyless).count())
            rows = enriched.filter(~keyless) if written else enriched
            merge_into(tables, spec, rows, dedup_source=dedup_source, null_keys=False, partition_keys=touched)
            if batch_id % COMPACT_EVERY == COMPACT_EVERY - 1:
                compact_loads(tables, layout)
            ledger.end(batch_id)
        finally:
            enriched.unpersist()

    return write


def forget_last_commit(spark, checkpoint: str) -> int:
    """Remove a stopped stream's newest commit: its last batch is run again on the next start, as after a crash.

    For tests of exactly-once writing; returns the batch's number.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/commits")
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    last = max((f.getPath() for f in fs.listStatus(path) if f.getPath().getName().isdigit()), key=lambda p: int(p.getName()))
    fs.delete(last, False)
    return int(last.getName())


def start_bronze_ingest(stream: DataFrame, lh: Lakehouse, checkpoint: str,
                        layout: Layout | None = None, load_ts=None, available_now: bool = True,
                        processing_time: str | None = None, dedup_source: bool = False) -> StreamingQuery:
    """Micro-batch bronze ingest: ``foreachBatch`` + insert-only merge.

    ``dedup_source`` also keeps one row per body within a micro-batch, which
    makes the whole log's non-NULL bodies distinct, however late a copy is.
    """
    writer = stream.writeStream.foreachBatch(bronze_batch_writer(lh, layout, load_ts, dedup_source)).option(
        "checkpointLocation", checkpoint
    )
    return _trigger(writer, available_now, processing_time).start()


def dedup_within_watermark(stream: DataFrame, delay: str = "1 minute", time_col: str = "enqueuedTime",
                           load_ts=None) -> DataFrame:
    """Bronze rows of a stream with repeated bodies dropped within the watermark.

    State holds each hash until the watermark passes its event time plus
    ``delay``, so it stays bounded by the rows of one delay period.  Rows
    with a NULL body have no hash and all pass.  A bounded state cannot judge
    rows later than ``delay``, and Spark drops them: where late rows matter,
    use ``start_bronze_ingest(dedup_source=True)``, which compares with the
    table instead.
    """
    watched = stream.withWatermark(time_col, delay)
    keyed = bronze.enrich(watched.filter(F.col("body").isNotNull()), load_ts).dropDuplicatesWithinWatermark(["rowhash"])
    return keyed.unionByName(bronze.enrich(watched.filter(F.col("body").isNull()), load_ts))
