"""Checked queries over the given tables, with their DuckDB oracle SQL.

Every query reads the whole ``events`` table and derives the device
messages from it (``sources.envelope``), then runs the engine's jobs as
DataFrame plans.  Time-dependent queries use a fixed ``AS_OF`` date and a
literal load time, so that the Spark result and the SQL oracle agree.
Column names are aliased identically on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

import datetime as dt
import functools
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestrata.functions.expressions import severity_v0, value_class
from lakestrata.operators import bronze, diagnosis, gold, inventory, merge, silver
from lakestrata.plans import compaction, daily
from lakestrata.plans.tables import Lakehouse
from lakestrata.schemas import telemetry_struct
from lakestrata.session import configure, scratch_path
from lakestrata.sources import eventlog, inference, templates
from lakestrata.sources.envelope import TELEMETRY_FIELD, TEMPLATE, envelope, envelope_sql, read_envelope
from lakestrata.streaming import ingest, late

# Fixed parameters of the checked queries.
AS_OF = "2024-01-31"
LOAD_TS = "2024-01-31 00:00:00"
KNOWN_TYPES = ("click", "view", "refund")
BLANK_TYPE_EVERY = 31
BOUNDED_START, BOUNDED_END = "2024-01-10T00:00:00Z", "2024-01-20T00:00:00Z"
MERGE_SOURCE_FROM, MERGE_TARGET_BEFORE = "2024-01-21 00:00:00", "2024-01-26 00:00:00"
INCREMENTAL_START = "2024-01-15T00:00:00Z"
ROLLING_MINUTES = 3000

Query = Callable[[SparkSession, str], DataFrame]


# ---------------------------------------------------------------- Spark side

def _bronze(spark: SparkSession, sf_dir: str, blank_type_every: int | None = None) -> DataFrame:
    configure(spark)
    return bronze.enrich(read_envelope(spark, sf_dir, blank_type_every), LOAD_TS)


def _telemetry():
    return telemetry_struct(TEMPLATE)


def _parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.parse(_bronze(spark, sf_dir), _telemetry())


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.rows(_parsed(spark, sf_dir))


def _readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.readings(_silver(spark, sf_dir))


def _severity(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = gold.daily_counts(_readings(spark, sf_dir))
    return gold.severity(gold.class_rows_from_daily(daily), AS_OF)


def q_bronze_enrich(spark, sf_dir):
    return _bronze(spark, sf_dir)


def q_bronze_binary_body(spark, sf_dir):
    """The log with binary bodies, as the event source delivers them."""
    configure(spark)
    log = read_envelope(spark, sf_dir).withColumn("body", F.col("body").cast("binary"))
    return bronze.enrich(log, LOAD_TS).select("event_id", "body", "templateName", "deviceId", "rowhash")


def q_bronze_bounded_read(spark, sf_dir):
    configure(spark)
    return eventlog.bounded(read_envelope(spark, sf_dir), BOUNDED_START, BOUNDED_END)


def q_bronze_rolling_window(spark, sf_dir):
    configure(spark)
    return eventlog.rolling(read_envelope(spark, sf_dir), ROLLING_MINUTES, LOAD_TS)


def q_bronze_range_minutes(spark, sf_dir):
    configure(spark)
    return bronze.range_report(read_envelope(spark, sf_dir))


def q_bronze_merge_new(spark, sf_dir):
    b = _bronze(spark, sf_dir)
    source = b.filter(F.col("enqueuedTime") >= F.lit(MERGE_SOURCE_FROM).cast("timestamp"))
    target = b.filter(F.col("enqueuedTime") < F.lit(MERGE_TARGET_BEFORE).cast("timestamp"))
    return merge.new_rows(source, target, "rowhash", bronze.PARTITION_COLS)


def q_silver_typed(spark, sf_dir):
    return _silver(spark, sf_dir)


def q_silver_one_type(spark, sf_dir):
    b = _bronze(spark, sf_dir)
    return silver.rows(silver.parse(silver.select_types(b, "click"), _telemetry()))


def q_silver_incremental(spark, sf_dir):
    b = eventlog.incremental(_bronze(spark, sf_dir), INCREMENTAL_START)
    return silver.rows(silver.parse(b, _telemetry()))


def q_silver_flags(spark, sf_dir):
    return silver.flags(_parsed(spark, sf_dir))


def q_field_diagnosis(spark, sf_dir):
    return diagnosis.diagnose(_parsed(spark, sf_dir), _telemetry())


def q_flag_detail(spark, sf_dir):
    """The flag-detail table layout: distinct (TemplateName, DeviceId, FlaggedField)."""
    return diagnosis.diagnose_as_detail(diagnosis.diagnose(_parsed(spark, sf_dir), _telemetry()))


def q_types_seen(spark, sf_dir):
    return bronze.template_names(_bronze(spark, sf_dir))


def q_types_known_seen(spark, sf_dir):
    seen = inventory.seen_types(_bronze(spark, sf_dir))
    return inventory.known_and_seen(seen, inventory.known_types(spark, KNOWN_TYPES))


def q_types_unknown(spark, sf_dir):
    seen = inventory.seen_types(_bronze(spark, sf_dir))
    return inventory.seen_not_known(seen, inventory.known_types(spark, KNOWN_TYPES))


def q_blank_type_messages(spark, sf_dir):
    b = _bronze(spark, sf_dir, BLANK_TYPE_EVERY)
    return bronze.blank_type_messages(b).select("event_id", "body", "templateName", "deviceId", "rowhash")


def q_recent_hour(spark, sf_dir):
    b = _bronze(spark, sf_dir).select("event_id", "enqueuedTime")
    literal = eventlog.not_null_time(b).withColumn("reading", F.lit("literal"))
    intended = eventlog.rolling(b, 60, LOAD_TS).withColumn("reading", F.lit("intended"))
    return literal.unionByName(intended)


def q_gold_counts(spark, sf_dir):
    return gold.counts(_readings(spark, sf_dir))


def q_gold_counts_joinform(spark, sf_dir):
    return gold.counts_join_form(_readings(spark, sf_dir))


def q_gold_percent(spark, sf_dir):
    return gold.percent(gold.counts(_readings(spark, sf_dir)))


def q_value_class_counts(spark, sf_dir):
    return gold.class_rows(_readings(spark, sf_dir)).orderBy("date", "deviceid")


def q_severity_v1(spark, sf_dir):
    return _severity(spark, sf_dir).select("date", "deviceid", "valuetype", "count", "severity")


def q_severity_v2(spark, sf_dir):
    return _severity(spark, sf_dir).select("date", "deviceid", "valuetype", "count", "severity_moy")


def q_gold_severity(spark, sf_dir):
    return _severity(spark, sf_dir)


def q_severity_means(spark, sf_dir):
    return gold.severity_means(_severity(spark, sf_dir))


def q_severity_describe(spark, sf_dir):
    text = gold.severity_describe(_severity(spark, sf_dir))
    return text.select("summary", *[F.round(F.col(c).cast("double"), 4).alias(c) for c in ("severity_moy", "severity")])


def _orders_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Natural readings: order totals per customer and order date (many "large")."""
    configure(spark)
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return o.select(
        F.to_date("o_orderdate").alias("date"),
        F.col("o_custkey").cast("string").alias("deviceid"),
        F.col("o_totalprice").alias("runninghour"),
    )


def _customer_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Natural readings without a date: account balances per market segment.

    Every group has a NULL date key, so its anomaly counts are NULL.
    """
    configure(spark)
    c = spark.read.parquet(f"{sf_dir}/customer.parquet")
    return c.select(
        F.lit(None).cast("date").alias("date"),
        F.col("c_mktsegment").alias("deviceid"),
        F.col("c_acctbal").alias("runninghour"),
    )


def q_gold_counts_orders(spark, sf_dir):
    return gold.counts(_orders_readings(spark, sf_dir))


def q_gold_severity_orders(spark, sf_dir):
    daily_df = gold.daily_counts(_orders_readings(spark, sf_dir))
    return gold.severity(gold.class_rows_from_daily(daily_df), AS_OF)


def q_gold_percent_orders(spark, sf_dir):
    return gold.percent(gold.counts(_orders_readings(spark, sf_dir)))


def q_gold_counts_customer(spark, sf_dir):
    return gold.counts(_customer_readings(spark, sf_dir))


def q_value_class_counts_customer(spark, sf_dir):
    return gold.class_rows(_customer_readings(spark, sf_dir))


def _scratch_lakehouse(spark: SparkSession, name: str) -> Lakehouse:
    """A fresh lakehouse (own folder, own catalog database) for one run."""
    root = scratch_path(spark, name)
    return Lakehouse(spark, f"{root}/lake", database=f"lakestrata_{uuid.uuid4().hex[:12]}")


SCRATCH_BUCKETS = 8


# Device types of the data (one row per type reaches the driver).
MAX_TYPES = 1000


def _devices(spark: SparkSession, sf_dir: str) -> list[daily.DeviceType]:
    seen = inventory.seen_types(_bronze(spark, sf_dir)).limit(MAX_TYPES + 1).collect()
    if len(seen) > MAX_TYPES:
        raise ValueError(f"more than {MAX_TYPES} device types")
    return [daily.DeviceType(n, _telemetry(), TELEMETRY_FIELD) for n in sorted(r["TemplateName"] for r in seen if r["TemplateName"])]


def _log_range(spark: SparkSession, sf_dir: str) -> tuple[dt.datetime, dt.datetime]:
    row = read_envelope(spark, sf_dir).agg(F.min("enqueuedTime").alias("a"), F.max("enqueuedTime").alias("b")).first()
    return row["a"], row["b"]


def _daily_runs(spark, sf_dir, severity=False, runs=1, described=False):
    """The daily batch (bronze, silver, gold per type) into fresh tables, in windows that overlap."""
    configure(spark)
    lh = _scratch_lakehouse(spark, "daily")
    layout, devices = daily.Layout(buckets=SCRATCH_BUCKETS), _devices(spark, sf_dir)
    first, last = _log_range(spark, sf_dir)
    step = (last - first) / runs
    for k in range(runs):
        begin = first + step * max(0, k - 0.5)  # half of the window before is read again
        end = last if k == runs - 1 else first + step * (k + 1)
        as_of = end if k < runs - 1 else max(last, dt.datetime.fromisoformat(LOAD_TS))
        daily.run_daily(lh, read_envelope(spark, sf_dir), devices, as_of=as_of, start=begin, load_ts=LOAD_TS, layout=layout)
        if described:
            for d in devices:  # device times are those of the hub: a later run changes no earlier date
                daily.refresh_moments(lh, d, layout, since=begin.date())
    if described:
        parts = [daily.describe_daily(lh, d, layout).withColumn("device_type", F.lit(d.name)) for d in devices]
        return functools.reduce(DataFrame.unionByName, parts)
    return daily.gold_tables(lh, devices, layout, severity)


def q_daily_gold_counts(spark, sf_dir):
    """The whole daily batch in one run."""
    return _daily_runs(spark, sf_dir)


def q_daily_two_runs(spark, sf_dir):
    """Two runs over overlapping windows into the same tables give the same gold."""
    return _daily_runs(spark, sf_dir, runs=2)


def q_daily_describe(spark, sf_dir):
    """Summary of the daily counts' numeric columns after two runs, from moments per date."""
    out = _daily_runs(spark, sf_dir, runs=2, described=True)
    return out.select("device_type", "column", "count", *[F.round(c, 6).alias(c) for c in ("mean", "stddev", "min", "max")])


def q_daily_gold_severity(spark, sf_dir):
    """The severity tables after two overlapping runs."""
    return _daily_runs(spark, sf_dir, severity=True, runs=2)


def _events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    return envelope(stream)


# Resent messages of the streamed log: each copy RESENT_EVERY-th event, later;
# and messages without a body.
RESENT_EVERY, NO_BODY_EVERY = 7, 37


# Rows of a file of a streamed log, about: a longer log has more files, not larger ones.
LOG_FILE_ROWS = 250_000


def _log_files(log: DataFrame, least: int) -> int:
    """The number of files that a log is dealt into, a multiple of ``least``."""
    return least * max(1, -(-log.count() // (least * LOG_FILE_ROWS)))


def _resent_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream of the whole log in two steps: the messages, then copies and messages without a body."""
    path = scratch_path(spark, "resent-log")
    env = read_envelope(spark, sf_dir)
    env.write.parquet(path)
    e, later = F.col("event_id"), F.col("enqueuedTime") + F.expr("INTERVAL 1 DAY")
    copies = env.filter(e % RESENT_EVERY == 0).withColumn("enqueuedTime", later)
    nothing = env.filter(e % NO_BODY_EVERY == 0).withColumn("body", F.lit(None).cast("string"))
    copies.unionByName(nothing).coalesce(2).write.mode("append").parquet(path)
    return spark.readStream.schema(env.schema).option("maxFilesPerTrigger", 4).parquet(path)


def q_stream_types(spark, sf_dir):
    """Device types discovered by a streaming run over the whole log."""
    configure(spark)
    query, out = ingest.discover_types(_events_stream(spark, sf_dir), f"{scratch_path(spark, 'types')}/_checkpoint")
    query.awaitTermination()
    return spark.read.parquet(out).select("TemplateName").distinct()


def q_stream_types_unknown(spark, sf_dir):
    """Types discovered by the stream that the known list lacks (Q5 on a stream)."""
    configure(spark)
    query, out = ingest.discover_types(_events_stream(spark, sf_dir), f"{scratch_path(spark, 'types')}/_checkpoint")
    query.awaitTermination()
    seen = spark.read.parquet(out).select("TemplateName").distinct()
    return inventory.seen_not_known(seen, inventory.known_types(spark, KNOWN_TYPES))


def _streamed(spark, sf_dir, runs, **options):
    configure(spark)
    lh = _scratch_lakehouse(spark, "stream-bronze")
    layout, stream = daily.Layout(buckets=SCRATCH_BUCKETS), _resent_log(spark, sf_dir)
    for k in range(runs):
        query = ingest.start_bronze_ingest(stream, lh, f"{lh.root}/_checkpoint{k}", layout, LOAD_TS, **options)
        query.awaitTermination()
    return lh.read(layout.bronze_spec())


def q_stream_bronze_dedup(spark, sf_dir):
    """Distinct bodies (and every message without one) of a log with copies, in micro-batches."""
    out = _streamed(spark, sf_dir, 1, dedup_source=True)
    return out.select("body", "templateId", "templateName", "deviceId", "rowhash")


def q_stream_bronze(spark, sf_dir):
    """Micro-batch ingest of a log with copies, then once more over the same files.

    Bodies are stored once; messages without a body have no key and are
    added by each run.
    """
    return _streamed(spark, sf_dir, 2).select("event_id", "body", "templateId", "templateName", "deviceId", "yearDevice", "monthDevice", "rowhash", "loadDatetime")


def q_severity_v0(spark, sf_dir):
    """The earlier severity on ungrouped rows: each reading with its time of day."""
    s = _silver(spark, sf_dir)
    rows = s.select("DeviceId", F.col("Device_enqueuedTime").alias("time"), value_class(F.col(TELEMETRY_FIELD)).alias("valuetype"), F.lit(1).cast("long").alias("count"))
    return rows.select("DeviceId", "time", "valuetype", severity_v0("count", "valuetype", "time", AS_OF).alias("severity"))


def q_template_fields(spark, sf_dir):
    """The types that each device type's telemetry fields really hold, counted."""
    configure(spark)
    return inference.observed_types(read_envelope(spark, sf_dir))


def q_template_merged(spark, sf_dir):
    """The one type that all values of a field fit."""
    configure(spark)
    return inference.merged_types(read_envelope(spark, sf_dir))


def _written_templates(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Template files written from the data and read again: (entries, dictionary)."""
    configure(spark)
    folder = scratch_path(spark, "templates")
    mapping = inference.write_templates(inference.observed_types(read_envelope(spark, sf_dir)), folder)
    listed = [r["path"] for r in templates.list_files(spark, folder, glob="*.json").limit(MAX_TYPES + 1).collect()]
    return templates.read_entries(spark, listed), templates.dictionary(spark, mapping)


def q_template_discrepancy(spark, sf_dir):
    """Fields that the data's templates declare with more than one type."""
    entries, types = _written_templates(spark, sf_dir)
    return templates.type_discrepancy(templates.flatten(entries, types))


def q_template_declared(spark, sf_dir):
    """The last declaration of each field, which its telemetry struct is made of."""
    entries, types = _written_templates(spark, sf_dir)
    last = templates.last_declarations(entries).join(types, "file")
    return last.select(F.col("device_type").alias("Asset"), F.col("name").alias("Telemetry"), F.col("schema").alias("DataType"))


# The second day of the template change begins here; the device type without times of its own.
CHANGE, TIMELESS_TYPE, NEW_FIELD = "2024-01-16 00:00:00", "view", "ACTIVE"


def _timeless(env: DataFrame) -> DataFrame:
    none = F.regexp_replace("body", '"enqueuedTime":"[^"]*"', '"enqueuedTime":null')
    return env.withColumn("body", F.when(F.col("body").contains(f'"templateName":"{TIMELESS_TYPE}"'), none).otherwise(F.col("body")))


def q_template_change(spark, sf_dir):
    """A run, a template that gains a field, a run in a new session, silver read in a third one.

    Messages of one type have no device time: its only silver partition is NULL.
    """
    configure(spark)
    first, last = _log_range(spark, sf_dir)
    change = dt.datetime.fromisoformat(CHANGE)
    days = [(min(first, change), change - dt.timedelta(microseconds=1)), (change, max(last, change))]
    names, lh, layout = [d.name for d in _devices(spark, sf_dir)], _scratch_lakehouse(spark, "change"), daily.Layout(buckets=SCRATCH_BUCKETS)

    def anew() -> Lakehouse:
        return Lakehouse(configure(spark.newSession()), lh.root, f"lakestrata_{uuid.uuid4().hex[:12]}")

    for (begin, end), template in zip(days, ({k: v for k, v in TEMPLATE.items() if k != NEW_FIELD}, TEMPLATE), strict=True):
        tables = anew()
        log = _timeless(read_envelope(tables.spark, sf_dir))
        devices = [daily.DeviceType(n, telemetry_struct(template)) for n in names]
        daily.run_daily(tables, log, devices, as_of=end, start=begin, load_ts=LOAD_TS, layout=layout)
    tables = Lakehouse(spark, lh.root, f"lakestrata_{uuid.uuid4().hex[:12]}")
    out = None
    for n in names:
        rows = tables.read(layout.silver_spec(n)).select("templateName", "DeviceId", "Device_Date", *TEMPLATE, "rowhash")
        out = rows if out is None else out.unionByName(rows)
    return out


def q_stream_replay(spark, sf_dir):
    """Messages without a body in every micro-batch, the creating one too; the last batch is run twice."""
    configure(spark)
    lh, layout, path = _scratch_lakehouse(spark, "replay"), daily.Layout(buckets=SCRATCH_BUCKETS), scratch_path(spark, "replay-log")
    env = read_envelope(spark, sf_dir)
    nothing = F.when(F.col("event_id") % NO_BODY_EVERY != 0, F.col("body"))
    files = _log_files(env, 4)
    env.withColumn("body", nothing).repartition(files).write.parquet(path)
    stream = spark.readStream.schema(env.schema).option("maxFilesPerTrigger", files // 2).parquet(path)
    checkpoint = f"{lh.root}/_checkpoint"
    ingest.start_bronze_ingest(stream, lh, checkpoint, layout, LOAD_TS).awaitTermination()
    ingest.forget_last_commit(spark, checkpoint)
    ingest.start_bronze_ingest(stream, lh, checkpoint, layout, LOAD_TS).awaitTermination()
    return lh.read(layout.bronze_spec()).select("event_id", "body", "templateName", "deviceId", "rowhash")


# The stream of late rows: how far its watermark trails, and the files that one batch reads at least.
LATE_DELAY, LATE_FILES = "3 days", 4


def q_stream_late_rows(spark, sf_dir):
    """Every row of a log with copies, late copies and late messages, with its verdict; none is lost."""
    configure(spark)
    path, out = scratch_path(spark, "late-log"), scratch_path(spark, "late-out")
    env = read_envelope(spark, sf_dir)
    files = _log_files(env, LATE_FILES)
    env.repartition(files).write.parquet(path)
    e = F.col("event_id")
    again = env.filter(e % RESENT_EVERY == 0)
    other = env.filter(e % 5 == 1).withColumn("body", F.concat("body", F.lit(" ")))
    nothing = env.filter(e % NO_BODY_EVERY == 0).withColumn("body", F.lit(None).cast("string"))
    again.unionByName(other).unionByName(nothing).coalesce(files).write.mode("append").parquet(path)
    stream = spark.readStream.schema(env.schema).option("maxFilesPerTrigger", files).parquet(path)
    late.start_split(stream, out, f"{out}-checkpoint", LATE_DELAY).awaitTermination()
    return late.rows_of(spark, out).groupBy("body", "verdict").agg(F.count("*").alias("rows"))


def q_stream_compacted(spark, sf_dir):
    """Bronze of a stream after its many small files were packed."""
    configure(spark)
    lh, layout = _scratch_lakehouse(spark, "compacted"), daily.Layout(buckets=SCRATCH_BUCKETS)
    stream = _resent_log(spark, sf_dir)
    ingest.start_bronze_ingest(stream, lh, f"{lh.root}/_checkpoint", layout, LOAD_TS).awaitTermination()
    compaction.compact(lh, layout.bronze_spec())
    return lh.read(layout.bronze_spec()).select("event_id", "body", "yearDevice", "monthDevice", "rowhash")


QUERIES: dict[str, Query] = {
    "stream_compacted": q_stream_compacted,
    "bronze_enrich": q_bronze_enrich,
    "bronze_binary_body": q_bronze_binary_body,
    "severity_v0": q_severity_v0,
    "template_fields": q_template_fields,
    "template_merged": q_template_merged,
    "template_discrepancy": q_template_discrepancy,
    "template_declared": q_template_declared,
    "template_change": q_template_change,
    "stream_replay": q_stream_replay,
    "stream_late_rows": q_stream_late_rows,
    "bronze_bounded_read": q_bronze_bounded_read,
    "bronze_rolling_window": q_bronze_rolling_window,
    "bronze_range_minutes": q_bronze_range_minutes,
    "bronze_merge_new": q_bronze_merge_new,
    "silver_typed": q_silver_typed,
    "silver_one_type": q_silver_one_type,
    "silver_incremental": q_silver_incremental,
    "silver_flags": q_silver_flags,
    "field_diagnosis": q_field_diagnosis,
    "flag_detail": q_flag_detail,
    "types_seen": q_types_seen,
    "types_known_seen": q_types_known_seen,
    "types_unknown": q_types_unknown,
    "blank_type_messages": q_blank_type_messages,
    "recent_hour": q_recent_hour,
    "gold_counts": q_gold_counts,
    "gold_counts_joinform": q_gold_counts_joinform,
    "gold_percent": q_gold_percent,
    "value_class_counts": q_value_class_counts,
    "severity_v1": q_severity_v1,
    "severity_v2": q_severity_v2,
    "gold_severity": q_gold_severity,
    "severity_means": q_severity_means,
    "severity_describe": q_severity_describe,
    "gold_counts_orders": q_gold_counts_orders,
    "gold_severity_orders": q_gold_severity_orders,
    "gold_percent_orders": q_gold_percent_orders,
    "gold_counts_customer": q_gold_counts_customer,
    "value_class_counts_customer": q_value_class_counts_customer,
    "daily_gold_counts": q_daily_gold_counts,
    "daily_two_runs": q_daily_two_runs,
    "daily_gold_severity": q_daily_gold_severity,
    "daily_describe": q_daily_describe,
    "stream_types": q_stream_types,
    "stream_types_unknown": q_stream_types_unknown,
    "stream_bronze": q_stream_bronze,
    "stream_bronze_dedup": q_stream_bronze_dedup,
}


# ---------------------------------------------------------------- SQL side

def _in_list(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def _bronze_cte(blank_type_every: int | None = None) -> str:
    return f"""env AS ({envelope_sql(blank_type_every)}),
bronze AS (
  SELECT event_id, enqueuedTime, body,
    json_extract_string(body, '$.templateId') AS templateId,
    json_extract_string(body, '$.templateName') AS templateName,
    json_extract_string(body, '$.deviceId') AS deviceId,
    TRY_CAST(json_extract_string(body, '$.enqueuedTime') AS TIMESTAMP) AS deviceEnqueueTtime,
    CAST(year(TRY_CAST(json_extract_string(body, '$.enqueuedTime') AS TIMESTAMP)) AS INTEGER) AS yearDevice,
    CAST(month(TRY_CAST(json_extract_string(body, '$.enqueuedTime') AS TIMESTAMP)) AS INTEGER) AS monthDevice,
    sha256(body) AS rowhash,
    TIMESTAMP '{LOAD_TS}' AS loadDatetime
  FROM env)"""


_NUMBER = ("'DOUBLE', 'BIGINT', 'UBIGINT', 'HUGEINT'", "f_type = 'VARCHAR' AND f_text IN ('NaN', 'Infinity', '-Infinity')")
# Per template type: JSON types it accepts, and texts accepted besides.
_ACCEPTS = {"double": _NUMBER, "float": _NUMBER, "integer": ("'BIGINT', 'UBIGINT'", "false"), "boolean": ("'BOOLEAN'", "false")}
_DUCK_TYPES = {"double": "DOUBLE", "float": "FLOAT", "integer": "INTEGER", "boolean": "BOOLEAN"}


def _bad(field: str) -> str:
    types, texts = _ACCEPTS[TEMPLATE[field]]
    texts = texts.replace("f_type", f"type_{field}").replace("f_text", f"text_{field}")
    return f"CASE WHEN type_{field} IS NOT NULL AND type_{field} <> 'NULL' AND type_{field} NOT IN ({types}) AND NOT ({texts}) THEN '{field}' END"


def _parsed_cte(source: str = "bronze") -> str:
    fields = ", ".join(f"json_type(body, '$.telemetry.{f}') AS type_{f}, json_extract_string(body, '$.telemetry.{f}') AS text_{f}" for f in TEMPLATE)
    return f"""typed AS (SELECT *, json_type(body, '$.telemetry') AS t_type, {fields} FROM {source}),
judged AS (SELECT *, list_filter([{", ".join(map(_bad, TEMPLATE))}], lambda x: x IS NOT NULL) AS bad FROM typed),
parsed AS (
  SELECT *,
    CASE WHEN body IS NULL OR NOT json_valid(body) OR json_type(body) <> 'OBJECT' THEN 'unreadable body'
         WHEN t_type IS DISTINCT FROM 'OBJECT' THEN 'no telemetry object'
         WHEN len(bad) > 0 THEN 'type mismatch' END AS reason
  FROM judged)"""


def _silver_cte() -> str:
    fields = ", ".join(f"TRY_CAST(text_{f} AS {_DUCK_TYPES[TEMPLATE[f]]}) AS {f}" for f in TEMPLATE)
    return f"""silver AS (
  SELECT enqueuedTime AS Eventhub_enqueuedTime,
    TRY_CAST(json_extract_string(body, '$.enqueuedTime') AS TIMESTAMP) AS Device_enqueuedTime,
    TRY_CAST(substr(json_extract_string(body, '$.enqueuedTime'), 1, 10) AS DATE) AS Device_Date,
    templateName, deviceId AS DeviceId, {fields},
    loadDatetime AS loaddatetime, rowhash
  FROM parsed WHERE reason IS NULL),
readings AS (SELECT Device_Date AS date, DeviceId AS deviceid, {TELEMETRY_FIELD} AS runninghour FROM silver)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


_CLASS = """CASE WHEN runninghour > 100000 THEN 'large' WHEN runninghour = 0 THEN 'zero'
  WHEN runninghour < 0 THEN 'negative' WHEN runninghour IS NULL THEN 'null' ELSE 'normal' END"""

_COUNTS = """SELECT date, deviceid,
  CASE WHEN date IS NOT NULL AND deviceid IS NOT NULL THEN NULLIF(count(*) FILTER (WHERE runninghour IS NULL), 0) END AS NullCount,
  CASE WHEN date IS NOT NULL AND deviceid IS NOT NULL THEN NULLIF(count(*) FILTER (WHERE runninghour < 0), 0) END AS NegCount,
  CASE WHEN date IS NOT NULL AND deviceid IS NOT NULL THEN NULLIF(count(*) FILTER (WHERE runninghour = 0), 0) END AS ZeroCount,
  CASE WHEN date IS NOT NULL AND deviceid IS NOT NULL THEN NULLIF(count(*) FILTER (WHERE runninghour > 100000), 0) END AS LargeCount,
  count(*) AS TotalCount
FROM readings GROUP BY date, deviceid"""


def _severity_cte() -> str:
    days = f"date_diff('day', date, DATE '{AS_OF}')"
    w1 = ("CASE valuetype WHEN 'normal' THEN 0.0::DOUBLE WHEN 'large' THEN 0.5::DOUBLE "
          "WHEN 'negative' THEN 0.7::DOUBLE WHEN 'null' THEN 0.3::DOUBLE WHEN 'zero' THEN 0.3::DOUBLE ELSE 0.0::DOUBLE END")
    w2 = "CASE valuetype WHEN 'large' THEN 50 WHEN 'negative' THEN 50 WHEN 'null' THEN 30 WHEN 'zero' THEN 40 WHEN 'normal' THEN 0 END"
    v2 = (f"CASE WHEN {days} <= 3 THEN (1 * {w2}) * count / 2880 "
          f"WHEN {days} <= 7 THEN (1.5::DOUBLE * {w2}) * count / 2880 "
          f"WHEN {days} <= 14 THEN (1.8::DOUBLE * {w2}) * count / 2880 "
          f"ELSE (2.0::DOUBLE * {w2}) * count / 2880 END")
    return f"""classes AS (
  SELECT date, deviceid, {_CLASS} AS valuetype, count(*) AS count FROM readings GROUP BY 1, 2, 3),
sev AS (
  SELECT date, deviceid, valuetype, count,
    CAST(CASE WHEN date IS NOT NULL THEN ((count * 1 + {w1}) + {days} * 1) + 0.7::DOUBLE * count END AS FLOAT) AS severity,
    CAST(CASE WHEN date IS NOT NULL THEN round_even({v2}, 0) END AS FLOAT) AS severity_moy
  FROM classes)"""


_ORDERS_READINGS = """readings AS (
  SELECT CAST(o_orderdate AS DATE) AS date, CAST(o_custkey AS VARCHAR) AS deviceid, o_totalprice AS runninghour
  FROM orders)"""

_CUSTOMER_READINGS = """readings AS (
  SELECT CAST(NULL AS DATE) AS date, c_mktsegment AS deviceid, c_acctbal AS runninghour FROM customer)"""


def _gold_prefix() -> str:
    return _with(_bronze_cte(), _parsed_cte(), _silver_cte())


def _per_type(sql: str) -> str:
    """The same gold query with the device type as first key."""
    sql = sql.replace("readings AS (SELECT Device_Date AS date,", "readings AS (SELECT templateName AS device_type, Device_Date AS date,")
    sql = sql.replace("SELECT date, deviceid,", "SELECT device_type, date, deviceid,").replace("GROUP BY date, deviceid", "GROUP BY device_type, date, deviceid")
    return sql.replace("FROM readings GROUP BY 1, 2, 3)", "FROM readings GROUP BY 1, 2, 3, 4)")


_NO_BODY = f"no_body AS (SELECT * FROM bronze WHERE event_id % {NO_BODY_EVERY} = 0)"


def _bronze_cols() -> str:
    return ("event_id, enqueuedTime, body, templateId, templateName, deviceId, deviceEnqueueTtime, "
            "yearDevice, monthDevice, rowhash, loadDatetime")


_JSON_TYPES = ("CASE t WHEN 'BOOLEAN' THEN 'boolean' WHEN 'BIGINT' THEN 'integer' WHEN 'UBIGINT' THEN 'integer' WHEN 'DOUBLE' THEN 'double' "
               "WHEN 'VARCHAR' THEN 'string' WHEN 'OBJECT' THEN 'object' WHEN 'ARRAY' THEN 'array' END")
_OBSERVED = f"""env AS ({envelope_sql()}),
fields AS ({" UNION ALL ".join(f"SELECT json_extract_string(body, '$.templateName') AS TemplateName, '{f}' AS Telemetry, json_type(body, '$.telemetry.{f}') AS t FROM env" for f in TEMPLATE)}),
observed AS (SELECT TemplateName, Telemetry, {_JSON_TYPES} AS DataType, count(*) AS messages FROM fields WHERE t IS NOT NULL AND t <> 'NULL' GROUP BY ALL)"""


def _change_ctes() -> tuple[str, ...]:
    """Messages of one type without device time; a template that gains a field on the second day."""
    body = (f"CASE WHEN contains(body, '\"templateName\":\"{TIMELESS_TYPE}\"') "
            "THEN regexp_replace(body, '\"enqueuedTime\":\"[^\"]*\"', '\"enqueuedTime\":null') ELSE body END")
    early = f"enqueuedTime < TIMESTAMP '{CHANGE}'"
    log = _bronze_cte().replace(f"env AS ({envelope_sql()})", f"env AS (SELECT event_id, enqueuedTime, {body} AS body FROM ({envelope_sql()}))")
    bad = _bad(NEW_FIELD)
    judged = _parsed_cte().replace(bad, f"CASE WHEN {early} THEN NULL ELSE {bad} END")
    value = f"TRY_CAST(text_{NEW_FIELD} AS {_DUCK_TYPES[TEMPLATE[NEW_FIELD]]})"
    return log, judged, _silver_cte().replace(f"{value} AS {NEW_FIELD}", f"CASE WHEN {early} THEN NULL ELSE {value} END AS {NEW_FIELD}")


_DAILY_COUNTS = {
    "n_NullCount": "runninghour IS NULL", "n_NegCount": "runninghour < 0", "n_ZeroCount": "runninghour = 0", "n_LargeCount": "runninghour > 100000",
    **{f"c_{c}": f"({_CLASS}) = '{c}'" for c in ("large", "zero", "negative", "null")},
}


ORACLES: dict[str, str] = {
    "bronze_binary_body": _with(_bronze_cte()) + "SELECT event_id, body, templateName, deviceId, rowhash FROM bronze",
    "severity_v0": _with(_bronze_cte(), _parsed_cte(), _silver_cte())
    + f"SELECT DeviceId, time, valuetype, CAST(CASE WHEN time IS NOT NULL THEN ((1 + CASE valuetype WHEN 'large' THEN 0.5::DOUBLE WHEN 'negative' THEN 0.7::DOUBLE WHEN 'null' THEN 0.3::DOUBLE WHEN 'zero' THEN 0.3::DOUBLE ELSE 0.0::DOUBLE END) "
    f"+ date_diff('day', CAST(time AS DATE), DATE '{AS_OF}')) + power(hour(time) - 12, 2) + 0.7::DOUBLE * 1 END AS FLOAT) AS severity "
    f"FROM (SELECT DeviceId, Device_enqueuedTime AS time, {_CLASS.replace('runninghour', TELEMETRY_FIELD)} AS valuetype FROM silver)",
    "template_fields": _with(_OBSERVED) + "SELECT * FROM observed",
    "template_merged": _with(_OBSERVED) + "SELECT TemplateName, Telemetry, CASE WHEN count(*) = 1 THEN min(DataType) WHEN bool_and(DataType IN ('integer', 'double')) THEN 'double' ELSE 'mixed' END AS DataType FROM observed GROUP BY ALL",
    "template_discrepancy": _with(_OBSERVED)
    + "SELECT Telemetry, TemplateName AS Asset, DataType FROM observed WHERE Telemetry IN (SELECT Telemetry FROM observed GROUP BY 1 HAVING count(DISTINCT DataType) > 1)",
    "template_declared": _with(_OBSERVED)
    + "SELECT TemplateName AS Asset, Telemetry, DataType FROM observed QUALIFY row_number() OVER (PARTITION BY TemplateName, Telemetry ORDER BY messages DESC, DataType DESC) = 1",
    "template_change": _with(*_change_ctes()) + f"SELECT templateName, DeviceId, Device_Date, {', '.join(TEMPLATE)}, rowhash FROM silver",
    "stream_replay": _with(_bronze_cte())
    + f"SELECT event_id, CASE WHEN keep THEN body END AS body, CASE WHEN keep THEN templateName END AS templateName, CASE WHEN keep THEN deviceId END AS deviceId, "
    f"CASE WHEN keep THEN rowhash END AS rowhash FROM (SELECT *, event_id % {NO_BODY_EVERY} <> 0 AS keep FROM bronze)",
    "stream_late_rows": _with(f"env AS ({envelope_sql()})")
    + f"""SELECT body, verdict, count(*) AS rows FROM (
  SELECT body, CASE WHEN row_number() OVER (PARTITION BY body) = 1 THEN 'first' ELSE 'copy' END AS verdict FROM env
  UNION ALL SELECT body, CASE WHEN enqueuedTime < wm THEN 'late' ELSE 'copy' END FROM env, mark WHERE event_id % {RESENT_EVERY} = 0
  UNION ALL SELECT body || ' ', CASE WHEN enqueuedTime < wm THEN 'late' WHEN row_number() OVER (PARTITION BY body, enqueuedTime < wm) = 1 THEN 'first' ELSE 'copy' END FROM env, mark WHERE event_id % 5 = 1
  UNION ALL SELECT NULL, 'first' FROM env WHERE event_id % {NO_BODY_EVERY} = 0) GROUP BY ALL""".replace("FROM env, mark", f"FROM env, (SELECT max(enqueuedTime) - INTERVAL {LATE_DELAY} AS wm FROM env)"),
    "bronze_enrich": _with(_bronze_cte()) + "SELECT * FROM bronze",
    "bronze_bounded_read": _with(f"env AS ({envelope_sql()})")
    + "SELECT * FROM env WHERE enqueuedTime BETWEEN TIMESTAMP '2024-01-10 00:00:00' AND TIMESTAMP '2024-01-20 00:00:00'",
    "bronze_rolling_window": _with(f"env AS ({envelope_sql()})")
    + f"SELECT * FROM env WHERE enqueuedTime >= TIMESTAMP '{LOAD_TS}' - INTERVAL {ROLLING_MINUTES} MINUTE"
    f" AND enqueuedTime <= TIMESTAMP '{LOAD_TS}'",
    "bronze_range_minutes": _with(f"env AS ({envelope_sql()})")
    + "SELECT MIN(enqueuedTime) AS MIN_Date, MAX(enqueuedTime) AS MAX_Date, "
    "date_sub('minute', MIN(enqueuedTime), MAX(enqueuedTime)) AS StreamRange_Minutes FROM env",
    "bronze_merge_new": _with(
        _bronze_cte(),
        f"src AS (SELECT * FROM bronze WHERE enqueuedTime >= TIMESTAMP '{MERGE_SOURCE_FROM}')",
        f"tgt AS (SELECT * FROM bronze WHERE enqueuedTime < TIMESTAMP '{MERGE_TARGET_BEFORE}')",
    )
    + f"SELECT {_bronze_cols()} FROM src WHERE rowhash IS NULL OR NOT EXISTS (SELECT 1 FROM tgt WHERE tgt.rowhash = src.rowhash)",
    "silver_typed": _gold_prefix() + "SELECT * FROM silver",
    "silver_one_type": _with(
        _bronze_cte(), _parsed_cte("(SELECT * FROM bronze WHERE templateName = 'click')"), _silver_cte()
    ) + "SELECT * FROM silver",
    "silver_incremental": _with(
        _bronze_cte(),
        "bronze_inc AS (SELECT * FROM bronze WHERE enqueuedTime >= TIMESTAMP '2024-01-15 00:00:00')",
        _parsed_cte("bronze_inc"),
        _silver_cte(),
    ) + "SELECT * FROM silver",
    "silver_flags": _gold_prefix()
    + "SELECT DISTINCT templateName AS TemplateName, deviceId AS DeviceID, CAST(loadDatetime AS DATE) AS load_date "
    "FROM parsed WHERE reason IS NOT NULL",
    "field_diagnosis": _gold_prefix()
    + "SELECT DISTINCT templateName AS TemplateName, deviceId AS DeviceId, "
    "unnest(CASE WHEN reason = 'type mismatch' THEN bad ELSE [NULL] END) AS FlaggedField, reason AS Reason "
    "FROM parsed WHERE reason IS NOT NULL",
    "flag_detail": _gold_prefix()
    + "SELECT DISTINCT templateName AS TemplateName, deviceId AS DeviceId, "
    "unnest(CASE WHEN reason = 'type mismatch' THEN bad ELSE [NULL] END) AS FlaggedField "
    "FROM parsed WHERE reason IS NOT NULL",
    "types_seen": _with(_bronze_cte()) + "SELECT DISTINCT templateName AS TemplateName FROM bronze ORDER BY 1",
    "types_known_seen": _with(_bronze_cte())
    + f"SELECT DISTINCT templateName AS TemplateName FROM bronze WHERE templateName IN ({_in_list(KNOWN_TYPES)})",
    "types_unknown": _with(_bronze_cte())
    + f"SELECT DISTINCT templateName AS TemplateName FROM bronze WHERE templateName NOT IN ({_in_list(KNOWN_TYPES)})",
    "blank_type_messages": _with(_bronze_cte(BLANK_TYPE_EVERY))
    + "SELECT event_id, body, templateName, deviceId, rowhash FROM bronze WHERE templateName = ''",
    "recent_hour": _with(_bronze_cte())
    + "SELECT event_id, enqueuedTime, 'literal' AS reading FROM bronze WHERE enqueuedTime IS NOT NULL "
    "UNION ALL SELECT event_id, enqueuedTime, 'intended' AS reading FROM bronze "
    f"WHERE enqueuedTime >= TIMESTAMP '{LOAD_TS}' - INTERVAL 60 MINUTE AND enqueuedTime <= TIMESTAMP '{LOAD_TS}'",
    "gold_counts": _gold_prefix() + _COUNTS,
    "gold_counts_joinform": _gold_prefix() + _COUNTS,
    "gold_percent": _gold_prefix()
    + f"SELECT date, deviceid, NullCount / TotalCount * 100 AS NullPercent, NegCount / TotalCount * 100 AS NegPercent, "
    f"ZeroCount / TotalCount * 100 AS ZeroPercent, LargeCount / TotalCount * 100 AS LargePercent, TotalCount "
    f"FROM ({_COUNTS})",
    "value_class_counts": _gold_prefix()
    + f"SELECT date, deviceid, {_CLASS} AS valuetype, count(*) AS count FROM readings GROUP BY 1, 2, 3 ORDER BY 1, 2",
    "severity_v1": _with(_bronze_cte(), _parsed_cte(), _silver_cte(), _severity_cte())
    + "SELECT date, deviceid, valuetype, count, severity FROM sev",
    "severity_v2": _with(_bronze_cte(), _parsed_cte(), _silver_cte(), _severity_cte())
    + "SELECT date, deviceid, valuetype, count, severity_moy FROM sev",
    "gold_severity": _with(_bronze_cte(), _parsed_cte(), _silver_cte(), _severity_cte()) + "SELECT * FROM sev",
    **dict.fromkeys(("daily_gold_counts", "daily_two_runs"), _per_type(_gold_prefix() + _COUNTS)),
    "daily_describe": _per_type(_gold_prefix().rstrip()) + ",\n" + f"d AS (SELECT device_type, date, deviceid, count(*) AS TotalCount, "
    + ", ".join(f"count(*) FILTER (WHERE {p}) AS {n}" for n, p in _DAILY_COUNTS.items()) + " FROM readings GROUP BY ALL)\n"
    + "SELECT device_type, x.c AS \"column\", count(x.v) AS \"count\", round(avg(x.v), 6) AS mean, round(stddev_samp(x.v), 6) AS stddev, round(min(x.v)::DOUBLE, 6) AS \"min\", round(max(x.v)::DOUBLE, 6) AS \"max\" "
    + "FROM d, LATERAL (VALUES ('TotalCount', TotalCount), " + ", ".join(f"('{n}', {n})" for n in _DAILY_COUNTS) + ") x(c, v) GROUP BY device_type, x.c",
    "daily_gold_severity": _per_type(_with(_bronze_cte(), _parsed_cte(), _silver_cte(), _severity_cte()) + "SELECT * FROM sev"),
    "gold_counts_orders": _with(_ORDERS_READINGS) + _COUNTS,
    "gold_severity_orders": _with(_ORDERS_READINGS, _severity_cte()) + "SELECT * FROM sev",
    "gold_percent_orders": _with(_ORDERS_READINGS)
    + "SELECT date, deviceid, NullCount / TotalCount * 100 AS NullPercent, NegCount / TotalCount * 100 AS NegPercent, "
    "ZeroCount / TotalCount * 100 AS ZeroPercent, LargeCount / TotalCount * 100 AS LargePercent, TotalCount "
    f"FROM ({_COUNTS})",
    "gold_counts_customer": _with(_CUSTOMER_READINGS) + _COUNTS,
    "value_class_counts_customer": _with(_CUSTOMER_READINGS)
    + f"SELECT date, deviceid, {_CLASS} AS valuetype, count(*) AS count FROM readings GROUP BY 1, 2, 3",
    "stream_types": _with(_bronze_cte()) + "SELECT DISTINCT templateName AS TemplateName FROM bronze",
    "stream_types_unknown": _with(_bronze_cte())
    + f"SELECT DISTINCT templateName AS TemplateName FROM bronze WHERE templateName NOT IN ({_in_list(KNOWN_TYPES)})",
    "stream_bronze": _with(_bronze_cte(), _NO_BODY)
    + "SELECT event_id, body, templateId, templateName, deviceId, yearDevice, monthDevice, rowhash, loadDatetime FROM bronze "
    "UNION ALL SELECT event_id, NULL, NULL, NULL, NULL, NULL, NULL, NULL, loadDatetime FROM no_body, range(2)",
    "stream_compacted": _with(_bronze_cte(), _NO_BODY)
    + "SELECT event_id, body, yearDevice, monthDevice, rowhash FROM bronze UNION ALL SELECT event_id, NULL, NULL, NULL, NULL FROM no_body",
    "stream_bronze_dedup": _with(_bronze_cte(), _NO_BODY)
    + "SELECT DISTINCT body, templateId, templateName, deviceId, rowhash FROM bronze "
    "UNION ALL SELECT NULL, NULL, NULL, NULL, NULL FROM no_body",
    "severity_describe": _with(_bronze_cte(), _parsed_cte(), _silver_cte(), _severity_cte())
    + " UNION ALL ".join(
        f"SELECT '{name}' AS summary, round(CAST(CAST({fn.format('severity_moy')} AS VARCHAR) AS DOUBLE), 4) AS severity_moy, round(CAST(CAST({fn.format('severity')} AS VARCHAR) AS DOUBLE), 4) AS severity FROM sev"
        for name, fn in (("count", "count({})"), ("mean", "avg({})"), ("stddev", "stddev_samp({})"), ("min", "min({})"), ("max", "max({})"))),
    "severity_means": _with(_bronze_cte(), _parsed_cte(), _silver_cte(), _severity_cte())
    + "SELECT date, deviceid, avg(count) AS avg_count, avg(severity) AS avg_severity, "
    "avg(severity_moy) AS avg_severity_moy FROM sev GROUP BY date, deviceid",
}
