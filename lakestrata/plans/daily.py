"""The daily batch: bronze ingest, then silver and gold per device type.

Jobs write tables through :class:`~lakestrata.plans.tables.Lakehouse`;
each returns small DataFrames describing what it did.  Nothing is passed
through the driver except the template schemas (configuration) and the
handful of partition values used to prune merge targets.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakestrata.operators import bronze, diagnosis, gold, merge, moments, silver
from lakestrata.plans.tables import Lakehouse, TableSpec
from lakestrata.session import require
from lakestrata.sources import eventlog

# Bucket count of the history tables, fixed when a table is created.  Size
# it so that one day's batch gives buckets of a few hundred MB: about 270 GB
# of bronze a day (100 TB a year) -> 256-1024 buckets.
DEFAULT_BUCKETS = 256
# Bronze columns that the silver step reads.
SILVER_INPUT = ("enqueuedTime", "body", "templateName", "deviceId", "loadDatetime", "rowhash")
# Device types processed concurrently by the daily batch.
DEFAULT_PARALLEL_TYPES = 4


@dataclass
class Layout:
    """Table names and physical layout of one lakehouse."""

    buckets: int = DEFAULT_BUCKETS
    silver_buckets: int | None = None  # default: same as bronze
    bronze: str = "bronze"
    scratch: str = "bronze_staging"
    silver_prefix: str = "silver"
    gold_prefix: str = "gold"

    def bronze_spec(self) -> TableSpec:
        return TableSpec(self.bronze, bronze.PARTITION_COLS, "rowhash", self.buckets)

    def scratch_spec(self) -> TableSpec:
        return TableSpec(self.scratch)

    def loads_spec(self) -> TableSpec:
        return TableSpec(f"{self.bronze}_loads")

    def silver_spec(self, device_type: str) -> TableSpec:
        name = f"{self.silver_prefix}_{device_type.replace(' ', '')}"
        return TableSpec(name, ("Device_Date",), "rowhash", self.silver_buckets or self.buckets)

    def flags_spec(self) -> TableSpec:
        return TableSpec(f"{self.silver_prefix}_FLAGS", ("load_date",))

    def flag_detail_spec(self) -> TableSpec:
        return TableSpec(f"{self.silver_prefix}_flagdetail")

    def investigation_spec(self, device_type: str) -> TableSpec:
        return TableSpec(f"{self.silver_prefix}_{device_type.replace(' ', '')}_investigation")

    def gold_spec(self, device_type: str) -> TableSpec:
        return TableSpec(f"{self.gold_prefix}_{device_type.replace(' ', '')}")

    def severity_spec(self, device_type: str) -> TableSpec:
        return TableSpec(f"{self.gold_prefix}_{device_type.replace(' ', '')}_Severity")

    def pending_spec(self, device_type: str) -> TableSpec:
        """Device dates whose silver rows may have changed since gold was built."""
        return TableSpec(f"{self.gold_prefix}_{device_type.replace(' ', '')}_pending")

    def moments_spec(self, device_type: str) -> TableSpec:
        """Moments of the daily counts' columns, a few rows per device date."""
        return TableSpec(f"{self.gold_prefix}_{device_type.replace(' ', '')}_moments", ("date",))

    def daily_counts_spec(self, device_type: str) -> TableSpec:
        return TableSpec(f"{self.gold_prefix}_{device_type.replace(' ', '')}_daily", ("date",))


@dataclass
class DeviceType:
    """A device type, its telemetry struct and (optionally) its gold field."""

    name: str
    telemetry: T.StructType
    gold_field: str | None = None
    large_threshold: float = gold.LARGE_THRESHOLD
    rows_per_day: int = gold.ROWS_PER_DAY


@dataclass
class BatchResult:
    range_report: DataFrame | None = None
    written: dict = field(default_factory=dict)


def merge_into(lh: Lakehouse, spec: TableSpec, source: DataFrame, key: str = "rowhash",
               dedup_source: bool = False, null_keys: bool = True, partition_keys: list[str] | None = None) -> None:
    """Create the table from the batch when absent, then merge insert-only.

    Same result as create-then-MERGE: after a create, every non-NULL key of
    the batch is in the table, so the merge can only add the NULL-key rows
    again - those are appended directly, without joining the batch against
    itself.  Otherwise the anti-join of ``merge.new_rows`` runs against the
    partitions of the table that the batch touches.  ``dedup_source`` keeps
    one row per key of the batch (by default every copy is inserted);
    ``null_keys=False`` leaves out the second writing of NULL-key rows after a
    create (silver has none: a NULL body is always flagged; a stream must not
    depend on which micro-batch creates the table).  ``partition_keys`` names the
    partitions that the batch touches, where they are known already.
    """
    if dedup_source:
        source = source.filter(F.col(key).isNull()).unionByName(
            source.filter(F.col(key).isNotNull()).dropDuplicates([key]))
    if lh.create_if_absent(spec, source):
        if null_keys:
            lh.append_if_rows(spec, source.filter(F.col(key).isNull()))
    else:
        lh.append(spec, merge.new_rows(source, lh.read(spec), key, spec.partition_by, partition_keys=partition_keys))


def ingest_bronze(lh: Lakehouse, events: DataFrame, start, end=None, load_ts=None,
                  layout: Layout | None = None, dedup_source: bool = False) -> DataFrame:
    """Bounded event-log read -> bronze, insert-only on rowhash.

    The enriched batch is staged once to the scratch table (the log is read
    once; the merge and the range report read the stage), which is emptied
    at the end.  A new bronze table is created from the whole batch; the
    merge then runs in every case, so - as with MERGE after the first write -
    NULL-hash rows are added again.  Returns the batch range report (one
    row, computed here: the stage does not outlive the call).
    """
    layout = layout or Layout()
    batch = bronze.enrich(eventlog.spread(eventlog.bounded(events, start, end)), load_ts)
    scratch = layout.scratch_spec()
    lh.overwrite(scratch, batch)
    staged = lh.read(scratch)
    # Index first: a failure after it leaves a superset of partitions indexed.
    touched = record_load(lh, staged, layout)
    merge_into(lh, layout.bronze_spec(), staged, dedup_source=dedup_source, partition_keys=touched)
    compact_loads(lh, layout)
    report = bronze.range_report(staged)
    report = lh.spark.createDataFrame(report.collect(), report.schema)
    lh.truncate(scratch)
    return report


def _spans(rows: DataFrame) -> DataFrame:
    t = F.col("enqueuedTime").cast("timestamp")
    return rows.groupBy(*bronze.PARTITION_COLS).agg(
        F.min(t).alias("from_time"), F.max(t).alias("to_time"), F.count(F.lit(1)).alias("rows"))


def record_load(lh: Lakehouse, batch: DataFrame, layout: Layout | None = None) -> list[str]:
    """Append to the load index: bronze partitions touched, with their span of hub time.

    A bronze table older than its index is indexed whole the first time, so
    the index always covers every row.  Returns the partitions' keys (bounded,
    see ``merge.MAX_BATCH_PARTITIONS``), which the merge needs next.
    """
    layout = layout or Layout()
    spec = layout.loads_spec()
    if not lh.exists(spec) and lh.exists(layout.bronze_spec()):
        lh.append(spec, _spans(lh.read(layout.bronze_spec())))
    spans = _spans(batch).withColumn("key", merge.partition_key(bronze.PARTITION_COLS))
    found = spans.limit(merge.MAX_BATCH_PARTITIONS + 1).collect()
    if len(found) > merge.MAX_BATCH_PARTITIONS:
        raise ValueError(f"a batch touches more than {merge.MAX_BATCH_PARTITIONS} partitions")
    lh.append(spec, lh.spark.createDataFrame(found, spans.schema).drop("key").coalesce(1))
    return [r["key"] for r in found]


def compact_loads(lh: Lakehouse, layout: Layout | None = None) -> None:
    """One row for each bronze partition in the load index: its span over all loads."""
    spec = (layout or Layout()).loads_spec()
    loads = lh.read(spec).groupBy(*bronze.PARTITION_COLS)
    lh.overwrite(spec, loads.agg(F.min("from_time").alias("from_time"), F.max("to_time").alias("to_time"), F.sum("rows").alias("rows")).coalesce(1))


def bronze_window(lh: Lakehouse, start: dt.datetime | None, device_types: list[str],
                  layout: Layout | None = None) -> DataFrame:
    """Bronze rows with hub time ``>= start`` of the given types; no start: all rows.

    Bronze is partitioned by device time, the window is on hub time.  The
    load index keeps the span of hub time of each load's partitions; only
    partitions with a row at ``start`` or later are read.  Without an index
    bronze is read whole, relying on Parquet statistics for the time filter.
    """
    layout = layout or Layout()
    table = lh.read(layout.bronze_spec())
    if start is not None and lh.exists(layout.loads_spec()):
        late = F.col("to_time") >= F.lit(start.isoformat(sep=" ")).cast("timestamp")
        table = merge.touched_partitions(table, lh.read(layout.loads_spec()).filter(late), bronze.PARTITION_COLS)
    return silver.select_types(eventlog.incremental(table, start), device_types)


def refine_silver(lh: Lakehouse, bronze_window: DataFrame, device: DeviceType,
                  layout: Layout | None = None, diagnose: bool = False, dedup_flags: bool = False) -> bool:
    """Bronze rows (already windowed) -> flags (appended) + silver (merged).

    The parse is persisted once and read by the flags, the silver rows and
    (optionally) the field diagnosis.  Flags are appended on every run, so
    overlapping windows repeat a ``(type, device, load date)``;
    ``dedup_flags`` appends only triples the flags table lacks.  The device
    dates of the batch are noted as pending for gold *before* silver is
    written, so a run that dies in between is made good by the next one.
    Returns whether flags were written.
    """
    layout = layout or Layout()
    parsed = silver.parse(silver.select_types(bronze_window, device.name), device.telemetry)
    parsed = parsed.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        flags = silver.flags(parsed)
        if dedup_flags and lh.exists(layout.flags_spec()):
            # Only the batch's load dates can match (a handful of partitions).
            seen = merge.touched_partitions(lh.read(layout.flags_spec()), flags, ["load_date"])
            same = [flags[c].eqNullSafe(seen[c]) for c in flags.columns]
            cond = same[0]
            for c in same[1:]:
                cond = cond & c
            flags = flags.join(seen, cond, "left_anti")
        wrote_flags = lh.append_if_rows(layout.flags_spec(), flags)
        if diagnose and wrote_flags:
            lh.append(layout.flag_detail_spec(),
                      diagnosis.diagnose_as_detail(diagnosis.diagnose(parsed, device.telemetry)))
        rows = silver.rows(parsed)
        if device.gold_field is not None:
            lh.append(layout.pending_spec(device.name), rows.select("Device_Date").distinct().coalesce(1))
        merge_into(lh, layout.silver_spec(device.name), rows, null_keys=False)
    finally:
        parsed.unpersist()
    return wrote_flags


def build_gold(lh: Lakehouse, device: DeviceType, as_of: str | dt.date | None = None,
               layout: Layout | None = None, full: bool = False) -> None:
    """Silver -> daily counts -> gold counts and gold severity.

    The daily counts (one row per device and day: total, anomaly-predicate
    and value-class counts) are kept in a table partitioned by date.  The
    pending device dates - noted before any silver write, cleared here after
    gold is written - are recomputed from silver (a partition-pruned read)
    and their partitions replaced.  A run that failed leaves its dates
    pending, so the table stays exact.  ``full``, or the first run, rebuilds
    it from all of silver.  Gold counts and severity (which depends on
    ``as_of``) are then projections of the small daily table, overwritten.
    """
    layout = layout or Layout()
    if device.gold_field is None:
        return
    as_of = as_of or dt.date.today()
    spec, pending = layout.daily_counts_spec(device.name), layout.pending_spec(device.name)
    silver_df = lh.read(layout.silver_spec(device.name))
    if full or not lh.exists(spec) or not lh.exists(pending):
        daily = gold.daily_counts(gold.readings(silver_df, device.gold_field), device.large_threshold)
        lh.overwrite(spec, daily)
    else:
        part = merge.touched_partitions(silver_df, lh.read(pending), ["Device_Date"])
        daily = gold.daily_counts(gold.readings(part, device.gold_field), device.large_threshold)
        lh.replace_partitions(spec, daily)
    daily = lh.read(spec)
    lh.overwrite(layout.gold_spec(device.name), gold.counts_from_daily(daily))
    sev = gold.severity(gold.class_rows_from_daily(daily), as_of, device.rows_per_day)
    lh.overwrite(layout.severity_spec(device.name), sev)
    lh.truncate(pending)


def run_daily(lh: Lakehouse, events: DataFrame, devices: Mapping[str, DeviceType] | list[DeviceType],
              minutes: int = 3000, as_of: dt.datetime | None = None, load_ts=None,
              layout: Layout | None = None, diagnose: bool = False,
              parallel_types: int = DEFAULT_PARALLEL_TYPES, dedup_flags: bool = False,
              start: dt.datetime | None = None, full_refresh: bool = False) -> BatchResult:
    """K7: ingest the last ``minutes`` up to ``as_of``, then silver and gold per type.

    ``start`` gives the window's begin itself instead of ``minutes``.
    ``full_refresh`` lets silver read all of bronze and rebuilds gold.

    Bronze is read once for all types: filtered to the window and the known
    types, persisted, and parsed per type from there.  The per-type jobs are
    independent (own tables) and are submitted from up to
    ``parallel_types`` threads, so small types do not leave the cluster idle.
    """
    require(lh.spark)
    layout = layout or Layout()
    devices = list(devices.values()) if isinstance(devices, Mapping) else list(devices)
    as_of = as_of or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    start = start or as_of - dt.timedelta(minutes=minutes)
    report = ingest_bronze(lh, events, start, as_of, load_ts, layout)
    window = bronze_window(lh, None if full_refresh else start, [d.name for d in devices], layout)
    # Only what silver and the flags read is kept, dealt out by type.
    window = window.select(*[c for c in window.columns if c in SILVER_INPUT]).persist(StorageLevel.MEMORY_AND_DISK)

    def one_type(device: DeviceType) -> dict:
        flagged = refine_silver(lh, window, device, layout, diagnose, dedup_flags)
        build_gold(lh, device, as_of.date(), layout, full_refresh)
        return {"flags": flagged}

    try:
        workers = max(1, min(parallel_types, len(devices)))
        with ThreadPoolExecutor(max_workers=workers) as pool:
            futures = {d.name: pool.submit(one_type, d) for d in devices}
            written = {name: f.result() for name, f in futures.items()}
    finally:
        window.unpersist()
    return BatchResult(report, written)


def investigate(lh: Lakehouse, device: DeviceType, start: dt.datetime | None = None,
                layout: Layout | None = None) -> DataFrame:
    """The field diagnosis of one type over stored bronze, as a job of its own.

    Overwrites the type's investigation table (TemplateName, DeviceId,
    FlaggedField, Reason) and returns it; ``start`` bounds the hub time.
    """
    require(lh.spark)
    layout = layout or Layout()
    window = bronze_window(lh, start, [device.name], layout)
    lh.overwrite(layout.investigation_spec(device.name), diagnosis.diagnose(silver.parse(window, device.telemetry), device.telemetry))
    return lh.read(layout.investigation_spec(device.name))


def refresh_moments(lh: Lakehouse, device: DeviceType, layout: Layout | None = None, since: dt.date | None = None) -> None:
    """Moments of the daily counts per device date: all dates the first time, later those from ``since`` on.

    Call it after :func:`build_gold`; a date without a value (NULL) is always
    computed anew.
    """
    layout = layout or Layout()
    spec, daily = layout.moments_spec(device.name), lh.read(layout.daily_counts_spec(device.name))
    if since is not None and lh.exists(spec):
        daily = daily.filter((F.col("date") >= F.lit(since)) | F.col("date").isNull())
        lh.replace_partitions(spec, moments.moments(daily, ["date"]))
    else:
        lh.overwrite(spec, moments.moments(daily, ["date"]))


def describe_daily(lh: Lakehouse, device: DeviceType, layout: Layout | None = None) -> DataFrame:
    """count, mean, stddev, min, max of every numeric column of the daily counts, from the moments alone."""
    return moments.describe(lh.read((layout or Layout()).moments_spec(device.name)))


def gold_tables(lh: Lakehouse, devices: list[DeviceType], layout: Layout | None = None,
                severity: bool = False) -> DataFrame:
    """All gold tables of the given types, with a ``device_type`` column."""
    layout = layout or Layout()
    out = None
    for d in devices:
        spec = layout.severity_spec(d.name) if severity else layout.gold_spec(d.name)
        part = lh.read(spec).withColumn("device_type", F.lit(d.name))
        out = part if out is None else out.unionByName(part)
    return out


def backfill(lh: Lakehouse, events: DataFrame, devices: Mapping[str, DeviceType] | list[DeviceType],
             start: dt.datetime, end: dt.datetime, slice_minutes: int = 1440, **kwargs) -> list[BatchResult]:
    """The daily batch over ``[start, end]`` in consecutive slices.

    A long window processed at once holds the whole range in one set of
    shuffles; slicing bounds each run to ``slice_minutes`` of log.  Each
    slice is a normal run through the same insert-only merges, so a row on
    a slice boundary (both windows are inclusive) is stored once, and the
    result equals one run over the whole range.
    """
    if slice_minutes <= 0:
        raise ValueError("slice_minutes must be positive")
    results = []
    lower = start
    while lower < end:
        upper = min(lower + dt.timedelta(minutes=slice_minutes), end)
        results.append(run_daily(lh, events, devices, as_of=upper, start=lower, **kwargs))
        lower = upper
    return results
