"""Insert-only merge: add the source rows whose key the target lacks.

Semantics of ``MERGE ... ON t.key = s.key WHEN NOT MATCHED THEN INSERT``:
rows already present are never updated or deleted, duplicates *inside* the
batch are all inserted (the source is not de-duplicated unless asked), and
a NULL key never matches, so NULL-key rows are inserted on every run.

Plan, for a target far larger than the batch, the same at every size:

* The target side is pruned to the partitions the batch touches (equal
  bodies give equal device times, hence equal partitions), and only its key
  column is read.
* The batch's distinct keys (combined map-side, so a body copied into a
  third of the batch costs a row per task) are anti-joined with the
  target; the bucketed target scan is not shuffled.
* The batch's rows are then semi-joined with the keys found new.  Both
  sides are ordinary shuffles, so adaptive execution splits a hot key.
* Both joins are sort-merge joins by a hint.  Sizes are estimated from the
  files and count a hash as 20 bytes, so that many millions of keys can pass
  for a table small enough to be broadcast, through the driver's memory.
* NULL keys bypass the joins: they can never match, and routing them
  through a shuffle would send them all to one reducer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A batch that touches more partitions than this is refused: the batch would
# write as many folders, and their names pass through the driver.
MAX_BATCH_PARTITIONS = 100_000


def partition_key(cols: Sequence[str]) -> Column:
    """A text that tells partitions apart, NULL values included."""
    return F.concat_ws("/", *[F.coalesce(F.col(c).cast("string"), F.lit("(null)")) for c in cols])


def touched_partitions(target: DataFrame, batch: DataFrame, cols: Sequence[str]) -> DataFrame:
    """The rows of ``target`` in partitions that ``batch`` has rows for.

    One membership test on partition columns: the scan lists only these.
    """
    keys = batch.select(partition_key(cols).alias("k")).distinct().limit(MAX_BATCH_PARTITIONS + 1).collect()
    return in_partitions(target, [r["k"] for r in keys], cols)


def in_partitions(target: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """The rows of ``target`` in the partitions that ``keys`` (see :func:`partition_key`) name."""
    if len(keys) > MAX_BATCH_PARTITIONS:
        raise ValueError(f"a batch touches more than {MAX_BATCH_PARTITIONS} partitions")
    return target.filter(partition_key(cols).isin(list(keys)))


def new_rows(source: DataFrame, target: DataFrame, key: str = "rowhash",
             partition_cols: Sequence[str] | None = None, dedup_source: bool = False,
             partition_keys: Sequence[str] | None = None) -> DataFrame:
    """Source rows to insert: key NULL, or key absent from the target.

    ``dedup_source``: one row per key of the batch.  ``partition_keys``: the
    partitions that the source touches, where the caller knows them already.
    """
    k = F.col(key)
    if partition_cols and partition_keys is not None:
        target = in_partitions(target, partition_keys, partition_cols)
    elif partition_cols:
        target = touched_partitions(target, source, partition_cols)
    keyed = source.filter(k.isNotNull())
    existing = target.select(key).filter(k.isNotNull())
    fresh = keyed.select(key).distinct().join(existing.hint("merge"), on=key, how="left_anti")
    if dedup_source:
        keyed = keyed.dropDuplicates([key])
    return keyed.join(fresh.hint("merge"), on=key, how="left_semi").unionByName(source.filter(k.isNull()))


def insert_new_sql(spark, target_table: str, source: DataFrame, key: str = "rowhash",
                   view: str = "source") -> None:
    """The SQL form over a temp view: ``INSERT INTO target SELECT new source rows``.

    ``MERGE ... WHEN NOT MATCHED THEN INSERT`` needs a transactional table
    format; on Parquet tables the same statement is an ``INSERT`` of the
    source rows that have no matching key (a NULL key never matches).
    Columns are matched by name.  The statement reads the whole key column
    of the target; :func:`new_rows` prunes it and is what the jobs use.  The
    view is gone afterwards.
    """
    source.createOrReplaceTempView(view)
    try:
        columns = ", ".join(f"s.`{c}`" for c in spark.table(target_table).columns)
        spark.sql(
            f"INSERT INTO {target_table} SELECT /*+ MERGE(t) */ {columns} FROM {view} s "
            f"LEFT ANTI JOIN {target_table} t ON s.`{key}` = t.`{key}`"
        )
    finally:
        spark.catalog.dropTempView(view)
