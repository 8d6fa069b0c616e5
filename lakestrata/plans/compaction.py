"""Compaction: partitions of many small files rewritten into few, layout kept.

Daily appends add a file per bucket and device date; a partition that many
runs have touched holds many small ones.  The plan comes from the files'
sizes alone (a listing, no data is read): per partition and bucket, files
below ``target_bytes`` are packed into as many files as their bytes need, and a
partition is rewritten only if that saves files.  Rewritten rows go to a
folder of their own, bucketed like the table; then the partitions' folders are
exchanged one by one.  A note names the exchange before it begins, so one that
breaks off is finished by the next compaction (or by :func:`finish`).  Until a
partition is exchanged readers see its old files; as for all writes here there
is one writer, and a job that reads while folders are exchanged may have to be run
again.
"""

from __future__ import annotations

import uuid
from urllib.parse import quote

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestrata.operators import merge
from lakestrata.plans.tables import Lakehouse, TableSpec

NOTE = "compaction"
TARGET_BYTES = 256 << 20


def files(lh: Lakehouse, spec: TableSpec) -> DataFrame:
    """(folder, bucket, path, bytes) of a table's data files; ``folder`` is the partition's, below the table's."""
    root = lh.path(spec.name)
    listed = lh.spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(root)
    name = F.substring_index("path", "/", -1)
    inside = F.regexp_extract("path", rf"/{quote(root.rsplit('/', 1)[-1])}/(.*?)/?[^/]*$", 1)
    bucket = F.regexp_extract(name, r"_(\d+)\.c\d+", 1)
    return listed.select(inside.alias("folder"), bucket.alias("bucket"), "path", F.col("length").alias("bytes"))


def plan(listed: DataFrame, target_bytes: int = TARGET_BYTES) -> DataFrame:
    """(folder, files, packed): partitions that packing leaves with fewer files.

    Files are packed first-fit in no order, so their bytes divided by the
    target tell how many are left; a file of the target's size stays one.
    """
    small = F.col("bytes") < target_bytes
    per = listed.groupBy("folder", "bucket").agg(
        F.count("*").alias("files"),
        (F.count_if(~small) + F.ceil(F.sum(F.when(small, F.col("bytes")).otherwise(0)) / target_bytes)).alias("packed"),
    )
    return per.groupBy("folder").agg(F.sum("files").alias("files"), F.sum("packed").alias("packed")).filter("packed < files")


def compact(lh: Lakehouse, spec: TableSpec, target_bytes: int = TARGET_BYTES) -> int:
    """Rewrite the partitions that the plan names; returns how many."""
    finish(lh, spec)
    rows = lh.read(spec)
    todo = plan(files(lh, spec), target_bytes).select("folder").limit(merge.MAX_BATCH_PARTITIONS + 1).collect()
    if len(todo) > merge.MAX_BATCH_PARTITIONS:
        raise ValueError(f"more than {merge.MAX_BATCH_PARTITIONS} partitions to compact")
    folders = sorted(r["folder"] for r in todo)
    if not folders:
        return 0
    if not spec.partition_by:  # one folder: the swap of an overwrite does it
        lh.overwrite(spec, rows)
        return 1
    staged = TableSpec(f"{spec.name}__{uuid.uuid4().hex[:12]}", spec.partition_by, spec.bucket_by, spec.buckets)
    root = lh.path(spec.name)
    # the partition columns' values name the folders: Spark reads only these partitions
    listed = lh.spark.createDataFrame([(f,) for f in folders], "folder string")
    names = [F.regexp_extract("folder", rf"(?:^|/){c}=([^/]*)", 1) for c in spec.partition_by]
    values = listed.select(F.concat_ws("/", *[F.when(n == "__HIVE_DEFAULT_PARTITION__", "(null)").otherwise(F.url_decode(F.replace(n, F.lit("+"), F.lit("%2B")))) for n in names]).alias("k"))
    keys = merge.in_partitions(rows, [r["k"] for r in values.collect()], spec.partition_by)
    lh.create(staged, keys)
    lh.notes.put(NOTE, spec.name, 1, {"staged": lh.path(staged.name), "table": staged.name, "root": root, "folders": folders})
    finish(lh, spec)
    return len(folders)


def finish(lh: Lakehouse, spec: TableSpec) -> None:
    """Exchange the folders of a compaction that is noted; nothing to do without a note."""
    found = lh.notes.latest(NOTE, spec.name)
    if found is None:
        return
    work, path = found[1], lh.spark._jvm.org.apache.hadoop.fs.Path
    fs = path(work["root"]).getFileSystem(lh.spark.sparkContext._jsc.hadoopConfiguration())
    for folder in work["folders"]:
        old, new, gone = path(f"{work['root']}/{folder}"), path(f"{work['staged']}/{folder}"), path(f"{work['staged']}/_replaced/{folder}")
        if fs.exists(new):  # otherwise it has been exchanged already
            if fs.exists(old):
                fs.mkdirs(gone.getParent())
                fs.rename(old, gone)
            fs.rename(new, old)
    lh.notes.forget(NOTE, spec.name)
    lh.drop(work["table"])
    lh.spark.catalog.refreshTable(lh.fq(spec.name))
