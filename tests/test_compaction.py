"""Compaction: same rows, fewer files, layout and pruning kept, breaking off included."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from lakestrata.operators import merge
from lakestrata.plans import compaction
from lakestrata.plans.tables import Lakehouse, TableSpec
from lakestrata.session import scratch_path

SPEC = TableSpec("t", ("day", "kind"), "k", 3)


def filled(spark, name):
    lh = Lakehouse(spark, scratch_path(spark, name) + "/lake", name.replace("-", "_"))
    for run in range(4):
        days = [dt.date(2024, 1, 1), None, dt.date(2024, 1, 2 + run)]
        rows = [(f"{run}-{i}", i, days[i % 3], "a b/é+ü" if i % 2 else None) for i in range(24)]
        lh.append(SPEC, spark.createDataFrame(rows, "k string, v int, day date, kind string"))
    return lh


def count_files(lh):
    return compaction.files(lh, SPEC).count()


def rows(lh):
    return sorted(map(str, lh.read(SPEC).collect()))


def test_compaction_keeps_rows_and_layout(spark):
    lh = filled(spark, "compact-keep")
    before, n, want = rows(lh), count_files(lh), {(r["folder"], r["bucket"]) for r in compaction.files(lh, SPEC).collect()}
    single = {r["folder"]: r["path"] for r in compaction.files(lh, SPEC).collect() if r["folder"].startswith("day=2024-01-03")}
    assert compaction.compact(lh, SPEC) == 4  # two dates, one of them NULL, times two kinds; the others have a file per bucket
    assert rows(lh) == before and count_files(lh) < n
    assert {(r["folder"], r["bucket"]) for r in compaction.files(lh, SPEC).collect()} == want
    assert count_files(lh) == len(want)  # a file for each partition and bucket
    assert {r["folder"]: r["path"] for r in compaction.files(lh, SPEC).collect() if r["folder"].startswith("day=2024-01-03")}.keys() == single.keys()
    assert compaction.compact(lh, SPEC) == 0 and lh.list_tables() == ["t"]
    # a new session, a merge and an append go on as before
    other = Lakehouse(spark.newSession(), lh.root, f"{lh.database}_new")
    assert rows(other) == before
    source = spark.createDataFrame([("0-0", 1, dt.date(2024, 1, 1), None), ("new", 1, dt.date(2024, 1, 1), None)], "k string, v int, day date, kind string")
    new = merge.new_rows(source, lh.read(SPEC), "k", SPEC.partition_by)
    assert [r["k"] for r in new.collect()] == ["new"]
    keys = lh.read(SPEC).groupBy("k").count()
    assert "Exchange" not in keys._jdf.queryExecution().executedPlan().toString()
    lh.append(SPEC, source)
    assert lh.read(SPEC).count() == len(before) + 2


@pytest.mark.parametrize("done", [0, 1, 3])
def test_an_exchange_that_breaks_off_is_finished(spark, monkeypatch, done):
    lh = filled(spark, f"compact-broke-{done}")
    before = rows(lh)
    real = compaction.finish
    monkeypatch.setattr(compaction, "finish", lambda lh, spec: None)
    compaction.compact(lh, SPEC)
    note = lh.notes.latest(compaction.NOTE, "t")[1]
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(lh.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for folder in note["folders"][:done]:  # as far as it came: the last of these is neither here nor there
        fs.mkdirs(path(f"{note['staged']}/_replaced/{folder}").getParent())
        fs.rename(path(f"{note['root']}/{folder}"), path(f"{note['staged']}/_replaced/{folder}"))
        if folder != note["folders"][done - 1]:
            fs.rename(path(f"{note['staged']}/{folder}"), path(f"{note['root']}/{folder}"))
    monkeypatch.setattr(compaction, "finish", real)
    compaction.finish(lh, SPEC)
    assert rows(lh) == before and lh.notes.latest(compaction.NOTE, "t") is None and compaction.compact(lh, SPEC) == 0


def test_plan_packs_small_files_only(spark):
    listed = spark.createDataFrame([("p=1", "0", "a", 10), ("p=1", "0", "b", 20), ("p=1", "1", "c", 200), ("p=2", "0", "d", 90), ("p=2", "0", "e", 95), ("p=3", "0", "f", 300), ("p=3", "0", "g", 400)], "folder string, bucket string, path string, bytes long")
    got = {r["folder"]: (r["files"], r["packed"]) for r in compaction.plan(listed, 100).collect()}
    assert got == {"p=1": (3, 2)}  # p=2: two files of 185 bytes need two; p=3: none is small


def test_unpartitioned_table(spark):
    lh, spec = Lakehouse(spark, scratch_path(spark, "compact-flat") + "/lake", "compact_flat"), TableSpec("flat")
    for _ in range(3):
        lh.append(spec, spark.range(5).coalesce(1))
    assert compaction.compact(lh, spec) == 1 and lh.read(spec).count() == 15
    assert lh.read(spec).agg(F.countDistinct("id")).first()[0] == 5
