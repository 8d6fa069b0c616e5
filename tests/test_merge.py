"""Insert-only merge semantics (DataFrame and SQL forms)."""

import datetime as dt

from lakestrata.operators import merge
from lakestrata.plans import daily
from lakestrata.plans.tables import Lakehouse, TableSpec
from lakestrata.schemas import telemetry_struct
from lakestrata.session import scratch_path
from lakestrata.sources.envelope import read_envelope

SCHEMA = "rowhash string, yearDevice int, monthDevice int, v int"


def test_new_rows_semantics(spark):
    target = spark.createDataFrame([("a", 2024, 1, 1), ("b", 2024, 1, 2), ("z", 2023, 5, 9)], SCHEMA)
    source = spark.createDataFrame(
        [("a", 2024, 1, 10), ("c", 2024, 1, 11), ("c", 2024, 1, 12), (None, None, None, 13), ("z", 2023, 5, 14)],
        SCHEMA,
    )
    got = sorted(r["v"] for r in merge.new_rows(source, target, "rowhash", ["yearDevice", "monthDevice"]).collect())
    # existing hashes dropped, in-batch duplicates kept, NULL hash kept
    assert got == [11, 12, 13]
    dedup = merge.new_rows(source, target, "rowhash", None, dedup_source=True).collect()
    assert sorted(r["rowhash"] or "" for r in dedup) == ["", "c"]


def test_touched_partitions_include_null_partition(spark):
    source = spark.createDataFrame([("a", 2024, 1, 1), ("b", None, None, 2)], SCHEMA)
    target = spark.createDataFrame([("x", 2024, 1, 1), ("y", None, None, 2), ("w", 2024, 2, 3)], SCHEMA)
    got = merge.touched_partitions(target, source, ["yearDevice", "monthDevice"])
    assert sorted(r["rowhash"] for r in got.collect()) == ["x", "y"]


def test_copied_body_in_a_third_of_the_batch(spark):
    rows = [("hot", 2024, 1, i) for i in range(300)] + [(f"k{i}", 2024, 1, 1000 + i) for i in range(600)]
    rows += [(None, None, None, 5000 + i) for i in range(100)]
    source = spark.createDataFrame(rows, SCHEMA)
    target = spark.createDataFrame([("k1", 2024, 1, 0), ("k2", 2024, 1, 0), ("other", 2024, 1, 0)], SCHEMA)
    got = merge.new_rows(source, target, "rowhash", ["yearDevice", "monthDevice"])
    assert sorted(r["v"] for r in got.collect()) == sorted(v for k, _, _, v in rows if k not in ("k1", "k2"))
    # the hot key already in the target: all its copies are dropped
    target2 = target.unionByName(spark.createDataFrame([("hot", 2024, 1, 0)], SCHEMA))
    assert merge.new_rows(source, target2, "rowhash", None).count() == 598 + 100


def test_insert_new_sql_matches_dataframe_form(spark):
    lh = Lakehouse(spark, scratch_path(spark, "test-sql-merge") + "/lake", "test_sql_merge")
    spec = TableSpec("t")
    target = spark.createDataFrame([("a", 2024, 1, 1), ("b", 2024, 1, 2)], SCHEMA)
    lh.create(spec, target)
    source = spark.createDataFrame([("a", 2024, 1, 10), ("c", 2024, 1, 11), ("c", 2024, 1, 12), (None, None, None, 13)],
                                   SCHEMA)
    merge.insert_new_sql(spark, lh.fq("t"), source)
    assert sorted(r["v"] for r in lh.read(spec).collect()) == [1, 2, 11, 12, 13]


def test_merge_broadcasts_no_keys(spark):
    # a hash counts 20 bytes in the estimates: the driver must not gather the keys on their strength
    source = spark.createDataFrame([("a", 2024, 1, 1), ("c", 2024, 1, 2), (None, None, None, 3)], SCHEMA)
    target = spark.createDataFrame([("a", 2024, 1, 0)], SCHEMA)
    got = merge.new_rows(source, target, "rowhash", ["yearDevice", "monthDevice"])
    assert "BroadcastExchange" not in got._jdf.queryExecution().executedPlan().toString()
    assert sorted(r["v"] for r in got.collect()) == [2, 3]
    assert "BroadcastExchange" not in got._jdf.queryExecution().executedPlan().toString()
