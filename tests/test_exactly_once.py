"""Replayed micro-batches, late rows, templates inferred from messages."""

import datetime as dt
import json

import pandas as pd
import pytest
from pyspark.sql import functions as F

from lakestrata.plans import daily, registry
from lakestrata.plans.notes import Notes
from lakestrata.plans.tables import Lakehouse
from lakestrata.session import scratch_path
from lakestrata.sources import inference, templates
from lakestrata.streaming import ingest, late

LOG = "event_id long, enqueuedTime timestamp, body string"
LOAD = "2024-01-31 00:00:00"
T0 = dt.datetime(2024, 1, 10)


def message(k, telemetry='{"D":1.5}', kind="pump"):
    return f'{{"deviceId":"d{k}","templateName":"{kind}","enqueuedTime":"2024-01-0{1 + k % 3}T00:00:00Z","telemetry":{telemetry}}}'


def log_of(spark, *files):
    path = scratch_path(spark, "log")
    for rows in files:
        spark.createDataFrame(rows, LOG).coalesce(1).write.mode("append").parquet(path)
    return path, spark.readStream.schema(LOG).option("maxFilesPerTrigger", 1).parquet(path)


def lake(spark, name):
    return Lakehouse(spark, scratch_path(spark, name) + "/lake", name.replace("-", "_"))


FILES = ([(1, T0, message(1)), (2, T0, None), (3, T0, None)], [(4, T0, message(1)), (5, T0, message(2)), (6, T0, None)])


def ids(lh, layout):
    return sorted(r["event_id"] for r in lh.read(layout.bronze_spec()).collect())


def test_creating_batch_stores_null_bodies_once_and_replays_add_nothing(spark):
    _, stream = log_of(spark, *FILES)
    lh, layout, ckpt = lake(spark, "once"), daily.Layout(buckets=2), scratch_path(spark, "once-ckpt")
    for _ in range(3):
        ingest.start_bronze_ingest(stream, lh, ckpt, layout, LOAD).awaitTermination()
        assert ids(lh, layout) == [1, 2, 3, 5, 6]
        assert ingest.forget_last_commit(spark, ckpt) == 1


@pytest.mark.parametrize("where", ["before the write", "after the write"])
def test_a_batch_that_broke_off_is_written_once(spark, monkeypatch, where):
    _, stream = log_of(spark, *FILES)
    lh, layout, ckpt = lake(spark, f"broke-{where[:3]}"), daily.Layout(buckets=2), scratch_path(spark, "broke-ckpt")
    real, fails = ingest.merge_into, [1]

    def merge(*args, **kwargs):
        if where == "after the write":
            real(*args, **kwargs)
        if len(fails) == 1 and len(fails.append(0) or fails) == 2:
            raise RuntimeError("lost")
        if where == "before the write":
            real(*args, **kwargs)

    monkeypatch.setattr(ingest, "merge_into", merge)
    with pytest.raises(Exception, match="lost"):
        ingest.start_bronze_ingest(stream, lh, ckpt, layout, LOAD).awaitTermination()
    ingest.start_bronze_ingest(stream, lh, ckpt, layout, LOAD).awaitTermination()
    assert ids(lh, layout) == [1, 2, 3, 5, 6]


def test_ledger_tells_streams_apart_and_refuses_half_a_batch(spark):
    lh, layout = lake(spark, "ledger"), daily.Layout(buckets=2)
    spec = layout.bronze_spec()
    a, b = ingest.BatchLedger(lh, "a"), ingest.BatchLedger(lh, "b")
    assert not a.begin(0, spec, 2) and not a.is_done(0)
    a.end(0)
    assert a.is_done(0) and not a.is_done(1) and not b.is_done(0)
    lh.create(spec, spark.createDataFrame([(None, 2024, 1)], "rowhash string, yearDevice int, monthDevice int"))
    assert not a.begin(1, spec, 2)
    lh.append(spec, spark.createDataFrame([(None, 2024, 1)], "rowhash string, yearDevice int, monthDevice int"))
    with pytest.raises(ingest.PartlyWritten):
        a.begin(1, spec, 2)
    assert a.begin(1, spec, 1)
    assert Notes(spark, lh.root).numbers("batch-done", "a") == [0]


def test_load_index_is_compacted(spark):
    lh, layout = lake(spark, "loads"), daily.Layout(buckets=2)
    df = spark.createDataFrame([(1, T0, 2024, 1), (2, T0 + dt.timedelta(hours=1), 2024, 2)], "event_id long, enqueuedTime timestamp, yearDevice int, monthDevice int")
    for k in range(3):
        keys = daily.record_load(lh, df.withColumn("enqueuedTime", F.col("enqueuedTime") + F.make_interval(hours=F.lit(k))), layout)
        assert sorted(keys) == ["2024/1", "2024/2"]
    assert lh.read(layout.loads_spec()).count() == 6
    daily.compact_loads(lh, layout)
    got = {r["monthDevice"]: (r["from_time"], r["to_time"], r["rows"]) for r in lh.read(layout.loads_spec()).collect()}
    assert got == {1: (T0, T0 + dt.timedelta(hours=2), 3), 2: (T0 + dt.timedelta(hours=1), T0 + dt.timedelta(hours=3), 3)}


def test_late_rows_are_kept(spark):
    h = dt.timedelta(hours=1)
    path, stream = log_of(
        spark,
        [(1, T0, "a"), (2, T0 + 24 * h, "b"), (3, T0, "a"), (4, T0, None), (5, None, "x")],
        [(6, T0, "a"), (7, T0 + 23 * h, "b"), (8, T0 - h, "new"), (9, T0 + 120 * h, "c")],
        [(10, T0 + 23 * h, "b"), (11, T0 + 120 * h, "c"), (12, T0 + 119 * h, "d")],
    )
    out, ckpt = scratch_path(spark, "late"), scratch_path(spark, "late-ckpt")
    before = spark.conf.get(late.STORE[0], None)
    late.start_split(stream, out, ckpt, "1 day").awaitTermination()
    assert spark.conf.get(late.STORE[0], None) == before
    rows = late.rows_of(spark, out)
    assert {r["event_id"]: r["verdict"] for r in rows.collect() if r["event_id"] not in (1, 3)} == {
        2: "first", 4: "first", 5: "first", 6: "copy", 7: "copy", 8: "late", 9: "first", 10: "late", 11: "copy", 12: "first"}
    assert sorted(r["verdict"] for r in rows.collect() if r["event_id"] in (1, 3)) == ["copy", "first"]
    assert rows.count() == spark.read.parquet(path).count()
    assert sorted(r["event_id"] for r in late.rows_of(spark, out, "late").collect()) == [8, 10]
    # the state of keys whose time has passed is gone
    held = {r["rowhash"] for r in late.state(spark, ckpt).collect()}
    assert held == {r[0] for r in spark.sql("SELECT sha2('c', 256) UNION SELECT sha2('d', 256)").collect()}
    late.start_split(stream, out, ckpt, "1 day").awaitTermination()
    assert late.rows_of(spark, out).count() == 12
    with pytest.raises(ValueError):
        late.judged(stream.withColumnRenamed("body", "_body"))


def test_late_state_is_called_per_bucket(spark):
    """The calls into the state store do not grow with the number of bodies; states end one by one."""
    calls = []

    class Seen:
        held = None

        def get(self):
            calls.append("get")
            return self.held

        def update(self, value):
            calls.append("update")
            self.held = value

        def clear(self):
            self.held = None

    class Times:
        def __init__(self, watermark):
            self.watermark = watermark

        def getCurrentWatermarkInMs(self):
            return self.watermark

    timers = []
    judge = late.FirstRows("enqueuedTime", 1000)
    judge.seen, judge.handle = Seen(), type("Handle", (), {"registerTimer": staticmethod(timers.append)})

    def verdicts(watermark, *frames):
        made = [pd.DataFrame({"rowhash": [k for k, _ in f], "at_ms": [t for _, t in f], late.BUCKET: 0}) for f in frames]
        return [v for out in judge.handleInputRows((0,), iter(made), Times(watermark)) for v in out["verdict"]]

    many = [(f"k{i}", 100 + i) for i in range(500)]
    assert verdicts(50, many, many + [("k0", 40)]) == ["first"] * 500 + ["copy"] * 500 + ["late"]
    assert calls == ["get", "update"] and timers == [1100]
    assert list(judge.handleExpiredTimer((0,), Times(1300), None)) == []  # ended: first times up to 300
    assert judge.seen.held == ([f"k{i}" for i in range(201, 500)], list(range(301, 600))) and timers == [1100, 1301]
    assert verdicts(1300, [("k1", 1299), ("k1", 1300), ("k499", 1300)]) == ["late", "first", "copy"]
    list(judge.handleExpiredTimer((0,), Times(9000), None))
    assert judge.seen.held is None


@pytest.mark.parametrize("buckets", [1, 3])
def test_late_rows_by_bucket(spark, buckets):
    h = dt.timedelta(hours=1)
    path, stream = log_of(
        spark,
        [(i, T0 + i * h, f"b{i}") for i in range(30)],
        [(100 + i, T0 + i * h, f"b{i}") for i in range(30)] + [(199, T0 + 90 * h, "z")],
        [(200, T0 + 89 * h, "b29"), (201, T0 + 90 * h, "z")],
    )
    out, ckpt = scratch_path(spark, "late"), scratch_path(spark, "late-ckpt")
    before = spark.conf.get(late.SHUFFLE)
    late.start_split(stream, out, ckpt, "10 hours", buckets=buckets, partitions=2).awaitTermination()
    assert spark.conf.get(late.SHUFFLE) == before
    got = {r["event_id"]: r["verdict"] for r in late.rows_of(spark, out).collect()}
    want = {i: "first" for i in range(30)} | {100 + i: "late" if i < 19 else "copy" for i in range(30)}
    assert got == want | {199: "first", 200: "copy", 201: "copy"}  # timers end the states after a batch's rows
    assert {r["first_ms"] for r in late.state(spark, ckpt).collect()} == {int((T0 + 90 * h).replace(tzinfo=dt.timezone.utc).timestamp() * 1000)}


def test_templates_from_messages(spark):
    bodies = [message(1, '{"A":1,"B":true,"C":null,"D":1.5,"O":{"x":1},"L":[1]}'), message(2, '{"A":2.5,"B":1,"D":2}'), message(3, '{"A":7,"S":"t"}'),
              message(4, '{"a b\\"é":1}', "odd/one"), message(5, "[1, 2]"), message(6, "3"), "no json", None, "[]", message(7, '{"A":"x"}', "")]
    df = spark.createDataFrame([(b,) for b in bodies], "body string").repartition(3)
    got = {(r["TemplateName"], r["Telemetry"], r["DataType"]): r["messages"] for r in inference.observed_types(df).collect()}
    assert got == {("pump", "A", "integer"): 2, ("pump", "A", "double"): 1, ("pump", "B", "boolean"): 1, ("pump", "B", "integer"): 1, ("pump", "D", "double"): 1, ("pump", "D", "integer"): 1,
                   ("pump", "O", "object"): 1, ("pump", "L", "array"): 1, ("pump", "S", "string"): 1, ("odd/one", 'a b"é', "integer"): 1, ("", "A", "string"): 1}
    merged = {(r["TemplateName"], r["Telemetry"]): r["DataType"] for r in inference.merged_types(df).collect()}
    assert merged["pump", "A"] == "double" and merged["pump", "B"] == "mixed" and merged["pump", "C"] is None
    folder = scratch_path(spark, "inferred")
    mapping = inference.write_templates(inference.observed_types(df), folder)
    assert set(mapping) == {"pump", "odd/one"} and len(set(mapping.values())) == 2
    files = [r["path"] for r in templates.list_files(spark, folder, glob="*.json").collect()]
    assert len(files) == 2
    entries = templates.read_entries(spark, files)
    assert {r["name"]: r["schema"] for r in templates.last_declarations(entries).collect() if r["file"] == mapping["pump"]}["A"] == "integer"
    assert {(r["name"], r["problem"]) for r in templates.diagnostics(entries).collect()} == {("O", "unsupported type"), ("L", "unsupported type"), ("S", "unsupported type")}
    flat = templates.flatten(entries, templates.dictionary(spark, mapping))
    assert {r["Telemetry"] for r in templates.type_discrepancy(flat).collect()} == {"A", "B", "D"}
    assert json.loads(inference.template_texts(inference.observed_types(df.limit(0))).toPandas().to_json()) == {"TemplateName": {}, "fields": {}, "text": {}}


def test_one_json_pass_per_message(spark):
    plan = inference.observed_types(spark.createDataFrame([("x",)], "body string"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parseJson") + plan.count("parse_json") == 1


def test_log_files_grow_in_number(spark, monkeypatch):
    assert registry._log_files(spark.range(1000), 4) == 4
    monkeypatch.setattr(registry, "LOG_FILE_ROWS", 100)
    assert [registry._log_files(spark.range(n), 4) for n in (0, 400, 401, 1000)] == [4, 4, 8, 12]
    lake = []
    monkeypatch.setattr(registry, "_scratch_lakehouse", lambda s, n, make=registry._scratch_lakehouse: lake.append(make(s, n)) or lake[0])
    events = spark.range(1, 1001).selectExpr(
        "id AS event_id", "TIMESTAMP_NTZ '2024-01-10 00:00:00' + make_dt_interval(0, 0, CAST(id AS INT)) AS ts",
        "id % 50 AS user_id", "'click' AS event_type", "CAST(id AS DOUBLE) AS value")
    sf_dir = scratch_path(spark, "replay-events")
    events.write.parquet(f"{sf_dir}/events.parquet")
    assert registry.q_stream_replay(spark, sf_dir).count() == 1000
    # twelve files of the log, two micro-batches: the first reads six files
    source = spark.read.text(f"{lake[0].root}/_checkpoint/sources/0/0").filter(F.col("value").contains("path"))
    assert source.count() == 6
