"""Tables seen from a new session, overwrites that fail, layouts kept beside the data."""

import datetime as dt
import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from lakestrata.plans import daily
from lakestrata.plans.notes import Notes
from lakestrata.plans.tables import Lakehouse, TableSpec
from lakestrata.schemas import telemetry_struct
from lakestrata.session import configure, scratch_path

LOG = "event_id long, enqueuedTime timestamp, body string"
LOAD = "2024-01-31 00:00:00"


def lake(spark, name):
    return Lakehouse(spark, scratch_path(spark, name) + "/lake", name.replace("-", "_"))


def anew(lh, name):
    """The same folder from a session whose catalog knows nothing of it."""
    return Lakehouse(configure(lh.spark.newSession()), lh.root, f"{lh.database}_{name}")


def rows(df):
    return sorted(map(str, df.collect()))


def test_notes_are_numbered_and_whole(spark):
    notes = Notes(spark, scratch_path(spark, "notes"))
    assert notes.latest("k", "n") is None and notes.names("k") == []
    notes.put("k", "a/b ü", 1, {"x": 1})
    notes.put("k", "a/b ü", 10, {"x": [2, "é"]})
    assert notes.latest("k", "a/b ü") == (10, {"x": [2, "é"]}) and notes.numbers("k", "a/b ü") == [1, 10] and notes.names("k") == ["a/b ü"]
    with pytest.raises(FileExistsError):
        notes.put("k", "a/b ü", 10, {})
    notes.forget("k", "a/b ü", below=10)
    assert notes.numbers("k", "a/b ü") == [10]
    notes.forget("k", "a/b ü")
    assert notes.latest("k", "a/b ü") is None


def test_attached_table_equals_the_old_one(spark):
    """Added columns, a partition column of NULLs only, buckets, nested and oddly named columns."""
    lh = lake(spark, "attach-equal")
    spec = TableSpec("t", ("day",), "k", 3)
    first = spark.createDataFrame([("a", 1, None), ("b", 2, None)], "k string, x int, day date")
    lh.create(spec, first)
    lh.append(spec, spark.createDataFrame([("c", 3, dt.date(2024, 1, 2), {"p": 1.5}, 7)], "k string, x int, day date, `odd name` map<string,double>, n long"))
    for k in range(3):
        other = anew(lh, f"s{k}")
        assert other.exists(TableSpec("t")) and other.list_tables() == ["t"]  # the layout comes with the data, not from the caller
        assert other.read("t").schema == lh.read(spec).schema and rows(other.read("t")) == rows(lh.read(spec))
        described = {r["col_name"]: r["data_type"] for r in other.spark.sql(f"DESCRIBE EXTENDED {other.fq('t')}").collect()}
        assert described["Num Buckets"] == "3" and described["day"] == "date"
        other.append(spec, spark.createDataFrame([(f"more{k}", None)], "k string, day date"))
        lh = other
    assert lh.read("t").count() == 6 and lh.read("t").where("day IS NULL").count() == 5


def test_bucketed_target_is_not_shuffled_after_attach(spark):
    lh = lake(spark, "attach-buckets")
    spec = TableSpec("t", (), "k", 4)
    lh.create(spec, spark.range(100).select(F.col("id").cast("string").alias("k")))
    grouped = anew(lh, "new").read(spec).groupBy("k").count()
    assert "Exchange" not in grouped._jdf.queryExecution().executedPlan().toString()


def test_failed_overwrite_leaves_the_old_rows(spark):
    lh = lake(spark, "attach-fail")
    spec = TableSpec("t", ("p",))
    lh.create(spec, spark.createDataFrame([(1, "a"), (2, "b")], "v int, p string"))
    bad = spark.range(4).select(F.expr("CASE WHEN id = 3 THEN raise_error('stop') ELSE id END").cast("int").alias("v"), F.lit("a").alias("p"))
    with pytest.raises(Exception, match="stop"):
        lh.overwrite(spec, bad)
    for seen in (lh, anew(lh, "new")):
        assert rows(seen.read(spec)) == rows(spark.createDataFrame([(1, "a"), (2, "b")], "v int, p string"))
    assert os.listdir(f"{lh.root}/data/t".removeprefix("file:")) == [lh.path("t").rsplit("/", 1)[1]]  # no leftovers


def test_overwrite_may_read_its_own_table_and_readers_finish(spark):
    lh, spec = lake(spark, "attach-own"), TableSpec("t")
    lh.create(spec, spark.range(5))
    begun = lh.read(spec)
    begun.queryExecution = begun._jdf.queryExecution().executedPlan()  # planned before the swap
    lh.overwrite(spec, lh.read(spec).select((F.col("id") * 10).alias("id")))
    assert begun.count() == 5 and rows(lh.read(spec)) == rows(spark.createDataFrame([(10 * k,) for k in range(5)], "id long"))
    with pytest.raises(AnalysisException):
        lh.create(spec, spark.range(1), mode="errorifexists")
    lh.truncate(spec)
    assert lh.read(spec).count() == 0 and anew(lh, "new").read(spec).schema == lh.read(spec).schema
    lh.drop("t")
    assert not lh.exists(spec) and not anew(lh, "gone").exists(spec)


def test_a_swap_by_another_session_is_followed(spark):
    lh, spec = lake(spark, "attach-two"), TableSpec("t")
    lh.create(spec, spark.range(3))
    other = anew(lh, "two")
    assert other.read(spec).count() == 3
    lh.overwrite(spec, spark.range(7).select("id", F.lit("x").alias("new")))
    assert other.read(spec).count() == 7 and other.read(spec).columns == ["id", "new"]


def test_tables_without_a_note_are_adopted(spark):
    """Files of earlier releases lie at <root>/<name>; their columns differ."""
    lh = lake(spark, "attach-old")
    spark.createDataFrame([(1, "a")], "x int, d string").write.parquet(f"{lh.root}/old")
    spark.createDataFrame([(2, "b", 5)], "x int, d string, y int").write.mode("append").parquet(f"{lh.root}/old")
    spark.createDataFrame([(1, None)], "x int, p date").write.partitionBy("p").parquet(f"{lh.root}/nulls")
    assert set(lh.read("old").columns) == {"x", "d", "y"} and lh.read("old").agg(F.sum("y")).first()[0] == 5
    assert lh.read(TableSpec("nulls", ("p",))).collect()[0]["p"] is None
    lh.append(TableSpec("old"), spark.createDataFrame([(3, "c", 6)], "x int, d string, y int"))
    assert anew(lh, "n").read("old").count() == 3


def test_second_day_in_a_new_session_after_a_template_change(spark):
    """Day 1 has field X, day 2 X and Y; a type without device times; gold on the new field."""
    configure(spark)
    lh = lake(spark, "attach-days")
    day = [dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)]
    say = lambda kind, t, tel: f'{{"deviceId":"d","templateName":"{kind}"{t},"telemetry":{tel}}}'
    logs = []
    for k, d in enumerate(day):
        at = [d + dt.timedelta(minutes=m) for m in range(5)]
        tel = '{"X":%d}' if k == 0 else '{"X":%d,"Y":2.5}'
        logs.append(spark.createDataFrame([(m, t, say("pump", f',"enqueuedTime":"{t.isoformat()}Z"', tel % m)) for m, t in enumerate(at)] + [(9 + k, at[0], say("timeless", "", tel % (7 + k)))], LOG))
    layout = daily.Layout(buckets=2)
    fields = [{"X": "integer"}, {"X": "integer", "Y": "double"}]
    for k in range(2):
        lh = anew(lh, f"day{k}")
        devices = [daily.DeviceType(n, telemetry_struct(fields[k]), "X" if k == 0 else "Y") for n in ("pump", "timeless")]
        daily.run_daily(lh, logs[k], devices, as_of=day[k] + dt.timedelta(hours=1), minutes=120, load_ts=LOAD, layout=layout)
    new = anew(lh, "read")
    pump = new.read(layout.silver_spec("pump"))
    assert pump.count() == 10 and pump.where("Y = 2.5").count() == 5 and pump.where("Y IS NULL").count() == 5
    timeless = new.read(layout.silver_spec("timeless"))
    assert timeless.count() == 2 and timeless.where("Device_Date IS NULL").count() == 2
    assert new.read(layout.bronze_spec()).count() == 12
    daily.build_gold(new, daily.DeviceType("pump", telemetry_struct(fields[1]), "Y"), "2024-01-31", layout, full=True)
    assert {r["NullCount"] for r in new.read(layout.gold_spec("pump")).collect()} == {5, None}
