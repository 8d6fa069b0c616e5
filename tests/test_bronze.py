"""Bronze enrichment on odd bodies, and the scan-level effect of the time bounds."""

import datetime as dt
import hashlib

from pyspark.sql import functions as F

from lakestrata.operators import bronze
from lakestrata.sources import eventlog
from lakestrata.sources.envelope import read_envelope

SF = "/root/testdata/sf0.001"


def test_enrich_odd_bodies(spark):
    rows = [
        ('{"deviceId":"d","templateName":"T","templateId":"t","enqueuedTime":"2024-03-05T10:00:00Z"}',),
        ('{"deviceId":"d","enqueuedTime":"not a time"}',),
        ("not json",),
        (None,),
    ]
    df = spark.createDataFrame(rows, "body string").withColumn("enqueuedTime", F.current_timestamp())
    out = bronze.enrich(df, "2024-03-06 00:00:00").collect()
    good, bad_time, not_json, null_body = out
    assert (good["templateName"], good["yearDevice"], good["monthDevice"]) == ("T", 2024, 3)
    assert good["rowhash"] == hashlib.sha256(rows[0][0].encode()).hexdigest()
    assert bad_time["deviceId"] == "d" and bad_time["deviceEnqueueTtime"] is None and bad_time["yearDevice"] is None
    assert not_json["templateName"] is None and not_json["rowhash"] is not None
    assert null_body["rowhash"] is None
    assert str(good["loadDatetime"]) == "2024-03-06 00:00:00"


def test_range_report_minutes(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 0, 59),), (dt.datetime(2024, 1, 1, 0, 2, 58),)],
                               "enqueuedTime timestamp")
    r = bronze.range_report(df).first()
    assert r["StreamRange_Minutes"] == 1


def test_time_bounds_reach_the_scan(spark):
    env = read_envelope(spark, SF)
    plan = eventlog.bounded(env, "2024-01-10T00:00:00Z", "2024-01-20T00:00:00Z")._jdf.queryExecution() \
        .executedPlan().toString()
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts," in plan and "LessThanOrEqual(ts," in plan


def test_type_filter_stays_above_the_parse(spark):
    b = bronze.enrich(read_envelope(spark, SF), "2024-01-31")
    plan = b.filter(F.col("templateName") == "click")._jdf.queryExecution().optimizedPlan().toString()
    # the body is parsed once: the filter reads the parsed value above the Generate
    assert plan.count("from_json") == 1
    assert plan.index("Filter") < plan.index("Generate")
