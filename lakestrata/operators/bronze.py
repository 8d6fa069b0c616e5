"""Bronze: raw messages enriched with their envelope fields and a content hash.

One ``from_json`` per row reads the four envelope fields; everything else
is a projection, so the step is narrow (no shuffle) and stays in one
code-generated stage.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestrata.functions.expressions import evaluate_once, minutes_between
from lakestrata.schemas import BRONZE_BODY_SCHEMA
from lakestrata.sources.eventlog import with_string_body

PARTITION_COLS = ("yearDevice", "monthDevice")


def _load_ts(load_ts: str | dt.datetime | Column | None) -> Column:
    if load_ts is None:
        return F.current_timestamp()
    if isinstance(load_ts, Column):
        return load_ts
    return F.lit(str(load_ts)).cast("timestamp")


def enrich(events: DataFrame, load_ts: str | dt.datetime | Column | None = None) -> DataFrame:
    """Event-log rows -> bronze rows.

    Adds templateId, templateName, deviceId, deviceEnqueueTtime (device time
    parsed as a timestamp), yearDevice, monthDevice, rowhash (SHA-256 of the
    body, lower-case hex; NULL for a NULL body) and loadDatetime (``load_ts``,
    default now).  Source columns pass through unchanged.
    """
    df = with_string_body(events)
    # Parsed once per row; a later filter on a parsed field (the device type)
    # stays above the parse instead of parsing the body a second time.
    df = evaluate_once(df, {"_envelope": F.from_json(F.col("body"), BRONZE_BODY_SCHEMA)})
    parsed = F.col("_envelope")
    device_time = parsed.getField("enqueuedTime")
    # The names of the history table's columns, spelled as there.
    added = {
        "templateId": parsed.getField("templateId"),
        "templateName": parsed.getField("templateName"),
        "deviceId": parsed.getField("deviceId"),
        "deviceEnqueueTtime": device_time,
        "yearDevice": F.year(device_time),
        "monthDevice": F.month(device_time),
        "rowhash": F.sha2(F.col("body"), 256),
        "loadDatetime": _load_ts(load_ts),
    }
    drop = {a.lower() for a in added} | {"_envelope"}
    keep = [F.col(c) for c in df.columns if c.lower() not in drop]
    return df.select(*keep, *[e.alias(n) for n, e in added.items()])


def range_report(batch: DataFrame, time_col: str = "enqueuedTime") -> DataFrame:
    """MIN / MAX of the batch time and the whole minutes between them."""
    t = F.col(time_col)
    return batch.agg(F.min(t).alias("MIN_Date"), F.max(t).alias("MAX_Date")).select(
        "MIN_Date", "MAX_Date",
        minutes_between(F.col("MIN_Date"), F.col("MAX_Date")).alias("StreamRange_Minutes"),
    )


def template_names(bronze: DataFrame) -> DataFrame:
    """Distinct device types present, sorted (blank and NULL included)."""
    return bronze.select(F.col("templateName").alias("TemplateName")).distinct().orderBy("TemplateName")


def blank_type_messages(bronze: DataFrame) -> DataFrame:
    """Messages whose template name is the empty string (NULLs excluded)."""
    return bronze.filter(F.col("templateName") == "")
