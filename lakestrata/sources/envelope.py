"""Device messages derived from the ``events`` table.

The given tables hold no device telemetry, so the checked queries run over
an event log that Spark derives row by row from ``events``: one message
per event, with one field of each template type.  The reading is the event's
``value``; fixed rules on ``event_id`` replace some, so that every value
class, wrongly typed fields and a missing telemetry object occur.
The derivation is a single projection; it partitions like ``events``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestrata.sources.eventlog import spread

# The template of the derived messages, one field of each type.
TEMPLATE = {"RUNNINGHR": "double", "PRESSURE": "float", "CYCLES": "integer", "ACTIVE": "boolean"}
# The reading rules per field as (condition on event_id, JSON
# text) in SQL that Spark and DuckDB both read, first match wins (FIXTURES.md
# section 6).  The normal RUNNINGHR is the event's value in hundredths.
READINGS = {
    "RUNNINGHR": (
        ("event_id % 17 = 0", "'null'"),
        ("event_id % 19 = 0", "'\"bad\"'"),
        ("event_id % 13 = 0", "'0'"),
        ("event_id % 11 = 0", "concat('-', CAST(event_id % 100 + 1 AS {text}))"),
        ("event_id % 23 = 0", "'250000'"),
        (None, "coalesce(concat(CAST(CAST(round(value * 100) AS BIGINT) AS {text}), 'e-2'), 'null')"),
    ),
    "PRESSURE": (
        ("event_id % 43 = 0", "'\"high\"'"),
        (None, "concat(CAST(event_id % 90 AS {text}), '.25')"),
    ),
    "CYCLES": (
        ("event_id % 41 = 0", "'1.5'"),
        (None, "CAST(event_id % 100000 AS {text})"),
    ),
    "ACTIVE": (
        ("event_id % 47 = 0", "'1'"),
        ("event_id % 2 = 0", "'true'"),
        (None, "'false'"),
    ),
}
# Telemetry is omitted when event_id % 29 = 0.
NO_TELEMETRY_EVERY = 29
TELEMETRY_FIELD = "RUNNINGHR"


def reading_sql(field: str, text: str) -> str:
    """The JSON text of a field; ``text`` is the dialect's text type."""
    cases = " ".join(f"WHEN {when} THEN {value}" if when else f"ELSE {value}" for when, value in READINGS[field])
    return f"CASE {cases} END".format(text=text)


def telemetry_sql(text: str) -> str:
    parts = [f"""'{"," if i else ""}"{field}":', {reading_sql(field, text)}""" for i, field in enumerate(TEMPLATE)]
    return f"""CASE WHEN event_id % {NO_TELEMETRY_EVERY} = 0 THEN '' ELSE concat(',"telemetry":{{', {", ".join(parts)}, '}}') END"""


def body_text(template_name: Column | None = None) -> Column:
    """The JSON message of an event, keys in fixed order, no blanks between tokens."""
    name = F.col("event_type") if template_name is None else template_name
    return F.concat(
        F.lit('{"deviceId":"dev-'), F.col("user_id").cast("string"),
        F.lit('","templateName":"'), name,
        F.lit('","templateId":"t-'), F.col("event_type"),
        F.lit('","enqueuedTime":"'), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"),
        F.lit('"'), F.expr(telemetry_sql("STRING")), F.lit("}"),
    )


def envelope(events: DataFrame, blank_type_every: int | None = None) -> DataFrame:
    """``events`` -> event-log rows ``(event_id, enqueuedTime, body)``.

    ``blank_type_every``: write an empty template name when
    ``event_id % n = 0`` (the blank-type check needs such messages).
    """
    e = F.col("event_id")
    name = None
    if blank_type_every:
        name = F.when(e % blank_type_every == 0, F.lit("")).otherwise(F.col("event_type"))
    return events.select(
        e.alias("event_id"),
        F.col("ts").cast("timestamp").alias("enqueuedTime"),
        body_text(name).alias("body"),
    )


def read_envelope(spark: SparkSession, sf_dir: str, blank_type_every: int | None = None) -> DataFrame:
    """The derived event log over ``<sf_dir>/events.parquet``, spread over all cores."""
    return envelope(spread(spark.read.parquet(f"{sf_dir}/events.parquet")), blank_type_every)


def envelope_sql(blank_type_every: int | None = None) -> str:
    """The same derivation in ANSI SQL (DuckDB), as a SELECT over ``events``."""
    name = "event_type"
    if blank_type_every:
        name = f"CASE WHEN event_id % {blank_type_every} = 0 THEN '' ELSE event_type END"
    return f"""SELECT event_id, CAST(ts AS TIMESTAMP) AS enqueuedTime,
  '{{"deviceId":"dev-' || CAST(user_id AS VARCHAR) || '","templateName":"' || {name}
  || '","templateId":"t-' || event_type || '","enqueuedTime":"' || strftime(ts, '%Y-%m-%dT%H:%M:%SZ') || '"'
  || {telemetry_sql("VARCHAR")} || '}}' AS body
FROM events"""
