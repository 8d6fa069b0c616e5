"""Field diagnosis: which telemetry field makes a flagged message fail.

One pass over the flagged messages, no driver loop: every field whose raw
value its declared type rejects is named (``offending_names``, linear in the
message size).  Messages that fail before any field is read (the body is not a JSON
object, or it has no ``telemetry`` object), or whose bad value a later one of
the same key hides, get a NULL field and a reason instead.  The result is distinct ``(TemplateName, DeviceId,
FlaggedField, Reason)``; the distinct is a partial-then-final aggregation,
so a device holding a large share of the flagged rows is combined map-side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakestrata.functions.expressions import evaluate_once
from lakestrata.schemas import FLAG_DETAIL_SCHEMA

# ``telemetry`` as text values: read for flagged messages only.
RAW_TELEMETRY_SCHEMA = T.StructType(
    [T.StructField("telemetry", T.MapType(T.StringType(), T.StringType()), True)]
)

# The reasons reported with a flagged field.
REASON_UNREADABLE = "unreadable body"
REASON_NO_TELEMETRY = "no telemetry object"
REASON_TYPE = "type mismatch"


def _finding(field, reason: str):
    return F.struct(F.lit(field).cast("string").alias("FlaggedField"), F.lit(reason).alias("Reason"))


def present_fields(telemetry: T.StructType):
    """Distinct template fields with a non-null raw value (one pass over the map)."""
    names = [f.name for f in telemetry.fields]
    present = F.map_filter(F.col("telemetry_raw"), lambda k, v: v.isNotNull() & k.isin(names))
    return F.array_distinct(F.map_keys(present))


def offending_names(telemetry: T.StructType):
    """Names of the offending fields of a message, linear in its size.

    ``to_json`` drops NULL fields, so the typed struct written back as a map
    holds exactly the accepted fields; the offending ones are the template
    fields with a raw value minus those (``array_except`` is hash-based).
    """
    accepted = F.from_json(F.to_json(F.col("JSONTemplate").getField("telemetry")),
                           T.MapType(T.StringType(), T.StringType()))
    return F.array_except(present_fields(telemetry), F.map_keys(accepted))


def diagnose(parsed: DataFrame, telemetry: T.StructType) -> DataFrame:
    """Flagged rows of ``silver.parse`` -> distinct (TemplateName, DeviceId, FlaggedField, Reason)."""
    flagged = parsed.filter(F.col("flagged") == 1)
    flagged = evaluate_once(flagged, {"telemetry_raw": F.from_json(F.col("body"), RAW_TELEMETRY_SCHEMA).getField("telemetry")})
    names = offending_names(telemetry)
    per_field = F.transform(
        names,
        lambda n: F.struct(n.alias("FlaggedField"), F.lit(REASON_TYPE).alias("Reason")),
    )
    msg = F.col("JSONTemplate")
    # A malformed body parses to a struct of NULLs, not to NULL: test that the
    # body is a JSON object directly (only flagged rows reach this).
    readable = F.json_object_keys(F.col("body")).isNotNull()
    findings = (
        F.when(~readable, F.array(_finding(None, REASON_UNREADABLE)))
        .when(msg.getField("telemetry").isNull(), F.array(_finding(None, REASON_NO_TELEMETRY)))
        .when(F.size(names) > 0, per_field)
        # e.g. a key given twice, of which only the overridden value was bad
        .otherwise(F.array(_finding(None, REASON_TYPE)))
    )
    return (
        flagged
        .select(
            F.col("templateName").alias("TemplateName"),
            F.col("deviceId").alias("DeviceId"),
            F.inline(findings),
        )
        .distinct()
    )


def diagnose_as_detail(findings: DataFrame) -> DataFrame:
    """The flag-detail table layout ``(TemplateName, DeviceId, FlaggedField)``."""
    return findings.select("TemplateName", "DeviceId", "FlaggedField").distinct()


def empty_findings(spark: SparkSession) -> DataFrame:
    """No findings, with the findings schema (a seed for unions and empty tables)."""
    return spark.createDataFrame([], FLAG_DETAIL_SCHEMA)
