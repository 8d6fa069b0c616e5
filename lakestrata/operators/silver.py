"""Silver: typed parse of each message against its device template.

A message is *flagged* when it does not fit the template: the body is not a
JSON object, it has no ``telemetry`` object, or a value in it is of another
type than declared (the strict, whole-record reading).  One ``from_json`` per
message decides all of it: its schema has a corrupt-record field, which the
parser fills exactly when some value did not fit.

Flagged messages go to the flags table; the others are expanded into the
wide silver table, one column per template field.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakestrata.functions.expressions import evaluate_once, parse_failed
from lakestrata.schemas import message_schema

CORRUPT = "_corrupt_record"


def select_types(bronze: DataFrame, device_types: str | Sequence[str]) -> DataFrame:
    """Rows of the given device type(s), on bronze's stored template name.

    The filter is on a stored column, so it reaches the scan of a bronze table.
    """
    if isinstance(device_types, str):
        return bronze.filter(F.col("templateName") == device_types)
    types = list(device_types)
    if len(types) == 1:
        return bronze.filter(F.col("templateName") == types[0])
    return bronze.filter(F.col("templateName").isin(types))


def parse(bronze: DataFrame, telemetry: T.StructType) -> DataFrame:
    """Adds ``JSONTemplate`` (typed message) and ``flagged`` (1/0); each body is parsed once."""
    schema = T.StructType([*message_schema(telemetry).fields, T.StructField(CORRUPT, T.StringType())])
    typed = F.from_json(F.col("body"), schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    parsed = evaluate_once(bronze, {"JSONTemplate": typed})
    message = F.col("JSONTemplate")
    bad = parse_failed(message, F.col("body")) | message.getField(CORRUPT).isNotNull()
    return parsed.withColumn("flagged", F.when(bad, F.lit(1)).otherwise(F.lit(0)))


def flags(parsed: DataFrame) -> DataFrame:
    """Distinct ``(TemplateName, DeviceID, load_date)`` of the flagged messages."""
    return (
        parsed.filter(F.col("flagged") == 1)
        .select(
            F.col("templateName").alias("TemplateName"),
            F.col("deviceId").alias("DeviceID"),
            F.to_date(F.col("loadDatetime")).alias("load_date"),
        )
        .distinct()
    )


def rows(parsed: DataFrame) -> DataFrame:
    """Unflagged messages expanded to the wide silver layout.

    ``Eventhub_enqueuedTime, Device_enqueuedTime, Device_Date, templateName,
    DeviceId, <telemetry fields by name>, loaddatetime, rowhash``.  The device
    date is the date as written in the message (zone offset ignored); bad
    device times give NULL instead of failing the job.
    """
    log_time = F.col("enqueuedTime")
    if not isinstance(parsed.schema["enqueuedTime"].dataType, T.TimestampType):
        log_time = F.try_to_timestamp(log_time.cast("string"))
    device_time = F.col("JSONTemplate").getField("enqueuedTime")
    return parsed.filter(F.col("flagged") == 0).select(
        log_time.alias("Eventhub_enqueuedTime"),
        F.try_to_timestamp(device_time).alias("Device_enqueuedTime"),
        device_time.try_cast("date").alias("Device_Date"),
        F.col("templateName").alias("templateName"),
        F.col("deviceId").alias("DeviceId"),
        "JSONTemplate.telemetry.*",
        F.col("loadDatetime").alias("loaddatetime"),
        F.col("rowhash"),
    )


def refine(bronze: DataFrame, device_types: str | Sequence[str], telemetry: T.StructType,
           ) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Bronze -> (parsed, flags, silver rows) for device type(s) sharing one template."""
    parsed = parse(select_types(bronze, device_types), telemetry)
    return parsed, flags(parsed), rows(parsed)
