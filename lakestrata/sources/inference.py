"""Templates from data: the telemetry types that messages really hold.

Every message is parsed once, into a VARIANT; its telemetry fields are
exploded and typed by ``schema_of_variant``, and counts per (device type,
field, type) are one map-side combined aggregation.  The counts become
template files in the format of ``sources.templates``: each observed type is an
entry, the most frequent one last, so that the last declaration, which wins,
is what most messages hold, and rarer types stay on record.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestrata.functions.expressions import evaluate_once
from lakestrata.schemas import TemplateError
from lakestrata.sources.templates import MAX_TEMPLATE_FIELDS

# Templates are configuration: more device types than this are refused.
MAX_DEVICE_TYPES = 1_000


def type_name(schema: Column) -> Column:
    """The template's name for a VARIANT type; NULL for JSON null.

    JSON has one kind of fraction: ``float`` is never observed, only ``double``.
    """
    return (
        F.when(schema == "VOID", None)
        .when(schema == "BOOLEAN", "boolean")
        .when(schema == "BIGINT", "integer")
        .when((schema == "DOUBLE") | schema.startswith("DECIMAL"), "double")
        .when(schema == "STRING", "string")
        .when(schema.startswith("OBJECT"), "object")
        .when(schema.startswith("ARRAY"), "array")
        .otherwise("mixed")
    )


def telemetry_values(messages: DataFrame, body_col: str = "body") -> DataFrame:
    """(TemplateName, Telemetry, value): one row per telemetry field of each readable message.

    Messages that are no JSON, or without a telemetry object, have no fields.
    """
    # parsed once: nothing that follows is pushed below the generators
    parsed = evaluate_once(messages.select(body_col), {"message": F.try_parse_json(F.col(body_col).cast("string"))})
    fields = parsed.select(
        F.try_variant_get("message", "$.templateName", "string").alias("TemplateName"),
        F.try_variant_get("message", "$.telemetry", "variant").alias("telemetry"),
    )
    each = fields.lateralJoin(messages.sparkSession.tvf.variant_explode(F.col("telemetry").outer()))
    return each.filter(F.col("key").isNotNull()).select("TemplateName", F.col("key").alias("Telemetry"), "value")


def observed_types(messages: DataFrame, body_col: str = "body") -> DataFrame:
    """(TemplateName, Telemetry, DataType, messages): how many messages hold which type; nulls are of none."""
    values = telemetry_values(messages, body_col)
    typed = evaluate_once(evaluate_once(values, {"schema": F.schema_of_variant("value")}), {"DataType": type_name(F.col("schema"))})
    return typed.filter(F.col("DataType").isNotNull()).groupBy("TemplateName", "Telemetry", "DataType").agg(F.count("*").alias("messages"))


def merged_types(messages: DataFrame, body_col: str = "body") -> DataFrame:
    """(TemplateName, Telemetry, DataType): the one type that all messages' values fit.

    ``schema_of_variant_agg`` merges types as it counts; values of types that
    have nothing in common give ``mixed``, whole numbers and fractions ``double``.
    """
    merged = telemetry_values(messages, body_col).groupBy("TemplateName", "Telemetry").agg(F.schema_of_variant_agg("value").alias("schema"))
    return merged.select("TemplateName", "Telemetry", type_name(F.col("schema")).alias("DataType"))


def template_texts(observed: DataFrame) -> DataFrame:
    """(TemplateName, fields, text): a template file's text for each device type."""
    rank = F.struct("Telemetry", "messages", "DataType")
    entry = lambda x: F.struct(x["Telemetry"].alias("name"), x["DataType"].alias("schema"))
    listed = observed.groupBy("TemplateName").agg(F.array_sort(F.collect_list(rank)).alias("entries"))
    contents = F.transform("entries", entry)
    return listed.select("TemplateName", F.size("entries").alias("fields"), F.to_json(F.array(F.struct(contents.alias("contents")))).alias("text"))


def write_templates(observed: DataFrame, folder: str) -> dict[str, str]:
    """Write a template file for each device type; returns the dictionary (device type -> file name).

    Messages without a type name have no template.  File names are numbered,
    since a type's name may hold any character; ``_dictionary.json`` lists them.
    """
    spark = observed.sparkSession
    named = observed.filter((F.col("TemplateName") != "") & F.col("TemplateName").isNotNull())
    sizes = named.groupBy("TemplateName").agg(F.count("*").alias("n")).limit(MAX_DEVICE_TYPES + 1).collect()
    if len(sizes) > MAX_DEVICE_TYPES:
        raise TemplateError(f"more than {MAX_DEVICE_TYPES} device types")
    if any(r["n"] > MAX_TEMPLATE_FIELDS for r in sizes):
        raise TemplateError(f"a template has more than {MAX_TEMPLATE_FIELDS} fields")
    rows = sorted(template_texts(named).collect(), key=lambda r: r["TemplateName"])  # checked above
    mapping = {r["TemplateName"]: f"template-{k}.json" for k, r in enumerate(rows)}
    for r in rows:
        _write_text(spark, f"{folder}/{mapping[r['TemplateName']]}", r["text"])
    _write_text(spark, f"{folder}/_dictionary.json", json.dumps(mapping))
    return mapping


def _write_text(spark, path: str, text: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(where, True)
    try:
        out.write(text.encode())
    finally:
        out.close()
