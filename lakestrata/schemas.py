"""Fixed message schemas and the template-driven telemetry struct.

A device message is a JSON object with a fixed envelope and a
``telemetry`` object whose fields depend on the device type.  The
telemetry struct is generated from the type's template: one nullable
field per template entry, sorted by name.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import types as T

# The four template type names and the Spark types they map to.
TEMPLATE_TYPES: dict[str, T.DataType] = {
    "boolean": T.BooleanType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "integer": T.IntegerType(),
}

# Envelope fields read by the bronze step; the device time is parsed as a
# timestamp inside the JSON read.
BRONZE_BODY_SCHEMA = T.StructType(
    [
        T.StructField("enqueuedTime", T.TimestampType(), True),
        T.StructField("deviceId", T.StringType(), True),
        T.StructField("templateName", T.StringType(), True),
        T.StructField("templateId", T.StringType(), True),
    ]
)

# The silver columns that are not telemetry fields.  A template
# field with one of these names would make the wide projection ambiguous.
SILVER_FIXED_COLUMNS = (
    "Eventhub_enqueuedTime",
    "Device_enqueuedTime",
    "Device_Date",
    "templateName",
    "DeviceId",
    "loaddatetime",
    "rowhash",
)

FLAG_DETAIL_SCHEMA = T.StructType(
    [
        T.StructField("TemplateName", T.StringType(), True),
        T.StructField("DeviceId", T.StringType(), True),
        T.StructField("FlaggedField", T.StringType(), True),
        T.StructField("Reason", T.StringType(), True),
    ]
)


class TemplateError(ValueError):
    """A template that cannot be turned into a telemetry struct."""


def telemetry_struct(fields: Mapping[str, str] | Iterable[tuple[str, str]]) -> T.StructType:
    """``{name: type name}`` -> nullable struct, fields sorted by name.

    Raises :class:`TemplateError` for a type name outside
    :data:`TEMPLATE_TYPES`, for a field named like a fixed silver column, or
    for two names that differ in case only (column names ignore case).
    """
    items = dict(fields.items() if isinstance(fields, Mapping) else fields)
    fixed = {c.lower() for c in SILVER_FIXED_COLUMNS}
    out = []
    for name, type_name in sorted(items.items()):
        if type_name not in TEMPLATE_TYPES:
            raise TemplateError(f"field {name!r}: unsupported template type {type_name!r}")
        if name.lower() in fixed:
            raise TemplateError(f"field {name!r} collides with a fixed silver column")
        if any(name.lower() == f.name.lower() for f in out):
            raise TemplateError(f"field {name!r} differs from another one in case only")
        out.append(T.StructField(name, TEMPLATE_TYPES[type_name], True))
    return T.StructType(out)


def message_schema(telemetry: T.StructType) -> T.StructType:
    """The full typed message: fixed envelope plus the given telemetry struct.

    The envelope field names and types are fixed values of the message format.
    """
    return T.StructType(
        [
            T.StructField("applicationId", T.StringType(), True),
            T.StructField("component", T.StringType(), True),
            T.StructField("enrichments", T.StringType(), True),
            T.StructField(
                "messageProperties",
                T.StructType([T.StructField("iothub-creation-time-utc", T.StringType(), True)]),
                True,
            ),
            T.StructField("messageSource", T.StringType(), True),
            T.StructField("module", T.StringType(), True),
            T.StructField("schema", T.StringType(), True),
            T.StructField("templateId", T.StringType(), True),
            T.StructField("enqueuedTime", T.StringType(), True),
            T.StructField("deviceId", T.StringType(), True),
            T.StructField("templateName", T.StringType(), True),
            T.StructField("telemetry", telemetry, True),
        ]
    )


def field_text(field: T.StructField) -> str:
    """Textual form of a schema field, e.g. ``StructField('X', DoubleType(), True)``."""
    return f"StructField('{field.name}', {field.dataType!r}, {field.nullable})"
