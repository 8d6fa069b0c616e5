"""Device templates: JSON files listing each interface's telemetry fields.

A template file is a JSON array of interfaces, each with a ``contents``
array of ``{name, schema, ...}`` entries.  The files are read by Spark as
whole texts (one row per file), parsed with ``from_json`` and flattened
with ``posexplode`` so that the declaration order is kept: within a file,
the last declaration of a name wins.  A template becomes a telemetry
struct only on the driver, from its (small, bounded) list of fields.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakestrata.schemas import TEMPLATE_TYPES, TemplateError, telemetry_struct

TEMPLATE_FILE_SCHEMA = T.ArrayType(
    T.StructType(
        [
            T.StructField(
                "contents",
                T.ArrayType(
                    T.StructType(
                        [T.StructField("name", T.StringType(), True), T.StructField("schema", T.StringType(), True)]
                    )
                ),
                True,
            )
        ]
    )
)

# Fixed value: the note file kept among the template files.
NOTE_FILE = "1. Note"

# The active device-type dictionary (device type -> template file).
ACTIVE_DICTIONARY = {
    "Compressors": "Compressors.json",
    "LNG Tank 1": "LNG Tank.json",
}

# A template with more fields than this is refused (its struct is built on
# the driver).
MAX_TEMPLATE_FIELDS = 50_000
# The device-type dictionary is configuration; it may not exceed this many entries.
MAX_DICTIONARY_ENTRIES = 100_000


def _decoded_name(path_col):
    """File name from a (URI-encoded) path; a literal '+' stays '+'."""
    name = F.regexp_extract(path_col, r"([^/]+)$", 1)
    return F.url_decode(F.regexp_replace(name, r"\+", "%2B"))


def list_files(spark: SparkSession, directory: str, skip: Sequence[str] = (NOTE_FILE,),
               glob: str = "*") -> DataFrame:
    """Files under ``directory`` (recursively), minus the skipped names: ``(path, file)``."""
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob)
        .load(directory).select("path")
    )
    files = files.withColumn("file", _decoded_name(F.col("path")))
    return files.filter(~F.col("file").isin(list(skip))) if skip else files


def read_entries(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Every ``contents`` entry of the given template files, in order.

    Columns: ``file`` (file name), ``iface`` and ``pos`` (positions),
    ``name``, ``schema`` (text; an object schema is kept as JSON text).
    """
    raw = spark.read.option("wholetext", "true").text(paths if isinstance(paths, str) else list(paths))
    parsed = raw.select(
        _decoded_name(F.col("_metadata.file_path")).alias("file"),
        F.from_json("value", TEMPLATE_FILE_SCHEMA).alias("interfaces"),
    )
    ifaces = parsed.select("file", F.posexplode_outer("interfaces").alias("iface", "interface"))
    return ifaces.select(
        "file", "iface", F.posexplode_outer("interface.contents").alias("pos", "entry")
    ).select("file", "iface", "pos", F.col("entry.name").alias("name"), F.col("entry.schema").alias("schema"))


def last_declarations(entries: DataFrame) -> DataFrame:
    """Per ``(file, name)``, the last declared schema: ``(file, name, schema)``.

    Entries without a schema (commands, for instance) are not fields.
    """
    fields = entries.filter(F.col("name").isNotNull() & F.col("schema").isNotNull())
    return fields.groupBy("file", "name").agg(
        F.max_by("schema", F.struct("iface", "pos")).alias("schema")
    )


def diagnostics(entries: DataFrame) -> DataFrame:
    """Entries that cannot become telemetry fields, with the reason."""
    supported = list(TEMPLATE_TYPES)
    return entries.select(
        "file", "name", "schema",
        F.when(F.col("name").isNull(), F.lit("entry without a name"))
        .when(F.col("schema").isNull(), F.lit("entry without a schema"))
        .when(~F.col("schema").isin(supported), F.lit("unsupported type"))
        .alias("problem"),
    ).filter(F.col("problem").isNotNull())


def dictionary(spark: SparkSession, mapping: Mapping[str, str]) -> DataFrame:
    """Device type -> template file name, as a small DataFrame ``(device_type, file)``.

    It is configuration: its size is checked.
    """
    if len(mapping) > MAX_DICTIONARY_ENTRIES:
        raise TemplateError(f"{len(mapping)} dictionary entries exceed the broadcast bound {MAX_DICTIONARY_ENTRIES}")
    schema = T.StructType(
        [T.StructField("device_type", T.StringType(), False), T.StructField("file", T.StringType(), False)]
    )
    rows = [(k, v.rsplit("/", 1)[-1]) for k, v in mapping.items()]
    return spark.createDataFrame(rows, schema)


def flatten(entries: DataFrame, dictionary_df: DataFrame) -> DataFrame:
    """``(Asset, Telemetry, DataType)`` for every field of every mapped template, distinct.

    Entries without a schema are skipped, as for the telemetry struct.  The
    dictionary has one row per device type: Spark broadcasts it by its own
    size check.
    """
    fields = entries.filter(F.col("name").isNotNull() & F.col("schema").isNotNull())
    return (
        fields.join(dictionary_df, "file")
        .select(
            F.col("device_type").alias("Asset"),
            F.col("name").alias("Telemetry"),
            F.col("schema").alias("DataType"),
        )
        .distinct()
    )


def type_discrepancy(flat: DataFrame) -> DataFrame:
    """Fields declared with more than one type across templates: ``(Telemetry, Asset, DataType)``."""
    per_type = flat.groupBy("Telemetry", "DataType").count()
    multi = per_type.groupBy("Telemetry").count().filter(F.col("count") > 1)
    return multi.join(flat, on=["Telemetry"], how="left").select("Telemetry", "Asset", "DataType")


def telemetry_of(spark: SparkSession, path: str) -> T.StructType:
    """The telemetry struct of one template file (last declaration wins).

    Unsupported type names raise :class:`TemplateError`; use
    :func:`diagnostics` to list them instead.
    """
    fields = last_declarations(read_entries(spark, path)).select("name", "schema")
    rows = fields.limit(MAX_TEMPLATE_FIELDS + 1).collect()
    if len(rows) > MAX_TEMPLATE_FIELDS:
        raise TemplateError(f"{path}: more than {MAX_TEMPLATE_FIELDS} fields")
    return telemetry_struct({r["name"]: r["schema"] for r in rows})


def telemetry_by_type(spark: SparkSession, directory: str, mapping: Mapping[str, str],
                      unsupported: dict[str, dict[str, str]] | None = None) -> dict[str, T.StructType]:
    """Telemetry struct per device type, from one scan of the mapped files.

    A field of an unsupported type does not stop its template, nor the other
    types: it is left out, and noted in ``unsupported`` (per device type:
    field -> type name) when the caller gives one.
    """
    files = sorted({v.rsplit("/", 1)[-1] for v in mapping.values()})
    paths = [f"{directory.rstrip('/')}/{f}" for f in files]
    decl = last_declarations(read_entries(spark, paths)).select("file", "name", "schema")
    rows = decl.limit(MAX_TEMPLATE_FIELDS * len(files) + 1).collect()
    per_file: dict[str, dict[str, str]] = {}
    for r in rows:
        per_file.setdefault(r["file"], {})[r["name"]] = r["schema"]
    if any(len(f) > MAX_TEMPLATE_FIELDS for f in per_file.values()) or len(rows) > MAX_TEMPLATE_FIELDS * len(files):
        raise TemplateError(f"a template has more than {MAX_TEMPLATE_FIELDS} fields")
    out = {}
    for device_type, path in mapping.items():
        fields = per_file.get(path.rsplit("/", 1)[-1], {})
        bad = {n: t for n, t in fields.items() if t not in TEMPLATE_TYPES}
        if bad and unsupported is not None:
            unsupported[device_type] = bad
        out[device_type] = telemetry_struct({n: t for n, t in fields.items() if n not in bad})
    return out


__all__ = [
    "ACTIVE_DICTIONARY",
    "dictionary",
    "diagnostics",
    "flatten",
    "last_declarations",
    "list_files",
    "read_entries",
    "telemetry_by_type",
    "telemetry_of",
    "type_discrepancy",
]
