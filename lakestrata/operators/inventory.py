"""Which device types occur in the data, against the known list.

The known list is the device-type dictionary: configuration of bounded
size (one row per template), which Spark broadcasts by its own size check;
the seen types are a distinct over the data.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# More known types than this are refused: they are configuration.
MAX_KNOWN_TYPES = 100_000


def known_types(spark: SparkSession, names: Iterable[str]) -> DataFrame:
    names = list(names)
    if len(names) > MAX_KNOWN_TYPES:
        raise ValueError(f"{len(names)} known types exceed the broadcast bound {MAX_KNOWN_TYPES}")
    schema = T.StructType([T.StructField("TemplateName", T.StringType(), True)])
    return spark.createDataFrame([(n,) for n in names], schema)


def seen_types(messages: DataFrame, name_col: str = "templateName") -> DataFrame:
    """Distinct template names seen (one column ``TemplateName``)."""
    return messages.select(F.col(name_col).alias("TemplateName")).distinct()


def known_and_seen(seen: DataFrame, known: DataFrame) -> DataFrame:
    """Known types that also occur in the data."""
    return seen.join(known, "TemplateName", "left_semi")


def seen_not_known(seen: DataFrame, known: DataFrame) -> DataFrame:
    """Types that occur in the data but are not in the dictionary."""
    return seen.join(known, "TemplateName", "left_anti")
