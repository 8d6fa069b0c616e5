"""lakestrata: a Spark-native bronze / silver / gold telemetry lakehouse.

Raw device messages are stored once in a history table keyed by the
SHA-256 of their body (bronze), parsed per device type into wide typed
tables with a schema generated from the device template (silver), and
summarised per device and day into anomaly counts and severity scores
(gold).  Every step is a DataFrame transformation; sinks are plain
Parquet tables written with insert-only merges built from anti-joins.

    from lakestrata import Lakehouse, DeviceType, Layout, run_daily, telemetry_struct
    lh = Lakehouse(spark, "<shared folder>")
    devices = [DeviceType("Compressors", telemetry_struct({"RUNNINGHR": "double"}), "RUNNINGHR")]
    run_daily(lh, spark.read.parquet("<event log>"), devices, minutes=3000)
"""

from lakestrata.plans.daily import DeviceType, Layout, backfill, run_daily
from lakestrata.plans.tables import Lakehouse, TableSpec
from lakestrata.schemas import telemetry_struct
from lakestrata.session import configure, scratch_path

__all__ = [
    "DeviceType",
    "Lakehouse",
    "Layout",
    "TableSpec",
    "backfill",
    "configure",
    "run_daily",
    "scratch_path",
    "telemetry_struct",
]
__version__ = "0.1.0"
