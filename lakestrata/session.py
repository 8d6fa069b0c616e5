"""Session settings the engine relies on, and the shared scratch folder.

Settings are applied to an existing session; nothing here creates one
except :func:`local_session`, which tests and the benchmark use.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the semantics depend on (see README, "Session").
#  - UTC so that device times, dates and partitions are the same everywhere.
#  - JSON partial results on: a wrongly typed field nulls only that field;
#    the flag rule adds the per-field test itself (operators/silver.py).
#  - case-insensitive names, as the silver projection mixes spellings.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.json.enablePartialResults": "true",
    "spark.sql.caseSensitive": "false",
}

# Settings for scale; applied only when the session has no value of its own.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Pin the settings the engine's results depend on."""
    for key, value in REQUIRED_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    for key, value in DEFAULT_CONF.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    return spark


def require(spark: SparkSession) -> None:
    """Refuse a session whose settings would give other partitions or flags."""
    wrong = {k: v for k, v in REQUIRED_CONF.items() if (spark.conf.get(k, None) or "").lower() != v.lower()}
    if wrong:
        raise ValueError(f"settings the results depend on (see lakestrata.configure): {wrong}")


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    A fresh local folder is made only for a local master that names none
    (tests); a cluster without the setting gets an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # a session without a SparkContext (Spark Connect)
        sc = None
    if not root and sc is not None:
        root = sc.getCheckpointDir()
    if not root:
        if sc is None or not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="lakestrata-ckpt-")
    if sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder under the shared checkpoint root."""
    return f"{checkpoint_root(spark)}/lakestrata/{name}-{uuid.uuid4().hex[:12]}"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "lakestrata") -> SparkSession:
    """A local session for tests and the benchmark (UI off)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("LAKESTRATA_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in {**REQUIRED_CONF, **DEFAULT_CONF}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)
