"""Parquet tables of the lakehouse, registered in the session catalog.

Each table is an external Parquet table in a folder below ``<root>/data/<name>``,
registered as ``<database>.<name>``.  History tables (bronze, silver) are partitioned by
time and bucketed by ``rowhash``: the daily insert-only merge then reads
only the touched partitions, and the target side of its anti-join needs no
shuffle (the bucketed scan is already hash-partitioned on the key); only
the batch is shuffled, into the bucket layout, before it is appended.

Tables survive the session.  A note beside the data (``plans.notes``) holds
each table's columns, types, partitioning, buckets and folder; the session's
catalog follows it: :meth:`Lakehouse.exists` registers a table that the catalog
lacks, or whose note has changed, from the note alone, so that columns added
later and partition types never depend on which file is looked at.

An overwrite writes a new folder and then changes the note: a reader sees all
of the old rows or all of the new ones, and an overwrite that fails leaves the
old ones.  The folder before stays for readers that have begun, until the next
overwrite.
"""

from __future__ import annotations

import copy
import json
import re
import threading
import uuid
from collections import defaultdict
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakestrata.plans.notes import Notes


@dataclass(frozen=True)
class TableSpec:
    name: str
    partition_by: tuple[str, ...] = ()
    bucket_by: str | None = None
    buckets: int = 0


class TableSchemaError(ValueError):
    """A batch whose columns cannot be stored in the table."""


def _ident(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


class Lakehouse:
    """Tables under one root folder and one catalog database."""

    def __init__(self, spark: SparkSession, root: str, database: str = "lakestrata"):
        self.spark = spark
        self.root = root.rstrip("/")
        self.database = database
        # Writes to one table from several driver threads are serialised
        # (check-then-create, and the committer's temporary folder per path);
        # writes to different tables run concurrently.
        self._locks: dict[str, threading.RLock] = defaultdict(threading.RLock)
        self._locks_guard = threading.Lock()
        self.notes = Notes(spark, self.root)
        self._registered: dict[str, int] = {}  # number of the note that the catalog follows
        # The database folder goes under the (shared) root, not under the
        # session's warehouse folder, which may be machine-local.
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {_ident(database)} LOCATION '{self.root}/_catalog/{database}.db'")

    def bound_to(self, spark: SparkSession) -> "Lakehouse":
        """The same tables (and locks) seen from another session.

        The frames of a streaming micro-batch belong to a session of their
        own, whose file listings differ from the starting session's.
        """
        other = copy.copy(self)
        other.spark = spark
        return other

    def _lock(self, name: str) -> threading.RLock:
        with self._locks_guard:
            return self._locks[name]

    # -- naming -------------------------------------------------------------
    def fq(self, name: str) -> str:
        return f"{_ident(self.database)}.{_ident(name)}"

    def path(self, name: str) -> str:
        """The folder that holds the table's current files."""
        found = self.notes.latest("table", name)
        return f"{self.root}/{found[1]['folder'] if found else name}"

    # -- existence and attach ----------------------------------------------
    def exists(self, spec: TableSpec | str) -> bool:
        """Whether the table has a note; the catalog then follows its latest one."""
        spec = spec if isinstance(spec, TableSpec) else TableSpec(spec)
        with self._lock(spec.name):
            found = self.notes.latest("table", spec.name)
            if found is None:
                return self._adopt(spec)
            number, note = found
            if self._registered.get(spec.name) != number or not self.spark.catalog.tableExists(f"{self.database}.{spec.name}"):
                self._register(spec.name, number, note)
            return True

    def _register(self, name: str, number: int, note: dict) -> None:
        """Make the catalog's table the one that the note describes."""
        schema = T.StructType.fromJson(note["schema"])
        cols = ", ".join(f"{_ident(f.name)} {f.dataType.simpleString()}" for f in schema.fields)
        ddl = f"CREATE TABLE {self.fq(name)} ({cols}) USING parquet"
        if note["partition_by"]:
            ddl += f" PARTITIONED BY ({', '.join(_ident(c) for c in note['partition_by'])})"
        if note["buckets"]:
            ddl += f" CLUSTERED BY ({_ident(note['bucket_by'])}) INTO {note['buckets']} BUCKETS"
        self.spark.sql(f"DROP TABLE IF EXISTS {self.fq(name)}")  # external: the files stay
        self.spark.sql(ddl + f" LOCATION '{self.root}/{note['folder']}'")
        if note["partition_by"]:
            # The catalog tracks partitions: register the ones on storage.
            self.spark.sql(f"ALTER TABLE {self.fq(name)} RECOVER PARTITIONS")
        self._registered[name] = number

    def _note(self, spec: TableSpec, schema: T.StructType, folder: str, before: str | None = None) -> None:
        """Write the table's next note and let the catalog follow it."""
        numbers = self.notes.numbers("table", spec.name)
        number = numbers[-1] + 1 if numbers else 1
        note = {
            "schema": json.loads(schema.json()), "partition_by": list(spec.partition_by), "folder": folder, "before": before,
            "bucket_by": spec.bucket_by if spec.buckets else None, "buckets": spec.buckets if spec.bucket_by else 0,
        }
        self.notes.put("table", spec.name, number, note)
        self.notes.forget("table", spec.name, below=number)
        self._register(spec.name, number, note)

    def _adopt(self, spec: TableSpec) -> bool:
        """A table written without a note, at ``<root>/<name>``: the columns of all its files become the note."""
        try:
            schema = self.spark.read.option("mergeSchema", "true").parquet(f"{self.root}/{spec.name}").schema
        except AnalysisException:
            return False
        # the type of a partition column cannot be read from NULL values alone
        fields = [T.StructField(f.name, T.StringType()) if isinstance(f.dataType, T.NullType) else f for f in schema.fields]
        self._note(spec, T.StructType(fields), spec.name)
        return True

    def _new_folder(self, name: str) -> str:
        return f"data/{name}/{uuid.uuid4().hex[:12]}"

    def _delete(self, folder: str | None) -> None:
        if folder:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{folder}")
            path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)

    def list_tables(self) -> list[str]:
        """Names of all tables, whether the catalog knows them yet or not."""
        return sorted({t.name for t in self.spark.catalog.listTables(self.database)} | set(self.notes.names("table")))

    # -- reads --------------------------------------------------------------
    def read(self, spec: TableSpec | str) -> DataFrame:
        spec = spec if isinstance(spec, TableSpec) else TableSpec(spec)
        if not self.exists(spec):
            raise AnalysisException(f"table {spec.name} does not exist")  # type: ignore[call-arg]
        return self._current(spec)

    def _current(self, spec: TableSpec) -> DataFrame:
        """The table with its files listed anew: another session may have written."""
        self.spark.catalog.refreshTable(self.fq(spec.name))
        return self.spark.table(self.fq(spec.name))

    def preview(self, spec: TableSpec | str, n: int = 100) -> DataFrame:
        """The first ``n`` rows of a table, in no particular order (a preview)."""
        return self.read(spec).limit(n)

    # -- writes -------------------------------------------------------------
    def _bucketed(self, spec: TableSpec, df: DataFrame) -> DataFrame:
        """Cluster rows for the table's layout before a write.

        By bucket id, or by partition values, so that each is written by few
        tasks into few files.  The exchange is a rebalance: adaptive
        execution merges small partitions and splits a large one (one body
        copied many times, one hot date) over several tasks, from the sizes
        it has written, without a sampling run beforehand.
        """
        if spec.bucket_by and spec.buckets:
            bucket = F.pmod(F.hash(F.col(spec.bucket_by)), F.lit(spec.buckets))
            return df.withColumn("__bucket", bucket).hint("rebalance", "__bucket").drop("__bucket")
        if spec.partition_by:
            return df.hint("rebalance", *spec.partition_by)
        return df

    def create(self, spec: TableSpec, df: DataFrame, mode: str = "overwrite") -> None:
        """Write ``df`` as the table (``mode='errorifexists'`` refuses an existing one).

        The rows go to a new folder; only when all are written does the
        table's note name it, so ``df`` may read the table itself.
        """
        with self._lock(spec.name):
            found = self.notes.latest("table", spec.name) if self.exists(spec) else None
            if found and mode == "errorifexists":
                raise AnalysisException(f"table {spec.name} exists")  # type: ignore[call-arg]
            folder, staged = self._new_folder(spec.name), f"{spec.name}__{uuid.uuid4().hex[:12]}"
            writer = self._bucketed(spec, df).write.format("parquet").option("path", f"{self.root}/{folder}")
            if spec.partition_by:
                writer = writer.partitionBy(*spec.partition_by)
            if spec.bucket_by and spec.buckets:
                writer = writer.bucketBy(spec.buckets, spec.bucket_by).sortBy(spec.bucket_by)
            try:
                writer.saveAsTable(self.fq(staged))
                schema = self.spark.table(self.fq(staged)).schema
            except BaseException:
                self._delete(folder)
                raise
            finally:
                self.spark.sql(f"DROP TABLE IF EXISTS {self.fq(staged)}")
            self._swap(spec, schema, folder, found[1] if found else None)

    def _swap(self, spec: TableSpec, schema: T.StructType, folder: str, old: dict | None, keep: bool = True) -> None:
        """From now on ``folder`` holds the table; the folder before it goes with the next swap, or now."""
        before = old["folder"] if old else None
        self._note(spec, schema, folder, before if keep else None)
        if old:
            self._delete(old["before"])
            if not keep:
                self._delete(before)

    def create_if_absent(self, spec: TableSpec, df: DataFrame) -> bool:
        """Create the table from ``df`` unless it exists; True when created."""
        with self._lock(spec.name):
            if self.exists(spec):
                return False
            self.create(spec, df)
            return True

    def _aligned(self, spec: TableSpec, df: DataFrame) -> DataFrame:
        """``df`` in the table's columns; columns the table lacks are added to it.

        Older rows read NULL in an added column, and a column that the batch
        lacks is NULL in its rows.  A column of another type is refused: a
        silent cast could lose values.
        """
        table = self._current(spec)
        have = {f.name.lower(): f for f in table.schema.fields}
        given = {f.name.lower(): f for f in df.schema.fields}
        for key, f in given.items():
            if key in have and have[key].dataType != f.dataType:
                raise TableSchemaError(f"{spec.name}.{f.name}: {f.dataType.simpleString()} given, "
                                       f"{have[key].dataType.simpleString()} stored")
        added = [f for key, f in given.items() if key not in have]
        if added:
            cols = ", ".join(f"{_ident(f.name)} {f.dataType.simpleString()}" for f in added)
            self.spark.sql(f"ALTER TABLE {self.fq(spec.name)} ADD COLUMNS ({cols})")
            note = self.notes.latest("table", spec.name)[1]
            layout = TableSpec(spec.name, tuple(note["partition_by"]), note["bucket_by"], note["buckets"])
            self._note(layout, self._current(spec).schema, note["folder"], note["before"])
            table = self._current(spec)
        return df.select(*[
            F.col(given[f.name.lower()].name).alias(f.name) if f.name.lower() in given
            else F.lit(None).cast(f.dataType).alias(f.name)
            for f in table.schema.fields
        ])

    def append(self, spec: TableSpec, df: DataFrame) -> None:
        """Append by column name (creating the table when absent, adding new columns)."""
        with self._lock(spec.name):
            if not self.exists(spec):
                self.create(spec, df)
                return
            self._bucketed(spec, self._aligned(spec, df)).write.insertInto(self.fq(spec.name))

    def append_if_rows(self, spec: TableSpec, df: DataFrame) -> bool:
        """Append only a non-empty batch; True when something was written."""
        if df.isEmpty():
            return False
        self.append(spec, df)
        return True

    def replace_partitions(self, spec: TableSpec, df: DataFrame) -> None:
        """Replace exactly the partitions present in ``df``.

        The mode is an option of this one write, not of the session (which
        other threads share); ``insertInto`` knows no such option, hence the
        write by path.
        """
        if spec.bucket_by:
            raise TableSchemaError(f"{spec.name}: partitions of a bucketed table cannot be replaced by path")
        with self._lock(spec.name):
            if not self.exists(spec):
                self.create(spec, df)
                return
            (self._bucketed(spec, self._aligned(spec, df)).write.mode("overwrite")
             .option("partitionOverwriteMode", "dynamic").partitionBy(*spec.partition_by).parquet(self.path(spec.name)))
            self.spark.sql(f"ALTER TABLE {self.fq(spec.name)} RECOVER PARTITIONS")
            self.spark.catalog.refreshTable(self.fq(spec.name))

    def overwrite(self, spec: TableSpec, df: DataFrame) -> None:
        """Replace the table's content (the plan must not read this table)."""
        self.create(spec, df, mode="overwrite")

    def drop(self, name: str) -> None:
        """Drop the table with its data: it must not come back when attached again."""
        with self._lock(name):
            self.spark.sql(f"DROP TABLE IF EXISTS {self.fq(name)}")
            self.notes.forget("table", name)
            self._registered.pop(name, None)
            self._delete(name)
            self._delete(f"data/{name}")

    def truncate(self, spec: TableSpec) -> None:
        """Empty the table, keeping its columns and layout: a new, empty folder; no job runs."""
        with self._lock(spec.name):
            if not self.exists(spec):
                return
            note = self.notes.latest("table", spec.name)[1]
            folder = self._new_folder(spec.name)
            path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{folder}")
            path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(path)
            layout = TableSpec(spec.name, tuple(note["partition_by"]), note["bucket_by"], note["buckets"])
            self._swap(layout, T.StructType.fromJson(note["schema"]), folder, note, keep=False)

    def size_in_bytes(self, name: str) -> int | None:
        """Table size from catalog statistics (computed without a scan)."""
        self.spark.sql(f"ANALYZE TABLE {self.fq(name)} COMPUTE STATISTICS NOSCAN")
        for row in self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.fq(name)}").collect():
            if row["col_name"] == "Statistics":
                m = re.match(r"(\d+) bytes", row["data_type"])
                return int(m.group(1)) if m else None
        return None
