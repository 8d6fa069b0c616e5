"""Small JSON notes beside the tables, on the same (shared) storage.

A note is ``<root>/_notes/<kind>/<name>/<number>.json``.  It is written under
another name and renamed, so a reader sees it whole or not at all, and a
number is taken only once.  Notes hold a table's layout or a stream's
progress: some kilobytes, never rows.
"""

from __future__ import annotations

import json
import uuid
from urllib.parse import quote, unquote

from pyspark.sql import SparkSession


class Notes:
    def __init__(self, spark: SparkSession, root: str):
        self.jvm = spark._jvm
        self.conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.root = f"{root}/_notes"

    def _path(self, *parts: str):
        return self.jvm.org.apache.hadoop.fs.Path("/".join([self.root, *parts]))

    def _fs(self):
        return self._path().getFileSystem(self.conf)

    def _children(self, *parts: str) -> list[str]:
        fs, path = self._fs(), self._path(*parts)
        return sorted(f.getPath().getName() for f in fs.listStatus(path)) if fs.exists(path) else []

    def numbers(self, kind: str, name: str) -> list[int]:
        return sorted(int(f[:-5]) for f in self._children(kind, quote(name, "")) if f.endswith(".json") and f[:-5].isdigit())

    def names(self, kind: str) -> list[str]:
        return [unquote(f) for f in self._children(kind)]

    def read(self, kind: str, name: str, number: int) -> dict:
        stream = self._fs().open(self._path(kind, quote(name, ""), f"{number}.json"))
        try:
            return json.loads(self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def latest(self, kind: str, name: str) -> tuple[int, dict] | None:
        """The note of the highest number."""
        found = self.numbers(kind, name)
        return (found[-1], self.read(kind, name, found[-1])) if found else None

    def put(self, kind: str, name: str, number: int, content: dict) -> None:
        """Write a note; a number that is taken is an error."""
        fs, folder = self._fs(), quote(name, "")
        draft, final = self._path(kind, folder, f".{uuid.uuid4().hex}"), self._path(kind, folder, f"{number}.json")
        if fs.exists(final):
            raise FileExistsError(f"note {kind}/{name}/{number} exists")
        out = fs.create(draft, False)
        try:
            out.write(json.dumps(content).encode())
        finally:
            out.close()
        if not fs.rename(draft, final):
            fs.delete(draft, False)
            raise FileExistsError(f"note {kind}/{name}/{number} exists")

    def forget(self, kind: str, name: str, below: int | None = None) -> None:
        """Remove a name's notes, or those of a lower number only."""
        fs, folder = self._fs(), quote(name, "")
        if below is None:
            fs.delete(self._path(kind, folder), True)
            return
        for n in self.numbers(kind, name):
            if n < below:
                fs.delete(self._path(kind, folder, f"{n}.json"), False)
