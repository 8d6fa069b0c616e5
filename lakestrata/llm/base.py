"""Shared helpers: lineage cuts, and vectorised words over Arrow batches."""

from __future__ import annotations

import secrets
import tempfile
import uuid

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Text that a kernel works on at once; its arrays take some 100 bytes a byte.
CHUNK_BYTES = 256 << 10
#: Rows of an Arrow batch: texts of some kilobytes, of which each task holds several batches.
BATCH_ROWS = 2_000


def small_batches(spark: SparkSession) -> None:
    """Lower the session's Arrow batches to BATCH_ROWS rows; a session that asks for fewer keeps its setting."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def shared_root(spark: SparkSession) -> str:
    """The folder that the session names in ``spark.checkpoint.dir``.

    A local folder is made only for a local master (tests).  A cluster
    without the setting gets an error, because executors could not share it.
    """
    small_batches(spark)
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        root = spark.conf.get("spark.checkpoint.dir", None)
        if not root:
            if not sc.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            root = tempfile.mkdtemp(prefix="lakestrata-llm-")
        sc.setCheckpointDir(root)
    return sc.getCheckpointDir().rstrip("/")


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and go on from there."""
    shared_root(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame) -> DataFrame:
    """Like ``cut``, as Parquet: for larger tables that several branches read."""
    path = f"{shared_root(df.sparkSession)}/stored-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_row(df: DataFrame) -> Column:
    """All columns in one, ``__row``: no helper column can clash with them."""
    return F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("__row")


def utf8(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets (n + 1, starting at 0) of a string column; null: empty."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    if arr.null_count:
        arr = arr.fill_null("")
    kind = np.int64 if pa.types.is_large_string(arr.type) else np.int32
    n = len(arr)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = arr.buffers()
    off = np.frombuffer(offsets, kind, n + 1 + arr.offset)[arr.offset :].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[off[0] : off[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, off - off[0]


def row_chunks(off: np.ndarray, limit: int = CHUNK_BYTES):
    """Row ranges of at most ``limit`` bytes each, or of one longer row."""
    lo, n = 0, len(off) - 1
    while lo < n:
        hi = int(np.searchsorted(off, off[lo] + limit, "right")) - 1
        hi = min(n, max(lo + 1, hi))
        yield lo, hi
        lo = hi


def separators() -> np.ndarray:
    """Bytes that end a word: 0x20 and 0x09 to 0x0D."""
    sep = np.zeros(256, bool)
    sep[[32, 9, 10, 11, 12, 13]] = True
    return sep


def word_spans(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of each word `[^\\x20\\x09-\\x0D]+`; words never cross rows."""
    if len(data) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    word = ~separators()[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[off] = True
    before = np.empty(len(data), bool)
    before[0] = False
    before[1:] = word[:-1]
    starts = np.flatnonzero(word & (~before | edge[:-1]))
    after = np.empty(len(data), bool)
    after[-1] = False
    after[:-1] = word[1:]
    ends = np.flatnonzero(word & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(off, starts, "right") - 1


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHasher:
    """64-bit hashes of byte ranges: prefix sums of a polynomial modulo 2**64, XXH3 for long ranges.

    The base is drawn anew by each driver and shipped with the functions, so
    that nobody can prepare colliding words; results do not depend on it.
    Long ranges have collisions for every base (Thue-Morse words from 1,024
    bytes on), hence the other hash for them.
    """

    BASE = secrets.randbits(64) & ~7 | 5
    LONG = 256

    def __init__(self):
        self.size = 0

    def grow(self, n: int) -> None:
        if n <= self.size:
            return
        self.size = n = max(n, CHUNK_BYTES + 2)
        with np.errstate(over="ignore"):
            self.power = np.cumprod(np.full(n, self.BASE, np.uint64))
            self.inverse = np.cumprod(np.full(n, pow(self.BASE, -1, 1 << 64), np.uint64))

    def __call__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """One hash for each of the ordered ranges; memory follows the longer of a chunk and a word."""
        out = np.empty(len(starts), np.uint64)
        lo = 0
        while lo < len(starts):
            a = int(starts[lo])
            hi = max(lo + 1, int(np.searchsorted(ends, a + CHUNK_BYTES, "right")))
            b = int(ends[hi - 1])
            self.grow(b - a + 1)
            sums = np.zeros(b - a + 1, np.uint64)
            with np.errstate(over="ignore"):
                np.cumsum((data[a:b].astype(np.uint64) + np.uint64(1)) * self.power[: b - a], out=sums[1:])
                h = (sums[ends[lo:hi] - a] - sums[starts[lo:hi] - a]) * self.inverse[starts[lo:hi] - a]
            out[lo:hi] = mix(h)
            lo = hi
        self.rehash_long(data, starts, ends, out)
        return out

    def rehash_long(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, out: np.ndarray) -> None:
        """Replace the hashes of long ranges."""
        for i in np.flatnonzero(ends - starts > self.LONG).tolist():
            out[i] = xxhash.xxh3_64_intdigest(np.ascontiguousarray(data[starts[i] : ends[i]]), self.BASE)


def windows(hashes: np.ndarray, rows: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Index and hash of each run of ``width`` words that lies in one row."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    at = np.flatnonzero(rows[:n] == rows[width - 1 :])
    h = np.zeros(len(at), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(width):
            h = mix(h * np.uint64(0xD1342543DE82EF95) + hashes[at + k])
    return at, h
