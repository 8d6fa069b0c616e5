"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Each source is a stream of words: its documents in a hashed order.  The
stream is cut into blocks of equal length; the mix takes every block a whole
number of times (epochs) and, for the rest of the target, the first blocks of
a keyed random permutation, the last of them in part, so that the words
taken meet the target exactly.  A splitting tree then deals the exact block
quotas of all sources among the output shards: a node hands its left child
a multivariate-hypergeometric draw of its blocks, down to single shards, so
each shard gets a random share of the mix and the quotas add up.  Blocks of a
source go to shards in permuted order, which makes the draws disjoint; a
hash gives each block's place within its shard.

The driver handles one row per source (MAX_SOURCES, an error beyond it),
never documents.  Sources are weighed by code-point order, null last.
Null or empty texts have size 0 and are taken 0 times.  Repeated rows each
count; equal rows (same id and text) lie in one stretch of the stream, ties
going to the smaller of their other columns' hash.  Empty tables give empty
results.  The same input and seed give the same mix.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .base import mix as scramble
from .base import whole_row

MAX_SOURCES = 50_000
ROUNDS = 24
MAX_BLOCKS = 200_000
#: numpy draws from fewer than this many.
LARGEST = 1_000_000_000
DRAW_CHUNK = 1 << 20
PIECES = T.ArrayType(T.StructType([T.StructField(n, t()) for n, t in (("epoch", T.IntegerType), ("shard", T.IntegerType), ("place", T.LongType), ("first", T.LongType), ("words", T.LongType))]))
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: list[int], weights: list[float], share: float, most: float) -> list[float]:
    """``share`` of all words dealt by weight; no source above ``most`` times its size, the excess dealt again."""
    left, out, open_ = share * sum(sizes), [0.0] * len(sizes), set(range(len(sizes)))
    while open_:
        unit = left / sum(weights[i] for i in open_)
        full = {i for i in open_ if weights[i] * unit >= most * sizes[i]}
        if not full:
            for i in open_:
                out[i] = weights[i] * unit
            break
        for i in full:
            out[i] = most * sizes[i]
            left -= out[i]
        open_ -= full
    return out


def hypergeometric(c: int, rest: int, n: int, rng: np.random.Generator) -> int:
    """How many of ``n`` drawn without replacement are of the ``c``, not of the ``rest``.

    Beyond numpy's limit by inversion: the weights of all values within twelve
    deviations of the mode, from the ratios of neighbours; what lies outside
    has less weight than a double tells apart.
    """
    total = c + rest
    if total < LARGEST:
        return int(rng.hypergeometric(c, rest, n))
    mode = (n + 1) * (c + 1) // (total + 2)
    reach = 64 + int(12 * math.sqrt(n * (c / total) * (rest / total) * ((total - n) / (total - 1))))
    lo, hi = max(0, n - rest, mode - reach), min(c, n, mode + reach)

    def weights(first: int, log: float) -> tuple[np.ndarray, float]:
        """Weights from ``first`` on, relative to that of ``lo``, and the logarithm of the next one."""
        k = np.arange(first, min(first + DRAW_CHUNK, hi + 1), dtype=np.float64)
        with np.errstate(divide="ignore"):
            logs = log + np.concatenate([[0.0], np.cumsum(np.log((c - k) / (k + 1)) + np.log((n - k) / (rest - n + k + 1)))])
        return np.exp(logs[:-1]), float(logs[-1])

    starts, sums, log = [], [], 0.0
    for first in range(lo, hi + 1, DRAW_CHUNK):
        starts.append((first, log))
        w, log = weights(first, log)
        sums.append(float(w.sum()))
    upto = np.cumsum(sums)
    at = rng.random() * upto[-1]
    part = min(int(np.searchsorted(upto, at, "right")), len(sums) - 1)
    w, _ = weights(*starts[part])
    inside = np.searchsorted(np.cumsum(w), at - (upto[part] - sums[part]), "right")
    return starts[part][0] + min(int(inside), len(w) - 1)


def split_tree(blocks: list[int], shards: int, seed: int) -> np.ndarray:
    """shards x sources: block counts; each node's left half is a multivariate-hypergeometric draw."""
    out = np.zeros((shards, len(blocks)), np.int64)

    def draw(counts: np.ndarray, n: int, rng: np.random.Generator) -> np.ndarray:
        got, rest = np.zeros_like(counts), int(counts.sum())
        for i, c in enumerate(counts.tolist()):
            rest -= c
            if n <= 0:
                break
            got[i] = k = hypergeometric(c, rest, n, rng)
            n -= k
        return got

    todo = [(0, shards, np.array(blocks, np.int64))]
    while todo:
        lo, hi, counts = todo.pop()
        if hi - lo == 1:
            out[lo] = counts
            continue
        mid = (lo + hi) // 2
        rng = np.random.default_rng([seed, lo, hi])
        left = draw(counts, int(counts.sum()) * (mid - lo) // (hi - lo), rng)
        todo += [(lo, mid, left), (mid, hi, counts - left)]
    return out


def _key(seed: int, source: str | None, r: int) -> int:
    return int.from_bytes(hashlib.blake2b(f"{seed}|{r}|{source!r}".encode(), digest_size=7).digest(), "big")


def permuted(i: np.ndarray, n: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Where keyed permutations of 0..n-1 put i: swap-or-not rounds, a column of ``keys`` each."""
    x = i.astype(np.int64)
    for r in range(keys.shape[1]):
        other = (keys[:, r] % n - x) % n
        coin = scramble(np.maximum(x, other).astype(np.uint64) ^ scramble(keys[:, r].astype(np.uint64))) & np.uint64(1)
        x = np.where(coin == 1, other, x)
    return x


def plan(sized: DataFrame, weights: tuple[float, ...], share: float, most: float, shards: int, seed: int, block: int) -> dict[str, list]:
    """By source key: size, target, block width and number, epochs, blocks drawn, words of the last, shard quotas (running sums), keys."""
    per = sized.groupBy("__source").agg(F.sum("size").alias("n")).limit(MAX_SOURCES + 1).collect()
    if len(per) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    per.sort(key=lambda r: (r["__source"] is None, (r["__source"] or "").encode("utf-8", "surrogatepass")))
    sizes = [r["n"] or 0 for r in per]
    goal = targets(sizes, [weights[i % len(weights)] for i in range(len(per))], share, most)
    rows = []
    for r, n, t in zip(per, sizes, goal, strict=True):
        width = max(1, min(block, n // 1024))
        count = -(-n // width)
        epochs = min(int(t // n), int(most)) if n else 0
        rest = min(n, round(t - epochs * n)) if epochs < most else 0
        drawn = -(-rest // width)
        rows.append([r["__source"], n, float(t), width, count, epochs, drawn, rest - (drawn - 1) * width if drawn else 0])
    dealt = split_tree([r[5] * r[4] + r[6] for r in rows], shards, seed)
    for i, r in enumerate(rows):
        r += [np.cumsum(dealt[:, i]).tolist(), [_key(seed, r[0], k) for k in range(ROUNDS)]]
    return {"" if r[0] is None else f"={r[0]}": r[1:] for r in rows}


def mix(docs: DataFrame, weights=(3.0, 1.0, 2.0), share: float = 1.5, most: float = 2.0, shards: int = 64, seed: int = 7, block: int = 1024, carry: list[str] | None = None) -> DataFrame:
    """The ``carry`` columns of ``docs``, with size, source_size, target and pieces.

    Default: all columns but those that the new ones replace by name.

    Only the carried columns are shuffled: leave out the text where the
    pieces alone are wanted.
    pieces: array of (epoch, shard, place, first, words): words
    ``first .. first + words - 1`` of the document, at ``place`` within the
    shard (sort by it).  An unfinished epoch has only the drawn blocks.
    """
    carry = [c for c in docs.columns if c not in ("size", "source_size", "target", "pieces")] if carry is None else carry
    placed, shared = _placed(docs, carry, weights, share, most, shards, seed, block)
    fields = [*placed.schema.fields[:-2], T.StructField("source_size", T.LongType()), T.StructField("target", T.DoubleType()), T.StructField("pieces", PIECES)]

    def run(batches):
        sources = shared.value
        for b in batches:
            size, at = b.column(len(carry)).to_numpy(), b.column(len(carry) + 2).to_numpy()
            plans = [sources[k] for k in b.column(len(carry) + 1).to_pylist()]
            lo = 0
            while lo < len(size):  # so many rows at a time that their blocks fit in memory
                blocks = np.cumsum([n // p[2] + 2 for n, p in zip(size[lo:].tolist(), plans[lo:], strict=True)])
                hi = lo + max(1, int(np.searchsorted(blocks, MAX_BLOCKS, "right")))
                made = pieces_of(size[lo:hi], at[lo:hi], plans[lo:hi])
                of_source = [pa.array([p[i] for p in plans[lo:hi]], t) for i, t in ((0, pa.int64()), (1, pa.float64()))]
                yield pa.RecordBatch.from_arrays([*(c.slice(lo, hi - lo) for c in b.columns[: len(carry) + 1]), *of_source, made], [f.name for f in fields])
                lo = hi

    return placed.mapInArrow(run, T.StructType(fields))


def _placed(docs: DataFrame, carry: list[str], weights=(3.0, 1.0, 2.0), share: float = 1.5, most: float = 2.0, shards: int = 64, seed: int = 7, block: int = 1024):
    """The ``carry`` columns with size, source key and offset in the source's stream; the plan, broadcast."""
    sized = docs.select(
        *(F.col(c) for c in carry),
        word_count(F.col("text").cast("string")).alias("size"),
        F.col("source").cast("string").alias("__source"),
        F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")).alias("__key"),
        F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("text")).alias("__h"),
        F.xxhash64(F.lit(seed), *(F.col(c) for c in carry if "map<" not in docs.schema[c].dataType.simpleString())).alias("__tie"),
    )
    shared = docs.sparkSession.sparkContext.broadcast(plan(sized, weights, share, most, shards, seed, block))
    # offsets in each source's stream: sums of (source, hash slice), then inside a slice
    sized = sized.withColumn("__slice", F.shiftrightunsigned("__h", 52).cast("int"))
    slices = sized.groupBy("__key", "__slice").agg(F.sum("size").alias("__n"))
    before = F.sum("__n").over(W.partitionBy("__key").orderBy("__slice").rowsBetween(W.unboundedPreceding, -1))
    slices = slices.select(F.col("__key").alias("__sk"), F.col("__slice").alias("__sl"), F.coalesce(before, F.lit(0)).alias("__base"))
    inner = F.sum("size").over(W.partitionBy("__key", "__slice").orderBy("__h", "size", "__tie").rowsBetween(W.unboundedPreceding, -1))
    placed = sized.withColumn("__off", F.coalesce(inner, F.lit(0)))
    placed = placed.join(slices, (F.col("__key") == F.col("__sk")) & (F.col("__slice") == F.col("__sl")), "left")
    return placed.select(*carry, "size", "__key", (F.col("__base") + F.col("__off")).alias("__at")), shared


def pieces_of(size: np.ndarray, at: np.ndarray, plans: list[list]) -> pa.Array:
    """Lists of pieces of documents that lie at ``at`` in their sources' streams."""
    width, blocks, epochs, drawn, last = (np.array([p[i] for p in plans], np.int64) for i in range(2, 7))
    first = at // width
    count = np.where(size > 0, (at + size - 1) // width - first + 1, 0)
    row = np.repeat(np.arange(len(size)), count)
    b = first[row] + np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    keys = np.array([p[8] for p in plans], np.int64).reshape(len(plans), ROUNDS)
    rank = permuted(b, blocks[row], keys[row])
    begin, end = np.maximum(b * width[row], at[row]), np.minimum((b + 1) * width[row], (at + size)[row])
    found = []
    for e in range(int(epochs.max(initial=0)) + 1):
        part = e == epochs[row]
        stop = np.where(part & (rank == drawn[row] - 1), np.minimum(end, b * width[row] + last[row]), end)
        got = np.flatnonzero(((e < epochs[row]) | (part & (rank < drawn[row]))) & (stop > begin))
        found.append((row[got], np.full(len(got), e), b[got], rank[got] + e * blocks[row[got]], begin[got], stop[got]))
    row, epoch, b, order, begin, stop = (np.concatenate(c) for c in zip(*found, strict=True))
    by = np.lexsort((b, epoch, row))
    row, epoch, b, order, begin, stop = (c[by] for c in (row, epoch, b, order, begin, stop))
    shard = np.zeros(len(row), np.int64)
    cuts = np.searchsorted(row, np.arange(len(size) + 1))
    for i in np.flatnonzero(np.diff(cuts)).tolist():
        shard[cuts[i] : cuts[i + 1]] = np.searchsorted(plans[i][7], order[cuts[i] : cuts[i + 1]], "right")
    with np.errstate(over="ignore"):
        place = scramble(scramble(keys[row, 0].astype(np.uint64) + epoch.astype(np.uint64)) ^ b.astype(np.uint64)).view(np.int64)
    values = [epoch.astype(np.int32), shard.astype(np.int32), place, begin - at[row], stop - begin]
    structs = pa.StructArray.from_arrays([pa.array(v) for v in values], PIECES.elementType.names)
    return pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), structs)


def taken() -> Column:
    return F.aggregate("pieces", F.lit(0).cast("long"), lambda s, p: s + p["words"])


def shard_words() -> Column:
    """Words of each shard that takes some: ``"0:12,5:3"``, by shard."""
    shards = F.array_sort(F.array_distinct(F.transform("pieces", lambda p: p["shard"])))
    words = lambda s: F.aggregate(F.filter("pieces", lambda p: p["shard"] == s), F.lit(0).cast("long"), lambda a, p: a + p["words"])
    return F.array_join(F.transform(shards, lambda s: F.concat(s.cast("string"), F.lit(":"), words(s).cast("string"))), ",")


#: Parts of a shard that are shuffled by a task each.
SHARD_PARTS = 64


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` at the mix's rates, as whole documents, shard after shard.

    A source's documents are taken once for each epoch.  For the rest of its
    target, words are rounded to documents along the hashed order: one more
    time each document whose middle lies before the rest.  So a source's words
    miss its target by at most half of one document (and the rounding of the
    target to a word).

    The splitting tree's quotas cut this stream of documents: a copy goes to
    the shard whose blocks hold its middle, so each shard's words of a source
    miss the quota by at most half a document at either end.  The copies of
    a shard are shuffled locally: dealt by a hash of their place, and in its
    order within a partition.
    """
    dealt = dealt_documents(docs, **options)
    return dealt.repartition("__shard", F.pmod("__place", F.lit(SHARD_PARTS))).sortWithinPartitions("__shard", "__place").select("__row.*")


def dealt_documents(docs: DataFrame, **options) -> DataFrame:
    """(__row, __shard, __place): a row for each copy of a document that the mix takes."""
    placed, shared = _placed(docs.select(whole_row(docs), "doc_id", "source", "text"), ["__row"], **options)
    copies = T.ArrayType(T.StructType([T.StructField("shard", T.IntegerType()), T.StructField("place", T.LongType())]))
    fields = [placed.schema["__row"], T.StructField("__copies", copies)]

    def run(batches):
        sources = shared.value
        for b in batches:
            size, at = b.column(1).to_numpy(), b.column(3).to_numpy()
            plans = [sources[k] for k in b.column(2).to_pylist()]
            width, blocks, epochs, drawn, last = (np.array([p[i] for p in plans], np.int64) for i in range(2, 7))
            rest = np.where(drawn > 0, (drawn - 1) * width + last, 0)
            times = np.where(size > 0, epochs + (2 * at + size <= 2 * rest), 0)
            row = np.repeat(np.arange(len(size)), times)
            epoch = np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times)
            block = epoch * blocks[row] + ((at + size // 2) // np.maximum(width, 1))[row]
            shard = np.array([np.searchsorted(plans[i][7], k, "right") for i, k in zip(row.tolist(), block.tolist(), strict=True)], np.int32)
            with np.errstate(over="ignore"):
                key = np.array([p[8][0] for p in plans], np.int64)[row].astype(np.uint64) + epoch.astype(np.uint64)
                place = scramble(scramble(key) ^ at[row].astype(np.uint64)).view(np.int64)
            structs = pa.StructArray.from_arrays([pa.array(shard), pa.array(place)], ["shard", "place"])
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(times)]).astype(np.int32)), structs)
            yield pa.RecordBatch.from_arrays([b.column(0), lists], ["__row", "__copies"])

    mixed = placed.mapInArrow(run, T.StructType(fields))
    return mixed.select("__row", F.explode("__copies").alias("__copy")).select("__row", F.col("__copy.shard").alias("__shard"), F.col("__copy.place").alias("__place"))
