"""Importance resampling towards a target distribution.

Texts become bags of hashed features: a table of 256 bytes lower-cases A to Z
and blanks every ASCII byte that is no letter or digit (bytes from 0x80 on
stay, so UTF-8 letters do), ``bytes.split`` yields the words, and chained CRC-32
seeds extend each word to longer runs without building them.  Counters reduce
the features of a task, Spark sums the buckets of all tasks.

A bucket's gain compares its smoothed share of the target with that of the
documents; a document's weight is the mean gain of its features.  Weight plus
Gumbel noise, made from the id by SHA-256, is the score, and the highest
scores are a draw without replacement in proportion to exp(weight).

Ranks need no sort of all rows: scores are whole numbers (the logarithms of
counts and of 32-bit noise leave about 100,000 of them at any size), so
counts per score give the rank at which each score begins, and only documents
above the last drawn score are ordered, score by score.

Null text: no words, weight 0.  A null id takes part under the empty id; equal
rows are drawn one by one, ties go to the smaller id (null first), then to fewer
features, then the smaller weight.  An empty target or empty
tables are counted as such.  Long texts are taken piece by piece.  Other
columns, whatever their names, are not read.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .base import stored, utf8

TABLE = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))
PIECE = 1 << 20
#: Different features that a task's counter holds before they are added to its buckets.
HELD = 1 << 20
MAX_BUCKETS = 1 << 20
COPIES = 10_000


@dataclass(frozen=True)
class Settings:
    """Features of 1 to ``width`` words in ``buckets``; of documents of ``least_words`` words ``percent`` are drawn."""

    width: int = 2
    buckets: int = 10_000
    seed: int = 0
    least_words: int = 1
    percent: int = 10

    def __post_init__(self):
        if self.width < 1 or not 1 <= self.buckets <= MAX_BUCKETS or not 0 <= self.percent <= 100:
            raise ValueError(f"width from 1, buckets from 1 to {MAX_BUCKETS}, percent from 0 to 100")


def words_of(text: bytes):
    """Words of a text, in lists of about PIECE bytes."""
    at, size = 0, len(text)
    while at < size:
        end = at + PIECE
        if end < size:
            plain = text[at:end].translate(TABLE)
            cut = plain.rfind(b" ", 1)
            while cut < 0 and end < size:  # one word, longer than a piece
                seen = len(plain)
                plain += text[end : end + PIECE].translate(TABLE)
                end += PIECE
                cut = plain.find(b" ", seen)
            plain = plain if cut < 0 else plain[:cut]
            end = size if cut < 0 else at + cut
        else:
            plain = text[at:].translate(TABLE)
        yield plain.split()
        at = end


def features(text: bytes, width: int):
    """(words in the piece, CRC-32 of each run of 1 to ``width`` words that ends in it)."""
    before: list[bytes] = []
    for words in words_of(text):
        codes = list(map(zlib.crc32, words))
        if width > 1 and words:
            spaced, start = [b" " + w for w in before + words], len(before)
            seeds = list(map(zlib.crc32, before + words))
            for n in range(1, width):
                seeds = list(map(zlib.crc32, spaced[n:], seeds))
                codes += seeds[max(0, start - n) :]
            before = (before + words)[1 - width :]
        yield len(words), codes


def bucket_counts(texts: DataFrame, settings: Settings) -> np.ndarray:
    """Features in each bucket, over all rows of the one text column."""
    width, buckets = settings.width, settings.buckets

    def run(batches):
        total, held = np.zeros(buckets, np.int64), Counter()

        def add():
            if held:
                codes = np.fromiter(held.keys(), np.int64, len(held))
                np.add.at(total, codes % buckets, np.fromiter(held.values(), np.int64, len(held)))
                held.clear()

        for b in batches:
            data, off = utf8(b.column(0))
            for i in range(b.num_rows):
                for _, codes in features(data[off[i] : off[i + 1]].tobytes(), width):
                    held.update(codes)
                    if len(held) > HELD:
                        add()
        add()
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["bucket", "n"])

    summed = texts.mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    found = summed.toArrow()  # at most one row a bucket
    out[found["bucket"].to_numpy()] = found["n"].to_numpy()
    return out


def gains(ours: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of smoothed shares, floored, for each bucket."""
    size = len(ours)
    s_all, t_all = float(ours.sum()) + size, float(target.sum()) + size
    ratio = [math.floor(1000 * math.log((t + 1.0) * s_all / ((s + 1.0) * t_all))) for s, t in zip(ours.tolist(), target.tolist(), strict=True)]
    return np.array(ratio, np.int64)


def weigh(docs: DataFrame, gain: np.ndarray, settings: Settings, id_col: str, text_col: str) -> DataFrame:
    """id, n_words, n_features, weight of every row."""
    width, buckets = settings.width, settings.buckets
    shared = docs.sparkSession.sparkContext.broadcast(gain)

    def run(batches):
        gain = shared.value
        for b in batches:
            data, off = utf8(b.column(1))
            out = np.zeros((3, b.num_rows), np.int64)
            for i in range(b.num_rows):
                words = n = total = 0
                for w, codes in features(data[off[i] : off[i + 1]].tobytes(), width):
                    words, n = words + w, n + len(codes)
                    total += int(gain[np.array(codes, np.int64) % buckets].sum()) if codes else 0
                out[:, i] = words, n, total // n if n else 0
            yield pa.RecordBatch.from_arrays([b.column(0), *map(pa.array, out)], ["id", "n_words", "n_features", "weight"])

    thin = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = thin.schema["id"].dataType.simpleString()
    return thin.mapInArrow(run, f"id {kind}, n_words long, n_features long, weight long")


def noise(id_: Column, seed: int) -> Column:
    """Gumbel noise in thousandths, floored, from 32 bits of the SHA-256 of "seed:id"."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(id_.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.log(-F.log((h + F.lit(0.5)) / F.lit(2.0**32)))).cast("long")


def ranked(scored: DataFrame, eligible: Column, draw: int, order: list[str]) -> DataFrame:
    """``scored`` with ``rank``: 1, 2, ... of the ``draw`` eligible rows of highest ``score``; else null.

    Equal rows are counted first, so that a row repeated many times is one
    row until its copies are dealt out.
    """
    eligible = F.coalesce(eligible, F.lit(False))
    per = scored.where(eligible).groupBy("score").agg(F.count("*").alias("n"))
    # one row a score: a table whose size does not follow the input
    above = per.select("score", (F.sum("n").over(W.orderBy(F.desc("score"))) - F.col("n")).alias("above"))
    begins = above.where(F.col("above") < draw).select(F.col("score").alias("at"), "above")
    last = begins.agg(F.min("at")).first()[0]
    near = eligible & (F.col("score") >= last) if last is not None else F.lit(False)
    groups = scored.where(near).groupBy(*scored.columns).agg(F.count("*").alias("copies"))
    inside = W.partitionBy("score").orderBy(*order, *(c for c in scored.columns if c not in order)).rowsBetween(W.unboundedPreceding, -1)
    first = F.col("above") + F.coalesce(F.sum("copies").over(inside), F.lit(0)) + 1
    placed = groups.join(F.broadcast(begins), F.col("score") == F.col("at")).withColumn("first", first)
    blocks = placed.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("copies") - 1) / COPIES))))
    copies = F.sequence(F.col("block") * COPIES, F.least(F.col("copies"), (F.col("block") + 1) * COPIES) - 1)
    drawn = blocks.select(*scored.columns, "first", F.explode(copies).alias("copy"))
    rank = F.when(F.col("first") + F.col("copy") <= draw, F.col("first") + F.col("copy"))
    return drawn.select(*scored.columns, rank.alias("rank")).unionByName(scored.where(~near).withColumn("rank", F.lit(None).cast("long")))


def resample(docs: DataFrame, target: DataFrame, settings: Settings, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text") -> DataFrame:
    """id_col, n_features, weight, score and rank (null: not drawn) of every row of ``docs``."""
    ours = bucket_counts(docs.select(F.col(text_col).cast("string").alias("text")), settings)
    theirs = bucket_counts(target.select(F.col(target_col).cast("string").alias("text")), settings)
    weighed = weigh(docs, gains(ours, theirs), settings, id_col, text_col)
    scored = stored(weighed.withColumn("score", F.col("weight") + noise(F.col("id"), settings.seed)))
    enough = F.col("n_words") >= settings.least_words
    draw = settings.percent * scored.where(enough).count() // 100
    out = ranked(scored, enough, draw, ["id", "n_features", "weight"])
    return out.select(F.col("id").alias(id_col), "n_features", "weight", "score", "rank")
