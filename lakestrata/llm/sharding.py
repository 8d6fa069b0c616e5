"""Sharding by rendezvous hashing of a stable key over weighted shards.

Every shard s scores -ln(u) / weight(s), with u in (0, 1) from the MD5 of
"key:s"; the least score takes the record.  A record's shard thus depends
on its key and the shards alone, and a new shard takes only the records
whose least score it is, nothing moves between old shards.

``slots`` numbers the records of a shard from 0 without gaps: by the MD5
of the key, then key, then text hash.  The order key's leading hex digits
split each shard into buckets, a count per bucket gives the offsets, and
only buckets are sorted; equal rows are counted before anything is sorted.

Null keys share the shard of the text "(null)".  Repeated rows take slots
of their own.  Empty tables give empty results.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .base import cut

ROWS_PER_BUCKET = 5_000


def key_text(key: Column) -> Column:
    return F.coalesce(key.cast("string"), F.lit("(null)"))


def rendezvous(key: Column, weights: list[float]) -> Column:
    """The shard (0 to len(weights) - 1) of a key; weights are above zero."""
    if not weights or min(weights) <= 0:
        raise ValueError("weights must be above zero")
    scores = []
    for s, w in enumerate(weights):
        u = F.conv(F.substring(F.md5(F.concat(key_text(key), F.lit(f":{s}"))), 1, 12), 16, 10).cast("long")
        scores.append(F.struct((-F.log((u + F.lit(0.5)) / F.lit(2.0**48)) / F.lit(float(w))).alias("score"), F.lit(s).alias("s")))
    return F.array_min(F.array(*scores))["s"]


def slots(rows: DataFrame, shard: str, order_hash: str, order: list[str]) -> DataFrame:
    """``rows`` with ``slot``: 0, 1, ... within each shard, by order_hash (hex), then order.

    ``rows`` should be thin: equal rows are counted first, the counts are
    written once to the checkpoint folder, and equal rows are told apart
    only when the slots are dealt.
    """
    groups = rows.groupBy(*rows.columns).agg(F.count("*").alias("__n"))
    groups = cut(groups)
    shards = max(1, groups.select(shard).distinct().count())
    digits = max(1, min(8, math.ceil(math.log(max(16, groups.count() / (shards * ROWS_PER_BUCKET)), 16))))
    groups = groups.withColumn("__prefix", F.substring(order_hash, 1, digits))
    starts = groups.groupBy(shard, "__prefix").agg(F.sum("__n").alias("__all"))
    upto = W.partitionBy(shard).orderBy("__prefix").rowsBetween(W.unboundedPreceding, -1)
    starts = starts.select(F.col(shard).alias("__shard"), F.col("__prefix").alias("__p"), F.coalesce(F.sum("__all").over(upto), F.lit(0)).alias("__start"))
    inside = W.partitionBy(shard, "__prefix").orderBy(order_hash, *order, *(c for c in rows.columns if c not in order)).rowsBetween(W.unboundedPreceding, -1)
    placed = groups.withColumn("__inner", F.coalesce(F.sum("__n").over(inside), F.lit(0)))
    placed = placed.join(starts, (F.col(shard) == F.col("__shard")) & (F.col("__prefix") == F.col("__p")))
    first = F.col("__start") + F.col("__inner")
    return placed.select(*rows.columns, F.explode(F.sequence(first, first + F.col("__n") - 1)).alias("slot"))


def shard(docs: DataFrame, weights: list[float], key: str = "doc_id", text: str = "text") -> DataFrame:
    """Thin rows: key, size (UTF-8 bytes + 1), text_crc32, shard, grown_shard, slot."""
    body = F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary")
    thin = docs.select(
        F.col(key),
        (F.octet_length(body).cast("long") + 1).alias("size"),
        F.crc32(body).alias("text_crc32"),
        rendezvous(F.col(key), weights).alias("shard"),
        rendezvous(F.col(key), [*weights, sum(weights) / len(weights)]).alias("grown_shard"),
        F.md5(key_text(F.col(key))).alias("key_hash"),
    )
    return slots(thin, "shard", "key_hash", [key, "text_crc32"]).drop("key_hash")
