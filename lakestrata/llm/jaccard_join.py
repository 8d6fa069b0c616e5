"""N-gram Jaccard self-join with adaptive multi-match prefixes.

A document's set is its distinct word shingles.  Equal sets are one node,
so copies are never paired.  The tokens of a set are put in one global
order, tokens seen often in the corpus last.  If two sets have a Jaccard
similarity of t or more, their prefixes of n - ceil(t * n) + l tokens share
at least l tokens, for any l.  Each node chooses its own l by estimated
candidate cost from the real posting sizes: a longer prefix costs postings,
but asks for l shared tokens and so saves verifications.  A pair needs as many
shared tokens as the smaller l of the two, and a shared token counts only
where sizes and positions still allow the overlap.

Dense groups: a first pass compares each node with the most central node of
its postings only; what these exact links join needs no further
comparison, so the full pass pairs nodes of different components alone.
That keeps links between all texts' components whole without pairing a
group's members with each other.

Null or empty texts have no shingle: linked with nothing.  Rows with the
same id but different texts are nodes of their own.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .base import WordHasher, cut, lower_ascii, mix, row_chunks, utf8, windows, word_spans
from .components import components

#: The table of frequent tokens has this many rows at most: a token is frequent from (shingles / this) rows on.
FREQUENT_TOKENS = 400_000
LEVELS = 4
SALTS = 32
SALT = np.uint64(0x5851F42D4C957F2D)
BROADCAST_IDS = 100_000


def shingle_sets(texts: pa.Array, width: int, hasher: WordHasher):
    """(lo, hi, offsets, tokens): the sorted distinct shingles of rows lo to hi, rows one after the other."""
    data, off = utf8(texts)
    for lo, hi in row_chunks(off):
        raw = lower_ascii(data[off[lo] : off[hi]])
        o = off[lo : hi + 1] - off[lo]
        starts, ends, rows = word_spans(raw, o)
        words = hasher(raw, starts, ends)
        n = np.bincount(rows, minlength=hi - lo)
        at, h = windows(words, rows, width)
        of = rows[at]
        for short in range(1, width):  # fewer words: the whole sequence as one
            pick = np.flatnonzero(n == short)
            if len(pick):
                first = np.searchsorted(rows, pick)
                s = np.full(len(pick), short, np.uint64)
                with np.errstate(over="ignore"):
                    for k in range(short):
                        s = mix(s * np.uint64(0x9E6C63D0676A9A99) + words[first + k])
                h, of = np.concatenate([h, s]), np.concatenate([of, pick])
        order = np.lexsort((h, of))
        h, of = h[order], of[order]
        keep = np.ones(len(h), bool)
        keep[1:] = (h[1:] != h[:-1]) | (of[1:] != of[:-1])
        h, of = h[keep], of[keep]
        yield lo, hi, np.concatenate([[0], np.cumsum(np.bincount(of, minlength=hi - lo))]), h


def node_ids(offsets: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    """64 bits for each set, by sums over its tokens."""
    with np.errstate(over="ignore"):
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(tokens + SALT), dtype=np.uint64)])
        return mix(sums[offsets[1:]] - sums[offsets[:-1]] + np.diff(offsets).astype(np.uint64)).view(np.int64)


def sets_of(docs: DataFrame, width: int) -> DataFrame:
    """id, n, node of every row; node null for empty sets."""

    def run(batches):
        hasher = WordHasher()
        for b in batches:
            for lo, hi, o, t in shingle_sets(b.column(1), width, hasher):
                n = np.diff(o)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo), pa.array(n), pa.array(node_ids(o, t), mask=n == 0)], ["id", "n", "node"])

    return docs.mapInArrow(run, f"id {docs.schema['id'].dataType.simpleString()}, n long, node long")


def frequent_tokens(docs: DataFrame, width: int, least: int) -> DataFrame:
    """(token, n) of tokens in ``least`` rows or more, as far as single tasks see them repeat."""

    def run(batches):
        hasher, held, size = WordHasher(), [], 0

        def flush():
            token, n = np.unique(np.concatenate(held), return_counts=True)
            keep = n >= 3
            return pa.RecordBatch.from_arrays([pa.array(token[keep].view(np.int64)), pa.array(n[keep])], ["token", "n"])

        for b in batches:
            for *_, t in shingle_sets(b.column(1), width, hasher):
                held.append(t)
                size += len(t)
                if size > 4_000_000:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    return docs.mapInArrow(run, "token long, n long").groupBy("token").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def postings(docs: DataFrame, width: int, percent: int, frequent) -> DataFrame:
    """(token, node, n, pos, salt) of the longest prefix a node may choose.

    pos counts from 0 in the global order; the salt splits the list of a
    frequent token and is 0 for the others.
    """

    def run(batches):
        hasher = WordHasher()
        hot, hot_n = frequent.value
        seen: set[int] = set()
        for b in batches:
            for _, _, o, t in shingle_sets(b.column(1), width, hasher):
                ids = node_ids(o, t)
                n = np.diff(o)
                if len(seen) > 500_000:
                    seen = set()
                new = np.zeros(len(n), bool)
                for i, key in enumerate(ids.tolist()):
                    if n[i] and key not in seen:
                        seen.add(key)
                        new[i] = True
                of = np.repeat(np.arange(len(n)), n)
                rank = np.zeros(len(t), np.int64)
                if len(hot):
                    at = np.minimum(np.searchsorted(hot, t), len(hot) - 1)
                    rank = np.where(hot[at] == t, hot_n[at], 0)
                order = np.lexsort((mix(t), rank, of))
                pos = np.arange(len(t)) - o[of]
                size = n[of]
                keep = np.flatnonzero(new[of] & (pos < size + percent * size // -100 + LEVELS))
                node = ids[of[keep]]
                salt = np.where(rank[order][keep] > 0, 1 + node % SALTS, 0)
                yield pa.RecordBatch.from_arrays([pa.array(t[order][keep].view(np.int64)), pa.array(node), pa.array(size[keep].astype(np.int32)), pa.array(pos[keep].astype(np.int32)), pa.array(salt.astype(np.int32))], ["token", "node", "n", "pos", "salt"])

    return docs.mapInArrow(run, "token long, node long, n int, pos int, salt int")


def verified(pairs: DataFrame, docs: DataFrame, sets: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (a, b) of nodes whose sets have the similarity, checked on the whole sets."""
    pairs = cut(pairs)
    wanted = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    ids = cut(sets.join(wanted, "node", "left_semi").groupBy("node").agg(F.min("id").alias("id")).select("id").distinct())
    known = ids.where(F.col("id").isNotNull()).withColumnRenamed("id", "__id")
    known = F.broadcast(known) if known.count() <= BROADCAST_IDS else known
    texts = docs.join(known, F.col("id") == F.col("__id"), "left_semi")
    if ids.where(F.col("id").isNull()).count():
        texts = texts.unionByName(docs.where(F.col("id").isNull()))

    def run(batches):
        hasher = WordHasher()
        for b in batches:
            for _, _, o, t in shingle_sets(b.column(1), width, hasher):
                rows = pa.ListArray.from_arrays(pa.array(o.astype(np.int32)), pa.array(t.view(np.int64)))
                yield pa.RecordBatch.from_arrays([pa.array(node_ids(o, t)), rows], ["node", "tokens"])

    full = texts.mapInArrow(run, "node long, tokens array<bigint>").join(wanted, "node", "left_semi").dropDuplicates(["node"])
    full = cut(full)
    left = pairs.join(full.select(F.col("node").alias("a"), F.col("tokens").alias("x")), "a")
    both = left.join(full.select(F.col("node").alias("b"), F.col("tokens").alias("y")), "b")
    shared = F.size(F.array_intersect("x", "y"))
    return both.where(100 * shared >= percent * (F.size("x") + F.size("y") - shared)).select("a", "b")


def possible(percent: int):
    """Sizes and positions of a token shared by x and y still allow the overlap.

    Of the tokens before it, only those (``r``) that some other prefix holds
    can be shared too: a token of x before it that y has lies in y's prefix.
    """
    need = F.ceil(percent * (F.col("x.n") + F.col("y.n")) / (100 + percent))
    after = F.least(F.col("x.n") - F.col("x.pos"), F.col("y.n") - F.col("y.pos"))
    return (100 * F.least("x.n", "y.n") >= percent * F.greatest("x.n", "y.n")) & (after + F.least("x.r", "y.r") >= need)


def shared_postings(docs: DataFrame, width: int, percent: int, frequent) -> DataFrame:
    """Postings of tokens that two nodes or more hold: c nodes, the most central one (hub), and r."""
    posted = postings(docs, width, percent, frequent).repartition("token", "salt").dropDuplicates(["token", "salt", "node"])
    middle = F.struct(-F.col("pos"), F.col("node"), F.col("n"))
    group = W.partitionBy("token", "salt")
    posted = posted.withColumns({"c": F.count("*").over(group), "m": F.max(middle).over(group)})
    # lists of frequent tokens were split: their totals have a row per frequent token at most
    split = posted.where("salt > 0").groupBy("token").agg(F.count("*").alias("hc"), F.max(middle).alias("hm"))
    split = F.broadcast(split.withColumnRenamed("token", "ht"))
    whole = posted.join(split, (F.col("salt") > 0) & (F.col("token") == F.col("ht")), "left")
    whole = whole.select("token", "node", "n", "pos", F.coalesce("hc", "c").alias("c"), F.coalesce("hm", "m").alias("m")).where("c > 1")
    before = W.partitionBy("node").orderBy("pos").rowsBetween(W.unboundedPreceding, -1)
    of_node = W.partitionBy("node")
    base = F.col("n") + F.expr(f"cast(floor(-{percent} * n / 100) as int)")
    cost = lambda k: F.sum(F.when(F.col("pos") < base + k, F.col("c") - 1).otherwise(0)).over(of_node)
    whole = whole.withColumns({"r": F.count("*").over(before).cast("int"), **{f"k{k}": cost(k) for k in range(1, LEVELS + 1)}})
    # each node's l: postings to read, and candidates left to verify
    full = lambda k: F.col(f"k{k}") + F.col(f"k{k}") * F.col("n") / (20.0 * k * k)
    choice = F.array_min(F.array(*(F.struct(full(k).alias("cost"), F.lit(k).alias("k")) for k in range(1, LEVELS + 1))))["k"]
    level = F.least(choice, F.ceil(percent * F.col("n") / 100).cast("int"))
    chosen = whole.withColumn("l", level).where(F.col("pos") < base + F.col("l"))
    return chosen.select("token", "node", "n", "pos", "r", "l", F.col("m.node").alias("hub"), F.col("m.n").alias("hub_n"))


def links(docs: DataFrame, sets: DataFrame, width: int, percent: int) -> DataFrame:
    """Links (a, b) between nodes that join the same components as all links of the similarity."""
    total = sets.agg(F.sum("n")).first()[0] or 0
    hot = frequent_tokens(docs, width, max(8, math.ceil(total / FREQUENT_TOKENS))).toPandas()
    token, n = hot["token"].to_numpy(np.int64).view(np.uint64), hot["n"].to_numpy(np.int64)
    order = np.argsort(token)
    frequent = docs.sparkSession.sparkContext.broadcast((token[order], n[order]))
    shared = cut(shared_postings(docs, width, percent, frequent))

    hubs = shared.where((F.col("node") != F.col("hub")) & (100 * F.least("n", "hub_n") >= percent * F.greatest("n", "hub_n")))
    first = hubs.groupBy("node", "hub").agg(F.count("*").alias("k"), F.max("l").alias("l")).where("k >= l")
    star = cut(verified(first.select(F.col("node").alias("a"), F.col("hub").alias("b")), docs, sets, width, percent))
    joined = components(star, "a", "b")

    rows = shared.join(joined, "node", "left").select("token", "node", "n", "pos", "r", "l", F.coalesce("root", "node").alias("root"))
    several = rows.groupBy("token").agg(F.min("root").alias("r0"), F.max("root").alias("r1")).where("r0 != r1").select("token")
    rows = cut(rows.join(several, "token", "left_semi"))
    pairs = rows.alias("x").join(rows.alias("y"), (F.col("x.token") == F.col("y.token")) & (F.col("x.node") < F.col("y.node")) & (F.col("x.root") != F.col("y.root")) & possible(percent))
    pairs = pairs.groupBy(F.col("x.node").alias("a"), F.col("y.node").alias("b")).agg(F.count("*").alias("k"), F.min(F.least("x.l", "y.l")).alias("l"))
    rest = verified(pairs.where("k >= l").select("a", "b"), docs, sets, width, percent)
    return star.unionByName(rest)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """id_col, n_shingles, component_id of every row.

    component_id: the least id among the rows that links reach from this row,
    itself included; equal sets are linked.
    """
    thin = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    sets = cut(sets_of(thin, width))
    found = components(links(thin, sets, width, percent), "a", "b")
    nodes = sets.where("node is not null").groupBy("node").agg(F.min("id").alias("least"))
    named = nodes.join(found, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    of_node = named.join(least, "root").select("node", "component_id")
    out = sets.join(of_node, "node", "left")
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("component_id", "id").alias("component_id"))
