"""The trie of conversations' common prefixes, by a van Emde Boas recursion.

A node is a distinct sequence of first turns.  Nothing walks the trie turn by
turn: sequences are cut at half their depth, the halves again, and all cuts of
one level are made at once, so the number of steps grows with the logarithm
of the greatest depth.

1.  ``names``.  Turns are named in blocks of 1, 2, 4, ... turns.  From the
    largest blocks down, the prefixes that end at a level's cuts are named
    from the prefix above the cut and the block below it; upper and lower
    halves then go on in parallel.  A name is 128 bits of a SHA-256.
2.  Equal names at one depth are one node, known from here on by its
    smallest member and its depth.
3.  ``graft``.  Totals of subtrees are first those of each node; level by
    level, the totals of the lower trees are added to the cut node above them
    and to its ancestors in the upper tree, as far as that tree goes.  A node of one
    member has one leaf and nothing to save: only shared nodes take part.

Rows are thin (id, depth, name) and keyed by (id, depth), which is unique,
so one conversation may hold a third of all turns; nodes with many members are
counted map-side first.  Only the lookup of a shared node's smallest member joins
on names, of which one may be frequent: adaptive execution splits that join.

Turns without a conversation id belong to none and are left out.  Null role or
text: empty.  Equal turn numbers: by the SHA-256 of role and text; a null
turn comes first; repeated rows are turns of their own.  Empty tables give no node.
Other columns, whatever their names, are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import stored

GROUP, HEADS = 100, 5
#: Members' ids are joined in chunks of so many consecutive ids.
CHUNK_BITS = 12


def _digest(*parts: Column) -> Column:
    return F.unhex(F.substring(F.sha2(F.concat(*parts), 256), 1, 32))


def turns(rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, pos, name, size): each turn's place from 1, its name and the code points of its text.

    Rows are dealt out by ranges of (id, turn), so a long conversation is
    spread over tasks; where it goes on in another task, the rows before are
    added.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    thin = rows.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("conv_id"), F.col(turn_col).alias("turn"),
        _digest(F.length(role).cast("string"), F.lit(":"), role, text).alias("name"), F.length(text).cast("long").alias("size"),
    )
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("name")]
    dealt = thin.repartitionByRange(*order, F.spark_partition_id()).sortWithinPartitions(*order)

    def number(batches):
        last, count = None, 0
        for b in batches:
            ids = b.column(0).to_numpy()
            if not len(ids):
                continue
            first = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
            place = np.arange(len(ids)) - np.repeat(first, np.diff(np.append(first, len(ids))))
            if ids[0] == last:
                place[: first[1] if len(first) > 1 else len(ids)] += count
            last, count = ids[-1], int(place[-1]) + 1
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(place + 1), b.column(1), b.column(2), b.column(3)], ["conv_id", "pos", "name", "size", "part"])

    numbered = dealt.select("conv_id", "name", "size", F.spark_partition_id().cast("long").alias("part"))
    numbered = stored(numbered.mapInArrow(number, "conv_id long, pos long, name binary, size long, part long"))
    # a task has rows before it for one conversation at most, the one it begins with
    held = numbered.groupBy("conv_id", "part").agg(F.max("pos").alias("n"))
    split = held.groupBy("conv_id").agg(F.collect_list(F.struct("part", "n")).alias("parts")).where(F.size("parts") > 1)
    upto = lambda p: F.aggregate(F.filter("parts", lambda q: q["part"] < p["part"]), F.lit(0).cast("long"), lambda a, q: a + q["n"])
    before = split.select("conv_id", F.explode(F.transform("parts", lambda p: F.struct(p["part"].alias("part"), upto(p).alias("before")))).alias("x")).select("conv_id", "x.*")
    placed = numbered.join(F.broadcast(before), ["conv_id", "part"], "left")
    return placed.select("conv_id", (F.col("pos") + F.coalesce("before", F.lit(0))).alias("pos"), "name", "size")


def rebuilt(own: DataFrame, group: int = GROUP, heads: int = HEADS) -> DataFrame:
    """(conv_id, depth, name, size, last) with each conversation's first turns taken from its group's first.

    Conversation c has a head of crc32(c) modulo (heads + 1) turns: those of
    conversation c - c % group, followed by its own turns after as many.
    Every conversation has a row of depth 0, without a turn.
    """
    if group < 1 or heads < 0:
        raise ValueError("group from 1, heads from 0")
    own = stored(own)
    base = lambda c: c - c % group
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % (heads + 1)
    first = own.where((F.col("pos") <= heads) & (F.col("conv_id") % group == 0))
    first = first.groupBy(F.col("conv_id").alias("base")).agg(F.array_sort(F.collect_list(F.struct("pos", "name", "size"))).alias("head"))
    whole = own.groupBy("conv_id").agg(F.max("pos").alias("n")).withColumns({"h": h, "base": base(F.col("conv_id"))})
    whole = whole.join(first, "base", "left").withColumn("head", F.slice(F.coalesce("head", F.array().cast("array<struct<pos:bigint,name:binary,size:bigint>>")), F.lit(1), F.col("h").cast("int")))
    whole = whole.withColumn("k", F.size("head").cast("long")).withColumn("total", F.col("k") + F.greatest(F.col("n") - F.col("h"), F.lit(0)))
    whole = stored(whole.select("conv_id", "h", "k", "total", "head"))
    start = whole.select("conv_id", F.lit(0).cast("long").alias("depth"), F.lit("").cast("binary").alias("name"), F.lit(0).cast("long").alias("size"), (F.col("total") == 0).alias("last"))
    shared = whole.select("conv_id", "total", F.explode("head").alias("x")).select("conv_id", F.col("x.pos").alias("depth"), "x.name", "x.size", (F.col("x.pos") == F.col("total")).alias("last"))
    rest = own.where(F.col("pos") > h).join(whole.select("conv_id", "h", "k", "total"), "conv_id").withColumn("depth", F.col("k") + F.col("pos") - F.col("h"))
    rest = rest.select("conv_id", "depth", "name", "size", (F.col("depth") == F.col("total")).alias("last"))
    return stored(start.unionByName(shared).unionByName(rest))


def names(rows: DataFrame) -> DataFrame:
    """(conv_id, depth, name): the name of each prefix; rows have consecutive depths from 0."""
    deepest = rows.agg(F.max("depth")).first()[0] or 0
    # blocks of 2^k turns: number j holds depths j 2^k + 1 to (j + 1) 2^k
    blocks = [rows.where("depth > 0").select("conv_id", (F.col("depth") - 1).alias("j"), "name")]
    while 2 << (len(blocks) - 1) <= deepest:
        odd = F.col("j") % 2 == 1
        pair = blocks[-1].groupBy("conv_id", F.shiftright("j", 1).alias("half")).agg(F.max(F.when(~odd, F.col("name"))).alias("a"), F.max(F.when(odd, F.col("name"))).alias("b"))
        blocks.append(stored(pair.where("b IS NOT NULL").select("conv_id", F.col("half").alias("j"), _digest("a", "b").alias("name"))))
    done = rows.where("depth = 0").select("conv_id", "depth", "name")
    for k in range(len(blocks) - 1, -1, -1):
        below = blocks[k].where("j % 2 = 0").select("conv_id", F.shiftleft("j", k).alias("depth"), F.col("name").alias("block"))
        named = below.join(done, ["conv_id", "depth"])
        deeper = F.when(F.col("depth") == 0, F.col("block")).otherwise(_digest("name", "block"))
        done = stored(done.unionByName(named.select("conv_id", (F.col("depth") + (1 << k)).alias("depth"), deeper.alias("name"))))
    return done


def graft(nodes: DataFrame, place: DataFrame) -> DataFrame:
    """(conv_id, depth, saved, leaves) summed over each node's subtree.

    ``nodes``: (conv_id, depth, parent, saved, leaves) of each node itself;
    ``place``: (conv_id, depth, node): the node a conversation is in.
    """
    total = stored(nodes)
    deepest = total.agg(F.max("depth")).first()[0] or 0
    k = 0
    while 1 << k <= deepest:
        k, half = k + 1, 1 << k
        # roots of the lower trees of this level, summed at the cut above them
        lower = total.where(F.col("depth") % (2 * half) == half)
        cut = lower.groupBy(F.col("parent").alias("conv_id"), (F.col("depth") - 1).alias("bottom")).agg(F.sum("saved").alias("saved"), F.sum("leaves").alias("leaves"))
        path = cut.withColumn("depth", F.explode(F.sequence(F.col("bottom") - (half - 1), F.col("bottom"))))
        added = path.join(place, ["conv_id", "depth"]).select(F.col("node").alias("conv_id"), "depth", F.lit(None).cast("long").alias("parent"), "saved", "leaves")
        total = stored(total.unionByName(added).groupBy("conv_id", "depth").agg(F.max("parent").alias("parent"), F.sum("saved").alias("saved"), F.sum("leaves").alias("leaves")))
    return total.select("conv_id", "depth", "saved", "leaves")


def _ends(members: DataFrame) -> DataFrame:
    """(depth, name, ends_sha256): ids that end at a node, ascending, joined by commas, hashed chunk after chunk."""
    chunk = members.groupBy("depth", "name", F.shiftright("conv_id", CHUNK_BITS).alias("chunk")).agg(F.array_sort(F.collect_list("conv_id")).alias("ids"))
    texts = chunk.select("depth", "name", "chunk", F.concat_ws(",", F.col("ids").cast("array<string>")).alias("text"))

    def run(batches):
        node, state = None, None
        for b in batches:
            out: list[list] = [[], [], []]

            def put(node, state, out=out):
                for c, v in zip(out, (*node, state.hexdigest()), strict=True):
                    c.append(v)

            for depth, name, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                if (depth, name) != node:
                    if node is not None:
                        put(node, state)
                    node, state = (depth, name), hashlib.sha256(text.encode())
                else:
                    state.update(b"," + text.encode())
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.binary()), pa.array(out[2])], ["depth", "name", "ends_sha256"])
        if node is not None:
            yield pa.RecordBatch.from_arrays([pa.array([node[0]], pa.int64()), pa.array([node[1]], pa.binary()), pa.array([state.hexdigest()])], ["depth", "name", "ends_sha256"])

    dealt = texts.repartition("depth", "name").sortWithinPartitions("depth", "name", "chunk").select("depth", "name", "text")
    return dealt.mapInArrow(run, "depth long, name binary, ends_sha256 string")


def trie(rows: DataFrame) -> DataFrame:
    """One row per node: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    named = stored(names(rows).join(rows.select("conv_id", "depth", "size", "last"), ["conv_id", "depth"]))
    nodes = stored(named.groupBy("depth", "name").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.max("size").alias("size")))
    shared = nodes.where("n_convs > 1").select("depth", "name", F.col("conv_id").alias("node"))
    place = stored(named.join(shared, ["depth", "name"]).select("conv_id", "depth", "node"))
    # the parent of a node that is not shared itself may be: of the same smallest member or of another
    above = place.select("conv_id", (F.col("depth") + 1).alias("depth"), F.col("node").alias("above"))
    parent = F.when(F.col("depth") > 0, F.coalesce("above", "conv_id"))
    nodes = stored(nodes.join(above, ["conv_id", "depth"], "left").withColumn("parent", parent).drop("above"))
    kids = nodes.where("depth > 0").groupBy(F.col("parent").alias("conv_id"), (F.col("depth") - 1).alias("depth"))
    kids = kids.agg(F.count("*").alias("n_children"), F.count(F.when(F.col("n_convs") == 1, 1)).alias("single"))
    nodes = stored(nodes.join(kids, ["conv_id", "depth"], "left").fillna(0, ["n_children", "single"]))
    own_leaves = F.when(F.col("n_children") == 0, 1).otherwise(F.col("single")).cast("long")
    start = nodes.where("n_convs > 1").select("conv_id", "depth", "parent", ((F.col("n_convs") - 1) * F.col("size")).alias("saved"), own_leaves.alias("leaves"))
    ends = _ends(named.where("last").select("depth", "name", "conv_id"))
    out = nodes.join(graft(start, place), ["conv_id", "depth"], "left").join(ends, ["depth", "name"], "left")
    return out.select(
        "conv_id", "depth", F.col("parent").alias("parent_conv_id"), "n_convs", "n_children",
        F.coalesce("leaves", F.lit(1)).cast("long").alias("n_leaves"), F.coalesce("saved", F.lit(0)).cast("long").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )
