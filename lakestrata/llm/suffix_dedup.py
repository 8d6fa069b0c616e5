"""Suffix-array deduplication of byte strings that occur more than once.

Every byte covered by a string of ``span`` bytes that also starts anywhere
else (any text, same text included) is removed.  No task sees the corpus:

1.  A window of ``span`` bytes is filed under its least 32-byte gram (by hash
    order), so equal windows are filed together.  Neighbouring windows with
    the same gram form one segment, about 1 % of the bytes in number.  Grams
    frequent in a sample come last in the order, so that a passage shared by
    many texts does not gather their borders in one group; the order has no
    effect on the result.
2.  Only segments whose gram occurs twice (in two segments, or in one) are kept.  Equal segments need no
    sorting: all their windows repeat.  Of each other group the distinct
    segments are fetched and sorted.
    A group of more than GROUP_BYTES is filed again, by the next gram in the
    order that its windows hold, and so on: borders leave the group, and what
    is left of its segments becomes equal.  What is still too large after
    LEVELS rounds (text of a short period) is counted window by window.
3.  The suffixes of a group's segments are put in order by two-stage
    sorting: those smaller than their successors are sorted directly, the
    others are induced by bucket scans; windows whose neighbour in the suffix
    array has ``span`` or more common first bytes repeat.

Texts are told apart by a 64-bit hash; equal texts are one text that repeats
as a whole.  Null text: empty.  Texts shorter than ``span`` keep all bytes.
Long texts go piece by piece, repeated rows are judged each by itself, empty
tables give empty results, and other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import base
from .base import WordHasher, cut, mix, stored, utf8

SPAN, GRAM = 200, 32
#: Documents read to find frequent grams; a gram is frequent in SAMPLE_SHARE of them.
SAMPLE, SAMPLE_SHARE = 1_000, 0.01
#: Bytes that a task sorts at once (a batch of whole groups), and of the largest group that is sorted.
BATCH_BYTES = GROUP_BYTES = 512 << 10
LEVELS = 6
FETCH_BYTES = 4 << 20
BROADCAST_KEYS = 300_000
#: Bytes of text whose grams a task holds at once.
LONGEST = 256 << 10
DEMOTED = np.uint64(1 << 63)
NOTHING = np.uint64((1 << 64) - 1)


def row_chunks(off: np.ndarray):
    return base.row_chunks(off, LONGEST)


class Grams:
    """Order values of the grams of a byte string; frequent grams get the top bit."""

    def __init__(self, frequent: np.ndarray):
        self.frequent = frequent
        self.seen = np.zeros(1 << 16, bool)
        self.seen[(frequent & np.uint64(0xFFFF)).astype(np.int64)] = True
        self.hasher = WordHasher()

    def __call__(self, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(order value of each gram, prefix sums for hashes of longer strings)."""
        self.hasher.grow(len(raw) + 1)
        sums = np.zeros(len(raw) + 1, np.uint64)
        with np.errstate(over="ignore"):
            np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * self.hasher.power[: len(raw)], out=sums[1:])
            value = mix((sums[GRAM:] - sums[:-GRAM]) * self.hasher.inverse[: max(0, len(raw) - GRAM + 1)]) & ~DEMOTED
        maybe = np.flatnonzero(self.seen[(value & np.uint64(0xFFFF)).astype(np.int64)])
        if len(maybe) and len(self.frequent):
            at = np.minimum(np.searchsorted(self.frequent, value[maybe]), len(self.frequent) - 1)
            value[maybe[self.frequent[at] == value[maybe]]] |= DEMOTED
        return value, sums


def sliding_least(v: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` values, from block-wise minima of both directions."""
    n = len(v) - width + 1
    if n <= 0:
        return np.zeros(0, v.dtype)
    blocks = -(-len(v) // width)
    full = np.full(blocks * width, np.iinfo(v.dtype).max, v.dtype)
    full[: len(v)] = v
    full = full.reshape(blocks, width)
    ahead = np.minimum.accumulate(full, axis=1).reshape(-1)
    back = np.minimum.accumulate(full[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(back[:n], ahead[width - 1 : width - 1 + n])


def pieces(size: int, width: int):
    """Parts of a text that hold each window of ``width`` bytes in exactly one of them."""
    for a in range(0, size - width + 1, LONGEST):
        yield a, min(size, a + LONGEST + width - 1)


def segments(raw: np.ndarray, off: np.ndarray, grams: Grams, span: int, above: np.ndarray | None = None):
    """(gram, hash of the bytes, row, start, windows, whether the gram occurs in it twice) of each segment.

    ``above``: for each row, the grams up to this one do not count (a window
    without any other is filed under NOTHING).
    """
    none = np.zeros(0, np.int64)
    if len(raw) < span:
        return none.view(np.uint64), none.view(np.uint64), none, none, none, none.astype(bool)
    value, sums = grams(raw)
    if above is not None:
        of = np.repeat(above, np.diff(off))[: len(value)]
        value = np.where(value <= of, NOTHING, value)
    least = sliding_least(value, span - GRAM + 1)
    row = np.searchsorted(off, np.arange(len(least)), "right") - 1 if len(off) > 2 else np.zeros(len(least), np.int64)
    valid = np.arange(span, span + len(least)) <= off[row + 1]
    new = np.ones(len(least), bool)
    new[1:] = (least[1:] != least[:-1]) | (row[1:] != row[:-1]) | ~valid[:-1]
    at = np.flatnonzero(new & valid)
    stop = np.flatnonzero(np.append(new[1:], True) | ~np.append(valid[1:], False))
    end = stop[np.searchsorted(stop, at)] + span  # bytes up to the last window's end
    with np.errstate(over="ignore"):
        whole = mix((sums[end] - sums[at]) * grams.hasher.inverse[at] + (end - at).astype(np.uint64))
    grams.hasher.rehash_long(raw, at, end, whole)
    # places of grams that are the least of some window around them, and how many a segment has of its own
    width = span - GRAM + 1
    around = np.concatenate([np.zeros(width - 1, np.uint64), least, np.zeros(width - 1, np.uint64)])
    place = np.flatnonzero(value == ~sliding_least(~around, width))
    kinds, kind = np.unique(value[place], return_inverse=True)
    listed = np.sort(kind * (len(raw) + 1) + place)
    own = np.searchsorted(kinds, least[at]) * (len(raw) + 1)
    many = np.searchsorted(listed, own + end - GRAM, "right") - np.searchsorted(listed, own + at, "left") > 1
    return least[at], whole, row[at], at - off[row[at]], end - at - span + 1, many


def frequent_grams(texts: DataFrame, rows: int) -> np.ndarray:
    """Grams in SAMPLE_SHARE of the sampled texts, each text once: a balance of load only."""
    some = texts.where(F.pmod("key", F.lit(max(1, rows // SAMPLE))) == 0).dropDuplicates(["key"])

    def run(batches):
        grams = Grams(np.zeros(0, np.uint64))
        for b in batches:
            data, off = utf8(b.column(1))
            for i in range(b.num_rows):
                for a, z in pieces(int(off[i + 1] - off[i]), GRAM):
                    found = np.unique(grams(data[off[i] + a : off[i] + z])[0])
                    yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64))], ["gram"])

    found = some.mapInArrow(run, "gram long").groupBy("gram").count()
    least = max(8, int(SAMPLE_SHARE * min(rows, SAMPLE)))
    return np.sort(found.where(F.col("count") >= least).select("gram").toPandas()["gram"].to_numpy(np.int64).view(np.uint64))


def sort_suffixes(text: np.ndarray, end: np.ndarray, packed: np.ndarray, depth: int) -> np.ndarray:
    """Suffix array of strings laid end to end, in order to ``depth`` symbols.

    ``text``: symbols 1 to 256, a 0 after every string; ``end``: of each
    position's string; ``packed``: the next seven symbols of each position.
    """
    n = len(text)
    # runs of one symbol share their type; a suffix is small if the next different symbol is larger
    change = np.flatnonzero(np.concatenate([[True], text[1:] != text[:-1]]))
    small_run = np.append(text[change[1:]] > text[change[:-1]], False)
    small = np.repeat(small_run, np.diff(np.append(change, n))) & (text > 0)

    # stage 1: sort the small suffixes directly, seven symbols a round, only where still tied
    rank = np.unique(packed, return_inverse=True)[1] + 1  # 0: beyond the string's end
    pos = np.flatnonzero(small)
    order = pos[np.argsort(rank[pos])]
    tied = np.zeros(len(order), bool)
    if len(order):
        same = rank[order][1:] == rank[order][:-1]
        group = np.concatenate([[0], np.cumsum(~same)])
        tied[1:] |= same
        tied[:-1] |= same
    for d in range(7, depth, 7):
        at = np.flatnonzero(tied)
        if not len(at):
            break
        next_ = order[at] + d
        key = np.where(next_ >= end[order[at]], 0, rank[np.minimum(next_, n - 1)]) + group[at] * (n + 2)
        by = np.argsort(key)
        order[at] = order[at][by]
        key = key[by]
        same = (key[1:] == key[:-1]) & (key[1:] % (n + 2) > 0)
        tied[:] = False
        tied[at[1:]] |= same
        tied[at[:-1]] |= same
        fresh = np.concatenate([[True], ~same])
        group[at] = at[np.flatnonzero(fresh)][np.cumsum(fresh) - 1]

    # stage 2: scan the buckets in order; the predecessor of a suffix, if not small, goes to the end of its bucket's front
    edges = np.searchsorted(text[order], np.arange(258)) if len(order) else np.zeros(258, np.int64)
    fronts: list[list[np.ndarray]] = [[] for _ in range(257)]
    out: list[np.ndarray] = []

    def induce(scanned: np.ndarray, c: int) -> np.ndarray:
        before = scanned[scanned > 0] - 1
        before = before[(text[before] > 0) & ~small[before]]
        if not len(before):
            return before
        symbol = text[before]
        by = np.argsort(symbol, kind="stable")
        before, symbol = before[by], symbol[by]
        cuts = np.flatnonzero(np.concatenate([[True], symbol[1:] != symbol[:-1]]))
        again = before[:0]
        for a, z in zip(cuts, [*cuts[1:], len(symbol)], strict=True):
            if symbol[a] == c:
                again = before[a:z]
            else:
                fronts[symbol[a]].append(before[a:z])
        return again

    ends = np.flatnonzero(text == 0)
    induce(ends, 0)
    for c in range(1, 257):
        wave = np.concatenate(fronts[c]) if fronts[c] else ends[:0]
        while len(wave):
            out.append(wave)
            wave = induce(wave, c)
        direct = order[edges[c] : edges[c + 1]]
        if len(direct):
            out.append(direct)
            induce(direct, c)
    return np.concatenate(out) if out else ends[:0]


def _packed(text: np.ndarray) -> np.ndarray:
    """Seven symbols from each position in one number, nothing after a string's end."""
    padded = np.concatenate([text, np.zeros(7, text.dtype)]).astype(np.uint64)
    out = np.zeros(len(text), np.uint64)
    open_ = np.ones(len(text), bool)
    for k in range(7):
        s = padded[k : k + len(text)]
        open_ &= s > 0
        out = (out << np.uint64(9)) | np.where(open_, s, np.uint64(0))
    return out


def repeated_windows(strings: list[bytes], span: int) -> list[np.ndarray]:
    """For each string, which of its windows of ``span`` bytes occur again in the list."""
    data = np.frombuffer(b"".join(strings), np.uint8)
    size = np.array([len(s) for s in strings])
    text = np.zeros(len(data) + len(strings), np.int16)
    starts = np.concatenate([[0], np.cumsum(size + 1)])[:-1]
    text[np.arange(len(data)) + np.repeat(np.arange(len(strings)), size)] = data.astype(np.int16) + 1
    packed, end = _packed(text), np.repeat(starts + size, size + 1)
    order = sort_suffixes(text, end, packed, span)
    # adjacent common prefixes of span symbols or more
    left = end[order] - order >= span
    pair = np.flatnonzero(left[1:] & left[:-1])
    for d in [*range(0, span - 6, 7), span - 7]:
        pair = pair[packed[order[pair] + d] == packed[order[pair + 1] + d]]
    hit = np.zeros(len(text), bool)
    hit[order[pair]] = hit[order[pair + 1]] = True
    return [hit[a : a + max(0, n - span + 1)] for a, n in zip(starts.tolist(), size.tolist(), strict=True)]


def _runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.diff(np.concatenate([[0], mask.astype(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def _segment_rows(texts: DataFrame, frequent, span: int) -> DataFrame:
    """(gram, least, hash, key, start, n windows, many); the copies of a text that a task has seen are left out.

    ``gram`` names the group, ``least`` is its place in the order of grams.
    """

    def run(batches):
        grams, seen = Grams(frequent.value), set()
        for b in batches:
            data, off = utf8(b.column(1))
            keys = b.column(0).to_numpy()
            for lo, hi in row_chunks(off):
                if len(seen) > 500_000:
                    seen = set()
                new = np.array([k not in seen and not seen.add(k) for k in keys[lo:hi].tolist()])
                # one long text goes piece by piece
                parts = [(0, int(off[hi] - off[lo]))] if hi - lo > 1 else pieces(int(off[hi] - off[lo]), span)
                for a, z in parts:
                    raw = data[off[lo] + a : off[lo] + z]
                    g, h, row, start, n, many = segments(raw, off[lo : hi + 1] - off[lo] if hi - lo > 1 else np.array([0, len(raw)]), grams, span)
                    keep = new[row]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in (g[keep].view(np.int64), h[keep].view(np.int64), keys[lo:hi][row[keep]], start[keep] + a, n[keep], many[keep])], ["gram", "hash", "key", "start", "n", "many"])

    found = texts.mapInArrow(run, "gram long, hash long, key long, start long, n long, many boolean")
    return found.withColumn("least", F.col("gram"))


def _filed_again(parts: DataFrame, frequent, span: int) -> DataFrame:
    """Rows as of ``_segment_rows`` of fetched segments, by the next gram of each window."""

    def run(batches):
        grams = Grams(frequent.value)
        for b in batches:
            data, off = utf8(b.column("bytes"))
            group, above, keys, begin = (b.column(c).to_numpy() for c in ("gram", "least", "key", "start"))
            for lo, hi in row_chunks(off):
                raw, at = data[off[lo] : off[hi]], off[lo : hi + 1] - off[lo]
                g, h, row, start, n, many = segments(raw, at, grams, span, above[lo:hi].view(np.uint64))
                with np.errstate(over="ignore"):
                    name = mix(group[lo:hi][row].view(np.uint64) * np.uint64(0xD1342543DE82EF95) + g) | DEMOTED  # counted by joins: it may be large
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in (name.view(np.int64), h.view(np.int64), keys[lo:hi][row], start + begin[lo:hi][row], n, many | (g == NOTHING), g.view(np.int64))], ["gram", "hash", "key", "start", "n", "many", "least"])

    return parts.mapInArrow(run, "gram long, hash long, key long, start long, n long, many boolean, least long")


def _counted(parts: DataFrame, span: int) -> DataFrame:
    """(key, start, end) of windows of fetched segments that occur twice, counted by hash: for what no filing splits."""

    def run(batches):
        hasher = WordHasher()
        for b in batches:
            data, off = utf8(b.column("bytes"))
            for i, (gram, key, start) in enumerate(zip(*(b.column(c).to_pylist() for c in ("gram", "key", "start")), strict=True)):
                for a, z in pieces(int(off[i + 1] - off[i]), span):
                    raw = data[off[i] + a : off[i] + z]
                    first = np.arange(len(raw) - span + 1)
                    h = hasher(raw, first, first + span).view(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(h), gram)), pa.array(h), pa.array(np.full(len(h), key)), pa.array(first + (start + a))], ["gram", "hash", "key", "start"])

    windows = stored(parts.mapInArrow(run, "gram long, hash long, key long, start long"))
    twice = windows.groupBy("gram", "hash").agg(F.count("*").alias("n")).where("n > 1").drop("n")
    return windows.join(twice, ["gram", "hash"]).select("key", "start", (F.col("start") + span).alias("end"))


def _repeating(rows: DataFrame) -> DataFrame:
    """Rows of grams that occur twice (in one segment: ``many``), with ``same`` (rows of an equal segment) and ``all`` (rows of the gram).

    Grams known to be frequent (below zero) are counted and joined, so that
    Spark may split them; the others are dealt out once.
    """
    cold = rows.where("gram >= 0")
    cold = cold.withColumns({"same": F.count("*").over(W.partitionBy("gram", "hash")), "all": F.count("*").over(W.partitionBy("gram"))}).where("`all` > 1 OR many")
    hot = rows.where("gram < 0")
    equal = hot.groupBy("gram", "hash").agg(F.count("*").alias("same"), F.max("many").alias("__many"))
    every = equal.groupBy("gram").agg(F.sum("same").alias("all"), F.max("__many").alias("__any")).where("`all` > 1 OR __any")
    hot = hot.join(equal.join(every, "gram"), ["gram", "hash"]).select(*rows.columns, "same", "all")
    return cold.unionByName(hot)


def texts_of(texts: DataFrame, wanted: DataFrame, each: DataFrame) -> DataFrame:
    """One text for each key of ``each``, which has a row for each key in ``wanted``."""
    keys = wanted.select(F.col("key").alias("__k"))
    some = texts.join(F.broadcast(keys) if keys.count() <= BROADCAST_KEYS else keys, F.col("key") == F.col("__k"), "left_semi")
    return some.join(each, "key")


def _fetch(rows: DataFrame, span: int) -> DataFrame:
    """The bytes of wanted segments: (gram, least, single, key, start, bytes)."""

    def run(batches):
        seen: set[int] = set()
        for b in batches:
            data, off = utf8(b.column(1))
            out: list[list] = [[] for _ in NAMES]
            held = 0
            for i, (key, segs) in enumerate(zip(b.column(0).to_pylist(), b.column(2), strict=True)):
                if key in seen:
                    continue
                seen.add(key)
                raw = data[off[i] : off[i + 1]]
                for s in segs.as_py():
                    part = raw[s["start"] : s["start"] + s["n"] + span - 1].tobytes()
                    for c, v in zip(out, (s["gram"], s["least"], s["single"], key, s["start"], part), strict=True):
                        c.append(v)
                    held += len(part)
                    if held > FETCH_BYTES:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, KINDS, strict=True)], NAMES)
                        out, held = [[] for _ in NAMES], 0
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, KINDS, strict=True)], NAMES)

    NAMES = ["gram", "least", "single", "key", "start", "bytes"]
    KINDS = [pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.binary()]
    return rows.mapInArrow(run, "gram long, least long, single boolean, key long, start long, bytes binary")


def _fetched(texts: DataFrame, wanted: DataFrame, span: int) -> DataFrame:
    each = cut(wanted.groupBy("key").agg(F.collect_list(F.struct("gram", "least", "single", "start", "n")).alias("segments")))
    return _fetch(texts_of(texts, each, each).select("key", "text", "segments"), span)


def _sorted_repeats(parts: DataFrame, span: int) -> DataFrame:
    """(key, start, end) of repeated bytes in segments that are equal to no other."""

    def solve(held):
        columns = [np.concatenate(c) for c in list(zip(*held, strict=True))[:3]]
        hits = repeated_windows([s for h in held for s in h[3]], span)
        out = []
        for single, key, start, hit in zip(*columns, hits, strict=True):
            if single:
                a, z = _runs(hit)
                out += [(key, start + x, start + y + span - 1) for x, y in zip(a.tolist(), z.tolist(), strict=True)]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], ["key", "start", "end"])

    def run(batches):
        held, size, last = [], 0, None
        for b in batches:
            group = b.column(0).to_numpy()
            begins = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]])) if len(group) else group
            for lo, hi in zip(begins.tolist(), [*begins[1:].tolist(), len(group)], strict=True):
                more = b.slice(lo, hi - lo)
                if group[lo] != last and size > BATCH_BYTES:  # groups stay whole; a batch holds several
                    yield from solve(held)
                    held, size = [], 0
                last = group[lo]
                single, key, start = (more.column(c).to_numpy(zero_copy_only=False) for c in (1, 2, 3))
                held.append((single, key, start, more.column(4).to_pylist()))
                size += sum(map(len, held[-1][3]))
        if held:
            yield from solve(held)

    dealt = parts.select("gram", "single", "key", "start", "bytes").repartition("gram").sortWithinPartitions("gram")
    return dealt.mapInArrow(run, "key long, start long, end long")


def _apply(rows: DataFrame) -> DataFrame:
    """(key, n_removed, n_spans, kept_sha256, kept) of texts with their repeated ranges."""

    def run(batches):
        for b in batches:
            data, off = utf8(b.column(1))
            out: list[list] = [[], [], [], [], []]
            for i, (key, ranges) in enumerate(zip(b.column(0).to_pylist(), b.column(2), strict=True)):
                raw = data[off[i] : off[i + 1]]
                depth = np.zeros(len(raw) + 1, np.int64)
                r = np.array([(x["start"], x["end"]) for x in ranges.as_py()])
                np.add.at(depth, r[:, 0], 1)
                np.add.at(depth, r[:, 1], -1)
                gone = np.cumsum(depth)[:-1] > 0
                kept = raw[~gone].tobytes()
                for c, v in zip(out, (key, int(gone.sum()), len(_runs(gone)[0]), hashlib.sha256(kept).hexdigest(), kept), strict=True):
                    c.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int64()), pa.array(out[3]), pa.array(out[4], pa.binary())], ["key", "n_removed", "n_spans", "kept_sha256", "kept"])

    return rows.mapInArrow(run, "key long, n_removed long, n_spans long, kept_sha256 string, kept binary")


def repeated_ranges(texts: DataFrame, rows: int, span: int) -> DataFrame:
    """(key, start, end) of bytes of each text that a repeated window covers; ranges may overlap."""
    frequent = texts.sparkSession.sparkContext.broadcast(frequent_grams(texts, rows))
    filed, out = _segment_rows(texts, frequent, span), None
    for level in range(LEVELS + 1):
        found = cut(_repeating(stored(filed)))
        equal = found.where("same > 1").select("key", "start", (F.col("start") + F.col("n") + (span - 1)).alias("end"))
        out = equal if out is None else out.unionByName(equal)
        # groups with different segments, and segments that may repeat in themselves: one of each, to be sorted
        mixed = found.where("same < `all` OR (same = 1 AND many)")
        one = mixed.groupBy("gram", "hash").agg(F.min(F.struct("key", "start", "n", "least")).alias("s"), F.max("same").alias("same"))
        one = cut(one.select("gram", "s.*", (F.col("same") == 1).alias("single")))
        large = one.groupBy("gram").agg(F.sum(F.col("n") + (span - 1)).alias("bytes")).where(F.col("bytes") > GROUP_BYTES).select("gram")
        large = cut(large)
        left = large.count()
        if not left:
            return out.unionByName(_sorted_repeats(_fetched(texts, one, span), span))
        out = out.unionByName(_sorted_repeats(_fetched(texts, one.join(large, "gram", "left_anti"), span), span))
        again = _fetched(texts, one.join(large, "gram", "left_semi"), span)
        if level == LEVELS:
            return out.unionByName(_counted(again, span))
        filed = _filed_again(again, frequent, span)
    return out


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", span: int = SPAN, keep_bytes: bool = False) -> DataFrame:
    """id_col, n_bytes, n_removed, n_spans, kept_sha256 of every row; with ``keep_bytes`` also the bytes kept."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    texts = docs.select(F.xxhash64(text).alias("key"), text.alias("text"))
    thin = cut(docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("key"), F.octet_length(text).cast("long").alias("n_bytes"), F.sha2(text, 256).alias("sha")))
    long_ = texts.where(F.octet_length("text") >= span)
    copies = thin.groupBy("key").agg(F.count("*").alias("copies"))
    ranges = repeated_ranges(long_, thin.count(), span)
    single = copies.where("copies = 1").select("key")
    each = ranges.groupBy("key").agg(F.collect_list(F.struct("start", "end")).alias("ranges")).join(single, "key", "left_semi")
    each = cut(each)
    changed = _apply(texts_of(long_, each, each).select("key", "text", "ranges"))
    changed = changed if keep_bytes else changed.drop("kept")
    out = thin.join(copies, "key").join(changed, "key", "left")
    whole = (F.col("copies") > 1) & (F.col("n_bytes") >= span)
    nothing = hashlib.sha256(b"").hexdigest()
    columns = [
        F.col("id").alias(id_col), "n_bytes",
        F.when(whole, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(whole, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(whole, F.lit(nothing)).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"),
    ]
    if keep_bytes:  # null: the text is kept as it is
        columns.append(F.when(whole, F.lit("").cast("binary")).otherwise(F.col("kept")).alias("kept"))
    return out.select(*columns)
