"""Benchmark decontamination: BM25 over the test items with block-max WAND, then overlap.

The index holds the benchmark; the training passages are the queries.  Items
are indexed by length class (up to 64 words, 128, 256, ...); a class's passages
are windows of twice its length, stepping by half, so every item that a
document quotes lies whole in some passage, and an item is judged alike
whatever else the benchmark holds.  Frequencies and the mean length are
counted over all items.  An item's impacts are scaled by its own full score, hence a passage scores 1 on
an item whose words it all has, and every item at ``threshold`` or above is
retrieved.  Retrieval is block-max WAND: items lie in blocks, a term keeps
its largest impact per block, and blocks whose bounds cannot reach the
threshold are skipped.  The bounds of all passages of a batch are taken at
once, and the cursors run only for passages that survive them.

A retrieved item is a match if the passage holds at least ``overlap`` of the
five-word shingles of its question and of its answer (the last sentence; of
a single sentence the last fifth of its words).  Parts of fewer than five
words count as one shingle.

Words: lower-cased runs of letters, with their marks, and digits; every other
code point separates, typographic quotes, dashes and spaces too.  Null or
empty texts and items match nothing, repeated rows are judged each by itself, and of
passages that match an item alike the first is returned.  Texts go piece by
piece of about a megabyte, or one longer row.  Benchmarks above MAX_INDEX_BYTES
are indexed in parts, one at a time, and all documents are queried against
each part; neither matches nor scores depend on the parts.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import WordHasher, cut, row_chunks, stored, utf8, whole_row, windows

BLOCK = 8
MAX_INDEX_BYTES = 16 << 20
K1, B = 1.2, 0.75
WIDTH = 5
LEAST_STEP = 64
#: Cells of (passage, block) whose bounds are held at once.
MAX_CELLS = 1 << 20
BROADCAST_KEYS = 300_000
#: Separators beyond ASCII, with the marks set on them; those of ASCII are told by their byte.
SEPARATORS = r"(?:[^\x00-\x7F\p{L}\p{M}\p{N}]\p{M}*)+"


@dataclass
class Index:
    ids: list  # item id of each position
    terms: np.ndarray  # sorted term hashes
    start: np.ndarray  # postings of a term: start[t] to start[t + 1]
    doc: np.ndarray
    impact: np.ndarray
    bstart: np.ndarray  # blocks of a term
    block: np.ndarray
    bmax: np.ndarray
    first: np.ndarray  # postings of a term's block: first[e] to first[e + 1]
    step: int
    question: list  # sorted distinct shingle hashes by shingle width
    answer: list


def tokens(texts: pa.Array):
    """(lo, hi, hashes, rows): lower-cased words of rows lo to hi."""
    data, off = utf8(pc.replace_substring_regex(pc.utf8_lower(texts), SEPARATORS, " "))
    code = np.arange(256)
    is_word = ((code >= 48) & (code <= 57)) | ((code >= 97) & (code <= 122)) | (code >= 128)
    hasher = WordHasher()
    for lo, hi in row_chunks(off):
        raw, o = data[off[lo] : off[hi]], off[lo : hi + 1] - off[lo]
        if not len(raw):
            yield lo, hi, np.zeros(0, np.uint64), np.zeros(0, np.int64)
            continue
        word = is_word[raw]
        edge = np.zeros(len(raw) + 1, bool)
        edge[o] = True
        starts = np.flatnonzero(word & (np.concatenate([[True], ~word[:-1]]) | edge[:-1]))
        ends = np.flatnonzero(word & (np.concatenate([~word[1:], [True]]) | edge[1:])) + 1
        yield lo, hi, hasher(raw, starts, ends), np.searchsorted(o, starts, "right") - 1


def shingles(hashes: np.ndarray) -> tuple[int, np.ndarray]:
    width = min(WIDTH, len(hashes))
    if not width:
        return 0, np.zeros(0, np.uint64)
    return width, np.unique(windows(hashes, np.zeros(len(hashes), np.int64), width)[1])


def split_item(text: str) -> tuple[str, str]:
    """Question and answer: the last sentence with a word answers the others."""
    parts = [p for p in re.split(r"(?<=[.!?])\s+|\n+", text) if re.search(r"\w", p)]
    if len(parts) > 1:
        return " ".join(parts[:-1]), parts[-1]
    words = text.split()
    k = max(1, len(words) - max(1, len(words) // 5))
    return " ".join(words[:k]), " ".join(words[k:])


def step_of(n_words: int) -> int:
    """The length class of an item: half the words of its passages."""
    return max(LEAST_STEP, 1 << (max(1, n_words) - 1).bit_length())


@dataclass
class Corpus:
    """What is counted over all items: their number, their mean words, and how many hold each term."""

    n: int
    mean: float
    df: dict[int, int]


def corpus_of(words: list[np.ndarray]) -> Corpus:
    held = [w for w in words if len(w)]
    df: dict[int, int] = {}
    for w in held:
        for t in set(w.tolist()):
            df[t] = df.get(t, 0) + 1
    return Corpus(len(held), sum(map(len, held)) / max(1, len(held)), df)


def build_classes(items: list[tuple[object, str]], corpus: Corpus | None = None) -> list[Index]:
    """An index for each length class of the items."""
    words = [h for *_, h in _each([t for _, t in items])]
    corpus = corpus or corpus_of(words)
    classes: dict[int, list[int]] = {}
    for k, w in enumerate(words):
        if len(w):
            classes.setdefault(step_of(len(w)), []).append(k)
    return [build([items[k] for k in ks], corpus, step) for step, ks in sorted(classes.items())]


def build(items: list[tuple[object, str]], corpus: Corpus | None = None, step: int | None = None) -> Index | None:
    """The index of some items, for passages of twice ``step`` words (default: the class of the longest)."""
    words = [h for *_, h in _each([t for _, t in items])]
    corpus = corpus or corpus_of(words)
    if not any(map(len, words)):
        return None
    df = corpus.df
    # blocks of like items give tight bounds: order by their commonest words, then length
    common = lambda w: sorted(set(w.tolist()), key=lambda t: (-df[t], t))[:2]
    text_of = dict(enumerate(t for _, t in items))
    order = sorted((k for k in range(len(items)) if len(words[k])), key=lambda k: (common(words[k]), len(words[k]), k))
    n, mean = corpus.n, corpus.mean
    rows = []
    for d, k in enumerate(order):
        term, tf = np.unique(words[k], return_counts=True)
        idf = np.array([math.log(1 + (n - df[t] + 0.5) / (df[t] + 0.5)) for t in term.tolist()])
        gain = idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(words[k]) / mean))
        rows += list(zip(term.tolist(), [d] * len(term), (gain / gain.sum()).tolist(), strict=True))
    rows.sort()
    term, doc, impact = np.array([r[0] for r in rows], np.uint64), np.array([r[1] for r in rows], np.int64), np.array([r[2] for r in rows])
    terms, start = np.unique(term, return_index=True)
    at = np.searchsorted(terms, term)
    key = at * (len(order) // BLOCK + 1) + doc // BLOCK
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    bterm, block = at[first], doc[first] // BLOCK
    parts = [split_item(text_of[k]) for k in order]
    found = [[shingles(h) for *_, h in _each([p[s] for p in parts])] for s in (0, 1)]
    return Index(
        [items[k][0] for k in order], terms, np.append(start, len(rows)), doc, impact,
        np.searchsorted(bterm, np.arange(len(terms) + 1)), block, np.maximum.reduceat(impact, first), np.append(first, len(rows)),
        step or step_of(max(len(words[k]) for k in order)), *found,
    )


def _each(texts: list[str]):
    """(row, hashes) of each text, in order."""
    for lo, hi, h, rows in tokens(pa.array(texts, pa.string())):
        at = np.searchsorted(rows, np.arange(hi - lo + 1))
        for k in range(hi - lo):
            yield lo + k, h[at[k] : at[k + 1]]


def wand(x: Index, terms: np.ndarray, threshold: float) -> list[tuple[int, float]]:
    """All items scoring ``threshold`` or more for a set of terms, by block-max WAND."""
    lists = []
    for t in terms.tolist():
        a, b = int(x.start[t]), int(x.start[t + 1])
        p, q = int(x.bstart[t]), int(x.bstart[t + 1])
        lists.append([x.doc[a:b].tolist(), x.impact[a:b].tolist(), 0, float(x.bmax[p:q].max()), dict(zip(x.block[p:q].tolist(), x.bmax[p:q].tolist(), strict=True))])
    out = []
    eps = 1e-9
    while lists:
        lists.sort(key=lambda c: c[0][c[2]])
        bound = pivot = 0.0
        for k, c in enumerate(lists):
            bound += c[3]
            if bound >= threshold - eps:
                pivot = c[0][c[2]]
                break
        else:
            break  # no item can reach the threshold any more
        while k + 1 < len(lists) and lists[k + 1][0][lists[k + 1][2]] == pivot:
            k += 1
        block = pivot // BLOCK
        if sum(c[4].get(block, 0.0) for c in lists[: k + 1]) < threshold - eps:
            upto = (block + 1) * BLOCK  # nothing in the rest of the block, up to the next cursor
            if k + 1 < len(lists):
                upto = min(upto, lists[k + 1][0][lists[k + 1][2]])
            upto = max(upto, pivot + 1)
            move = lists[: k + 1]
        elif lists[0][0][lists[0][2]] == pivot:
            score = sum(c[1][c[2]] for c in lists[: k + 1])
            if score >= threshold - eps:
                out.append((pivot, score))
            upto, move = pivot + 1, lists[: k + 1]
        else:
            upto, move = pivot, [c for c in lists[:k] if c[0][c[2]] < pivot]
        for c in move:
            while c[2] < len(c[0]) and c[0][c[2]] < upto:
                c[2] += 1
        lists = [c for c in lists if c[2] < len(c[0])]
    return out


def candidates(x: Index, known: np.ndarray, rows: np.ndarray, steps: np.ndarray, last: np.ndarray, threshold: float):
    """(row, step) of passages with an item at the threshold, for all passages of a batch at once.

    Bounds as the cursors would take them, each round for the survivors of
    the round before: the sum of the terms' largest impacts, the sums of
    their largest impacts in each block, the scores within a block.
    A passage is half ``step`` and the next; ``last``: the last half of each row.
    """
    n_terms, n_blocks = len(x.terms), int(x.block.max()) + 1
    span = int(last.max(initial=0)) + 1
    # a word lies in the passage of its half and in the one before; a last half alone is part of the one before
    own = (steps < last[rows]) | (steps == 0)
    before = steps > 0
    passage = np.concatenate([(rows * span + steps)[own], (rows * span + steps - 1)[before]])
    key = np.unique(passage * n_terms + np.concatenate([known[own], known[before]]))
    passage, term = key // n_terms, key % n_terms
    passages, at = np.unique(passage, return_inverse=True)
    top = np.maximum.reduceat(x.bmax, x.bstart[:-1])
    reach = threshold - 1e-6

    alive = np.bincount(at, weights=top[term], minlength=len(passages)) >= reach
    pick = alive[at]
    passages, at, term = passages[alive], (np.cumsum(alive) - 1)[at[pick]], term[pick]

    good = []
    width = max(1, MAX_CELLS // n_blocks)  # so many passages at a time: blocks times passages stay in memory
    for lo in range(0, len(passages), width):
        mine = slice(*np.searchsorted(at, [lo, lo + width]))
        n = min(width, len(passages) - lo)
        entry, of = spread(x.bstart[term[mine]], x.bstart[term[mine] + 1])
        cell = (at[mine] - lo)[of] * n_blocks + x.block[entry]
        alive = np.bincount(cell, weights=x.bmax[entry], minlength=n * n_blocks) >= reach
        pick = alive[cell]
        entry, cell = entry[pick], (np.cumsum(alive) - 1)[cell[pick]]
        cells = np.flatnonzero(alive)

        posting, of = spread(x.first[entry], x.first[entry + 1])
        score = np.bincount(cell[of] * BLOCK + x.doc[posting] % BLOCK, weights=x.impact[posting], minlength=len(cells) * BLOCK)
        good.append(passages[lo + np.unique(cells[np.flatnonzero(score >= reach) // BLOCK] // n_blocks)])
    good = np.concatenate(good) if good else passages
    return good // span, good % span


def spread(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers from each start up to its end, and which pair each is of."""
    count = end - start
    of = np.repeat(np.arange(len(count)), count)
    return np.arange(int(count.sum())) + (start - (np.cumsum(count) - count))[of], of


def matches(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", threshold: float = 0.6, overlap: float = 0.8) -> DataFrame:
    """id_col, item_id, passage (its first word), score, question_overlap, answer_overlap.

    One row for each row of ``docs`` and item that match, from the best passage.
    """
    spark = docs.sparkSession
    items = items.select(F.col(item_col).alias("item_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-size // MAX_INDEX_BYTES))
    thin = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind, item_kind = (f.schema[c].dataType.simpleString() for f, c in ((thin, "id"), (items, "item_id")))
    schema = f"`{id_col}` {kind}, item_id {item_kind}, passage long, score double, question_overlap double, answer_overlap double"
    counted = _counted(items) if parts > 1 else None
    out = spark.createDataFrame([], schema)
    for part in range(parts):
        mine = items.where(F.pmod(F.xxhash64("text"), F.lit(parts)) == part)
        rows = [(r["item_id"], r["text"]) for r in mine.orderBy("item_id", "text").collect()]  # about MAX_INDEX_BYTES
        indexes = build_classes(rows, _corpus_of_part(mine, *counted) if counted else None)
        if not indexes:
            continue
        found, shared = _query(thin, indexes, schema, threshold, overlap)
        if parts == 1:
            return found
        out = out.unionByName(stored(found))
        shared.unpersist()  # one part in memory at a time
    return out


def _counted(items: DataFrame) -> tuple[DataFrame, int, float]:
    """(how many items hold each term, number of items with a word, their mean words), counted on Spark."""

    def run(batches):
        for b in batches:
            for *_, h in _each(b.column(0).to_pylist()):
                if len(h):
                    term = np.unique(h).view(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(term), pa.array(np.append(np.zeros(len(term) - 1, np.int64), len(h)))], ["term", "words"])

    # one row of each item bears its number of words
    rows = stored(items.select("text").mapInArrow(run, "term long, words long"))
    n, words = rows.where("words > 0").agg(F.count("*"), F.sum("words")).first()
    return rows.groupBy("term").agg(F.count("*").alias("df")), n, (words or 0) / max(1, n)


def _corpus_of_part(mine: DataFrame, counts: DataFrame, n: int, mean: float) -> Corpus:
    """The counts over all items, of the terms that a part's items hold."""

    def run(batches):
        for b in batches:
            for *_, h in _each(b.column(0).to_pylist()):
                yield pa.RecordBatch.from_arrays([pa.array(np.unique(h).view(np.int64))], ["term"])

    terms = mine.select("text").mapInArrow(run, "term long").distinct()
    found = counts.join(terms, "term").toArrow()
    return Corpus(n, mean, dict(zip(found["term"].to_numpy().view(np.uint64).tolist(), found["df"].to_pylist(), strict=True)))


def _share(part: tuple[int, np.ndarray], own: dict[int, np.ndarray]) -> float:
    width, wanted = part
    return float(np.isin(wanted, own[width]).mean()) if width else 1.0


def _passage_matches(x: Index, h: np.ndarray, rows: np.ndarray, place: np.ndarray, threshold: float, overlap: float):
    """(row, position of the item, first word, score, overlaps): the best passage of each row and item that match."""
    at = np.minimum(np.searchsorted(x.terms, h), len(x.terms) - 1)
    hit = x.terms[at] == h
    if not hit.any():
        return
    first = np.searchsorted(rows, np.arange(int(rows[-1]) + 2))
    best: dict[tuple[int, int], tuple] = {}
    last = np.maximum(np.diff(first) - 1, 0) // x.step
    for row, step in zip(*map(np.ndarray.tolist, candidates(x, at[hit], rows[hit], place[hit] // x.step, last, threshold)), strict=True):
        a = int(first[row]) + step * x.step
        z = min(a + 2 * x.step, int(first[row + 1]))
        terms = np.unique(at[a:z][hit[a:z]])
        own: dict[int, np.ndarray] = {}
        for d, score in wand(x, terms, threshold):
            for w in {x.question[d][0], x.answer[d][0]} - own.keys():
                own[w] = windows(h[a:z], np.zeros(z - a, np.int64), w)[1] if w else np.zeros(0, np.uint64)
            q, r = _share(x.question[d], own), _share(x.answer[d], own)
            if q >= overlap and r >= overlap:
                key, new = (row, d), (min(q, r), round(score, 9), -step, q, r)
                best[key] = max(best.get(key, new), new)
    for (row, d), (_, score, s, q, r) in best.items():
        yield row, d, -s * x.step, score, q, r


def _query(thin: DataFrame, indexes: list[Index], schema: str, threshold: float, overlap: float):
    """The matches of all rows against some indexes, in one pass, and the broadcast they need."""
    shared = thin.sparkSession.sparkContext.broadcast([tuple(vars(x).values()) for x in indexes])
    names = [c.split()[0].strip("`") for c in schema.split(", ")]

    def run(batches):
        indexes = [Index(*x) for x in shared.value]
        for b in batches:
            found: list[tuple] = []
            for lo, _, h, rows in tokens(b.column(1)):
                if not len(h):
                    continue
                place = np.arange(len(rows)) - np.searchsorted(rows, rows)
                for x in indexes:
                    found += [(lo + row, x.ids[d], *rest) for row, d, *rest in _passage_matches(x, h, rows, place, threshold, overlap)]
            if found:
                rows_, ids, *rest = zip(*found, strict=True)
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(rows_)), pa.array(ids), *map(pa.array, rest)], names)

    return thin.mapInArrow(run, schema), shared


def decontaminate(docs: DataFrame, items: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """``docs`` without the rows whose text has a match."""
    keyed = docs.select(whole_row(docs), F.xxhash64(text_col).alias("__key"), F.col(text_col).alias("text"))
    bad = cut(matches(keyed, items, "__key", **options).select(F.col("__key").alias("__bad")).distinct())
    bad = F.broadcast(bad) if bad.count() <= BROADCAST_KEYS else bad
    return keyed.join(bad, F.col("__key") == F.col("__bad"), "left_anti").select("__row.*")
