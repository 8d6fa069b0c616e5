"""Language identification: multinomial naive Bayes over hashed character n-grams.

``fit`` counts n-grams of every learning text in tasks, sums them per
(language, bucket) in Spark and keeps one log-probability matrix, whose
size depends on the number of languages and buckets only; ``predict``
broadcasts it and scores batches with numpy.

Texts are lower-cased, every run of other characters than letters becomes
one space.  Null text, or one without a letter: ``und`` with score 0.
Rows with a null language are not learned from.  Ties: the language first in
code-point order.  If nothing can be learned, every prediction is ``und``.
Very long texts are read in pieces; repeated rows count as often as they
occur in learning and are predicted each by itself; empty tables give empty
results; other columns, whatever their names, are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import mix, row_chunks, utf8

BUCKETS = 1 << 14
SIZES = (2, 3)
#: The matrix has this many rows at most (64 MB as float32); more labels are an error, not cut.
MAX_LANGUAGES = 1024
#: Counts kept in a task before they are handed on.
FLUSH_LANGUAGES = 256
CHUNK_CHARS = 1 << 18


@dataclass
class Model:
    languages: list[str]
    log_prior: np.ndarray  # (languages,)
    log_prob: np.ndarray  # (languages, BUCKETS)


def letter_table() -> np.ndarray:
    return np.frombuffer(bytes(chr(i).isalpha() for i in range(0x110000)), bool)


def ngram_buckets(text: str, letters: np.ndarray, buckets: int):
    """Arrays of n-gram buckets of a text, piece by piece so that memory stays bounded."""
    tail = np.zeros(0, np.uint32)
    for k in range(0, len(text), CHUNK_CHARS):
        c = np.frombuffer(text[k : k + CHUNK_CHARS].lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        c = np.where(letters[c], c, np.uint32(32))
        c = np.concatenate([tail if k else np.array([32], np.uint32), c])
        keep = np.ones(len(c), bool)
        keep[1:] = (c[1:] != 32) | (c[:-1] != 32)
        c = c[keep]
        last = k + CHUNK_CHARS >= len(text)
        if last and len(c) and c[-1] != 32:
            c = np.append(c, np.uint32(32))
        done = len(tail)  # n-grams inside the tail were counted before
        c64 = c.astype(np.uint64)
        found = []
        for n in SIZES:
            first = max(0, done - n + 1)
            m = len(c) - n + 1
            if m <= first:
                continue
            with np.errstate(over="ignore"):
                h = np.full(m - first, n, np.uint64)
                for j in range(n):
                    h = h * np.uint64(0x100000001B3) + c64[first + j : m + j]
                found.append((mix(h) % np.uint64(buckets)).astype(np.int64))
        if found:
            yield np.concatenate(found)
        tail = c[-(max(SIZES) - 1) :]


def has_letter(text: str, letters: np.ndarray) -> bool:
    return any(letters[np.frombuffer(text[k : k + CHUNK_CHARS].encode("utf-32-le", "surrogatepass"), np.uint32)].any() for k in range(0, len(text), CHUNK_CHARS))


def fit(learn: DataFrame, buckets: int = BUCKETS, smoothing: float = 0.5) -> Model:
    """Learn from (text, lang); both columns only."""
    rows = learn.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))

    def count(batches):
        letters, sums, n_docs = letter_table(), {}, {}

        def flush():
            for lang, s in sums.items():
                at = np.flatnonzero(s)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * (len(at) + 1)), pa.array(np.append(at, -1)), pa.array(np.append(s[at], n_docs[lang]))], ["lang", "bucket", "n"])
            sums.clear()
            n_docs.clear()

        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                if lang not in sums:
                    if len(sums) >= FLUSH_LANGUAGES:
                        yield from flush()
                    sums[lang], n_docs[lang] = np.zeros(buckets, np.int64), 0
                n_docs[lang] += 1
                for g in ngram_buckets(text.as_py(), letters, buckets):
                    sums[lang] += np.bincount(g, minlength=buckets)
        yield from flush()

    counts = rows.mapInArrow(count, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    packed = counts.groupBy("lang").agg(F.collect_list(F.struct("bucket", "n")).alias("c"))  # at most buckets + 1 per language
    got = packed.limit(MAX_LANGUAGES + 1).collect()
    if len(got) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} language labels")
    got.sort(key=lambda r: r["lang"])
    table = np.zeros((len(got), buckets), np.float64)
    docs = np.ones(len(got))
    for i, r in enumerate(got):
        for bucket, n in r["c"]:
            if bucket < 0:
                docs[i] = n
            else:
                table[i, bucket] = n
    table += smoothing
    log_prob = np.log(table / table.sum(axis=1, keepdims=True)).astype(np.float32)
    return Model([r["lang"] for r in got], np.log(docs / docs.sum()), log_prob)


def predict(docs: DataFrame, model: Model, id_cols: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """id_cols, lang_pred, score (posterior probability) of every row; reads text only."""
    shared = docs.sparkSession.sparkContext.broadcast((model.languages, model.log_prior, model.log_prob))
    thin = docs.select(*id_cols, F.col("text").cast("string").alias("__text"))
    kinds = ", ".join(f"`{c}` {thin.schema[c].dataType.simpleString()}" for c in id_cols)

    def score(batches):
        (languages, log_prior, log_prob), letters = shared.value, letter_table()
        by_bucket = np.ascontiguousarray(log_prob.T)
        buckets = by_bucket.shape[0]
        for b in batches:
            preds, scores = [], []
            for t in b.column(b.num_columns - 1):
                text = t.as_py() or ""
                if not languages or not has_letter(text, letters):
                    preds.append("und")
                    scores.append(0.0)
                    continue
                total = log_prior.astype(np.float64).copy()
                for g in ngram_buckets(text, letters, buckets):
                    if len(languages) <= 8 and len(g) < buckets:
                        total += by_bucket[g].sum(axis=0, dtype=np.float64)
                    else:
                        total += np.bincount(g, minlength=buckets) @ by_bucket
                best = int(np.argmax(total))
                preds.append(languages[best])
                scores.append(float(1 / np.exp(total - total[best]).sum()))
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(preds, pa.string()), pa.array(scores, pa.float64())], [*id_cols, "lang_pred", "score"])

    return thin.mapInArrow(score, f"{kinds}, lang_pred string, score double")
