"""Quality rules with risk-controlled cutoffs.

``statistics`` measures every whole text; ``choose_cutoffs`` picks, for
each stratum and rule, the strictest cutoff whose false rejection of good
labelled documents is proven small; ``judge`` applies them.

The proof: candidate cutoffs of a rule are tested from the loosest to the
strictest.  A cutoff passes if, among n good holdout documents of which it
rejects k, the exact binomial probability P(Bin(n, a) <= k) is at most d,
where a is the share of false rejections allowed to one rule (``risk``
over the number of rules: the union bound over rules) and d is ``error``
over the number of (stratum, rule) pairs (Bonferroni).  The test of a rule
stops at its first failure (fixed sequence), so no further correction is
due for the number of cutoffs.  With probability 1 - ``error``, no stratum
loses more than ``risk`` of its good documents to the rules.  A stratum
with too few labels to prove anything keeps all its documents.

Null text: zero words, base_failed.  Null or unseen stratum value: its own
stratum, kept unless base_failed.  Repeated rows are judged each by itself;
empty tables give empty results.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import WordHasher, cut, lower_ascii, mix, row_chunks, utf8, windows, word_spans

SYMBOLS = b"#*$%&|<>"
STATS = [
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_upper", "n_adjacent", "n_marks",
]
#: Rules: a rate that grows with the fault, in thousandths of its base.
RULES = {
    "symbols": ("n_symbols", "word_chars"),
    "dup_lines": ("n_dup_lines", "n_lines"),
    "repeats": ("n_repeat_words", "n_words"),
    "upper": ("n_upper", "word_chars"),
    "adjacent": ("n_adjacent", "n_words"),
    "marks": ("n_marks", "n_words"),
}
#: Candidate cutoffs in thousandths, loosest first; a rate above its cutoff rejects.
CUTOFFS = [900, 700, 500, 400, 300, 250, 200, 150, 120, 100, 80, 60, 50, 40, 30, 25, 20, 15, 10, 5]
MAX_BROADCAST_STRATA = 10_000
#: Share of good documents that may be rejected in a stratum, and the chance that some stratum loses more.
RISK, ERROR = 0.03, 0.05


def _line_counts(text: str) -> tuple[int, int]:
    """Lines with a word, and those of them equal to an earlier line."""
    lines = [x for x in text.split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    return len(lines), len(lines) - len(set(lines))


def _measure(batch: pa.RecordBatch, hasher: WordHasher) -> list[np.ndarray]:
    texts = batch.column(batch.schema.get_field_index("text"))
    data, off = utf8(texts)
    out = np.zeros((len(STATS), batch.num_rows), np.int64)
    symbol = np.isin(np.arange(256), list(SYMBOLS))
    for lo, hi in row_chunks(off):
        raw, o = data[off[lo] : off[hi]], off[lo : hi + 1] - off[lo]
        n = hi - lo
        starts, ends, rows = word_spans(raw, o)
        out[0, lo:hi] = np.bincount(rows, minlength=n)
        chars = np.zeros(len(raw) + 1, np.int64)
        per_row = lambda mask: (np.cumsum(mask, out=chars[1:]), np.diff(chars[o]))[1]
        sep = (raw == 32) | ((raw >= 9) & (raw <= 13))
        out[1, lo:hi] = per_row(((raw & 0xC0) != 0x80) & ~sep)
        out[2, lo:hi] = per_row(symbol[raw])
        out[6, lo:hi] = per_row((raw >= 65) & (raw <= 90))
        out[8, lo:hi] = per_row(raw == 33)
        hashes = hasher(raw, starts, ends)
        folded = hasher(lower_ascii(raw), starts, ends)
        same = np.flatnonzero((folded[1:] == folded[:-1]) & (rows[1:] == rows[:-1])) if len(rows) else []
        out[7, lo:hi] = np.bincount(rows[1:][same], minlength=n) if len(same) else 0
        at, h = windows(hashes, rows, 8)
        if len(at):
            with np.errstate(over="ignore"):
                key = h + mix(rows[at].astype(np.uint64) + np.uint64(1))
            order = np.argsort(key, kind="stable")
            equal = np.flatnonzero(key[order][1:] == key[order][:-1])
            twice = np.zeros(len(at), bool)
            twice[order[equal]] = twice[order[equal + 1]] = True
            cover = np.zeros(len(rows) + 1, np.int64)
            np.add.at(cover, at[twice], 1)
            np.add.at(cover, at[twice] + 8, -1)
            out[4, lo:hi] = np.bincount(rows[np.cumsum(cover)[:-1] > 0], minlength=n)
    for i, text in enumerate(texts):
        if text.is_valid:
            out[5, i], out[3, i] = _line_counts(text.as_py())
    return list(out)


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum: Column | None = None) -> DataFrame:
    """doc_id, stratum and the counts of ``STATS`` for every row (``docs`` may have any other columns)."""
    stratum = F.lit("all") if stratum is None else stratum
    thin = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(stratum.cast("string"), F.lit("(null)")).alias("stratum"), F.col(text_col).cast("string").alias("text"))

    def run(batches):
        hasher = WordHasher()
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *map(pa.array, _measure(b, hasher))], ["doc_id", "stratum", *STATS])

    kind = thin.schema["doc_id"].dataType.simpleString()
    return thin.mapInArrow(run, f"doc_id {kind}, stratum string, " + ", ".join(f"{s} long" for s in STATS))


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def rate(rule: str) -> Column:
    top, base = RULES[rule]
    return F.coalesce(1000 * F.col(top) / F.nullif(F.col(base), F.lit(0)), F.lit(0.0))


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(Bin(n, p) <= k), summed exactly in logarithms."""
    if k >= n:
        return 1.0
    logs = [math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p) for i in range(k + 1)]
    top = max(logs)
    return min(1.0, math.exp(top) * math.fsum(math.exp(x - top) for x in logs))


def choose_cutoffs(holdout: DataFrame, risk: float = RISK, error: float = ERROR) -> DataFrame:
    """stratum and one cutoff column per rule (null: none is proven).

    ``holdout``: statistics of good labelled documents that pass the base
    rules.  A document is one trial, however often its rows repeat (by its
    greatest rates); without a column doc_id each row is one.  One row per (stratum, rule) reaches the test, whatever the
    input.
    """
    rules = list(RULES)
    rates = holdout.select("stratum", *(c for c in holdout.columns if c == "doc_id"), *(rate(r).alias(r) for r in rules))
    holdout = rates.groupBy("stratum", "doc_id").agg(*(F.max(r).alias(r) for r in rules)) if "doc_id" in rates.columns else rates
    # how many cutoffs a document's rate exceeds, counted per stratum and rule
    level = lambda r: F.size(F.filter(F.lit(CUTOFFS), lambda c: F.col(r) > c))
    each = F.explode(F.array(*(F.struct(F.lit(i).alias("rule"), level(r).alias("level")) for i, r in enumerate(rules))))
    counted = holdout.select("stratum", each.alias("e")).groupBy("stratum", "e.rule", "e.level").agg(F.count("*").alias("n"))
    strata = cut(counted.groupBy("stratum").agg(F.collect_list(F.struct("rule", "level", "n")).alias("cells")))
    tests = max(1, strata.count() * len(rules))
    share, bound = risk / len(rules), error / tests

    def decide(batches):
        for b in batches:
            chosen: list[list] = []
            for cells in b.column(1).to_pylist():
                table = np.zeros((len(rules), len(CUTOFFS) + 1), np.int64)
                for cell in cells:
                    table[cell["rule"], cell["level"]] = cell["n"]
                row = []
                for counts in table:
                    best = None
                    for i, c in enumerate(CUTOFFS):  # loosest first; a rate above cutoff i is above all later ones
                        if binomial_tail(int(counts[len(CUTOFFS) - i :].sum()), int(counts.sum()), share) > bound:
                            break
                        best = float(c)
                    row.append(best)
                chosen.append(row)
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array([r[i] for r in chosen], pa.float64()) for i in range(len(rules)))], ["stratum", *rules])

    return strata.mapInArrow(decide, "stratum string, " + ", ".join(f"{r} double" for r in rules))


def judge(stats: DataFrame, labels: DataFrame, risk: float = RISK, error: float = ERROR) -> DataFrame:
    """``stats`` with base_failed, failed_rules (array) and kept.

    ``labels``: doc_id, quality (1: good); a document labelled more than
    once counts as good only if all its labels say so.
    """
    good = labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min("quality").alias("__q")).where("__q = 1")
    stats = stats.withColumn("base_failed", base_failed())
    holdout = stats.where(~F.col("base_failed")).join(good, "doc_id", "left_semi")
    cutoffs = cut(choose_cutoffs(holdout, risk, error))
    chosen = cutoffs.select(F.col("stratum").alias("__s"), *(F.col(r).alias(f"__{r}") for r in RULES))
    chosen = F.broadcast(chosen) if cutoffs.count() <= MAX_BROADCAST_STRATA else chosen
    joined = stats.join(chosen, F.col("stratum") == F.col("__s"), "left")
    failed = F.array_compact(F.array(*(F.when(rate(r) > F.col(f"__{r}"), F.lit(r)) for r in RULES)))
    out = joined.withColumn("failed_rules", failed)
    return out.select(*stats.columns, "failed_rules", (~F.col("base_failed") & (F.size("failed_rules") == 0)).alias("kept"))
