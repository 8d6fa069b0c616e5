"""Quality classifier by positive-unlabelled learning.

Trusted positives are documents labelled good; every other learning text
is unlabelled web text, whatever its label.  The class prior is estimated
from the scores of a first classifier (the least ratio of unlabelled to
positive mass over score tails), then a logistic model minimises the
non-negative unbiased risk

    prior * E_pos[l(f, +)] + max(0, E_unl[l(f, -)] - prior * E_pos[l(f, -)]).

Features are rates of a text's surface (symbols, repeats, case, lines, word
lengths); scoring is an expression over them.  A bounded sample (about
``sample`` positives and as many unlabelled rows, chosen by a hash) only gives
the first weights and places the prior's cuts.  All rows count in the features'
means and deviations, in the tail masses of the prior and in the risk that is
minimised: from the first weights on, Newton steps use gradient and curvature
summed over all rows on Spark, shortened while the negative part of the risk
would fall below zero.  The sums are exact (in units of 2**-30), so the
weights do not depend on partitions.

Null or empty texts have zero features and get a score too.  Repeated rows
score alike.  Without positives every score is the prior 0.5.
"""

from __future__ import annotations

from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .base import WordHasher, cut, lower_ascii, mix, row_chunks, utf8, windows, word_spans

#: Counts of a text, as columns ``q_...``.
COUNTS = [f"q_{c}" for c in ("n_words", "n_chars", "n_symbols", "n_marks", "n_bars", "n_upper", "n_digits", "n_stops", "n_commas", "n_lines", "n_adjacent", "n_distinct", "n_repeats", "n_long", "n_short", "n_capital")]
SAMPLE = 20_000
#: Newton steps over all rows, halvings of each, and the unit of their sums.
STEPS, HALVINGS, UNIT = 8, 6, 2.0**30
DECAY = 1e-4
#: Shrinkage of the weights in the steps over all rows.
RIDGE = 1e-2


@dataclass
class Model:
    weights: list[float]
    bias: float
    mean: list[float]
    scale: list[float]
    prior: float


def _count(texts: pa.Array, hasher: WordHasher) -> np.ndarray:
    data, off = utf8(texts)
    out = np.zeros((len(COUNTS), len(off) - 1), np.int64)
    code = np.arange(256)
    kinds = {2: np.isin(code, list(b"#*$%&<>@^~")), 3: np.isin(code, list(b"!?")), 4: code == 124, 5: (code >= 65) & (code <= 90), 6: (code >= 48) & (code <= 57), 7: code == 46, 8: code == 44, 9: code == 10, 1: (code & 0xC0) != 0x80}
    for lo, hi in row_chunks(off):
        raw, o, n = data[off[lo] : off[hi]], off[lo : hi + 1] - off[lo], hi - lo
        for k, table in kinds.items():
            out[k, lo:hi] = np.diff(np.concatenate([[0], np.cumsum(table[raw])])[o])
        starts, ends, rows = word_spans(raw, o)
        if not len(rows):
            continue
        h = hasher(lower_ascii(raw), starts, ends)
        per = lambda mask: np.bincount(rows[mask], minlength=n)
        out[0, lo:hi] = np.bincount(rows, minlength=n)
        out[10, lo:hi] = np.bincount(rows[1:][(h[1:] == h[:-1]) & (rows[1:] == rows[:-1])], minlength=n)
        out[13, lo:hi], out[14, lo:hi] = per(ends - starts > 15), per(ends - starts < 4)
        out[15, lo:hi] = per((raw[starts] >= 65) & (raw[starts] <= 90))
        for k, width in ((11, 1), (12, 4)):
            at, w = windows(h, rows, width)
            with np.errstate(over="ignore"):
                key = np.sort(w + mix(rows[at].astype(np.uint64) + np.uint64(1)))
                order = np.argsort(w + mix(rows[at].astype(np.uint64) + np.uint64(1)))
            fresh = np.ones(len(key), bool)
            fresh[1:] = key[1:] != key[:-1]
            of = rows[at][order]
            out[k, lo:hi] = np.bincount(of[fresh if k == 11 else ~fresh], minlength=n)
    return out


def features(docs: DataFrame, carry: tuple[str, ...] = ("doc_id",), text_col: str = "text") -> DataFrame:
    """The ``carry`` columns and the counts of every row."""
    thin = docs.select(*carry, F.col(text_col).cast("string").alias("__text"))
    schema = T.StructType([*thin.schema.fields[:-1], *(T.StructField(c, T.LongType()) for c in COUNTS)])

    def run(batches):
        hasher = WordHasher()
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], *map(pa.array, _count(b.column(b.num_columns - 1), hasher))], [*carry, *COUNTS])

    return thin.mapInArrow(run, schema)


def inputs() -> list[Column]:
    """Model inputs: logarithms of rates, so that a fault in part of a text shows."""
    words, chars = F.greatest(F.col("q_n_words"), F.lit(1)), F.greatest(F.col("q_n_chars"), F.lit(1))
    log = lambda c, base: F.log1p(1000 * F.col(c) / base)
    return [
        F.log1p("q_n_words"), F.col("q_n_chars") / words, F.col("q_n_distinct") / words, F.col("q_n_short") / words,
        *(log(c, chars) for c in ("q_n_symbols", "q_n_marks", "q_n_bars", "q_n_upper", "q_n_digits")),
        *(log(c, words) for c in ("q_n_stops", "q_n_commas", "q_n_lines", "q_n_adjacent", "q_n_repeats", "q_n_long", "q_n_capital")),
    ]


def _risk_gradient(w: np.ndarray, p: np.ndarray, u: np.ndarray, prior: float) -> np.ndarray:
    sig = lambda z: 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    zp, zu = p @ w, u @ w
    good = prior * (p.T @ (sig(zp) - 1)) / len(p)
    minus_u, minus_p = np.logaddexp(0, zu).mean(), np.logaddexp(0, zp).mean()
    bad = (u.T @ sig(zu)) / len(u) - prior * (p.T @ sig(zp)) / len(p)
    # a negative part below zero is over-fitting: step back from it
    return good + bad if minus_u - prior * minus_p >= 0 else -bad


def _train(p: np.ndarray, u: np.ndarray, prior: float, steps: int = 1500, rate: float = 0.03, decay: float = DECAY) -> np.ndarray:
    w = np.zeros(p.shape[1])
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, steps + 1):
        g = _risk_gradient(w, p, u, prior) + decay * w
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w


def _standard(x: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    return np.concatenate([np.clip((x - mean) / scale, -8, 8), np.ones((len(x), 1))], axis=1)


def _scores(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return (x * w).sum(axis=1)  # row by row, so that equal rows score alike in any batch


def _tails(z: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Numbers of scores, of those from each cut up, and of those up to each cut."""
    z = np.sort(z)
    return np.concatenate([[len(z)], len(z) - np.searchsorted(z, cuts, "left"), np.searchsorted(z, cuts, "right")])


def tail_counts(rows: DataFrame, models: list[np.ndarray], cuts: list[np.ndarray], mean: np.ndarray, scale: np.ndarray, bounds: tuple[int, int]) -> np.ndarray:
    """models x (unlabelled, positive) x (rows, tails): over the ``rows`` (x, good, h) outside both samples' hash bounds."""
    size = 1 + 2 * len(cuts[0])

    def run(batches):
        out = np.zeros((len(models), 2, size), np.int64)
        for b in batches:
            if not b.num_rows:
                continue
            x = _standard(b.column(0).flatten().to_numpy().reshape(b.num_rows, -1), mean, scale)
            good, h = b.column(1).to_numpy(zero_copy_only=False).astype(bool), b.column(2).to_numpy()
            for k, w in enumerate(models):
                z = _scores(x, w)
                for part, of in enumerate((h >= bounds[0], good & (h >= bounds[1]))):
                    out[k, part] += _tails(z[of], cuts[k])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(out.size)), pa.array(out.ravel())], ["k", "n"])

    out = np.zeros(len(models) * 2 * size, np.int64)
    for r in rows.select("x", "good", "h").mapInArrow(run, "k long, n long").groupBy("k").agg(F.sum("n").alias("n")).collect():
        out[r["k"]] = r["n"]
    return out.reshape(len(models), 2, size)


def risk_sums(rows: DataFrame, w: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """(unlabelled, positives) x sums over all ``rows`` (x, good) at weights ``w``.

    Of each: rows, softplus of the score, inputs, probability times inputs,
    and curvature (probability times its complement times products of inputs).
    """
    k = len(w)
    size = 2 + 2 * k + k * k

    def run(batches):
        out = np.zeros((2, size), np.int64)
        for b in batches:
            if not b.num_rows:
                continue
            x = _standard(b.column(0).flatten().to_numpy().reshape(b.num_rows, -1), mean, scale)
            good = b.column(1).to_numpy(zero_copy_only=False).astype(bool)
            for lo in range(0, len(x), 2048):
                part = x[lo : lo + 2048]
                z = np.clip(_scores(part, w), -30, 30)
                sig = 1 / (1 + np.exp(-z))
                curve = (sig * (1 - sig))[:, None] * (part[:, :, None] * part[:, None, :]).reshape(len(part), -1)
                each = np.concatenate([np.ones((len(part), 1)), np.logaddexp(0, z)[:, None], part, sig[:, None] * part, curve], axis=1)
                units = np.rint(each * UNIT).astype(np.int64)  # a row's share does not depend on the rows beside it
                out[0] += units.sum(axis=0)
                out[1] += units[good[lo : lo + 2048]].sum(axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(out.size)), pa.array(out.ravel())], ["k", "n"])
            out[:] = 0

    summed = rows.select("x", "good").mapInArrow(run, "k long, n long").groupBy("k").agg(F.sum(F.col("n").cast("decimal(20,0)")).alias("n"))
    out = np.zeros(2 * size)
    for r in summed.collect():  # one row for each sum
        out[r["k"]] = float(Fraction(r["n"]) / int(UNIT))
    return out.reshape(2, size)


def refine(rows: DataFrame, w: np.ndarray, prior: float, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Newton steps of the risk over all rows, as long as its negative part stays above zero.

    There the risk is -prior * E_pos[f] + E_unl[softplus(f)], which is convex.
    """
    k = len(w)

    def negative(sums: np.ndarray) -> float:
        u, p = sums
        return u[1] / u[0] - prior * p[1] / p[0]

    def risk(sums: np.ndarray, at: np.ndarray) -> float:
        u, p = sums
        return float(u[1] / u[0] - prior * (p[2 : 2 + k] / p[0]) @ at + RIDGE / 2 * at @ at)

    sums = risk_sums(rows, w, mean, scale)
    for _ in range(HALVINGS):
        if negative(sums) >= 0:
            break
        w = w / 2  # at zero the negative part is positive
        sums = risk_sums(rows, w, mean, scale)
    if negative(sums) < 0:
        return w
    for _ in range(STEPS):
        u, p = sums
        slope = u[2 + k : 2 + 2 * k] / u[0] - prior * p[2 : 2 + k] / p[0] + RIDGE * w
        curve = u[2 + 2 * k :].reshape(k, k) / u[0] + RIDGE * np.eye(k)
        step = np.linalg.solve(curve, slope)
        for _ in range(HALVINGS):
            new = w - step
            there = risk_sums(rows, new, mean, scale)
            if negative(there) >= 0 and risk(there, new) <= risk(sums, w):
                break
            step = step / 2
        else:
            return w
        w, sums = new, there
        if np.abs(step).max() < 1e-4:
            break
    return w


def estimate_prior(counts: np.ndarray) -> float:
    """Share of positives among the unlabelled: P(A) * prior <= U(A) for every set A of scores.

    The least U(A) / P(A) over upper and lower tails.  Being a least value of
    noisy ratios it errs below, if at all: a prior above the true share would
    make the negative risk vanish before the negatives are told apart.
    """
    unl, pos = (c[1:] / max(1, c[0]) for c in counts)
    big = pos >= 0.3  # shares of smaller tails are too noisy
    best = min(1.0, float((unl[big] / pos[big]).min(initial=1.0)))
    return float(np.clip(best, 0.05, 0.99))


def moments(rows: DataFrame) -> tuple[int, int, np.ndarray, np.ndarray]:
    """Numbers of rows and of positives, mean and deviation of each input over all rows, by exact sums."""
    n_inputs = len(inputs())
    x = [F.col("x")[i].cast("decimal(18,6)") for i in range(n_inputs)]
    got = rows.agg(F.count("*"), F.count_if("good"), *map(F.sum, x), *(F.sum(c * c) for c in x)).first()
    n, n_good, sums = got[0], got[1], [Fraction(v or 0) for v in got[2:]]
    if not n:
        return 0, 0, np.zeros(n_inputs), np.zeros(n_inputs)
    mean = np.array([float(v / n) for v in sums[:n_inputs]])
    var = [float((n * q - v * v) / (n * n)) for v, q in zip(sums[:n_inputs], sums[n_inputs:], strict=True)]
    return n, n_good, mean, np.sqrt(np.maximum(var, 0))


def fit(feats: DataFrame, labels: DataFrame, id_col: str = "doc_id", sample: int = SAMPLE) -> Model:
    """Learn from ``feats`` (unlabelled) and the rows of them that ``labels`` marks good (quality 1)."""
    good = labels.where(F.col(id_col).isNotNull()).groupBy(id_col).agg(F.min("quality").alias("q")).where("q = 1")
    array = F.array(*(c.cast("double") for c in inputs())).alias("x")
    span = 1 << 31
    marked = feats.join(good.select(id_col, F.lit(True).alias("good")), id_col, "left")
    rows = cut(marked.select(array, F.coalesce("good", F.lit(False)).alias("good"), F.pmod(F.xxhash64(id_col, *COUNTS), F.lit(span)).alias("h")))
    n, n_good, mean, scale = moments(rows)
    scale = scale + 1e-6

    def below(count: int) -> int:
        return int(min(1.0, sample / max(1, count)) * span)

    def take(df: DataFrame, bound: int) -> tuple[np.ndarray, float]:
        """About ``sample`` rows, by a hash, and how many rows each stands for: what reaches the driver does not grow with the input."""
        some = df.where(F.col("h") < bound)
        x = np.array(sorted(r["x"] for r in some.select("x").limit(2 * sample).collect()), float).reshape(-1, len(inputs()))
        x = x[np.random.default_rng(0).permutation(len(x))]
        # the limit matters only if one row fills the table
        return _standard(x, mean, scale), some.count() / len(x) if len(x) == 2 * sample else 1.0

    bounds = below(n), below(n_good)
    (u, u_weight), (p, p_weight) = take(rows, bounds[0]), take(rows.where("good"), bounds[1])
    if not len(p) or not len(u):
        k = len(inputs())
        return Model([0.0] * k, 0.0, [0.0] * k, [1.0] * k, 0.5)
    prior = 0.5
    if len(p) > 3 and len(u) > 3:  # each half of the samples is judged by a classifier of the other, all other rows by both; the lower estimate is the safe one
        halves = [(np.arange(len(p)) % 2 == k, np.arange(len(u)) % 2 == k) for k in (0, 1)]
        models = [_train(p[a], u[b], 0.5, steps=500) for a, b in halves]
        cuts = [np.quantile(_scores(p[~a], w), np.linspace(0.02, 0.98, 49)) for (a, _), w in zip(halves, models, strict=True)]
        sampled = [[u_weight * _tails(_scores(u[~b], w), c), p_weight * _tails(_scores(p[~a], w), c)] for (a, b), w, c in zip(halves, models, cuts, strict=True)]
        others = tail_counts(rows, models, cuts, mean, scale, bounds) if min(bounds) < span else 0
        prior = min(map(estimate_prior, np.array(sampled) + others))
    w = refine(rows, _train(p, u, prior), prior, mean, scale)
    return Model(w[:-1].tolist(), float(w[-1]), mean.tolist(), scale.tolist(), prior)


def score(model: Model) -> Column:
    """The probability that a text is good, 0 to 1, over the columns of ``features``."""
    z = F.lit(model.bias)
    for c, w, m, s in zip(inputs(), model.weights, model.mean, model.scale, strict=True):
        z = z + F.least(F.greatest((c - F.lit(m)) / F.lit(s), F.lit(-8.0)), F.lit(8.0)) * F.lit(w)
    return 1 / (1 + F.exp(-F.greatest(F.least(z, F.lit(30.0)), F.lit(-30.0))))
