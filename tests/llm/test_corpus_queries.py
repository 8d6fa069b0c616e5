"""The registered queries on the given tables: oracle SQL, brute force, held-out accuracy; the pipeline."""

import collections
import os
import re
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from test_corpus_small import bag, brute_counts, brute_join, brute_removed, make_rows

import corpus_pipeline as P
from lakestrata.llm import decontaminate, quality_pu
from lakestrata.llm.base import table
from lakestrata.llm.queries import ORACLES, QUERIES

SF, SF_LABELS = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
TABLES = "documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF, t + '.parquet')}')")
    return c


@pytest.fixture(scope="module")
def texts(spark):
    return [(r["doc_id"], r["text"], r["lang"], r["source"]) for r in table(spark, SF, "documents").collect()]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, con, name):
    df = QUERIES[name](spark, SF)
    res = con.execute(ORACLES[name])
    columns = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(columns)
    assert bag(df.select(columns).collect()) == bag(res.fetchall())


def test_op1_counts(spark, texts):
    out = QUERIES["op1_quality_rules"](spark, SF).collect()
    got = {r["doc_id"]: tuple(r)[1:6] for r in out}
    assert got == {i: brute_counts(t) for i, t, *_ in texts} and len(out) == len(texts)
    assert all(r["base_failed"] == (r["n_words"] < 20 or 100 * r["n_repeat_words"] > 30 * r["n_words"]) for r in out)
    assert all(not (r["kept"] and r["base_failed"]) for r in out)


def test_op2_held_out_accuracy(spark):
    out = QUERIES["op2_language_id"](spark, SF_LABELS).join(table(spark, SF_LABELS, "documents"), "doc_id").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in out)
    held = [r for r in out if r["held_out"]]
    assert sum(r["lang_pred"] == r["lang"] for r in held) >= 0.98 * len(held) > 100


def test_op3_finds_whole_items(spark, texts):
    words = lambda t: re.findall(r"[a-z0-9\x80-\U0010ffff]+", (t or "").lower())
    items = [(r["item_id"], " " + " ".join(words(r["text"])) + " ") for r in table(spark, SF, "benchmark").collect()]
    whole = {(i, k) for i, t, *_ in texts for k, q in items if q.strip() and q in " " + " ".join(words(t)) + " "}
    got = {(r["doc_id"], r["item_id"]) for r in QUERIES["op3_decontamination"](spark, SF).collect()}
    assert whole and whole <= got and len(got - whole) <= 1


def test_op5_removed(spark, texts):
    got = bag(QUERIES["op5_suffix_dedup"](spark, SF).collect())
    assert got == bag((t[0], *x) for t, x in zip(texts, brute_removed([t[1] for t in texts], 200), strict=True))


def test_op6_held_out_accuracy(spark):
    out = QUERIES["op6_quality_classifier"](spark, SF_LABELS)
    held = out.where("held_out").join(table(spark, SF_LABELS, "labels"), "doc_id").collect()
    good = [r["predicted"] for r in held if r["quality"] == 1]
    bad = [r["predicted"] for r in held if r["quality"] == 0]
    assert sum(good) >= 0.97 * len(good) and sum(bad) <= 0.3 * len(bad)


def test_op7_targets(spark):
    out = QUERIES["op7_mixing"](spark, SF).join(table(spark, SF, "documents").select("doc_id", "source"), "doc_id").collect()
    took = collections.Counter()
    for r in out:
        assert r["taken"] <= 2 * r["size"]
        took[r["source"]] += r["taken"]
    goal = {r["source"]: r["target"] for r in out}
    assert all(abs(took[s] - goal[s]) <= max(20, 0.01 * goal[s]) for s in goal)


def awkward(spark):
    schema = T.StructType([
        T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
        T.StructField("size", T.LongType()), T.StructField("__n", T.StringType()), T.StructField("n_words", T.StringType()), T.StructField("shard", T.StringType()),
    ])
    rows = [(i, t, lang, s, n, "n", None, "x") for i, t, lang, s, n, *_ in make_rows()]
    return rows, spark.createDataFrame(rows, schema)


@pytest.mark.parametrize("k", range(len(P.STAGES)))
def test_stages_take_awkward_rows(spark, k):
    """Nulls, repeated rows and clashing names; all but the last stage return the columns of documents."""
    rows, docs = awkward(spark)
    out = P.STAGES[k][1](spark, docs, SF)
    empty = P.STAGES[k][1](spark, docs.limit(0), SF)
    assert empty.count() == 0
    if k < len(P.STAGES) - 1:
        assert out.columns == docs.columns and empty.columns == docs.columns
        assert set(map(tuple, out.collect())) <= set(rows)
    else:
        assert out.count() == len(rows)


def test_near_copies_stage(spark):
    """One row of each group stays, the least id; texts without words all stay."""
    rows, docs = awkward(spark)
    got = bag(P.join_copies(spark, docs, SF).collect())
    groups = collections.defaultdict(list)
    unique = list(dict.fromkeys(rows))
    for r, (_, n, component) in zip(unique, brute_join(list(enumerate(r[1] for r in unique)), 5, 80), strict=True):
        if n:
            groups[component].append(r)
    for g in groups.values():
        stays = [r for r in g if got[r]]
        assert len(stays) == 1 and got[stays[0]] == 1
        assert any(r[0] is None for r in g) or stays[0][0] == min(r[0] for r in g)
    assert sum(got.values()) == len(groups) + sum(1 for r in rows if brute_counts(r[1])[0] == 0)


def test_pipeline_against_its_parts(spark, texts):
    """run() on the given tables: each document's shard rows follow from the stages' verdicts."""
    docs = table(spark, SF, "documents")
    out = P.run(spark, SF).collect()
    feats = quality_pu.features(docs)
    model = quality_pu.fit(feats.where(P.fold(5) != 0), table(spark, SF, "labels"))
    good = {r["doc_id"] for r in feats.where(quality_pu.score(model) >= P.PREDICTED_FROM).collect()}
    rows = sorted(r for r in texts if r[0] in good)
    stay = {c for _, n, c in brute_join(rows, 5, 80) if n} | {i for i, n, _ in brute_join(rows, 5, 80) if not n}
    leaks = {r["doc_id"] for r in decontaminate.matches(docs, table(spark, SF, "benchmark")).collect()}
    times = collections.Counter(r["doc_id"] for r in out)
    assert set(times) <= stay - leaks and max(times.values()) <= 2
    words = {i: brute_counts(t)[0] for i, t, *_ in rows}
    left = [(i, s) for i, _, _, s in rows if i in stay - leaks]
    per = collections.Counter()
    for i, s in left:
        per[s] += words[i]
    names = sorted(per)
    goal = P.mixing.targets([per[s] for s in names], [(3, 1, 2)[k % 3] for k in range(len(names))], 1.5, 2)
    took = sum(words[i] * n for i, n in times.items())
    assert abs(took - sum(goal)) <= 0.25 * sum(goal)
    whole = [s for s, g in zip(names, goal) if g >= 2 * per[s]]
    assert all(times[i] == 2 for i, s in left if s in whole and words[i])
    text = {i: t for i, t, *_ in texts}
    assert all(r["text_crc32"] == zlib.crc32((text[r["doc_id"]] or "").encode()) for r in out)
    for s in {r["shard"] for r in out}:
        assert sorted(r["slot"] for r in out if r["shard"] == s) == list(range(sum(r["shard"] == s for r in out)))


def test_rows_with_clashing_names_pass_the_queries_operators(spark):
    rows, docs = awkward(spark)
    assert decontaminate.decontaminate(docs, table(spark, SF, "benchmark")).columns == docs.columns
    assert docs.where(F.col("doc_id").isNull()).count() == 1
