"""Conversation trie, license scan and importance resampling against brute force on awkward rows."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakestrata.llm import conversation_trie, importance, license_rules, license_scan
from lakestrata.llm.importance import Settings
from lakestrata.llm.license_rules import Signature

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(t):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))


# ---------------------------------------------------------------- conversations

TURNS = "conv_id long, turn long, role string, text string, depth long, name string"


def brute_trie(rows, group=100, heads=5):
    own = collections.defaultdict(list)
    for c, turn, role, text, *_ in rows:
        if c is not None:
            role, text = role or "", text or ""
            own[c].append(((turn is not None, turn or 0), hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest(), role, text))
    own = {c: [x[2:] for x in sorted(v)] for c, v in own.items()}
    seqs = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % (heads + 1)
        seqs[c] = tuple(own.get(c - c % group, [])[:h] + own[c][h:])
    nodes = collections.defaultdict(list)
    for c, s in seqs.items():
        for d in range(len(s) + 1):
            nodes[s[:d]].append(c)
    out = []
    for p, members in nodes.items():
        kids = [q for q in nodes if len(q) == len(p) + 1 and q[:-1] == p]
        below = [q for q in nodes if q[: len(p)] == p]
        ends = ",".join(str(c) for c in sorted(c for c in members if len(seqs[c]) == len(p)))
        out.append((min(members), len(p), min(nodes[p[:-1]]) if p else None, len(members), len(kids),
                    sum(not any(len(r) > len(q) and r[: len(q)] == q for r in nodes) for q in below),
                    sum((len(nodes[q]) - 1) * len(q[-1][1]) for q in below if q), hashlib.sha256(ends.encode()).hexdigest()))
    return collections.Counter(out)


def run_trie(df, **kw):
    return collections.Counter(tuple(r) for r in conversation_trie.trie(conversation_trie.rebuilt(conversation_trie.turns(df), **kw)).collect())


def conversations():
    rng = random.Random(3)
    rows = []
    for c in [*range(0, 12), *range(100, 140), 305, 306, 7000, 7001]:  # 305's first conversation is absent
        same = c in (110, 111, 112, 113, 120)
        for t in range(6 if same else rng.randint(1, 9)):
            text = f"shared {t}" if same or rng.random() < 0.5 else rng.choice(["", "é🙂 ü", f"own {c} {t}"])
            rows.append((c, t, rng.choice(["user", None]) if not same else "user", text, 1, "x"))
    rows += [(102, None, "system", "comes first", 1, "x"), (103, 2, "user", "a tie", 1, "x"), (103, 2, "user", "a tie", 1, "x"), (104, 1, None, None, None, None), (None, 0, "user", "of none", 1, "x")]
    rows += [(400, t, "user", f"t{t}", 1, "x") for t in range(37)] + [(401, t, "user", f"t{t}", 1, "x") for t in range(37)] + [(402, t, "user", f"t{t}", 1, "x") for t in range(20)]
    rng.shuffle(rows)
    return rows


def test_trie_equals_brute_force(spark):
    rows = conversations()
    df = spark.createDataFrame(rows, TURNS).repartition(5)
    assert run_trie(df) == brute_trie(rows)
    assert run_trie(df, group=7, heads=2) == brute_trie(rows, 7, 2)


def test_trie_of_one_long_conversation(spark):
    """A conversation spread over several tasks keeps its order; chains of any depth."""
    rows = [(100, t, "user", f"text {t % 11}", 1, "x") for t in range(3_000)] + [(200, t, "user", f"text {t % 11}", 1, "x") for t in range(1_500)]
    df = spark.createDataFrame(rows, TURNS).repartition(4)
    numbered = conversation_trie.turns(df)
    assert numbered.where("conv_id = 100").agg(F.min("pos"), F.max("pos"), F.countDistinct("pos")).first()[:] == (1, 3_000, 3_000)
    out = {(r["conv_id"], r["depth"]): r for r in conversation_trie.trie(conversation_trie.rebuilt(numbered, heads=0)).collect()}
    assert len(out) == 3_001 and out[100, 1_500]["n_convs"] == 2 and out[100, 1_501]["n_convs"] == 1
    assert out[100, 0]["saved_tokens"] == sum(len(f"text {t % 11}") for t in range(1_500)) and out[100, 0]["n_leaves"] == 1
    assert out[100, 1_500]["ends_sha256"] == hashlib.sha256(b"200").hexdigest()


def test_trie_of_nothing(spark):
    assert not run_trie(spark.createDataFrame([], TURNS))
    alone = [(305, 0, "user", "x", 1, "x")]  # its head of turns is absent, its own first turns are cut
    assert run_trie(spark.createDataFrame(alone, TURNS)) == brute_trie(alone)


def test_ids_of_many_members_are_hashed_in_order(spark):
    rows = [(c, 0, "user", "hello", 1, "x") for c in range(10_000)]
    out = conversation_trie.trie(conversation_trie.rebuilt(conversation_trie.turns(spark.createDataFrame(rows, TURNS)), heads=0)).collect()
    end = next(r for r in out if r["depth"] == 1)
    assert len(out) == 2 and end["ends_sha256"] == hashlib.sha256(",".join(map(str, range(10_000))).encode()).hexdigest()


# ---------------------------------------------------------------- licenses

PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
RULES = [*license_rules.phrases(PHRASES), *license_rules.signatures()]
SAMPLES = {
    "Licensed under the Apache License, Version 2.0 (the \"License\")": "apache-2,apache-2.0",
    "released UNDER THE  mit-license.": "mit",
    "This work is licensed under the GNU General Public License, version 3.": "gpl-3.0",
    "GNU Lesser General Public License v2.1": "lgpl-2.1",
    "GNU Affero General Public License version 3": "agpl-3.0",
    "under the GNU General Public License version 2 of the License, or (at your option) any later version": "gpl-2.0-or-later",
    "SPDX-License-Identifier: BSD-3-Clause": "bsd-3-clause",
    "see https://www.apache.org/licenses/LICENSE-2.0 for it": "apache-2.0",
    "https://creativecommons.org/licenses/by-nc-sa/4.0/": "cc-by-nc-sa-4.0",
    "CC BY-NC 4.0": "cc-by-nc,cc-by-nc-4.0",
    "CC BY-SA": "cc-by-sa",
    "Creative Commons Attribution-NonCommercial 4.0": "cc-by-nc-4.0",
    "Creative Commons Attribution Non-Commercial 4.0 International": "cc-by-nc-4.0",
    "the 2-Clause BSD License": "bsd-2",
    "a BSD-style license": "bsd",
    "Mozilla Public License Version 2.0 and MPL 1.1": "mpl-1.1,mpl-2.0",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files": "mit",
    "placed in the public domain": "public-domain",
    "Copyright (c) 2019 Some Body. All rights reserved.": "all-rights-reserved",
    "dual: Eclipse Public License 2.0 / GPLv2": "epl-2.0,gpl-2.0",
    "émit license, permit licenses, simple examples of bsdfoo": "",
    "": "", "no words here!": "",
}


def brute_scan(text, rules):
    """Every rule on every text, positions by counting, suppression by all pairs."""
    w = words(text)
    padded = " " + "  ".join(w) + " "
    found = []
    for i, r in enumerate(rules):
        for m in re.finditer(r.regex(), padded):
            a = padded[: m.start()].count(" ") // 2
            found.append((a, a + m[0].count(" ") // 2, r.level, i, r.label, r.base))
            assert f" {r.keyword}" in " " + m[0].replace("  ", " "), "a match without its keyword"
    over = lambda f, b: b != f and b[0] <= f[0] and b[1] >= f[1] and b[2] <= f[2] and (b[2] < f[2] or b[:2] != f[:2] or b[3] < f[3])
    return len(w), sorted(f for f in found if f[5] or not any(over(f, b) for b in found))


def test_hundreds_of_rules_compile_and_are_filed():
    assert len(RULES) > 300 and len({r.keyword for r in RULES}) > 50
    assert all(re.compile(r.regex()) for r in RULES)


def test_license_scan(spark):
    rng = random.Random(8)
    texts = [None, "\n\t ", *SAMPLES, "x " * 5_000 + "under the mit license " * 40, "UNDER THE MIT LICENSE under the mit license", "cc by nc cc by nc sa 4.0"]
    texts += [" ".join(rng.sample(list(SAMPLES), 4)) for _ in range(12)] * 2  # repeated rows
    rows = [(i, t, "clash", 1) for i, t in enumerate(texts)] + [(None, "CC BY-NC", "clash", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, detections string, n_words int").repartition(3)
    out = license_scan.scan(df, RULES).select("row.doc_id", "row.text", "row.detections", "n_words", F.col("detections").alias("found"), license_scan.labels(F.col("detections")).alias("labels"), license_scan.confidence(F.col("detections")).alias("score")).collect()
    assert len(out) == len(rows) and all(r["detections"] == "clash" for r in out)
    for r in out:
        n, want = brute_scan(r["text"], RULES)
        assert (r["n_words"], sorted(tuple(f) for f in r["found"])) == (n, want)
        assert r["score"] == max((license_rules.CONFIDENCE[f[2]] for f in want), default=0.0)
        if r["text"] in SAMPLES:
            assert r["labels"] == SAMPLES[r["text"]], r["text"]


def test_license_scan_own_rules(spark):
    """Levels, equal intervals, a base phrase inside a better match."""
    rules = [*license_rules.phrases({"b c": "base"}), Signature("outer", 0, "a", "a b c d"), Signature("first", 3, "b", "b c"), Signature("second", 3, "b", "b c"), Signature("long", 3, "d", "d e f")]
    df = spark.createDataFrame([(1, "a b c d e f"), (2, "b c"), (3, "")], "doc_id long, text string")
    got = {r["doc_id"]: [(f["start"], f["stop"], f["label"]) for f in r["detections"]] for r in license_scan.scan(df, rules).select("row.doc_id", "detections").collect()}
    assert got == {1: [(0, 4, "outer"), (1, 3, "base"), (3, 6, "long")], 2: [(0, 2, "base")], 3: []}
    assert license_scan.scan(df.limit(0), rules).count() == 0
    with pytest.raises(ValueError):
        license_rules.phrases({"a b a": "overlaps itself"})


def test_license_scan_runs_no_python_worker(spark):
    plan = license_scan.scan(spark.createDataFrame([(1, "x")], "doc_id long, text string"), RULES)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


# ---------------------------------------------------------------- resampling


def brute_features(t, width):
    w = words(t)
    return len(w), [" ".join(w[i : i + n]) for n in range(1, width + 1) for i in range(len(w) - n + 1)]


def brute_resample(docs, target, s):
    bucket = lambda f: zlib.crc32(f.encode()) % s.buckets
    feats = [brute_features(t, s.width) for _, t in docs]
    ours = collections.Counter(bucket(f) for _, fs in feats for f in fs)
    theirs = collections.Counter(bucket(f) for t in target for f in brute_features(t, s.width)[1])
    a, b = sum(ours.values()) + s.buckets, sum(theirs.values()) + s.buckets
    gain = lambda u: math.floor(1000 * math.log((theirs[u] + 1.0) * a / ((ours[u] + 1.0) * b)))
    rows = []
    for (i, _), (n, fs) in zip(docs, feats, strict=True):
        weight = sum(gain(bucket(f)) for f in fs) // len(fs) if fs else 0
        h = int(hashlib.sha256(f"{s.seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append((i, len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), n >= s.least_words))
    order = sorted((r for r in rows if r[4]), key=lambda r: (-r[3], r[0] is not None, r[0] or 0, r[1], r[2]))
    draw = s.percent * len(order) // 100
    return collections.Counter([(*r[:4], k + 1 if k < draw else None) for k, r in enumerate(order)] + [(*r[:4], None) for r in rows if not r[4]])


def resampling_rows():
    rng = random.Random(4)
    vocab = ["".join(rng.choice("abcdEFGé9") for _ in range(rng.randint(1, 6))) for _ in range(300)]
    say = lambda n: " ".join(rng.choice(vocab) + rng.choice(["", ",", "--", "\n"]) for _ in range(n))
    docs = [(i, say(rng.randint(0, 60))) for i in range(150)] + [(200, None), (201, ""), (202, "\x00 \x7f!"), (203, "日本語 🙂 X" * 9), (204, say(3000)), (None, say(40))]
    docs += [(300, "the same words " * 10)] * 40 + [(None, "the same words " * 10)] * 30
    return docs, [say(50) for _ in range(10)] + [None]


@pytest.mark.parametrize("s", [Settings(width=1, buckets=97, seed=2024, least_words=20, percent=10), Settings(width=3, buckets=1000, seed=1, least_words=1, percent=50), Settings(percent=100), Settings(percent=0)])
def test_resample_equals_brute_force(spark, s):
    docs, target = resampling_rows()
    df = spark.createDataFrame([(*r, "x", 1) for r in docs], "doc_id long, text string, weight string, score int").repartition(4)
    out = importance.resample(df, spark.createDataFrame([(t,) for t in target], "text string"), s)
    assert collections.Counter(tuple(r) for r in out.collect()) == brute_resample(docs, target, s)


def test_resample_of_nothing(spark):
    none, some = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    assert importance.resample(none, some, Settings()).count() == 0
    out = importance.resample(some, none.select("text"), Settings(percent=100)).collect()
    assert {(r["doc_id"], r["n_features"], r["rank"]) for r in out} == {(1, 3, 1), (2, 0, None)}


def test_pieces_of_a_long_text(monkeypatch):
    """Pieces change neither words nor runs of words."""
    docs, _ = resampling_rows()
    text = (" ".join(t for _, t in docs if t) + " " + "w" * 500 + " end").encode()
    whole = [collections.Counter(c for _, codes in importance.features(text, n) for c in codes) for n in (1, 2, 4)]
    monkeypatch.setattr(importance, "PIECE", 64)
    parts = [list(importance.features(text, n)) for n in (1, 2, 4)]
    assert len(parts[0]) > 100 and [collections.Counter(c for _, codes in p for c in codes) for p in parts] == whole
    assert sum(n for n, _ in parts[0]) == len(words(text.decode()))


def test_drawn_documents_resemble_the_target(spark):
    rng = random.Random(6)
    kinds = {k: [f"{k}{i}" for i in range(50)] for k in "ab"}
    say = lambda k: " ".join(rng.choice(kinds[k]) for _ in range(40))
    docs = spark.createDataFrame([(i, say("a" if i % 4 == 0 else "b")) for i in range(800)], "doc_id long, text string")
    out = importance.resample(docs, spark.createDataFrame([(say("a"),) for _ in range(20)], "text string"), Settings(width=2, buckets=5000, percent=10))
    drawn = [r["doc_id"] for r in out.where("rank IS NOT NULL").collect()]
    assert len(drawn) == 80 and np.mean([i % 4 == 0 for i in drawn]) > 0.5
