"""Each operator against brute force on a small fixture with awkward rows."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakestrata.llm import base, components, decontaminate, jaccard_join, language_id, mixing, quality_pu, quality_rules, sharding, suffix_dedup, token_counts, url_filter
from lakestrata.llm.url_filter import Rule

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("size", T.LongType()), T.StructField("token", T.StringType()), T.StructField("n", T.StringType()),
])


def make_rows():
    rng = random.Random(5)
    vocab = ["".join(rng.choice("abcdefgéß") for _ in range(rng.randint(1, 7))) for _ in range(400)]
    say = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    passage, long_text = say(90), say(30_000)
    texts = [None, "", "   \n\t", "one", "One", "two words", "x" * 500, "A b A b " * 80, "ab " * 400, "\x00\x01 zero", "日本語 テキスト です", "🙂 🙂 🙂"]
    for _ in range(40):
        t = say(rng.randint(30, 120))
        texts.append(t)
        if rng.random() < 0.4:
            texts.append(t)
        if rng.random() < 0.5:
            w = t.split()
            w[rng.randrange(len(w))] = "changed"
            texts.append(" ".join(w))
        if rng.random() < 0.4:
            texts.append(say(10) + " " + passage + "\n" + say(12))
    texts += [long_text, long_text + " end", "line of words here\n" * 30 + say(5), say(50) + "#" * 40]
    rows = [(i, t, rng.choice(["en", "fr", None]), rng.choice(["s0", "s0", "s0", "s1", "S2", None]), 7, "t", "n") for i, t in enumerate(texts)]
    rows.append(rows[15])  # a repeated row
    rows.append((None, "a row without an id but with some words", "en", "s1", 7, "t", "n"))
    rows.append((15, "the same id with another text", "en", "s1", 7, "t", "n"))
    return rows


@pytest.fixture(scope="module")
def rows():
    return make_rows()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def bag(items):
    return collections.Counter(tuple(x) for x in items)


def brute_counts(t):
    t = t or ""
    w = WORD.findall(t)
    lines = [x for x in t.split("\n") if WORD.search(x)]
    seen = collections.Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    repeat = {j for i in range(len(w) - 7) if seen[tuple(w[i : i + 8])] > 1 for j in range(i, i + 8)}
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(repeat))


def test_word_spans_and_hashes():
    import pyarrow as pa

    texts = ["a bc", None, "", " x\n\ny ", "bc a"]
    data, off = base.utf8(pa.array(texts))
    s, e, r = base.word_spans(data, off)
    assert [(int(k), data[a:b].tobytes()) for a, b, k in zip(s, e, r)] == [(0, b"a"), (0, b"bc"), (3, b"x"), (3, b"y"), (4, b"bc"), (4, b"a")]
    h = base.WordHasher()(data, s, e)
    assert h[0] == h[5] and h[1] == h[4] and len(set(h.tolist())) == 4


def test_rules_statistics(docs, rows):
    got = quality_rules.statistics(docs, stratum=F.col("lang")).collect()
    want = bag((r[0], r[2] or "(null)", *brute_counts(r[1])) for r in rows)
    assert bag((g["doc_id"], g["stratum"], g["n_words"], g["word_chars"], g["n_symbols"], g["n_dup_lines"], g["n_repeat_words"]) for g in got) == want


def test_binomial_tail_is_exact():
    from fractions import Fraction
    from math import comb

    for k, n, p in ((0, 10, Fraction(1, 20)), (3, 40, Fraction(1, 10)), (40, 40, Fraction(1, 2)), (7, 300, Fraction(1, 50))):
        exact = sum(comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
        assert quality_rules.binomial_tail(k, n, float(p)) == pytest.approx(float(exact), rel=1e-10)


def test_cutoffs_keep_the_promise(spark):
    """Cutoffs stop at the first candidate whose false rejections cannot be bounded; a small stratum gets none."""
    rng = np.random.default_rng(1)
    columns = ["stratum", *quality_rules.STATS]
    data = [("big", 1000, 5000, int(x), 0, 0, 10, 0, 0, 0) for x in rng.integers(0, 200, 4000)]
    data += [("small", 1000, 5000, 0, 0, 0, 10, 0, 0, 0)] * 20
    got = {r["stratum"]: r for r in quality_rules.choose_cutoffs(spark.createDataFrame(data, columns)).collect()}
    assert got["small"]["symbols"] is None
    rejected = lambda c: sum(x[3] * 1000 / 5000 > c for x in data if x[0] == "big")
    level, share = 0.05 / 12, 0.03 / 6
    want = None
    for c in quality_rules.CUTOFFS:
        if quality_rules.binomial_tail(rejected(c), 4000, share) > level:
            break
        want = float(c)
    assert got["big"]["symbols"] == want and got["big"]["upper"] == 5.0


def test_rules_reject_and_keep(spark, docs, empty):
    stats = quality_rules.statistics(docs)
    labels = spark.createDataFrame([(1, 1), (None, 1), (99999, 0)], "doc_id long, quality int")
    out = quality_rules.judge(stats, labels).collect()
    assert len(out) == docs.count() and all(r["kept"] == (not r["base_failed"]) for r in out)
    assert quality_rules.judge(quality_rules.statistics(empty), labels).count() == 0


def test_language(spark, docs, empty):
    learn = spark.createDataFrame([("der die das und nicht ein", "de"), ("the and of with that", "en"), ("nothing", None)] * 4, "text string, lang string")
    model = language_id.fit(learn)
    assert model.languages == ["de", "en"]
    ask = spark.createDataFrame([(1, "und das ein"), (2, "that the of"), (3, None), (4, "12 34 --"), (5, ""), (None, "and " * 200_000)], "doc_id long, text string")
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language_id.predict(ask, model).collect()}
    assert [got[k][0] for k in (1, 2, 3, 4, 5, None)] == ["de", "en", "und", "und", "und", "en"]
    assert all(0 <= s <= 1 for _, s in got.values())
    nothing = language_id.fit(empty)
    assert {r["lang_pred"] for r in language_id.predict(docs, nothing).collect()} == {"und"}
    assert language_id.predict(empty, model).count() == 0


def test_language_ngrams_in_pieces(monkeypatch):
    letters = language_id.letter_table()
    text = "Ein Text, der in  Teile -- zerlegt wird 12 und wieder"
    whole = collections.Counter(np.concatenate(list(language_id.ngram_buckets(text, letters, 1 << 14))).tolist())
    monkeypatch.setattr(language_id, "CHUNK_CHARS", 7)
    assert collections.Counter(np.concatenate(list(language_id.ngram_buckets(text, letters, 1 << 14))).tolist()) == whole


def test_wand_equals_exhaustive():
    rng = random.Random(2)
    vocab = [f"w{i}" for i in range(120)]
    items = [(i, " ".join(rng.choices(vocab, weights=range(1, 121), k=rng.randint(3, 25))) + ". The end " + rng.choice(vocab)) for i in range(90)]
    x = decontaminate.build(items)
    for _ in range(60):
        words = rng.sample(vocab, rng.randint(5, 90)) + ["the", "end"]
        (_, h), = decontaminate._each([" ".join(words)])
        at = np.searchsorted(x.terms, np.unique(h))
        terms = np.array([t for t, w in zip(at, np.unique(h)) if t < len(x.terms) and x.terms[t] == w])
        score = np.zeros(len(x.ids))
        for t in terms:
            score[x.doc[x.start[t] : x.start[t + 1]]] += x.impact[x.start[t] : x.start[t + 1]]
        for threshold in (0.3, 0.6, 0.9):
            got = decontaminate.wand(x, terms, threshold)
            assert sorted(d for d, _ in got) == np.flatnonzero(score >= threshold - 1e-9).tolist()
            assert all(abs(s - score[d]) < 1e-9 for d, s in got)


def test_decontamination(spark, docs, empty):
    items = [(1, "Where does the river bend towards the old stone mill? It bends at the third bridge near town."), (2, None), (3, ""), (4, "short one. yes"), (1, "Where does the river bend towards the old stone mill? It bends at the third bridge near town.")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    filler = "some other words that say nothing in particular about it " * 60
    ask = [
        (10, filler + items[0][1].upper() + filler), (11, items[0][1].replace("?", " ;")), (12, filler), (13, None),
        (14, "Where does the river bend towards the old stone mill? Nobody knows."), (15, "It bends at the third bridge near town."),
        (16, " ".join(reversed(items[0][1].split()))), (None, items[0][1]), (10, filler),
    ]
    d = spark.createDataFrame(ask, "doc_id long, text string").withColumn("item_id", F.lit("x"))
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.matches(d, bench).collect()}
    assert got == {(10, 1), (11, 1), (None, 1)}
    left = sorted((r["doc_id"] or -1) for r in decontaminate.decontaminate(d, bench).collect())
    assert left == [10, 12, 13, 14, 15, 16]
    assert decontaminate.matches(empty, bench).count() == 0 and decontaminate.matches(d, bench.limit(0)).count() == 0


def test_decontamination_typographic_characters(spark):
    item = "Who wrote in the harbour log that the ferry didn't sail on that day? The keeper's son - aged nine - wrote it."
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    curly = item.replace("'", "\u2019")
    ways = [
        curly, item.replace(" - ", "\u2014"), item.replace(" ", "\u00a0"), "\u201c" + item.replace("day?", "day?\u201d \u2026") + "\u201d",
        curly.replace(" - ", "\u2013").replace(" ", "\u202f"), item.replace("-", "\u2764\ufe0f"),
    ]
    d = spark.createDataFrame([*enumerate(ways), (10, "Who wrote it\u2014the keeper\u2019s son?")], "doc_id long, text string")
    assert {r["doc_id"] for r in decontaminate.matches(d, bench).collect()} == set(range(len(ways)))
    assert [r["doc_id"] for r in decontaminate.decontaminate(d, bench).collect()] == [10]
    quoted = spark.createDataFrame([(1, curly.replace(" - ", "\u2014"))], "item_id long, text string")
    assert {r["doc_id"] for r in decontaminate.matches(d, quoted).collect()} == set(range(len(ways)))


def test_decontamination_words():
    words = lambda t: len(next(decontaminate._each([t]))[1])
    assert [words(t) for t in ("don\u2019t", "don't", "a\u2014b", "a\u00a0b\u3000c", "\u201c\u2026\u201d", "\u00e9t\u00e9 \u65e5\u672c \u0663\u0664")] == [2, 2, 2, 3, 0, 3]
    assert words("\u0939\u093f\u0928\u094d\u0926\u0940 e\u0301te\u0301") == 2  # marks belong to their letters


def test_decontamination_in_index_parts(spark, monkeypatch):
    items = [(i, f"question {i} about topic {i * 7} and so on? answer {i} is number {i * 13}.") for i in range(30)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    d = spark.createDataFrame([(i, "before " + t + " after") for i, t in items], "doc_id long, text string")
    whole = bag(decontaminate.matches(d, bench).select("doc_id", "item_id").collect())
    monkeypatch.setattr(decontaminate, "MAX_INDEX_BYTES", 500)
    assert bag(decontaminate.matches(d, bench).select("doc_id", "item_id").collect()) == whole == bag((i, i) for i in range(30))


def test_url_filter(spark):
    rules = [Rule("allow", host="org"), Rule("block", host="example.org", path="/es/"), Rule("block", host="com", path="/de/"), Rule("block", pattern="*/casino-*"), Rule("allow", pattern="*/casino-info^"), Rule("block", pattern="*.exe"), Rule("block", pattern="x*y")]
    urls = [
        None, "", "nothing", "http://", "HTTP://Example.ORG/es/a", "http://a.example.org/es", "http://a.example.org/es/?q=/x", "https://badexample.org/es/", "http://org", "http://org/",
        "http://x.com/de/1", "http://x.com/De/1", "http://u:p@x.com:80/de/#f", "http://casino/casino-win", "http://q.net/casino-info", "http://q.net/casino-info.html", "http://q.net/A.EXE", "http://q.net/xAAy", "a://b://c/d", "http://x.com?/de/", "http://ü.org/é",
    ]

    def brute(u):
        host = path = ""
        if u and "://" in u:
            rest = u.split("://", 1)[1]
            host = re.match(r"[^/?#]*", rest)[0]
            path = re.match(r"[^?#]*", rest[len(host) :])[0]
            host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
        fit = [r for r in rules if not r.pattern and (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
        if fit:
            best = max(fit, key=lambda r: (len(r.name), r.name))
            return host, path, best.name, best.action
        low = (u or "").translate({c: c + 32 for c in range(65, 91)})
        hit = [r for r in rules if r.pattern and re.search(r.regex(), low)]
        return host, path, None, max((r.action for r in hit), default="allow")

    d = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls * 2)], "page_id long, url string, url_rule string")
    got = {r["page_id"]: (r["url_host"], r["url_path"], r["url_rule"], r["url_verdict"]) for r in url_filter.judge(d, rules).collect()}
    assert got == {i: brute(u) for i, u in enumerate(urls * 2)}
    assert url_filter.judge(d.limit(0), rules).count() == 0
    assert {r["url_verdict"] for r in url_filter.judge(d, []).collect()} == {"allow"}


def test_url_rules_by_rarest_token():
    slots, always = url_filter.index_rules([Rule("block", host="mail.example.com"), Rule("block", pattern="a*b")], {"com": 50, "example": 20, "mail": 3})
    assert [e[0] for s in slots for e in s] == ["mail"] and [e[2] for e in always] == ["a*b"]


def test_suffix_sorting_fuzz():
    rng = random.Random(3)
    for _ in range(150):
        span, a = rng.choice([7, 8, 13, 20]), rng.choice([1, 2, 4, 256])
        make = lambda n: bytes(rng.randrange(a) for _ in range(n))  # noqa: B023, E731
        shared = make(60)
        strings = [make(rng.randint(0, 30)) + shared[(i := rng.randrange(50)) : i + rng.randint(0, 40)] + make(rng.randint(0, 10)) for _ in range(rng.randint(1, 8))]
        seen = collections.Counter(s[i : i + span] for s in strings for i in range(len(s) - span + 1))
        assert [x.tolist() for x in suffix_dedup.repeated_windows(strings, span)] == [[seen[s[i : i + span]] > 1 for i in range(len(s) - span + 1)] for s in strings]


def test_suffix_array_is_sorted():
    text = np.concatenate([np.frombuffer(s, np.uint8).astype(np.int16) + 1 if s != b"|" else np.zeros(1, np.int16) for s in (b"banana", b"|", b"ananas", b"|", b"bandana", b"|")])
    order = suffix_dedup.sort_suffixes(text, np.repeat([6, 13, 21], [7, 7, 8]), suffix_dedup._packed(text), 50)
    tails = [bytes(text[i:].astype(np.uint8)).split(b"\0")[0] for i in order]
    assert tails == sorted(tails) and len(tails) == 19


def brute_removed(texts, span):
    raw = [(t or "").encode() for t in texts]
    seen = collections.Counter(hash(r[i : i + span]) for r in raw for i in range(len(r) - span + 1))
    out = []
    for r in raw:
        gone = np.zeros(len(r), bool)
        for i in range(len(r) - span + 1):
            if seen[hash(r[i : i + span])] > 1:
                gone[i : i + span] = True
        kept = np.frombuffer(r, np.uint8)[~gone].tobytes()
        spans = int(np.count_nonzero(np.diff(np.concatenate([[0], gone.astype(int), [0]])) == 1))
        out.append((len(r), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("span", [200, 60])
def test_suffix_dedup(docs, rows, empty, span):
    want = bag((r[0], *x) for r, x in zip(rows, brute_removed([r[1] for r in rows], span)))
    assert bag(suffix_dedup.deduplicate(docs, span=span).collect()) == want
    assert suffix_dedup.deduplicate(empty).count() == 0


def test_suffix_dedup_of_long_texts_in_pieces(docs, rows, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "LONGEST", 700)
    monkeypatch.setattr(suffix_dedup, "row_chunks", lambda off: base.row_chunks(off, 1))
    assert bag(suffix_dedup.deduplicate(docs).collect()) == bag((r[0], *x) for r, x in zip(rows, brute_removed([r[1] for r in rows], 200)))


def brute_matches(docs, items, threshold=0.6, overlap=0.8, k1=1.2, b=0.75):
    """Every passage of every document against every item: BM25 share and shingle overlaps."""
    say = lambda t: re.findall("[a-z0-9]+", (t or "").lower())
    held = [(i, t, say(t)) for i, t in items if say(t)]
    df, mean = collections.Counter(w for *_, ws in held for w in set(ws)), sum(len(ws) for *_, ws in held) / len(held)

    def grams(ws):
        n = min(5, len(ws))
        return n, {tuple(ws[i : i + n]) for i in range(len(ws) - n + 1)} if n else set()

    out = {}
    for item, text, ws in held:
        gain = {w: math.log(1 + (len(held) - df[w] + 0.5) / (df[w] + 0.5)) * c * (k1 + 1) / (c + k1 * (1 - b + b * len(ws) / mean)) for w, c in collections.Counter(ws).items()}
        step = max(decontaminate.LEAST_STEP, 1 << (len(ws) - 1).bit_length())
        halves = [grams(say(p)) for p in decontaminate.split_item(text)]
        for r, (doc, t) in enumerate(docs):
            dw = say(t)
            for s in range(max(1, max(len(dw) - 1, 0) // step)):
                part = dw[s * step : (s + 2) * step]
                score = sum(gain[w] for w in set(part) & gain.keys()) / sum(gain.values())
                if part and score >= threshold:
                    q, a = (sum(g in {tuple(part[i : i + n]) for i in range(len(part) - n + 1)} for g in want) / len(want) if n else 1.0 for n, want in halves)
                    if q >= overlap and a >= overlap:
                        new = (min(q, a), round(score, 6), -s, doc, item, s * step, q, a)
                        out[r, item] = max(out.get((r, item), new), new)
    return collections.Counter((doc, item, at, score, round(q, 6), round(a, 6)) for _, score, _, doc, item, at, q, a in out.values())


def short_item(items):
    return next(i for i, t in items if t and 12 <= len(t.split()) <= 60)


def benchmark_rows():
    rng = random.Random(12)
    vocab = [f"w{i}" for i in range(160)]
    say = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    items = [(i, f"{say(rng.choice([4, 9, 25, 40, 90, 150]))}? {say(rng.choice([1, 3, 8]))}.") for i in range(40)] + [(50, ""), (51, None), (52, "!?")]
    docs = [(i, f"{say(rng.randint(0, 200))} {rng.choice(items[:40])[1] if rng.random() < 0.6 else ''} {say(rng.randint(0, 120))}") for i in range(50)]
    for i in range(50, 80):  # damaged quotes
        w = rng.choice(items[:40])[1].split()
        w[rng.randrange(len(w))] = "changed"
        docs.append((i, f"{say(rng.randint(0, 90))} {' '.join(w)} {say(30)}"))
    q, a = items[short_item(items)][1].split("? ")
    docs += [(80, f"{q} {say(300)} {a}"), (81, f"{q} {say(9)} {a}"), (82, None), (83, ""), (84, docs[0][1]), (84, docs[0][1])]
    return docs, items


def found_matches(spark, docs, items, **kw):
    d, m = spark.createDataFrame(docs, "doc_id long, text string").repartition(3), spark.createDataFrame(items, "item_id long, text string")
    rows = decontaminate.matches(d, m, **kw).collect()
    return collections.Counter((r["doc_id"], r["item_id"], r["passage"], round(r["score"], 6), round(r["question_overlap"], 6), round(r["answer_overlap"], 6)) for r in rows)


@pytest.mark.parametrize("threshold", [0.6, 0.95])
def test_decontamination_equals_brute_force(spark, monkeypatch, threshold):
    """The whole operator, in one index, in parts, and with few cells at a time: matches, passages and scores."""
    docs, items = benchmark_rows()
    want = brute_matches(docs, items, threshold)
    assert len(want) > 40 and found_matches(spark, docs, items, threshold=threshold) == want
    monkeypatch.setattr(decontaminate, "MAX_INDEX_BYTES", 3_000)
    monkeypatch.setattr(decontaminate, "MAX_CELLS", 5)
    assert found_matches(spark, docs, items, threshold=threshold) == want


def test_an_unrelated_item_changes_no_verdict(spark):
    docs, items = benchmark_rows()
    other = [(99, " ".join(f"other{i}" for i in range(2_000)))]
    pairs = lambda m: {x[:2] for x in m}
    before, after = found_matches(spark, docs, items), found_matches(spark, docs, items + other)
    k = short_item(items)
    assert pairs(before) == pairs(after) and (80, k) not in pairs(after) and (81, k) in pairs(after)


def test_long_words_are_counted_in_linear_time():
    import time

    rng = random.Random(1)
    pieces = {tuple(rng.choice(b"abc") for _ in range(rng.randint(1, 4))) for _ in range(60)} | {(c,) for c in b"abc"}
    pieces |= {(*p[:-1], p[-1] + 256) for p in list(pieces)}
    a = token_counts.build(sorted(pieces))
    words = ["".join(rng.choice("abc") for _ in range(n)) for n in (255, 256, 257, 300, 2_000, 3)]
    short = token_counts._count_together(a, words)
    assert token_counts.count_words(a, words).tolist() == short.tolist() == [token_counts.count_long(a, w.encode()) for w in words]
    lost = ["abc" * 100 + "x" + "abc" * 100, "é" * 200, "a" * 300 + "\U0001f642"]
    assert token_counts.count_words(a, lost).tolist() == [1, 1, 1]
    begin = time.perf_counter()
    assert token_counts.count_words(a, ["".join(rng.choice("abc") for _ in range(300_000))])[0] > 50_000
    assert time.perf_counter() - begin < 10


def test_refined_weights_minimise_the_risk_over_all_rows(spark):
    """Against plain descent on all rows in one array; the same for any partitions."""
    rng = np.random.default_rng(5)
    x = np.concatenate([rng.normal(1, 1, (300, 3)), rng.normal(-1, 1, (500, 3))])
    good = np.arange(800) < 120
    prior, mean, scale = 0.3, np.zeros(3), np.ones(3)
    df = spark.createDataFrame([(r.tolist(), bool(g)) for r, g in zip(x, good)], "x array<double>, good boolean")
    w = quality_pu.refine(df.repartition(3), np.zeros(4), prior, mean, scale)
    one = np.concatenate([np.clip(x, -8, 8), np.ones((800, 1))], axis=1)
    slope = one.T @ (1 / (1 + np.exp(-one @ w))) / 800 - prior * one[good].mean(axis=0) + quality_pu.RIDGE * w
    sums = quality_pu.risk_sums(df, w, mean, scale)
    assert np.abs(slope).max() < 1e-3 and sums[0, 0] == 800 and sums[1, 0] == 120
    assert np.logaddexp(0, one @ w).mean() - prior * np.logaddexp(0, one[good] @ w).mean() >= 0
    assert (quality_pu.refine(df.repartition(11), np.zeros(4), prior, mean, scale) == w).all()
    # from weights whose negative part is below zero it steps back first
    far = quality_pu.refine(df, np.array([40.0, 40.0, 40.0, 60.0]), prior, mean, scale)
    assert np.logaddexp(0, one @ far).mean() - prior * np.logaddexp(0, one[good] @ far).mean() >= 0


@pytest.mark.parametrize("levels", [6, 1, 0])
def test_suffix_dedup_of_large_groups(spark, monkeypatch, levels):
    """Groups above the bound are filed again, and what no gram splits is counted window by window."""
    monkeypatch.setattr(suffix_dedup, "GROUP_BYTES", 600)
    monkeypatch.setattr(suffix_dedup, "BATCH_BYTES", 600)
    monkeypatch.setattr(suffix_dedup, "LEVELS", levels)
    rng = random.Random(9)
    passage = "".join(rng.choice("abcd ") for _ in range(330))
    texts = [f"{rng.random()} {rng.random()} " * rng.randint(3, 9) + passage[rng.randint(0, 60) :][: rng.randint(210, 330)] + f" {rng.random()}" * 8 for _ in range(60)]
    texts += ["ab" * 400, "x" * 700, "ab" * 300 + "y", passage * 3, None, "", passage[:200], passage[:199]]
    d = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(4)
    assert bag(suffix_dedup.deduplicate(d).collect()) == bag((i, *x) for i, x in enumerate(brute_removed(texts, 200)))


def test_sorting_memory_is_bounded():
    """What a task sorts at once needs some 100 bytes a byte."""
    import tracemalloc

    rng = random.Random(2)
    part = bytes(rng.choice(b"abcdefgh ") for _ in range(900))
    strings = [bytes(rng.choice(b"abcdefgh ") for _ in range(150)) + part[rng.randint(0, 300) :] for _ in range(400)]
    tracemalloc.start()
    suffix_dedup.repeated_windows(strings, 200)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 130 * sum(map(len, strings))


def colliding_words(k):
    """A Thue-Morse word of 2^k letters and its swap: equal under any polynomial hash modulo 2^64 from k = 10 on."""
    bits = [bin(i).count("1") % 2 for i in range(1 << k)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


def test_hashes_of_constructed_words(spark):
    hasher = base.WordHasher()
    for k in range(6, 14):
        a, b = (np.frombuffer(w.encode(), np.uint8) for w in colliding_words(k))
        one, two = (hasher(x, np.array([0]), np.array([len(x)]))[0] for x in (a, b))
        assert one != two, k
    a, b = colliding_words(11)
    texts = [" ".join([w, "plain", "words", "here"] * 9) for w in (a, b)] + [f"{a} {b} " * 4 + "one two three " * 8]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in jaccard_join.near_duplicates(d, width=3, percent=90).collect()}
    assert got == {0: 0, 1: 1, 2: 2}
    words = quality_rules.statistics(d).collect()
    assert {r["doc_id"]: r["n_repeat_words"] for r in words} == {i: brute_counts(t)[4] for i, t in enumerate(texts)}


def test_quality_rules_count_documents_not_rows(spark):
    """Copies of one labelled document prove nothing."""
    text = "some good words that follow each other without any harm " * 5
    one = spark.createDataFrame([(1, text, "en")] * 400, "doc_id long, text string, lang string")
    stats = quality_rules.statistics(one, stratum=F.col("lang"))
    cutoffs = quality_rules.choose_cutoffs(stats).collect()[0]
    assert all(cutoffs[r] is None for r in quality_rules.RULES)


def test_url_hosts_with_blanks(spark):
    rules = [Rule("block", host="example.org", path="/es/"), Rule("block", host="com", path="/de/")]
    d = spark.createDataFrame([(1, "http://foo bar.example.org/es/x"), (2, "http://a b.com/de/1"), (3, "http://x/ example.org/es/"), (4, "http://com /de/")], "page_id long, url string")
    assert {r["page_id"]: r["url_rule"] for r in url_filter.judge(d, rules).collect()} == {1: "example.org/es/", 2: "com/de/", 3: None, 4: None}


def test_suffix_dedup_with_frequent_grams(spark, monkeypatch):
    """A passage in most texts: its grams are demoted, its windows still found."""
    rng = random.Random(8)
    passage = "".join(rng.choice("abcdefghij ") for _ in range(700))
    noise = lambda n: "".join(rng.choice("klmnopqrst ") for _ in range(n))
    texts = [noise(rng.randint(0, 400)) + passage[(k := rng.randrange(0, 300)) :] + noise(rng.randint(0, 300)) for _ in range(60)] + [noise(500) for _ in range(20)]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    assert len(suffix_dedup.frequent_grams(d.select(F.xxhash64("text").alias("key"), "text"), 80)) > 100
    assert bag(suffix_dedup.deduplicate(d).collect()) == bag((i, *x) for i, x in enumerate(brute_removed(texts, 200)))


def test_classifier(spark, docs, empty):
    rng = random.Random(4)
    good = lambda: " ".join("".join(rng.choice("abcde") for _ in range(rng.randint(2, 6))) for _ in range(60)) + "."
    bad = lambda: " ".join("X#" + rng.choice("abc") + "!!" for _ in range(60))
    data = [(i, bad() if i % 4 == 0 else good()) for i in range(400)]
    d = spark.createDataFrame(data, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 != 0)) for i in range(0, 400, 3)] + [(None, 1)], "doc_id long, quality int")
    model = quality_pu.fit(quality_pu.features(d), labels)
    assert 0.6 <= model.prior <= 0.95
    got = {r["doc_id"]: r["s"] for r in quality_pu.features(d).select("doc_id", quality_pu.score(model).alias("s")).collect()}
    right = sum((got[i] >= 0.3) == (i % 4 != 0) for i in range(400))
    assert right >= 390
    others = quality_pu.features(docs).select(quality_pu.score(model).alias("s")).collect()
    assert len(others) == docs.count() and all(0 <= r["s"] <= 1 for r in others)
    untaught = quality_pu.fit(quality_pu.features(empty), labels)
    assert {r["s"] for r in quality_pu.features(docs).select(quality_pu.score(untaught).alias("s")).collect()} == {0.5}


def test_classifier_statistics_take_all_rows(spark):
    rng = random.Random(6)
    good = lambda: " ".join("".join(rng.choice("abcde") for _ in range(rng.randint(2, 6))) for _ in range(rng.randint(20, 90))) + "."
    bad = lambda: " ".join("X#" + rng.choice("abc") + "!!" for _ in range(rng.randint(20, 90)))
    d = spark.createDataFrame([(i, bad() if i % 4 == 0 else good()) for i in range(1600)], "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(i, int(i % 4 != 0)) for i in range(1600)], "doc_id long, quality int")
    feats = quality_pu.features(d).cache()
    model = quality_pu.fit(feats, labels, sample=60)
    x = np.array([r[0] for r in feats.select(F.array(*(c.cast("double") for c in quality_pu.inputs()))).collect()])
    assert np.allclose(model.mean, x.mean(axis=0), atol=1e-5) and np.allclose(model.scale, x.std(axis=0), atol=1e-4)
    assert 0.72 <= model.prior <= 0.8  # of three quarters; least ratios of 30 rows err far below
    assert quality_pu.fit(feats.repartition(7), labels, sample=60) == model


def test_classifier_tail_counts(spark):
    rng = np.random.default_rng(2)
    x, good, h = rng.normal(size=(500, 3)).round(1), rng.random(500) < 0.4, rng.integers(0, 1000, 500)
    rows = spark.createDataFrame([(a, bool(g), int(k)) for a, g, k in zip(x.tolist(), good, h)], "x array<double>, good boolean, h long").repartition(5)
    mean, scale, models = x.mean(axis=0), x.std(axis=0), [rng.normal(size=4), rng.normal(size=4)]
    z = [quality_pu._scores(quality_pu._standard(x, mean, scale), w) for w in models]
    cuts = [np.quantile(s[good], [0.2, 0.5, 0.9]) for s in z]
    got = quality_pu.tail_counts(rows, models, cuts, mean, scale, (300, 700))
    for k in (0, 1):
        for part, of in enumerate((h >= 300, good & (h >= 700))):
            s = z[k][of]
            assert got[k, part].tolist() == [len(s), *((s >= c).sum() for c in cuts[k]), *((s <= c).sum() for c in cuts[k])]


def test_non_negative_risk_gradient():
    rng = np.random.default_rng(0)
    p, u, w = rng.normal(1, 1, (50, 3)), rng.normal(0, 1, (80, 3)), rng.normal(0, 1, 3)

    def risk(w, prior):
        l = lambda z: np.logaddexp(0, -z).mean()  # noqa: E731, E741
        rest = l(-(u @ w)) - prior * l(-(p @ w))
        return prior * l(p @ w) + rest, rest

    step = 1e-6
    assert risk(w, 0.3)[1] > 0
    numeric = [(risk(w + step * e, 0.3)[0] - risk(w - step * e, 0.3)[0]) / (2 * step) for e in np.eye(3)]
    assert np.allclose(quality_pu._risk_gradient(w, p, u, 0.3), numeric, atol=1e-6)


def test_targets_fill_up():
    assert mixing.targets([100, 100], [3, 1], 1.5, 2) == [200, 100]
    got = mixing.targets([10, 100, 100, 0], [3, 1, 2, 3], 1.5, 2)
    assert got[0] == 20 and got[3] == 0 and sum(got) == pytest.approx(315) and max(g - 2 * s for g, s in zip(got, [10, 100, 100, 0])) <= 0
    assert mixing.targets([], [], 1.5, 2) == [] and mixing.targets([0], [1], 1.5, 2) == [0]


def test_splitting_tree():
    blocks = [1000, 10, 0, 333]
    out = mixing.split_tree(blocks, 7, 1)
    assert out.sum(axis=0).tolist() == blocks and (out >= 0).all()
    assert max(out.sum(axis=1)) - min(out.sum(axis=1)) <= 3
    assert (mixing.split_tree(blocks, 7, 1) == out).all() and (mixing.split_tree(blocks, 7, 2) != out).any()


def test_splitting_tree_draws_are_exact_at_large_sizes():
    """Beyond numpy's limit: halves of a small source, and rare blocks among 1e12."""
    one = np.array([mixing.split_tree([2, 4 * 10**9], 2, seed)[0, 0] for seed in range(3000)])
    share = np.bincount(one, minlength=3) / len(one)
    assert np.abs(share - [0.25, 0.5, 0.25]).max() < 0.04  # a normal draw: 0.24, 0.52, 0.24
    rng = np.random.default_rng(1)
    few = np.array([mixing.hypergeometric(10**10, 99 * 10**10, 100, rng) for _ in range(3000)])
    for k in range(4):
        assert abs((few == k).mean() - math.comb(100, k) * 0.01**k * 0.99 ** (100 - k)) < 0.035  # a normal draw: 0.31 of 0, not 0.37
    out = mixing.split_tree([3 * 10**11, 10**9, 7], 4, 3)
    assert out.sum(axis=0).tolist() == [3 * 10**11, 10**9, 7] and (out >= 0).all()


def test_large_draws_follow_the_law(monkeypatch):
    c, rest, n = 40, 70, 30
    monkeypatch.setattr(mixing, "LARGEST", 0)
    for chunk in (1 << 20, 7):
        monkeypatch.setattr(mixing, "DRAW_CHUNK", chunk)
        rng = np.random.default_rng(4)
        got = np.bincount([mixing.hypergeometric(c, rest, n, rng) for _ in range(20000)], minlength=n + 1) / 20000
        want = np.array([math.comb(c, k) * math.comb(rest, n - k) / math.comb(c + rest, n) for k in range(n + 1)])
        assert np.abs(got - want).max() < 0.015
    rng = np.random.default_rng(5)
    assert [mixing.hypergeometric(a, b, k, rng) for a, b, k in ((5, 0, 3), (0, 5, 3), (4, 3, 7), (4, 3, 0))] == [3, 0, 4, 0]


def test_mixing(docs, rows, empty):
    mixed = mixing.mix(docs).cache()
    sizes = [len(WORD.findall(r[1] or "")) for r in rows]
    per = collections.Counter()
    for r, n in zip(rows, sizes):
        per[r[3]] += n
    names = sorted(per, key=lambda s: (s is None, s or ""))
    goal = dict(zip(names, mixing.targets([per[s] for s in names], [(3, 1, 2)[i % 3] for i in range(len(names))], 1.5, 2)))
    got = mixed.withColumn("taken", mixing.taken()).collect()
    assert bag((r["doc_id"], r["size"], r["source"], r["source_size"], r["target"]) for r in got) == bag((r[0], n, r[3], per[r[3]], goal[r[3]]) for r, n in zip(rows, sizes))
    took = collections.Counter()
    for r in got:
        assert r["taken"] <= 2 * r["size"]
        took[r["source"]] += r["taken"]
        for e in {p["epoch"] for p in r["pieces"]}:  # pieces of an epoch do not overlap
            spans = sorted((p["first"], p["first"] + p["words"]) for p in r["pieces"] if p["epoch"] == e)
            assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:])) and spans[0][0] >= 0 and spans[-1][1] <= r["size"]
    assert all(abs(took[s] - goal[s]) <= 0.5 + 1e-6 for s in per)
    sized = docs.select(mixing.word_count(F.col("text")).alias("size"), F.col("source").alias("__source"))
    plans = mixing.plan(sized, (3.0, 1.0, 2.0), 1.5, 2.0, 64, 7, 1024)
    for s in names:  # every shard holds as many blocks of a source as the tree's quota says
        blocks = {(p["shard"], p["epoch"], p["place"]) for r in got if r["source"] == s for p in r["pieces"]}
        quota = np.diff([0, *plans["" if s is None else f"={s}"][7]])
        assert collections.Counter(b[0] for b in blocks) == {k: n for k, n in enumerate(quota.tolist()) if n}
    told = mixed.select("pieces", mixing.shard_words().alias("w")).collect()
    for r in told:
        by = collections.Counter()
        for p in r["pieces"]:
            by[p["shard"]] += p["words"]
        assert r["w"] == ",".join(f"{k}:{by[k]}" for k in sorted(by))
    shards = collections.Counter()
    for r in got:
        for p in r["pieces"]:
            assert 0 <= p["shard"] < 64
            shards[p["shard"]] += p["words"]
    assert len(shards) == 64
    again = mixing.mix(docs.repartition(3)).withColumn("taken", mixing.taken()).collect()
    assert bag((r["doc_id"], r["taken"]) for r in again) == bag((r["doc_id"], r["taken"]) for r in got)
    assert mixing.mix(empty).count() == 0 and mixing.mixed_documents(docs).columns == docs.columns


def test_mixed_documents_meet_each_target(spark):
    """Few and long documents: every source is within half a document of its target."""
    rng = random.Random(9)
    data = [(100 * s + i, f"s{s:02}", "w " * (rng.randint(2000, 4000) if i < 3 else rng.randint(1, 60))) for s in range(20) for i in range(rng.randint(4, 30))]
    d = spark.createDataFrame([*data, (None, "s01", None), (5000, None, "a b c")], "doc_id long, source string, text string").repartition(3)
    per, longest, took = collections.Counter(), collections.Counter(), collections.Counter()
    for r in d.collect():
        n = len((r["text"] or "").split())
        per[r["source"]] += n
        longest[r["source"]] = max(longest[r["source"]], n)
    names = sorted(per, key=lambda s: (s is None, s or ""))
    goal = dict(zip(names, mixing.targets([per[s] for s in names], [(3, 1, 2)[i % 3] for i in range(len(names))], 1.5, 2)))
    out = mixing.mixed_documents(d).collect()
    for r in out:
        took[r["source"]] += len(r["text"].split())
    assert all(abs(took[s] - goal[s]) <= longest[s] / 2 + 1 for s in names)
    assert max(collections.Counter(r["doc_id"] for r in out).values()) == 2
    assert bag(tuple(r) for r in mixing.mixed_documents(d.repartition(5)).collect()) == bag(tuple(r) for r in out)
    # each shard's words of a source are the tree's quota, but for half a document at either end
    dealt = mixing.dealt_documents(d, shards=4).select("__shard", "__place", "__row.*").collect()
    assert bag((r["doc_id"], r["source"], r["text"]) for r in dealt) == bag(tuple(r) for r in out) and len({r["__place"] for r in dealt}) == len(dealt)
    plans = mixing.plan(d.select(mixing.word_count(F.col("text")).alias("size"), F.col("source").alias("__source")), (3.0, 1.0, 2.0), 1.5, 2.0, 4, 7, 1024)
    for s in names:
        size, _, width, *_, quota, _ = plans["" if s is None else f"={s}"]
        words = collections.Counter()
        for r in dealt:
            if r["source"] == s:
                words[r["__shard"]] += len(r["text"].split())
        assert all(abs(words[k] - n * width) <= longest[s] + 2 * width for k, n in enumerate(np.diff([0, *quota]).tolist())), s
    shuffled = [r["__shard"] for r in mixing.dealt_documents(d, shards=4).repartition(2, "__shard").sortWithinPartitions("__shard", "__place").collect()]
    assert len(set(shuffled)) == 4


def test_permutation():
    for n in (1, 2, 7, 100):
        for seed in (1, 2):
            keys = np.random.default_rng(seed).integers(0, 1 << 50, (1, mixing.ROUNDS)).repeat(n, axis=0)
            assert sorted(mixing.permuted(np.arange(n), np.full(n, n), keys).tolist()) == list(range(n))


def greedy(symbols, pieces):
    n = i = 0
    while i < len(symbols):
        j = next((j for j in range(len(symbols), i, -1) if symbols[i:j] in pieces), 0)
        if not j:
            return 1
        i, n = j, n + 1
    return n


def test_token_counts_automaton():
    rng = random.Random(6)
    for _ in range(30):
        letters = "abc"
        pieces = {tuple(ord(c) + 256 * (end and i == k - 1) for i, c in enumerate(rng.choices(letters, k=k))) for k in (1, 2, 3, 4) for _ in range(8) for end in (False, True)}
        words = ["".join(rng.choices(letters, k=rng.randint(1, 12))) for _ in range(80)]
        got = token_counts.count_words(token_counts.build(sorted(pieces)), words)
        for w, n in zip(words, got):
            s = [ord(c) for c in w]
            s[-1] += 256
            assert n == greedy(tuple(s), pieces), w


def test_token_counts(docs, rows, empty):
    pieces = token_counts.load_vocabulary()
    known = set(pieces)
    got = bag(token_counts.token_counts(docs).collect())
    want = []
    memo = {}
    for r in rows:
        words = re.findall(token_counts.WORDS, (r[1] or "").lower())
        for w in words:
            if w not in memo:
                s = list(w.encode())
                s[-1] += 256
                memo[w] = greedy(tuple(s), known)
        want.append((r[0], len(words), sum(memo[w] for w in words)))
    assert got == bag(want)
    assert token_counts.token_counts(empty).count() == 0


def test_components(spark):
    rng = random.Random(9)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 460)] + [(None, 3), (5, 5)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        if a is not None and a != b:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    got = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()}
    assert got == {x: find(x) for x in root}
    assert components.components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def brute_join(rows, width, percent):
    sets = []
    for r in rows:
        w = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r[1] or ""))
        sets.append({tuple(w[i : i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} - {()})
    group = list(range(len(rows)))

    def find(x):
        while group[x] != x:
            x = group[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common and 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
                group[find(i)] = find(j)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[find(i)] = min(least.get(find(i), r[0]), r[0])
    return [(r[0], len(sets[i]), least.get(find(i))) for i, r in enumerate(rows)]


@pytest.mark.parametrize("width,percent", [(3, 90), (5, 80)])
def test_jaccard_join(docs, rows, empty, width, percent):
    got = jaccard_join.near_duplicates(docs, width=width, percent=percent).collect()
    assert bag(got) == bag(brute_join(rows, width, percent))
    assert jaccard_join.near_duplicates(empty).count() == 0


def test_jaccard_join_dense_group(spark, monkeypatch):
    """Many near copies of one text, linked only through it, and frequent tokens in play."""
    monkeypatch.setattr(jaccard_join, "FREQUENT_TOKENS", 500)
    rng = random.Random(11)
    text = [f"w{rng.randrange(10_000)}" for _ in range(150)]
    made = []
    for _ in range(150):
        t = list(text)
        for k in rng.sample(range(150), rng.choice([0, 1, 1, 2, 2, 3, 5])):
            t[k] = f"new{rng.randrange(10_000)}"
        made.append(" ".join(t))
    made += [" ".join(f"u{rng.randrange(10_000)}" for _ in range(100)) for _ in range(40)]
    rows = [(i, t) for i, t in enumerate(made)]
    d = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert bag(jaccard_join.near_duplicates(d, width=3, percent=90).collect()) == bag(brute_join(rows, 3, 90))


def test_sharding(spark, docs, rows, empty):
    weights = [1.0, 2.0, 1.0, 4.0]
    got = sharding.shard(docs, weights).collect()
    assert bag((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == bag((r[0], len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in rows)
    for s in {r["shard"] for r in got}:
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(sum(r["shard"] == s for r in got)))
    assert all(r["grown_shard"] in (r["shard"], 4) for r in got)
    many = spark.range(20_000).withColumn("text", F.lit("t"))
    share = collections.Counter(r["shard"] for r in sharding.shard(many.withColumnRenamed("id", "doc_id"), weights).collect())
    assert all(abs(share[i] / 20_000 - w / 8) < 0.02 for i, w in enumerate(weights))
    same = spark.range(500).select(F.lit(3).alias("doc_id"), F.lit("t").alias("text"))
    assert sorted(r["slot"] for r in sharding.shard(same, weights).collect()) == list(range(500))
    assert sharding.shard(empty, weights).count() == 0
