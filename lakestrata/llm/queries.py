"""The checked queries of the operators over the given tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import conversation_trie, decontaminate, importance, jaccard_join, language_id, license_rules, license_scan, mixing, quality_pu, quality_rules, sharding, suffix_dedup, token_counts, url_filter
from .base import cut, table
from .url_filter import Rule

SHARDS = 16
PREDICTED_FROM = 0.3
URL_RULES = [
    Rule("allow", host="org"),
    Rule("block", host="example.org", path="/es/"),
    Rule("block", host="example.org", path="/en/1"),
    Rule("allow", host="com", path="/fr/"),
    Rule("block", host="com", path="/de/"),
    *(Rule("block", pattern=p) for p in ("*/casino-*", "*.casino-*", "*/free-bets.*", "*.free-bets.*", "*/poker-*", "*.poker-*", "*://ads.*", "*.doubleclick.*", "*/wp-login.php^", "*.exe^")),
]

LICENSE_PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
LICENSE_RULES = [*license_rules.phrases(LICENSE_PHRASES), *license_rules.signatures()]
IMPORTANCE = importance.Settings(width=1, buckets=10_000, seed=2024, least_words=20, percent=10)


def fold(parts: int) -> Column:
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(parts))


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = cut(quality_rules.statistics(table(spark, sf_dir, "documents"), stratum=F.col("lang")))
    judged = quality_rules.judge(stats, table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language_id.fit(docs.where(fold(3) != 1))
    return language_id.predict(docs, model).select("doc_id", (fold(3) == 1).alias("held_out"), "lang_pred", "score")


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_filter.judge(table(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES)
    return judged.select("page_id", F.col("url_host").alias("host"), F.col("url_path").alias("path"), F.col("url_rule").alias("rule"), F.col("url_verdict").alias("verdict"))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.deduplicate(table(spark, sf_dir, "documents"))


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    feats = cut(quality_pu.features(table(spark, sf_dir, "documents")))
    model = quality_pu.fit(feats.where(fold(5) != 0), table(spark, sf_dir, "labels"))
    scored = feats.select("doc_id", (fold(5) == 0).alias("held_out"), quality_pu.score(model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= PREDICTED_FROM).cast("int"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"), carry=["doc_id"])
    return mixed.select("doc_id", "size", "source_size", "target", mixing.taken().alias("taken"), mixing.shard_words().alias("shard_words"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"))


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(table(spark, sf_dir, "documents"), width=3, percent=90)


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sharding.shard(table(spark, sf_dir, "documents"), [1.0] * SHARDS)
    return rows.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", F.col("slot").cast("long"), "grown_shard")


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie.trie(conversation_trie.rebuilt(conversation_trie.turns(table(spark, sf_dir, "conversations"))))


def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.scan(table(spark, sf_dir, "documents").select("doc_id", "text"), LICENSE_RULES)
    every = F.col("detections")
    base = F.filter(every, lambda d: d["base"])
    starts = F.transform(base, lambda d: d["start"])
    return found.select(
        "row.doc_id", "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        license_scan.labels(base).alias("base_labels"), license_scan.labels(every).alias("labels"), license_scan.confidence(every).alias("score"),
    )


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), IMPORTANCE)


QUERIES = {
    f.__name__: f
    for f in (op1_quality_rules, op2_language_id, op3_decontamination, op4_url_filter, op5_suffix_dedup, op6_quality_classifier, op7_mixing, op8_token_counts, op9_jaccard_join, op10_sharding,
        op11_conversation_trie, op12_license_scan, op13_importance_resampling)
}

_UPPER, _LOWER = url_filter.UPPER, url_filter.LOWER
_RATES = ", ".join(f"({i}, coalesce(1000 * {top} / nullif({base}, 0), 0.0))" for i, (top, base) in enumerate(quality_rules.RULES.values()))
_HOST = f"CASE WHEN position('://' IN url) > 0 THEN translate(regexp_extract(substr(url, position('://' IN url) + 3), '^([^/?#]*)', 1), '{_UPPER}', '{_LOWER}') ELSE '' END"
_PATH = "CASE WHEN position('://' IN url) > 0 THEN regexp_extract(substr(url, position('://' IN url) + 3), '^[^/?#]*([^?#]*)', 1) ELSE '' END"
_HOST_RULES = ", ".join(f"('{r.host}', '{r.path}', '{r.action}')" for r in URL_RULES if not r.pattern)
_PATTERNS = " OR ".join(f"regexp_matches(translate(url, '{_UPPER}', '{_LOWER}'), '{r.regex()[4:]}', 's')" for r in URL_RULES if r.pattern)
_quote = lambda t: "'" + t.replace("'", "''") + "'"
_SIGNATURES = ", ".join(f"({i}, {_quote(r.label)}, {r.level}, {r.base}, {_quote(' ' + r.keyword)}, {_quote(r.regex())})" for i, r in enumerate(LICENSE_RULES))
#: CRC-32 of a blob ``b``, byte by byte; the table ``t`` is made by the rule of its polynomial
_CRC_TABLE = "SELECT list(list_reduce(list_prepend(i, range(8)), lambda c, b: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t FROM range(256) r(i)"
_CRC = "xor(list_reduce(list_prepend(4294967295, list_transform(regexp_extract_all(hex(b), '..'), lambda h: ('0x' || h)::BIGINT)), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)"

ORACLES = {
    # the binomial test of every candidate cutoff; a rule's cutoff is the last before the first failure
    "op1_quality_rules": rf"""
        WITH w AS (SELECT row_number() OVER () AS r, doc_id, coalesce(lang, '(null)') AS stratum, coalesce(text, '') AS t,
              regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws,
              list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM documents),
        win AS (SELECT r, unnest(range(1, len(ws) - 6)) AS i, unnest(list_transform(range(1, len(ws) - 6), lambda i: array_to_string(ws[i:i + 7], ' '))) AS g FROM w WHERE len(ws) > 7),
        dup AS (SELECT r, i FROM win QUALIFY count(*) OVER (PARTITION BY r, g) > 1),
        cov AS (SELECT r, count(DISTINCT i + k) AS n FROM dup, range(8) x(k) GROUP BY r),
        c AS (SELECT w.r, doc_id, stratum, len(ws) AS n_words, coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::BIGINT AS word_chars,
              length(t) - length(translate(t, '#*$%&|<>', '')) AS n_symbols, len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(cov.n, 0) AS n_repeat_words,
              len(ls) AS n_lines, length(t) - length(translate(t, '{_UPPER}', '')) AS n_upper, length(t) - length(translate(t, '!', '')) AS n_marks,
              len(list_filter(range(1, len(ws)), lambda i: translate(ws[i], '{_UPPER}', '{_LOWER}') = translate(ws[i + 1], '{_UPPER}', '{_LOWER}'))) AS n_adjacent
              FROM w LEFT JOIN cov ON w.r = cov.r),
        b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM c),
        rates AS (SELECT r, doc_id, stratum, base_failed, x.rule, x.rate FROM b, LATERAL (VALUES {_RATES}) x(rule, rate)),
        good AS (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id HAVING min(quality) = 1),
        cuts AS (SELECT unnest(range(1, {len(quality_rules.CUTOFFS)} + 1)) AS i, unnest({quality_rules.CUTOFFS}) AS c),
        held AS (SELECT stratum, rule, i, c, count(*) AS n, count(*) FILTER (WHERE rate > c) AS k
              FROM (SELECT stratum, rule, doc_id, max(rate) AS rate FROM rates WHERE NOT base_failed AND doc_id IN (SELECT doc_id FROM good) GROUP BY ALL), cuts GROUP BY stratum, rule, i, c),
        lim AS (SELECT {quality_rules.RISK}::DOUBLE / {len(quality_rules.RULES)} AS a, {quality_rules.ERROR}::DOUBLE / greatest(1, count(DISTINCT stratum) * {len(quality_rules.RULES)}) AS d FROM held),
        test AS (SELECT held.*, k < n AND list_sum(list_transform(range(k + 1), lambda j: exp(lgamma(n + 1) - lgamma(j + 1) - lgamma(n - j + 1) + j * ln(a) + (n - j) * ln(1 - a)))) <= d AS ok FROM held, lim),
        chosen AS (SELECT stratum, rule, min(c) AS cutoff FROM (SELECT *, bool_and(ok) OVER (PARTITION BY stratum, rule ORDER BY i) AS so_far FROM test) WHERE so_far GROUP BY ALL),
        fails AS (SELECT DISTINCT r FROM rates JOIN chosen USING (stratum, rule) WHERE rate > cutoff)
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND fails.r IS NULL AS kept
        FROM b LEFT JOIN fails ON b.r = fails.r""",
    "op4_url_filter": f"""
        WITH p AS (SELECT row_number() OVER () AS i, page_id, url, coalesce({_HOST}, '') AS host, coalesce({_PATH}, '') AS path FROM pages),
        r(h, s, action) AS (VALUES {_HOST_RULES}),
        fit AS (SELECT i, h || s AS rule, action, row_number() OVER (PARTITION BY i ORDER BY length(h || s) DESC, h || s DESC) AS k
                FROM p JOIN r ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, s))
        SELECT page_id, host, path, rule, coalesce(action, CASE WHEN {_PATTERNS} THEN 'block' END, 'allow') AS verdict
        FROM p LEFT JOIN fit ON p.i = fit.i AND k = 1""",
    "op9_jaccard_join": rf"""
        WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
        s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
              ELSE list_transform(range(1, len(ws) - 1), lambda i: array_to_string(ws[i:i + 2], ' ')) END) AS g FROM w),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
        h AS (SELECT doc_id, md5(string_agg(g, chr(10) ORDER BY g)) AS h FROM s GROUP BY 1),
        rep AS (SELECT doc_id, min(doc_id) OVER (PARTITION BY h) AS rep FROM h),
        q AS (SELECT s.doc_id, g FROM s JOIN rep ON s.doc_id = rep.doc_id WHERE rep = s.doc_id),
        i AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM q a JOIN q b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
        e AS (SELECT x, y FROM i JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 90 * (a.n + b.n - c)),
        e2 AS (SELECT x, y FROM e UNION ALL SELECT y, x FROM e),
        r(x, y) AS (SELECT DISTINCT rep, rep FROM rep UNION SELECT r.x, e2.y FROM r JOIN e2 ON r.y = e2.x),
        m AS (SELECT x, min(y) AS c FROM r GROUP BY 1)
        SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(m.c, d.doc_id) AS component_id
        FROM documents d LEFT JOIN n ON d.doc_id = n.doc_id LEFT JOIN rep ON d.doc_id = rep.doc_id LEFT JOIN m ON m.x = rep.rep""",
    # CRC-32 byte by byte, its table made by the rule of its polynomial; rendezvous scores from MD5
    "op10_sharding": f"""
        WITH t AS ({_CRC_TABLE}),
        d AS (SELECT coalesce(doc_id::VARCHAR, '(null)') AS k, doc_id, encode(coalesce(text, '')) AS b FROM documents),
        c AS (SELECT k, doc_id, octet_length(b) + 1 AS size,
              {_CRC} AS text_crc32 FROM d, t),
        s AS (SELECT c.*, list_transform(range({SHARDS + 1}), lambda s: -ln((('0x' || left(md5(k || ':' || s), 12))::BIGINT + 0.5::DOUBLE) / 281474976710656.0::DOUBLE)) AS v FROM c),
        g AS (SELECT *, list_position(v[1:{SHARDS}], list_min(v[1:{SHARDS}])) - 1 AS shard, list_position(v, list_min(v)) - 1 AS grown_shard FROM s)
        SELECT doc_id, size, text_crc32, 'key' AS law, shard::INT AS shard,
               row_number() OVER (PARTITION BY shard ORDER BY md5(k), doc_id, text_crc32, size) - 1 AS slot, grown_shard::INT AS grown_shard FROM g""",
    # subtrees by all ancestors of each node's smallest member
    "op11_conversation_trie": f"""
        WITH tab AS ({_CRC_TABLE}),
        y AS (SELECT conv_id AS c, turn, length(coalesce(text, '')) AS n, sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS tok FROM conversations WHERE conv_id IS NOT NULL),
        o AS (SELECT c, n, tok, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, tok) AS p FROM y),
        i AS (SELECT c, encode(c::VARCHAR) AS b FROM (SELECT DISTINCT c FROM o)),
        h AS (SELECT c, {_CRC} % 6 AS h FROM i, tab),
        r AS (SELECT h.c, b.p, b.tok, b.n FROM h JOIN o b ON b.c = h.c - h.c % 100 AND b.p <= h.h
              UNION ALL SELECT o.c, o.p, o.tok, o.n FROM h JOIN o ON o.c = h.c AND o.p > h.h),
        s AS (SELECT c, row_number() OVER (PARTITION BY c ORDER BY p) AS d, tok, n FROM r),
        q AS (SELECT c, d, n, md5(list(tok) OVER (PARTITION BY c ORDER BY d)::VARCHAR) AS k, d = max(d) OVER (PARTITION BY c) AS last FROM s
              UNION ALL SELECT c, 0, 0, '', c NOT IN (SELECT c FROM s) FROM h),
        n AS (SELECT d, k, min(c) AS conv_id, count(*) AS n_convs, max(n) AS n, sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE last), '')) AS ends_sha256 FROM q GROUP BY d, k),
        a AS (SELECT n.d AS below, n.k AS kb, q.d, q.k, n.n_convs, n.n FROM n JOIN q ON q.c = n.conv_id AND q.d <= n.d),
        kids AS (SELECT d, k, count(*) AS n_children FROM a WHERE below = d + 1 GROUP BY d, k),
        leaf AS (SELECT n.d, n.k, kids.n_children IS NULL AS leaf FROM n LEFT JOIN kids USING (d, k)),
        sub AS (SELECT a.d, a.k, sum((n_convs - 1) * n) AS saved_tokens, count(*) FILTER (WHERE leaf) AS n_leaves FROM a JOIN leaf ON a.below = leaf.d AND a.kb = leaf.k GROUP BY a.d, a.k)
        SELECT n.conv_id, n.d AS depth, up.conv_id AS parent_conv_id, n.n_convs, coalesce(n_children, 0) AS n_children, n_leaves, saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
        FROM n JOIN sub USING (d, k) LEFT JOIN kids USING (d, k) LEFT JOIN a ON a.below = n.d AND a.kb = n.k AND a.d = n.d - 1 LEFT JOIN n up ON up.d = a.d AND up.k = a.k""",
    "op12_license_scan": rf"""
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, trim(regexp_replace(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+', ' ', 'g')) AS w FROM documents),
        s(rule, label, level, base, keyword, regex) AS (VALUES {_SIGNATURES}),
        m AS (SELECT r, rule, label, level, base, string_split_regex(p, regex) AS ps, regexp_extract_all(p, regex) AS hs
              FROM (SELECT r, ' ' || w AS w, ' ' || replace(w, ' ', '  ') || ' ' AS p FROM d) JOIN s ON contains(w, keyword)),
        c AS (SELECT *, list_transform(ps, lambda x: (length(x) - length(replace(x, ' ', ''))) // 2) AS pn, list_transform(hs, lambda x: (length(x) - length(replace(x, ' ', ''))) // 2) AS hn FROM m WHERE len(hs) > 0),
        f AS (SELECT r, rule, label, level, base, (list_sum(pn[1:i]) + coalesce(list_sum(hn[1:i - 1]), 0))::BIGINT AS a, a + hn[i] AS z FROM (SELECT *, unnest(range(1, len(hs) + 1)) AS i FROM c)),
        k AS (SELECT * FROM f WHERE base OR NOT EXISTS (SELECT 1 FROM f b WHERE b.r = f.r AND b.a <= f.a AND b.z >= f.z AND b.level <= f.level
              AND (b.level < f.level OR b.a < f.a OR b.z > f.z OR b.rule < f.rule))),
        g AS (SELECT r, count(*) FILTER (WHERE base) AS n_base, min(a) FILTER (WHERE base) AS first_word, max(a) FILTER (WHERE base) AS last_word,
              string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE base) AS base_labels, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, min(level) AS best FROM k GROUP BY r)
        SELECT doc_id, CASE WHEN w = '' THEN 0 ELSE length(w) - length(replace(w, ' ', '')) + 1 END AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
               coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(({list(license_rules.CONFIDENCE)})[best + 1], 0.0)::DOUBLE AS score
        FROM d LEFT JOIN g ON d.r = g.r""",
    "op13_importance_resampling": rf"""
        WITH tab AS ({_CRC_TABLE}),
        d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
        w AS (SELECT r, unnest(ws) AS w FROM d),
        tw AS (SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM benchmark),
        v AS (SELECT w, encode(w) AS b FROM (SELECT w FROM w UNION SELECT w FROM tw)),
        u AS (SELECT w, {_CRC} % {IMPORTANCE.buckets} AS u FROM v, tab),
        s AS (SELECT u, count(*) AS s FROM w JOIN u USING (w) GROUP BY u),
        t AS (SELECT u, count(*) AS t FROM tw JOIN u USING (w) GROUP BY u),
        n AS (SELECT (SELECT coalesce(sum(s), 0) FROM s)::DOUBLE AS ns, (SELECT coalesce(sum(t), 0) FROM t)::DOUBLE AS nt),
        gain AS (SELECT u, floor(1000 * ln(((coalesce(t, 0) + 1)::DOUBLE * (ns + {IMPORTANCE.buckets})) / ((s + 1)::DOUBLE * (nt + {IMPORTANCE.buckets}))))::BIGINT AS g FROM s LEFT JOIN t USING (u), n),
        m AS (SELECT r, floor(sum(g)::DOUBLE / count(*))::BIGINT AS weight FROM w JOIN u USING (w) JOIN gain USING (u) GROUP BY r),
        z AS (SELECT d.r, doc_id, len(ws)::BIGINT AS n_features, coalesce(weight, 0) AS weight,
              floor(-1000 * ln(-ln((('0x' || left(sha256('{IMPORTANCE.seed}:' || coalesce(doc_id::VARCHAR, '')), 8))::BIGINT + 0.5::DOUBLE) / 4294967296.0::DOUBLE)))::BIGINT AS noise FROM d LEFT JOIN m ON d.r = m.r),
        x AS (SELECT r, row_number() OVER (ORDER BY weight + noise DESC, doc_id NULLS FIRST, n_features, weight) AS k, count(*) OVER () AS n FROM z WHERE n_features >= {IMPORTANCE.least_words})
        SELECT doc_id, n_features, weight, weight + noise AS score, CASE WHEN k <= ({IMPORTANCE.percent} * n) // 100 THEN k END AS rank FROM z LEFT JOIN x USING (r)""",
}
