"""License scans by ordered signature rules.

A text's words are runs of letters and digits (every code point from U+0080
on counts as a letter), lower-cased from A to Z.  A rule is a regular
expression over words; hundreds of them are filed under keywords
(``license_rules.py``).  Only texts that hold an anchor, a part of some
keyword, are looked at closer; in these each keyword found fetches its rules,
and only those run.

Every match is a detection: an interval of words.  It is suppressed if an
interval that contains it was found by a rule of the same or of a better
level (of equal intervals: by an earlier rule), so "GNU Lesser General Public
License 2.1" is not also a GPL.  Matches of base phrases are never suppressed.

Rules are configuration, bounded by MAX_RULES; they travel in the plan as one
literal.  All built-in functions; a text is judged in the task that reads it:
no shuffle, and no row is multiplied.  The work of a text grows with its
length times the rules fetched, plus the square of its detections.

Null text: no words.  Repeated rows and ids are judged each by itself, empty
tables give empty results, all columns of the input stay under ``row``.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import whole_row
from .license_rules import CONFIDENCE, Signature
from .url_filter import LOWER, UPPER

MAX_RULES = 5_000
BREAKS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
RULE = "struct<rule:int,label:string,level:int,base:boolean,regex:string>"
FOUND = "struct<start:bigint,stop:bigint,level:int,rule:int,label:string,base:boolean>"


def anchor(keyword: str) -> str:
    """What the first look at a text searches for."""
    return "licen" if "licen" in keyword else keyword


def _index(rules: list[Signature]) -> Column:
    """array<struct<keyword, rules>>, one literal; a rule's place in the list is its order."""
    filed: dict[str, list[dict]] = {}
    for i, r in enumerate(rules):
        filed.setdefault(f" {r.keyword}", []).append({"rule": i, "label": r.label, "level": r.level, "base": r.base, "regex": r.regex()})
    entries = [{"keyword": k, "rules": rs} for k, rs in filed.items()]
    return F.from_json(F.lit(json.dumps(entries)), f"array<struct<keyword:string,rules:array<{RULE}>>>")


def _spaces(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" ")))


def _matches(rule: Column, padded: Column) -> Column:
    """Detections of one rule: words before each match, counted piece by piece."""
    pieces, hits = F.split(padded, rule["regex"], -1), F.regexp_extract_all(padded, rule["regex"], F.lit(0))
    words = F.arrays_zip(F.transform(pieces, _spaces).alias("before"), F.transform(hits, _spaces).alias("size"))
    zero = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(f"array<{FOUND}>").alias("found"))

    def step(state: Column, x: Column) -> Column:
        start = state["at"] + (x["before"] / 2).cast("long")
        stop = start + F.coalesce((x["size"] / 2).cast("long"), F.lit(0))
        one = F.struct(start.alias("start"), stop.alias("stop"), rule["level"].alias("level"), rule["rule"].alias("rule"), rule["label"].alias("label"), rule["base"].alias("base"))
        return F.struct(stop.alias("at"), F.when(x["size"].isNull(), state["found"]).otherwise(F.concat(state["found"], F.array(one))).alias("found"))

    return F.when(F.size(hits) > 0, F.aggregate(words, zero, step, lambda s: s["found"])).otherwise(F.array().cast(f"array<{FOUND}>"))


def unsuppressed(found: Column) -> Column:
    """Detections that stay: a sweep by start keeps, for each level, how far its intervals reach."""
    levels = range(len(CONFIDENCE))
    order = F.array_sort(F.transform(found, lambda d: F.struct(d["start"].alias("start"), (-d["stop"]).alias("back"), d["level"].alias("level"), d["rule"].alias("rule"), d["label"].alias("label"), d["base"].alias("base"))))
    zero = F.struct(*(F.lit(-1).cast("long").alias(f"reach{k}") for k in levels), F.array().cast(f"array<{FOUND}>").alias("kept"))

    def step(state: Column, d: Column) -> Column:
        stop = -d["back"]
        over = F.greatest(*(F.when(d["level"] >= k, state[f"reach{k}"]).otherwise(F.lit(-1)) for k in levels)) >= stop
        one = F.struct(d["start"].alias("start"), stop.alias("stop"), d["level"].alias("level"), d["rule"].alias("rule"), d["label"].alias("label"), d["base"].alias("base"))
        reach = [F.when(d["level"] == k, F.greatest(state[f"reach{k}"], stop)).otherwise(state[f"reach{k}"]).alias(f"reach{k}") for k in levels]
        return F.struct(*reach, F.when(over & ~d["base"], state["kept"]).otherwise(F.concat(state["kept"], F.array(one))).alias("kept"))

    return F.aggregate(order, zero, step, lambda s: s["kept"])


def scan(docs: DataFrame, rules: list[Signature], text_col: str = "text") -> DataFrame:
    """``row`` (all columns), ``n_words`` and ``detections``, an array of (start, stop, level, rule, label, base).

    ``start`` and ``stop`` count words from 0; ``rule`` is the place in ``rules``.
    """
    if len(rules) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rules")
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    words = docs.select(whole_row(docs).alias("row"), F.trim(F.regexp_replace(text, BREAKS, " ")).alias("words"))
    # lower-cases more than A to Z: never loses an anchor of plain letters; a column of its own, made once per text
    words = words.withColumn("low", F.lower("words"))
    seen = F.lit(False)
    for a in sorted({anchor(r.keyword) for r in rules}):
        seen = seen | F.contains(F.col("low"), F.lit(a))
    n_words = F.when(F.col("words") == "", 0).otherwise(_spaces(F.col("words")) + 1)
    near = words.select("row", n_words.cast("long").alias("n_words"), F.when(seen, F.concat(F.lit(" "), F.translate("words", UPPER, LOWER))).alias("words"))
    holds = F.filter(_index(rules), lambda k: F.contains(F.col("words"), k["keyword"]))
    fetched = F.flatten(F.transform(holds, lambda k: k["rules"]))
    close = near.select("row", "n_words", F.concat(F.replace("words", F.lit(" "), F.lit("  ")), F.lit(" ")).alias("padded"), F.when(F.col("words").isNotNull(), fetched).alias("fetched"))
    found = F.flatten(F.transform(F.col("fetched"), lambda r: _matches(r, F.col("padded"))))
    return close.select("row", "n_words", F.coalesce(unsuppressed(found), F.array().cast(f"array<{FOUND}>")).alias("detections"))


def labels(detections: Column) -> Column:
    """Distinct labels in order, joined by commas."""
    return F.array_join(F.array_sort(F.array_distinct(F.transform(detections, lambda d: d["label"]))), ",")


def confidence(detections: Column) -> Column:
    """0 without a detection, else that of the best level found."""
    best = F.array_min(F.transform(detections, lambda d: d["level"]))
    return F.when(best.isNull(), F.lit(0.0)).otherwise(F.element_at(F.array(*map(F.lit, CONFIDENCE)), best + 1))
