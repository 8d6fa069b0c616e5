"""URL filters: pattern rules found through their rarest literal token.

A rule is a host rule (``Rule(action, host="com", path="/fr/")``: the host
and its subdomains, path prefix) or a pattern with the wildcards ``*``
(anything) and ``^`` (one separator or the end), matched anywhere in the URL.
Each rule is filed under the one of its literal tokens that is rarest in
the URLs; the tokens of a URL fetch their rules, and only those run their
regular expression.  A token is a maximal run of letters and digits, in
lower case.

Rules are configuration: their number is bounded by MAX_RULES (an error
beyond it), so the index travels inside the plan as one array literal with a
slot per token hash, and a URL is judged in the task that reads it: no
shuffle, no join, and no row is multiplied.  All built-in functions.

Of the host rules that fit, the longest name decides; failing those, a
fitting pattern decides (block before allow, then by name); failing those,
the default.  Null URLs, or without ``://``: empty host and path, no rule,
the default verdict.  Empty tables give empty results; repeated rows are
judged each by itself; a long URL is judged whole, its candidate rules growing
with its tokens.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_RULES = 5_000
TOKEN = "[a-z0-9]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    action: str
    host: str = ""
    path: str = "/"
    pattern: str = ""

    @property
    def name(self) -> str:
        return self.pattern or self.host + self.path

    def regex(self) -> str:
        """A Java regular expression for the lower-cased URL (pattern) or for host and path (host rule: a host holds no slash)."""
        if not self.pattern:
            return r"^([^/]*\.)?" + re.escape(self.host) + re.escape(self.path)
        text = "".join(".*" if c == "*" else "([^a-z0-9_.%-]|$)" if c == "^" else re.escape(c) for c in self.pattern.lower())
        return "(?s)" + text

    def tokens(self) -> list[str]:
        """Literal tokens that any matching URL has as whole tokens."""
        if not self.pattern:
            return re.findall(TOKEN, self.host.lower())
        p = self.pattern.lower()
        return [m[0] for m in re.finditer(TOKEN, p) if m.start() > 0 and p[m.start() - 1] != "*" and m.end() < len(p) and p[m.end()] != "*"]


def lower(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def host_of(url: Column) -> Column:
    rest = F.substring_index(url, "://", 1)
    after = F.when(F.instr(url, "://") > 0, url.substr(F.length(rest) + 4, F.length(url)))
    return F.coalesce(lower(F.regexp_extract(after, r"^([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    rest = F.substring_index(url, "://", 1)
    after = F.when(F.instr(url, "://") > 0, url.substr(F.length(rest) + 4, F.length(url)))
    return F.coalesce(F.regexp_extract(after, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def tokens_of(url: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(lower(F.coalesce(url, F.lit(""))), F.lit(f"({TOKEN})"), F.lit(1)))


def token_counts(urls: DataFrame, url_col: str, rules: list[Rule]) -> dict[str, int]:
    """In how many URLs each token of the rules occurs: at most one row per token."""
    wanted = sorted({t for r in rules for t in r.tokens()})
    if not wanted:
        return {}
    hits = F.filter(tokens_of(F.col(url_col)), lambda t: t.isin(wanted)) if len(wanted) < 50 else F.array_intersect(tokens_of(F.col(url_col)), F.lit(wanted))
    seen = urls.select(F.explode(hits).alias("t")).groupBy("t").count().collect()
    return {r["t"]: r["count"] for r in seen}


def index_rules(rules: list[Rule], counts: dict[str, int]) -> tuple[list[list[tuple]], list[tuple]]:
    """Slots of (token, rule) by crc32 of the token, and the rules without a literal token."""
    n = 1
    while n < 2 * len(rules):
        n *= 2
    slots: list[list[tuple]] = [[] for _ in range(n)]
    always = []
    for r in rules:
        found = r.tokens()
        entry = (r.regex(), r.name, r.action, not r.pattern)
        if not found:
            always.append(("", *entry))
        else:
            rarest = min(found, key=lambda t: (counts.get(t, 0), -len(t), t))
            slots[zlib.crc32(rarest.encode()) % n].append((rarest, *entry))
    return slots, always


def _entries(items: list[tuple]) -> Column:
    kind = "array<struct<token:string,regex:string,name:string,action:string,host:boolean>>"
    made = [F.struct(*(F.lit(v).alias(k) for k, v in zip(("token", "regex", "name", "action", "host"), x, strict=True))) for x in items]
    return F.array(*made).cast(kind)


def judge(urls: DataFrame, rules: list[Rule], url_col: str = "url", default: str = "allow") -> DataFrame:
    """``urls`` with url_host, url_path, url_rule, url_pattern and url_verdict; all rows stay, and all columns but those of these names, ``__hit`` and ``__pat``."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rules")
    slots, always = index_rules(rules, token_counts(urls, url_col, rules))
    url = F.col(url_col)
    index = F.array(*map(_entries, slots))
    slot = lambda t: F.element_at(index, (F.pmod(F.crc32(t.cast("binary")), F.lit(len(slots))) + 1).cast("int"))
    fetched = F.flatten(F.transform(tokens_of(url), lambda t: F.filter(slot(t), lambda e: e["token"] == t)))
    candidates = F.concat(fetched, _entries(always))
    site = F.concat(host_of(url), path_of(url))
    runs = F.filter(candidates, lambda e: F.when(e["host"], F.regexp_like(site, e["regex"])).otherwise(F.regexp_like(lower(F.coalesce(url, F.lit(""))), e["regex"])))
    # struct order picks the winner: the longest host rule; for patterns block before allow
    hosts = F.array_max(F.transform(F.filter(runs, lambda e: e["host"]), lambda e: F.struct(F.length(e["name"]).alias("n"), e["name"].alias("name"), e["action"].alias("action"))))
    patterns = F.array_max(F.transform(F.filter(runs, lambda e: ~e["host"]), lambda e: F.struct(e["action"].alias("action"), e["name"].alias("name"))))
    judged = urls.withColumns({"__hit": hosts, "__pat": patterns, "url_host": host_of(url), "url_path": path_of(url)})
    return judged.withColumns({
        "url_rule": F.col("__hit.name"),
        "url_pattern": F.when(F.col("__hit").isNull(), F.col("__pat.name")),
        "url_verdict": F.coalesce(F.col("__hit.action"), F.col("__pat.action"), F.lit(default)),
    }).drop("__hit", "__pat")
