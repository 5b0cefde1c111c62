"""URL filters: host rules, and pattern rules indexed by their rarest literal token.

A pattern is literal text with `*` for any run of characters; it must begin and end at a token boundary of the
lower-cased url (tokens are runs of 0-9 and a-z). Each pattern is filed under the one of its whole literal tokens that
occurs least often in the table's urls; a url's tokens fetch candidate patterns, and only these run as regular
expressions. Everything is a column expression, the tables of rules are literals of the plan, and no row is shuffled.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: (verdict, host/path): a rule fits its host and all subdomains where the path starts with the rule's.
HOST_RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]
#: Names and patterns of unwanted urls.
PATTERNS = {
    "betting": "free-bets", "casino": "casino-win", "casino_any": "casino", "poker": "poker-*-bonus", "pills": "cheap-pills",
    "spam_farm": "spam-farm", "ad_tracking": "ads-track", "adult": "adult", "xxx": "xxx", "porn": "porn",
    "torrent": "torrent-download", "warez": "warez", "payday": "payday-loan", "malware": "malware", "phishing": "phish-login",
}


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def pattern_tokens(pattern: str) -> list[str]:
    """Whole literal tokens: those that no `*` can lengthen."""
    return re.findall(r"(?<![0-9a-z*])[0-9a-z]+(?![0-9a-z*])", pattern.lower())


def pattern_regex(pattern: str) -> str:
    """Regular expression of a pattern, in the syntax that Java and RE2 share."""
    body = ".*".join(re.sub(r"([^0-9a-zA-Z])", r"\\\1", part) for part in pattern.lower().split("*"))
    return f"(^|[^0-9a-z]){body}([^0-9a-z]|$)"


def url_tokens(url: Column) -> Column:
    return F.array_distinct(F.split(lower_ascii(url), "[^0-9a-z]+"))


def token_counts(pages: DataFrame, tokens: list[str], url: str = "url") -> dict[str, int]:
    """In how many urls each of the given tokens occurs; one aggregate with a column per token."""
    found = F.array_intersect(url_tokens(F.col(url)), F.array(*map(F.lit, tokens)))
    rows = pages.select(F.explode(found).alias("token")).groupBy("token").count().collect()  # no more rows than tokens
    return dict.fromkeys(tokens, 0) | {r["token"]: r["count"] for r in rows}


def filed(patterns: dict[str, str], counts: dict[str, int]) -> dict[str, list[tuple[str, str]]]:
    """(name, regular expression) of the patterns under their rarest token; ties go to the smaller token."""
    index: dict[str, list[tuple[str, str]]] = {}
    for name, pattern in sorted(patterns.items()):
        token = min(pattern_tokens(pattern), key=lambda t: (counts[t], t))
        index.setdefault(token, []).append((name, pattern_regex(pattern)))
    return index


def _table(entries: dict[str, list[Column]], empty: str) -> Column:
    if not entries:
        return F.from_json(F.lit("{}"), f"map<string,{empty}>")
    return F.create_map(*(x for key, values in sorted(entries.items()) for x in (F.lit(key), F.array(*values))))


def _fetched(keys: Column, table: Column) -> Column:
    return F.flatten(F.transform(F.filter(keys, lambda k: F.map_contains_key(table, k)), lambda k: table[k]))


def judge_urls(pages: DataFrame, id_col: str = "page_id", url: str = "url", host_rules=None, patterns=None) -> DataFrame:
    """page id, host, path, host rule, matched patterns and verdict of every url, one row per row.

    A host rule decides where one fits, the longest if several do; else a matched pattern blocks, else the url is
    allowed. A null url or one without `://` has empty host and path, fits no host rule, and is allowed unless a pattern
    fits; null and repeated ids stay as they are. Further columns are ignored; an empty table gives no rows. A pattern
    without a whole literal token is refused.
    """
    host_rules = HOST_RULES if host_rules is None else host_rules
    patterns = PATTERNS if patterns is None else patterns
    if bare := [name for name, p in patterns.items() if not pattern_tokens(p)]:
        raise ValueError(f"patterns without a whole literal token: {bare}")
    tokens = sorted({t for p in patterns.values() for t in pattern_tokens(p)})
    index = filed(patterns, token_counts(pages, tokens, url) if tokens else {})
    by_token = _table({token: [F.struct(F.lit(n).alias("name"), F.lit(r).alias("regex")) for n, r in rules] for token, rules in index.items()},
                      "array<struct<name:string,regex:string>>")
    hosts: dict[str, list[Column]] = {}
    for verdict, rule in host_rules:
        host, slash, path = rule.partition("/")
        hosts.setdefault(host, []).append(F.struct(
            F.lit(len(rule)).alias("length"), F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"), F.lit(slash + path).alias("path")))
    by_host = _table(hosts, "array<struct<length:int,rule:string,verdict:string,path:string>>")

    text = F.coalesce(F.col(url).cast("string"), F.lit(""))
    rows = pages.select(F.col(id_col).alias("page_id"), text.alias("u"))
    rows = rows.withColumns({
        "host": lower_ascii(F.regexp_extract("u", r"(?s)^.*?://([^/?#]*)", 1)),
        "path": F.regexp_extract("u", r"(?s)^.*?://[^/?#]*([^?#]*)", 1),
        "low": lower_ascii(F.col("u")),
    })
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    best = F.array_max(F.filter(_fetched(suffixes, by_host), lambda r: F.startswith(F.col("path"), r["path"])))
    candidates = _fetched(F.array_distinct(F.split("low", "[^0-9a-z]+")), by_token)
    matched = F.array_sort(F.transform(F.filter(candidates, lambda r: F.regexp(F.col("low"), r["regex"])), lambda r: r["name"]))
    rows = rows.withColumns({"best": best, "matched": matched})
    return rows.select(
        "page_id", "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.when(F.size("matched") > 0, "block").otherwise("allow")).alias("verdict"),
        F.array_join("matched", ",").alias("patterns"),
    )
