"""URL rules fetched by their rarest literal token.

A rule is a regular expression over ``host + path`` with the literal tokens that every url it fits must contain.
How often each of these tokens occurs in the urls is counted first; a rule is then filed under its rarest one, so
that a url fetches few rules: those filed under one of its own tokens. Only these run their expression.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterable
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heliogrid.session import may_broadcast

TOKEN = r"[0-9A-Za-z]+"
KEY, JUDGED = "url_key", "url_judged"  # working columns, not returned


@dataclass(frozen=True)
class UrlRule:
    """``text`` names the rule; the longest text that fits wins, then the smallest."""

    text: str
    verdict: str
    pattern: str
    tokens: tuple[str, ...]


def host_rule(text: str, verdict: str) -> UrlRule:
    """A rule ``host/path``: fits the host and its subdomains where the url's path starts with ``/path``."""
    host, slash, path = text.partition("/")
    if not host or not slash:
        raise ValueError(f"{text!r} is not of the form host/path")
    # The last token of the path may go on in the url, unless something follows it in the rule.
    words = [m[0] for m in re.finditer(TOKEN, text) if m.end() < len(text)]
    return UrlRule(text, verdict, rf"(?s)(?:[^/]*\.)?{re.escape(text)}", tuple(dict.fromkeys(words)))


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null and for urls without ``://``."""
    body = F.coalesce(url, F.lit(""))
    rest = F.regexp_extract(body, r"(?s)^.*?://(.*)$", 1)
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def _rarest(urls: DataFrame, rules: Iterable[UrlRule]) -> dict[str, str]:
    """For each rule the token that the fewest urls have; what comes back is one count per token of the rules."""
    rules = list(rules)
    wanted = sorted({t for r in rules for t in r.tokens})
    spark = urls.sparkSession
    words = F.regexp_extract_all(F.col(KEY), F.lit(f"({TOKEN})"), 1)
    tokens = spark.createDataFrame([(t,) for t in wanted], "token string")
    counts = urls.select(F.explode(F.array_distinct(words)).alias("token")).join(tokens, "token", "left_semi").groupBy("token").count()
    n = {r["token"]: r["count"] for r in counts.collect()}
    return {r.text: min(r.tokens, key=lambda t: (n.get(t, 0), t)) for r in rules if r.tokens}


def _judge_by_index(rules: list[UrlRule], rarest: dict[str, str]):
    index = defaultdict(list)
    for r in rules:
        index[rarest.get(r.text)].append((-len(r.text), r.text, r.verdict, r.pattern))
    index = dict(index)
    compiled: dict[str, re.Pattern] = {}

    def judge(key: str) -> tuple[str | None, str | None]:
        found = list(index.get(None, ()))
        for token in set(re.findall(TOKEN, key)):
            found += index.get(token, ())
        for _, text, verdict, pattern in sorted(found):
            expression = compiled.get(pattern) or compiled.setdefault(pattern, re.compile(pattern))
            if expression.match(key):
                return text, verdict
        return None, None

    @F.pandas_udf("struct<rule: string, verdict: string>")
    def run(keys: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([judge(k) for k in keys], columns=["rule", "verdict"], dtype=object)

    return run


def _judge_by_join(urls: DataFrame, rules: list[UrlRule], rarest: dict[str, str]) -> DataFrame:
    """The same for rule sets too large to send to every task: tokens meet the index in a join.

    Rules without a token are met by every url, so there may be only as many as fit a task.
    """
    spark = urls.sparkSession
    kind = "token string, rule string, rule_verdict string, pattern string"
    filed = spark.createDataFrame([(rarest[r.text], r.text, r.verdict, r.pattern) for r in rules if r.text in rarest], kind)
    tokens = F.array_distinct(F.regexp_extract_all(F.col(KEY), F.lit(f"({TOKEN})"), 1))
    # A key meets a rule once: distinct keys only, and each rule is filed under one token.
    met = urls.select(KEY).distinct().withColumn("token", F.explode(tokens)).join(filed, "token")
    met = met.filter(F.expr("url_key rlike concat('^', pattern)")).drop("token", "pattern")
    for r in rules:
        if r.text not in rarest:
            fits = urls.select(KEY).distinct().filter(F.col(KEY).rlike("^" + r.pattern))
            met = met.unionByName(fits.select(KEY, F.lit(r.text).alias("rule"), F.lit(r.verdict).alias("rule_verdict")))
    best = met.groupBy(KEY).agg(F.min(F.struct((-F.length("rule")).alias("l"), "rule", "rule_verdict")).alias("b"))
    best = best.select(KEY, F.struct(F.col("b.rule").alias("rule"), F.col("b.rule_verdict").alias("verdict")).alias(JUDGED))
    return urls.join(best, KEY, "left")


def filter_urls(pages: DataFrame, rules: Iterable[UrlRule], url: str = "url", default: str = "allow", by_join: bool | None = None) -> DataFrame:
    """``pages`` with host, path, rule and verdict of each url; no row is dropped.

    The longest rule that fits decides; without one, rule is null and the verdict is ``default``. Null urls and urls
    without ``://`` have an empty host and path and fit no host rule. Columns of ``pages`` named like the four
    results are replaced; url_key and url_judged may not occur. ``by_join`` is chosen by the measured size of the rules if not given.
    """
    rules = list({r.text: r for r in rules}.values())
    host, path = split_url(F.col(f"`{url}`"))
    plain = pages.select(*[F.col(f"`{c}`") for c in pages.columns if c not in ("host", "path", "rule", "verdict")], host.alias("host"), path.alias("path"))
    urls = plain.withColumn(KEY, F.concat("host", "path"))
    rarest = _rarest(urls, rules)
    if by_join is None:
        by_join = not may_broadcast(sum(len(r.text) + len(r.pattern) for r in rules))
    urls = _judge_by_join(urls, rules, rarest) if by_join else urls.withColumn(JUDGED, _judge_by_index(rules, rarest)(KEY))
    return urls.withColumns({"rule": F.col(f"{JUDGED}.rule"), "verdict": F.coalesce(f"{JUDGED}.verdict", F.lit(default))}).drop(KEY, JUDGED)
