"""URL filter: pattern rules indexed by their rarest literal token.

A rule is a regular expression with the literal tokens that any matching URL must contain.  Each rule hangs in the index
under that token which fewest URLs of the table contain; a URL's tokens fetch candidate rules, and only those run.
Rules without a token are candidates for every URL.  Host rules are such rules too: their expression is anchored at the
host, their tokens are the labels and path parts.  Among matching host rules the longest wins; otherwise any matching
pattern rule blocks; otherwise the URL is allowed.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TOKEN = re.compile(r"[a-z0-9]+")


@dataclass(frozen=True)
class UrlRule:
    """text: the rule as shown; verdict: block or allow; pattern: searched in host + path (host rules) or the lower-cased
    URL (pattern rules); tokens: literals, whole tokens of any URL that matches."""

    text: str
    verdict: str
    pattern: str
    tokens: tuple[str, ...]
    on_host: bool = False


def host_rule(verdict: str, host: str, path: str) -> UrlRule:
    """Fits the host and its subdomains where the path begins with `path`; only whole path parts serve as tokens."""
    host = host.lower()
    whole = path if path.endswith("/") else path[: path.rfind("/") + 1]
    return UrlRule(host + path, verdict, rf"^(?:[^/]*\.)?{re.escape(host)}(?={re.escape(path)})", tuple(dict.fromkeys(_TOKEN.findall(host) + (_TOKEN.findall(whole) if whole.isascii() and whole == whole.lower() else []))), True)


HOST_RULES = (host_rule("block", "net", "/"), host_rule("allow", "example.net", "/en/"), host_rule("block", "example.com", "/de/"), host_rule("allow", "org", "/fr/"))

#: Trackers, paged listings and files that are not pages.
PATTERN_RULES = (
    UrlRule("tracking reference", "block", r"[?&]ref=", ("ref",)),
    UrlRule("campaign tag", "block", r"[?&]utm_source=", ("utm", "source")),
    UrlRule("session in query", "block", r"[?&]sessionid=", ("sessionid",)),
    UrlRule("advert path", "block", r"/ads?/(?:click|view)", ()),
    UrlRule("print view", "block", r"/print/[0-9]+", ("print",)),
    UrlRule("deep listing page", "block", r"[?&]page=[0-9]{3,}(?:&|#|$)", ("page",)),
)


def host_of(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end, A-Z lower-cased; empty without ://."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


class RuleIndex:
    """Rules under one token each; `judge` gives (rule, verdict)."""

    def __init__(self, rules: list[UrlRule], chosen: dict[int, str | None]):
        self.by_token: dict[str, list[tuple[UrlRule, re.Pattern]]] = {}
        self.always: list[tuple[UrlRule, re.Pattern]] = []
        for i, r in enumerate(rules):
            entry = (r, re.compile(r.pattern, re.S))
            (self.always if chosen[i] is None else self.by_token.setdefault(chosen[i], [])).append(entry)

    def judge(self, url: str, host: str, path: str) -> tuple[str | None, str]:
        low, place = url.lower(), host + path
        candidates = list(self.always)
        for t in dict.fromkeys(_TOKEN.findall(low)):
            candidates += self.by_token.get(t, ())
        best, blocked = None, False
        for r, p in candidates:
            if r.on_host:
                if (best is None or len(r.text) > len(best.text)) and p.search(place):
                    best = r
            elif not blocked and p.search(low):
                blocked = True
        return (best.text, best.verdict) if best else (None, "block" if blocked else "allow")


def rarest_tokens(urls: DataFrame, rules: list[UrlRule]) -> dict[int, str | None]:
    """For each rule its token that fewest rows hold (ties: the longer, then the smaller); counts only the rules' own tokens."""
    known = sorted({t for r in rules for t in r.tokens})
    found = F.array_intersect(F.regexp_extract_all(F.lower(F.col("url")), F.lit("([a-z0-9]+)"), 1), F.array(*[F.lit(t) for t in known])) if known else F.array().cast("array<string>")
    counts = {r["t"]: r["n"] for r in urls.filter("url is not null").select(F.explode(found).alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most as many rows as the rules have tokens
    return {i: min(r.tokens, key=lambda t: (counts.get(t, 0), -len(t), t)) if r.tokens else None for i, r in enumerate(rules)}


def judge_urls(pages: DataFrame, host_rules=HOST_RULES, pattern_rules=PATTERN_RULES, keep: tuple[str, ...] = ("page_id",)) -> DataFrame:
    """keep columns, then url, host, path, rule (null if no host rule fits) and verdict, for every row.

    Null urls and those without :// have empty host and path and get the pattern rules' verdict on what text there is.
    """
    rules = [*host_rules, *pattern_rules]
    chosen = rarest_tokens(pages.select("url"), rules)
    rows = pages.select(*keep, "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = RuleIndex(rules, chosen)
        for b in batches:
            urls, hosts, paths = (b.column(c).to_pylist() for c in ("url", "host", "path"))
            said = [index.judge(u or "", h, p) for u, h, p in zip(urls, hosts, paths, strict=True)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([x[0] for x in said], pa.string()), pa.array([x[1] for x in said], pa.string())], names=[*b.schema.names, "rule", "verdict"])

    schema = T.StructType([*rows.schema.fields, T.StructField("rule", T.StringType()), T.StructField("verdict", T.StringType())])
    return rows.mapInArrow(judged, schema)
