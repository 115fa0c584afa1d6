"""URL filtering with pattern rules indexed by their rarest literal token.

A pattern rule is a regular expression over the whole lower-cased URL together
with the literal tokens (``[a-z0-9]+`` runs) that any match must contain as whole
tokens of the URL.  Token frequencies are counted over all URLs; each rule is
filed under its rarest token.  A URL's tokens fetch candidate rules from that
index, and only candidates run their expression.  Host/path rules (`net/`,
`example.com/de/`) are pattern rules too: they fit a host and its subdomains when
the URL's path starts with the rule's.

Verdict: the longest fitting host/path rule decides (a tie goes to the first in
code point order); without one, a fitting pattern rule blocks, else the URL is
allowed.

Edge cases: a null URL or one without ``://`` has an empty host and path, no host
rule, and no pattern rule; a rule without literal tokens is tried on every URL;
repeated rows are judged one by one; an empty table gives no rows; input columns
other than the id and URL are ignored.
"""
from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crease.llm.common import ship

TOKEN = re.compile(r"[a-z0-9]+")
HOST_PATH = re.compile(r"://([^/?#]*)([^?#]*)")
ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@dataclass(frozen=True)
class Rule:
    """``site``: host/path of a host rule, else None; ``pattern`` is searched in
    the URL (lower case; for host rules in ``host`` + ``path``)."""
    pattern: str
    tokens: tuple[str, ...]
    action: str
    site: str | None = None


def host_rule(site: str, action: str) -> Rule:
    """A rule for a host, its subdomains and a path prefix.

    Tokens come from the host alone: the path prefix may end inside a token.
    """
    host, _, path = site.partition("/")
    pattern = r"^(?:[^/]*\.)?" + re.escape(host) + "(?=" + re.escape("/" + path) + ")"
    return Rule(pattern, tuple(TOKEN.findall(host)), action, site)


def block_words(*words: str) -> Rule:
    """Block URLs that hold these words as whole tokens, one after another."""
    return Rule(r"(?<![a-z0-9])" + r"[^a-z0-9]+".join(map(re.escape, words)) + r"(?![a-z0-9])",
                words, "block")


# The rules of the contract, and the pattern rules of this method.
SITE_RULES = (host_rule("net/", "block"), host_rule("example.net/en/", "allow"),
              host_rule("example.com/de/", "block"), host_rule("org/fr/", "allow"))
PATTERN_RULES = (
    block_words("spam", "farm"), block_words("cheap", "pills"), block_words("casino"),
    block_words("adult"), block_words("xxx"), block_words("porn"), block_words("viagra"),
    block_words("free", "download"), block_words("click", "bait"), block_words("doubleclick"),
)
RULES = SITE_RULES + PATTERN_RULES


def url_parts(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path; both empty without ``://``."""
    m = HOST_PATH.search(url or "")
    return (m[1].translate(ASCII_LOWER), m[2]) if m else ("", "")


def token_frequencies(urls: DataFrame, rules: tuple[Rule, ...]) -> dict[str, int]:
    """In how many URLs each token of the rules occurs (a row a rule token at most)."""
    ship(urls.sparkSession)
    wanted = {t for r in rules for t in r.tokens}

    def count(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for part in parts:
            for url in part.column(0):
                seen.update(wanted.intersection(
                    TOKEN.findall((url.as_py() or "").translate(ASCII_LOWER))))
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()),
                                          pa.array(list(seen.values()), pa.int64())], ["token", "n"])

    rows = (urls.select("url").mapInArrow(count, "token string, n long")
            .groupBy("token").agg(F.sum("n").alias("n")).collect())
    return {r["token"]: r["n"] for r in rows}


class RuleIndex:
    """Candidate rules by their rarest token."""

    def __init__(self, rules: tuple[Rule, ...], frequencies: dict[str, int]):
        self.by_token: dict[str, list[tuple[Rule, re.Pattern]]] = {}
        self.always: list[tuple[Rule, re.Pattern]] = []
        for r in rules:
            entry = (r, re.compile(r.pattern))
            if r.tokens:
                rarest = min(r.tokens, key=lambda t: (frequencies.get(t, 0), t))
                self.by_token.setdefault(rarest, []).append(entry)
            else:
                self.always.append(entry)

    def judge(self, url: str | None) -> tuple[str, str, str | None, str]:
        """host, path, host rule or None, verdict."""
        host, path = url_parts(url)
        if "://" not in (url or ""):
            return host, path, None, "allow"
        lower = url.translate(ASCII_LOWER)
        best, verdict = None, "allow"
        tokens = set(TOKEN.findall(lower))
        for t in tokens & self.by_token.keys() | {""}:
            for rule, pattern in self.by_token[t] if t else self.always:
                if rule.site is None:
                    if best is None and verdict == "allow" and pattern.search(lower):
                        verdict = rule.action
                elif (best is None or (-len(rule.site), rule.site) < (-len(best.site), best.site)) \
                        and pattern.search(host + path):
                    best = rule
        return host, path, best and best.site, best.action if best else verdict


def judge_urls(pages: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """page_id, host, path, rule, verdict of every row."""
    index = RuleIndex(rules, token_frequencies(pages, rules))

    def run(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            rows = [index.judge(u.as_py()) for u in part.column(1)]
            cols = list(zip(*rows)) if rows else [()] * 4
            yield pa.RecordBatch.from_arrays(
                [part.column(0), *[pa.array(c, pa.string()) for c in cols]],
                ["page_id", "host", "path", "rule", "verdict"])

    return (pages.select(F.col("page_id").cast("long").alias("page_id"), "url")
            .mapInArrow(run, "page_id long, host string, path string, rule string, verdict string"))
