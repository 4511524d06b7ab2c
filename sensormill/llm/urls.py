"""URL filter: host rules first, then a weighted vocabulary searched by an Aho-Corasick automaton.

The automaton reads the whole url with A-Z lower-cased. A term counts where no ASCII letter or digit touches it on
either side. One strict term, or ``SOFT_LIMIT`` different soft terms, reject the url.

Rules are pairs (verdict, pattern); a pattern is a host, a slash and the begin of a path. A rule fits its host and all
subdomains if the url's path starts with the rule's; the longest pattern wins, and its verdict overrides the vocabulary.

NULL urls and urls without ``://`` have an empty host and path, fit no rule and are judged by their text (NULL: none,
so allow). Rows are judged one by one: repeated rows give repeated rows, and other columns are ignored.
"""

from __future__ import annotations

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RULES = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)
STRICT = ("adult", "porn", "porno", "xxx", "casino", "casinos", "escort", "escorts", "viagra", "cialis", "hentai", "warez")
SOFT = (
    "ad", "ads", "bet", "bets", "bonus", "cheap", "click", "crack", "deal", "deals", "farm", "free", "keygen", "loan",
    "loans", "lottery", "pill", "pills", "poker", "prize", "sex", "slots", "spam", "torrent", "track", "tracker", "win",
)
SOFT_LIMIT = 2
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORD = frozenset("0123456789" + _LOWER)


def host_of(url: Column) -> Column:
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(rest, _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: tuple[tuple[str, str], ...]) -> tuple[Column, Column]:
    """(pattern, verdict) of the longest rule that fits, else NULL."""
    pattern, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for decision, text in sorted(rules, key=lambda r: len(r[1])):
        own_host, _, own_path = text.partition("/")
        fits = ((host == own_host) | host.endswith("." + own_host)) & path.startswith("/" + own_path)
        pattern = F.when(fits, F.lit(text)).otherwise(pattern)
        verdict = F.when(fits, F.lit(decision)).otherwise(verdict)
    return pattern, verdict


def automaton(strict: tuple[str, ...], soft: tuple[str, ...]) -> ahocorasick.Automaton:
    out = ahocorasick.Automaton()
    for number, term in enumerate((*strict, *soft)):
        out.add_word(term, (number, len(term), number < len(strict)))
    out.make_automaton()
    return out


def hits(terms: ahocorasick.Automaton, text: str) -> tuple[int, int]:
    """Strict hits, and different soft terms hit."""
    strict, soft = 0, set()
    for last, (number, length, is_strict) in terms.iter(text):
        before, after = text[last - length : last - length + 1] if last >= length else "", text[last + 1 : last + 2]
        if before not in _WORD and after not in _WORD:
            if is_strict:
                strict += 1
            else:
                soft.add(number)
    return strict, len(soft)


def judge(pages: DataFrame, rules=RULES, strict=STRICT, soft=SOFT, soft_limit: int = SOFT_LIMIT) -> DataFrame:
    """page_id, host, path, rule, verdict, n_strict, n_soft for every row."""

    @F.pandas_udf("n_strict int, n_soft int")
    def count(urls: pd.Series) -> pd.DataFrame:
        terms = automaton(strict, soft)
        found = [hits(terms, u) for u in urls]
        return pd.DataFrame({"n_strict": [s for s, _ in found], "n_soft": [t for _, t in found]}, dtype="int32")

    host, path = host_of(F.col("url")), path_of(F.col("url"))
    rows = pages.select("page_id", "url", host.alias("host"), path.alias("path"))
    counted = rows.withColumn("hits", count(F.translate(F.coalesce("url", F.lit("")), _UPPER, _LOWER)))
    pattern, verdict = rule_of(F.col("host"), F.col("path"), rules)
    bad = (F.col("hits.n_strict") > 0) | (F.col("hits.n_soft") >= soft_limit)
    own = F.when(bad, F.lit("block")).otherwise(F.lit("allow"))
    return counted.select(
        "page_id", "host", "path", pattern.alias("rule"), F.coalesce(verdict, own).alias("verdict"), "hits.n_strict", "hits.n_soft"
    )
