"""URL filter: host and path rules, else a weighted vocabulary.

Terms are looked for in the lower-cased URL by one Aho-Corasick automaton; a hit counts where no letter or digit
stands on either side. A URL is blocked for one strict term or for ``min_soft`` distinct soft ones.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairforge.llm.words import LOWER, UPPER

STRICT = ("porn", "xxx", "adult", "casino", "viagra", "escort", "spam", "warez", "malware", "phishing")
SOFT = ("ads", "bet", "bets", "bonus", "cheap", "click", "crack", "deal", "farm", "free", "loan", "pills", "poker", "promo", "track", "win")
MIN_SOFT = 2
#: (verdict, host, path), fixed by the contract
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER.decode(), LOWER.decode())


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host after the first ``://`` up to ``/ ? #`` or the end, A-Z lower-cased; path then up to ``? #`` or the end.

    Both are empty for null or without ``://``."""
    parts = "(?s)^.*?://([^/?#]*)([^?#]*)"
    known = F.coalesce(url, F.lit(""))
    return lower_ascii(F.regexp_extract(known, parts, 1)), F.regexp_extract(known, parts, 2)


def longest_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> Column:
    """``struct<rule, verdict>`` of the longest rule that fits, null if none does. Rules are a parameter, few and fixed."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule_host, rule_path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        found = F.when(fits, F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def _plain(char: str) -> bool:
    return "a" <= char <= "z" or "0" <= char <= "9"


def count_terms(url: str, terms: ahocorasick.Automaton) -> tuple[int, set[str]]:
    """Number of strict hits and the distinct soft terms of a lower-cased URL."""
    strict, soft = 0, set()
    for end, (term, is_strict) in terms.iter(url):
        start = end - len(term) + 1
        if (start and _plain(url[start - 1])) or (end + 1 < len(url) and _plain(url[end + 1])):
            continue
        if is_strict:
            strict += 1
        else:
            soft.add(term)
    return strict, soft


def _scan(strict: Sequence[str], soft: Sequence[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = ahocorasick.Automaton()
        for kind, words in ((False, soft), (True, strict)):
            for word in words:
                terms.add_word(word, (word, kind))
        terms.make_automaton()
        for batch in batches:
            hits = [count_terms(url or "", terms) for url in batch.column("low").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array([h[0] for h in hits], pa.int64()), pa.array([len(h[1]) for h in hits], pa.int64())],
                names=["row", "n_strict", "n_soft"],
            )

    return run


def judge_urls(
    pages: DataFrame,
    key: str = "page_id",
    rules: Sequence[tuple[str, str, str]] = RULES,
    strict: Sequence[str] = STRICT,
    soft: Sequence[str] = SOFT,
    min_soft: int = MIN_SOFT,
) -> DataFrame:
    """``(key, host, path, rule, verdict, n_strict, n_soft)`` of ``pages(key, url, ...)``, one row per input row.

    ``verdict`` is the longest fitting rule's, else ``block`` by the vocabulary, else ``allow``. A null or empty URL
    has no host, fits no rule and is allowed. Other columns are ignored. A word in both lists is strict.
    """
    host, path = host_and_path(F.col("url"))
    parsed = pages.select(
        F.struct(F.col(key).alias("key"), host.alias("host"), path.alias("path")).alias("row"), lower_ascii(F.col("url")).alias("low")
    )
    counts = [T.StructField(n, T.LongType()) for n in ("n_strict", "n_soft")]
    found = parsed.mapInArrow(_scan(strict, soft), T.StructType([parsed.schema["row"], *counts]))
    best = longest_rule(F.col("row.host"), F.col("row.path"), rules)
    bad = (F.col("n_strict") > 0) | (F.col("n_soft") >= min_soft)
    return found.withColumn("best", best).select(
        F.col("row.key").alias(key), "row.host", "row.path", F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.when(bad, "block").otherwise("allow")).alias("verdict"), "n_strict", "n_soft",
    )
