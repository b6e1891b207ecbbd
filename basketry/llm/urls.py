"""URL filters: rules by host and path, then a blocked Bloom filter and an exact join for listed URLs.

A URL's canonical form is what differing spellings of a page share: host without ``www.`` or a
default port, path without a closing slash, query without tracking parameters and in sorted order;
scheme and fragment go. Listed URLs are turned into a blocked Bloom filter of fixed size that is
broadcast. URLs that it rules out are done; the few others are joined with the list itself, which
takes out false positives.

A null URL, or one without ``://``, has an empty host and path, fits no rule and is in no list.
Repeated URLs get equal verdicts; an empty list blocks nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from basketry.llm import bloom
from basketry.llm.tables import stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TRACKING = "^(utm_[a-z]*|ref|fbclid|gclid)(=|$)"

# Fixed values: (verdict, host, path) of the query's rules, and the labels of listed hosts.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
LISTED_LABELS = ("ads-track", "casino-win", "cheap-pills", "free-bets", "spam-farm")


def with_parts(pages: DataFrame) -> DataFrame:
    """Adds ``host``, ``path`` and ``query``; ``pages`` has a column ``url``."""
    at = F.instr("url", "://")
    rest = F.when(at > 0, F.substring(F.col("url"), at + 3, F.length("url"))).otherwise("")
    host = F.regexp_extract(F.coalesce(rest, F.lit("")), "^[^/?#]*", 0)
    out = pages.withColumn("_rest", F.coalesce(rest, F.lit(""))).withColumn("host", host)
    after = F.substring(F.col("_rest"), F.length("host") + 1, F.length("_rest"))
    out = out.withColumn("path", F.regexp_extract(after, "^[^?#]*", 0))
    query = F.regexp_extract(after, r"^[^?#]*\?([^#]*)", 1)
    out = out.withColumn("query", query)
    return out.withColumn("host", F.translate("host", UPPER, LOWER)).drop("_rest")


def canonical() -> Column:
    """Canonical form from host, path and query; null without a host."""
    host = F.regexp_replace(F.regexp_replace("host", "^www[.]", ""), ":(80|443)?$", "")
    path = F.regexp_replace("path", "/+$", "")
    terms = F.filter(F.split("query", "&"), lambda t: (t != "") & ~t.rlike(TRACKING))
    query = F.array_join(F.array_sort(terms), "&")
    form = F.concat(host, path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""))
    return F.when(F.col("host") != "", form)


def _fits(host: str, path: str) -> Column:
    own = (F.col("host") == host) | F.col("host").endswith("." + host)
    return own & F.col("path").startswith(path)


def rule_columns(rules) -> tuple[Column, Column]:
    """(rule, its verdict) of the longest rule that fits; of equally long ones a block wins, then text order."""
    ranked = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[0] != "block", r[1] + r[2]))
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, host, path in reversed(ranked):
        rule = F.when(_fits(host, path), F.lit(host + path)).otherwise(rule)
        verdict = F.when(_fits(host, path), F.lit(kind)).otherwise(verdict)
    return rule, verdict


def filter_urls(pages: DataFrame, listed: DataFrame, rules=RULES, keep: list[str] = ("page_id",), blocks: int = bloom.BLOCKS) -> DataFrame:
    """The columns ``keep`` with ``host``, ``path``, ``rule``, ``listed`` and ``verdict`` for every row.

    ``listed`` has a column ``url`` of URLs to block.
    """
    spark = pages.sparkSession
    names = with_parts(listed.select("url")).select(canonical().alias("canonical")).where("canonical IS NOT NULL")
    names = stored(names.distinct().withColumn("key", F.xxhash64("canonical")), "listed-urls")
    words = bloom.build(names, "key", blocks)
    rule, verdict = rule_columns(rules)
    parts = with_parts(pages.select(*(F.col(c).alias(f"kept_{c}") for c in keep), F.col("url").cast("string").alias("url")))
    parts = parts.withColumn("canonical", canonical()).withColumn("rule", rule).withColumn("verdict", verdict)
    possible = bloom.may_contain(spark, words, F.xxhash64("canonical")) & F.col("canonical").isNotNull()
    probed = parts.withColumn("possible", possible)
    exact = names.select("canonical", F.lit(True).alias("listed"))
    hits = probed.where("possible").join(exact, "canonical", "left").withColumn("listed", F.coalesce("listed", F.lit(False)))
    misses = probed.where("NOT possible").withColumn("listed", F.lit(False))
    own = F.when(F.col("listed"), "block").otherwise("allow")
    return hits.unionByName(misses).select(
        *(F.col(f"kept_{c}").alias(c) for c in keep),
        "host",
        "path",
        "rule",
        F.coalesce("verdict", own).alias("verdict"),
        "listed",
    )


def listed_pages(pages: DataFrame, labels=LISTED_LABELS) -> DataFrame:
    """The list of the query: URLs of pages on hosts with one of the listed labels."""
    label = F.arrays_overlap(F.split("host", "[.]"), F.array(*map(F.lit, labels)))
    return with_parts(pages.select("url")).where(label).select("url")
