"""URL filtering by host/path rules and by a list of canonical URLs.

The list is first folded into a blocked Bloom filter kept as a table: one row
per 256-bit block (four 64-bit words, two bits set in each by every key). A
page probes the one block its URL hashes to; only pages that pass go on to an
exact hash join with the list, which removes false positives. Everything is a
DataFrame expression.

Defined results: a null url, or one without ``://``, has empty host and path,
fits no rule and is allowed; an empty list lets everything pass; repeated rows
are judged alike and all kept; an empty table gives an empty result. Extra
columns of the input are not carried.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower

RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]

#: Bits of filter for each listed URL; 16 give about one false positive in 500.
BITS_PER_KEY = 16
#: A filter of at most this many bytes is broadcast, a larger one is joined by shuffle.
BROADCAST_BYTES = 8 << 20
_ROW_BYTES = 48


def split_url(url: Column) -> tuple[Column, Column]:
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    text = F.coalesce(url, F.lit(""))
    return ascii_lower(F.regexp_extract(text, pattern, 1)), F.regexp_extract(text, pattern, 2)


def canonical(host: Column, path: Column) -> Column:
    """Host without a leading ``www.``, path without trailing slashes; scheme, query and fragment go."""
    return F.concat(F.regexp_replace(host, r"^www\.", ""), F.regexp_replace(path, r"/+$", ""))


def match_rules(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest fitting rule, nulls where none fits."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, h + p).otherwise(rule), F.when(fits, what).otherwise(verdict)
    return rule, verdict


def _masks(key: Column) -> list[Column]:
    """Four words with two bits each, from an independent second hash."""
    h = F.xxhash64(F.lit("bloom"), key)

    def bit(i: int) -> Column:
        return F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftright(h, i).bitwiseAND(63).cast("int"))

    return [bit(12 * w).bitwiseOR(bit(12 * w + 6)) for w in range(4)]


def build_filter(listed: DataFrame) -> tuple[DataFrame, int]:
    """The filter of a one-column (``canon``) table of distinct keys, and its number of blocks."""
    n = listed.count()
    blocks = max(1, 1 << max(0, (max(1, n) * BITS_PER_KEY - 1) // 256).bit_length())
    m = _masks(F.col("canon"))
    keyed = listed.select(F.pmod(F.xxhash64("canon"), F.lit(blocks)).alias("block"), *[x.alias(f"w{i}") for i, x in enumerate(m)])
    return keyed.groupBy("block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(4)]), blocks


def judge(pages: DataFrame, listed: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES) -> DataFrame:
    """id, host, path, rule, verdict, canonical and ``listed`` for each row of ``pages``.

    ``listed`` has one string column of canonical URLs; nulls and repeats in it are ignored.
    """
    listed = listed.select(F.col(listed.columns[0]).cast("string").alias("canon")).filter("canon is not null").distinct()
    host, path = split_url(F.col(url_col))
    rows = pages.select(F.col(id_col), host.alias("host"), path.alias("path"))
    rows = rows.withColumn("canon", canonical(F.col("host"), F.col("path")))
    rule, verdict = match_rules(F.col("host"), F.col("path"), rules)
    rows = rows.withColumns({"rule": rule, "rule_verdict": verdict})

    bloom, blocks = build_filter(listed)
    bloom = F.broadcast(bloom) if blocks * _ROW_BYTES <= BROADCAST_BYTES else bloom
    probed = rows.withColumn("block", F.pmod(F.xxhash64("canon"), F.lit(blocks))).join(bloom, "block", "left")
    passed = F.lit(True)
    for i, m in enumerate(_masks(F.col("canon"))):
        passed = passed & (F.col(f"w{i}").bitwiseAND(m) == m)
    probed = probed.withColumn("passed", F.coalesce(passed, F.lit(False)))

    exact = listed.withColumn("hit", F.lit(True)).hint("shuffle_hash")
    possible = probed.filter("passed").join(exact, "canon", "left")
    rest = probed.filter("not passed").withColumn("hit", F.lit(None).cast("boolean"))
    out = possible.unionByName(rest).withColumn("listed", F.coalesce("hit", F.lit(False)))
    method = F.when(F.col("listed"), "block").otherwise("allow")
    return out.select(F.col(id_col), "host", "path", "rule", F.coalesce("rule_verdict", method).alias("verdict"), "canon", "listed", F.col("passed").alias("possible"))


#: Name part of the hosts whose pages make up the list that the query filters by.
FEED_HOSTS = ["ads-track", "spam-farm", "casino-win", "adult-x", "cheap-pills", "free-bets"]


def host_feed(pages: DataFrame, names=FEED_HOSTS) -> DataFrame:
    """The list used by the query: canonical URLs of all pages on hosts with a listed name part."""
    host, path = split_url(F.col("url"))
    return pages.select(host.alias("h"), path.alias("p")).filter(F.col("h").rlike(r"(^|\.)(" + "|".join(names) + r")\.")).select(canonical(F.col("h"), F.col("p")).alias("canon"))


def query(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return judge(pages, host_feed(pages)).select("page_id", "host", "path", "rule", "verdict", "canon", "listed")


_HOST = r"translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_PATH = r"regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2)"
ORACLE = f"""
WITH u AS (SELECT page_id, {_HOST} AS host, {_PATH} AS path FROM pages),
c AS (SELECT *, regexp_replace(host, '^www\\.', '') || regexp_replace(path, '/+$', '') AS canon FROM u),
l AS (SELECT DISTINCT canon FROM c WHERE regexp_matches(host, '(^|\\.)(ads-track|spam-farm|casino-win|adult-x|cheap-pills|free-bets)\\.')),
r AS (SELECT *, CASE
  WHEN (host = 'www.example.com' OR host LIKE '%.www.example.com') AND starts_with(path, '/en/') THEN 'www.example.com/en/'
  WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/en/') THEN 'example.com/en/'
  WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/es/') THEN 'net/es/'
  WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/fr/') THEN 'net/fr/'
  WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/') THEN 'com/' END AS rule,
  canon IN (SELECT canon FROM l) AS listed FROM c)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
       WHEN listed THEN 'block' ELSE 'allow' END AS verdict, canon, listed FROM r
"""
