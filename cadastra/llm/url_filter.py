"""URL filter: a blocked Bloom filter of listed canonical URL prefixes, then an exact hash join.

A rule is a host with a path prefix and an action. It fits a URL whose host is the rule's host or one of its subdomains
and whose path starts with the rule's path; of several, the longest rule wins (then the longer host, then the rule in
code point order, then block before allow).

Each URL yields one key for every (host labels, path length) shape that the rules have. The Bloom filter, an array of
64-bit blocks with four bits set for each rule, is the bounded part that goes to all tasks: its size follows the number
of rules up to max_blocks, beyond which it only lets more keys pass. What passes is joined with the rules exactly, once
for each different (host, path), so repeated URLs and hot hosts cost one lookup for each different address.
"""

from __future__ import annotations

import string

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bloom import MOST_BLOCKS, blocks_for, bloom, may_hold
from .common import table

RULES = [
    ("com", "/en/", "block"),
    ("example.com", "/en/7", "allow"),
    ("net", "/de/", "allow"),
    ("example.net", "/de/8", "block"),
    ("org", "/es/", "block"),
]
_ADDRESS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def canonical(url: F.Column) -> tuple[F.Column, F.Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty if it is null or has no '://'."""
    url = F.coalesce(url, F.lit(""))
    host = F.translate(F.regexp_extract(url, _ADDRESS, 1), string.ascii_uppercase, string.ascii_lowercase)
    return host, F.regexp_extract(url, _ADDRESS, 2)


def url_filter(pages: DataFrame, rules: DataFrame, url: str = "url", max_blocks: int = MOST_BLOCKS) -> DataFrame:
    """Rows of pages with host, path, rule and verdict; other columns of those names are replaced, and one named _apart is lost.

    rules: host, path, action. Null or malformed URLs have empty host and path, no rule and verdict allow, as have all
    URLs that no rule fits. Repeated rows stay; empty inputs give empty results; no rules, all allow."""
    rules = rules.select(
        F.concat("host", F.lit("\n"), "path").alias("key"), F.concat("host", "path").alias("rule"), F.length(F.concat("host", "path")).alias("n"),
        F.length("host").alias("n_host"), (F.size(F.split("host", r"\.")) * 100_000 + F.length("path")).alias("shape"), F.col("action"),
    )
    counted = rules.agg(F.count("*").alias("n"), F.sort_array(F.collect_set("shape")).alias("shapes")).first()
    blocks = blocks_for(counted["n"], max_blocks)
    host, path = canonical(F.col(url))
    judged = pages.drop("host", "path", "rule", "verdict").withColumns({"host": host, "path": path})
    columns = judged.columns
    # Addresses without host match nothing; the number of their partition keeps them from meeting in one task.
    judged = judged.withColumn("_apart", F.when(F.col("host") == "", F.spark_partition_id() + 1).otherwise(0))
    addresses = judged.select("host", "path").where("host != ''").distinct()
    labels = F.split("host", r"\.")
    keys = [
        F.when(
            (F.size(labels) >= shape // 100_000) & (F.length("path") >= shape % 100_000),
            F.concat(F.array_join(F.slice(labels, -(shape // 100_000), shape // 100_000), "."), F.lit("\n"), F.substring("path", 1, shape % 100_000)),
        )
        for shape in counted["shapes"]
    ]
    if not keys:
        return judged.drop("_apart").withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit("allow")})
    known = bloom(rules.select(F.xxhash64("key").alias("h")), blocks).scalar()
    possible = (
        addresses.select("host", "path", F.explode(F.array_compact(F.array(*keys))).alias("key"))
        .where(may_hold(known, F.xxhash64("key"), blocks))
        .join(rules, "key")
        .groupBy("host", "path")
        .agg(F.max(F.struct("n", "n_host", "rule", "action")).alias("best"))
        .select("host", "path", F.lit(0).alias("_apart"), F.col("best.rule").alias("rule"), F.col("best.action").alias("action"))
    )
    out = judged.join(possible, ["host", "path", "_apart"], "left")
    return out.select(*columns, "rule", F.coalesce("action", F.lit("allow")).alias("verdict"))


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(RULES, "host string, path string, action string")
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter(pages, rules).select("page_id", "host", "path", "rule", "verdict")


_FITS = "\n".join(
    f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{h}{p}:{a}'" for h, p, a in sorted(RULES, key=lambda r: -len(r[0] + r[1]))
)
OP1_SQL = f"""
WITH a AS (
  SELECT page_id,
    translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path
  FROM pages),
b AS (SELECT *, CASE {_FITS} END AS r FROM a)
SELECT page_id, host, path, split_part(r, ':', 1) AS rule, coalesce(split_part(r, ':', 2), 'allow') AS verdict FROM b
"""
