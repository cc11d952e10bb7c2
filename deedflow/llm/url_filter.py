"""URL filters: host-suffix and path-prefix expressions, joined on short hash prefixes.

A rule is a host and a path. It fits a URL whose host is the rule's or a subdomain of it and whose path
starts with the rule's. Each URL is expanded into every (host suffix, path prefix) pair that a rule of the
given shapes could name; the expressions join the rules on the first PREFIX_HEX hex digits of their SHA-256,
the full digests then confirm, and the longest rule wins (equal length: the longer host, then block over allow).

Defined results: a null URL or one without "://" has an empty host and path, fits no rule and gets the
default verdict. A URL of any length is judged whole: only rules' shapes bound its expressions. An empty path starts with no rule's path. Repeated rows give a row each. An empty rule
table leaves every page with the default verdict; an empty page table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PREFIX_HEX = 8  # 32 bits
#: A rule set of so many rows at most (a row is under 1 KB) is broadcast; a larger one is shuffled.
BROADCAST_RULES = 100_000
RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]


def host_of(url: Column) -> Column:
    after = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(after, UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def expressions(host: Column, path: Column, labels: list[int], lengths: list[int]) -> Column:
    """Distinct host-suffix + path-prefix strings, for suffixes of so many labels and prefixes of so many characters."""
    parts = F.split(host, r"\.")
    suffixes = F.array_distinct(F.array(*[F.when(F.size(parts) >= n, F.substring_index(host, ".", -n)) for n in labels]))
    prefixes = F.array(*[F.when(F.length(path) >= n, F.substring(path, 1, n)) for n in lengths])
    some = lambda a: F.filter(a, lambda x: x.isNotNull())
    pairs = F.transform(some(suffixes), lambda h: F.transform(some(prefixes), lambda p: F.concat(h, F.lit("\n"), p)))
    return F.flatten(pairs)


def filter_urls(pages: DataFrame, rules: DataFrame, key: str = "page_id", url: str = "url", default: str = "allow") -> DataFrame:
    """pages(key, url), rules(verdict, host, path) -> key, host, path, rule, verdict; one row per page row."""
    rules = rules.select("verdict", F.translate("host", UPPER, LOWER).alias("host"), "path").where("verdict is not null and host is not null and path is not null").distinct()
    # The shapes that rules have: as many labels and path lengths as the longest rule at most, whatever the number of rules.
    shapes = rules.select(F.size(F.split("host", r"\.")).alias("n"), F.length("path").alias("m"))
    labels = sorted(r[0] for r in shapes.select("n").distinct().collect())
    lengths = sorted(r[0] for r in shapes.select("m").distinct().collect())
    base = pages.select(F.col(key).alias("_key"), host_of(F.col(url)).alias("_host"), path_of(F.col(url)).alias("_path"))
    out = [F.col("_key").alias(key), F.col("_host").alias("host"), F.col("_path").alias("path")]
    if not labels:
        return base.select(*out, F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    known = rules.select(
        F.sha2(F.concat("host", F.lit("\n"), "path"), 256).alias("digest"),
        F.struct(
            (F.length("host") + F.length("path")).alias("len"),
            F.length("host").alias("host_len"),
            (F.col("verdict") == "block").cast("int").alias("blocks"),
            F.concat("host", "path").alias("rule"),
            "verdict",
        ).alias("fit"),
    ).withColumn("short", F.substring("digest", 1, PREFIX_HEX))
    if rules.limit(BROADCAST_RULES + 1).count() <= BROADCAST_RULES:
        known = F.broadcast(known)
    # Expressions of one URL stay in its task until the partial maximum has made them one row; its first expression (a URL
    # without any has one that no rule has, by its own hash) counts the rows, so that repeated rows come back as often as they came.
    digests = F.transform(expressions(F.col("_host"), F.col("_path"), labels, lengths), lambda x: F.sha2(x, 256))
    own = F.concat(F.lit("-"), F.hex(F.xxhash64("_key", "_host", "_path")))
    tried = base.withColumn("_d", digests).withColumn("_d", F.when(F.size("_d") > 0, F.col("_d")).otherwise(F.array(own)))
    tried = tried.select("_key", "_host", "_path", F.posexplode("_d").alias("_n", "digest"))
    met = (
        tried.withColumn("short", F.substring("digest", 1, PREFIX_HEX))
        .join(known.withColumnRenamed("digest", "full"), "short", "left")
        .groupBy("_key", "_host", "_path")
        .agg(F.max(F.when(F.col("digest") == F.col("full"), F.col("fit"))).alias("fit"), F.count_if(F.col("_n") == 0).alias("rows"))
    )
    met = met.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))))
    return met.select(*out, F.col("fit.rule").alias("rule"), F.coalesce("fit.verdict", F.lit(default)).alias("verdict"))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(RULES, "verdict string, host string, path string")
    return filter_urls(table(spark, sf_dir, "pages"), rules)


SQL = r"""
WITH p AS (
  SELECT page_id,
         CASE WHEN strpos(coalesce(url, ''), '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages
), q AS (
  SELECT page_id,
         translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM p
), r AS (
  SELECT *, CASE
    WHEN (host = 'example.com' OR suffix(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'example.net' OR suffix(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'org' OR suffix(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR suffix(host, '.net')) AND starts_with(path, '/') THEN 'net/'
  END AS rule
  FROM q
)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict
FROM r
"""
