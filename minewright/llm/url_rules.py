"""URL filters by expressions of host suffixes and path prefixes.

A URL is expanded into the host suffixes and path prefixes that some rule could
have, each expression is hashed, the short prefix of the digest is the key of an
equi-join with the rules, and the full digests and the precedence decide.  All
of it is native DataFrame work.

Defined cases: a null URL or one without ``://`` has an empty host and path and
gets the default verdict; repeated rows each get a row; of rules with the same
host and path, block wins; a rule with a null host or path is no rule, and one
whose path does not begin with a slash fits no URL's path; extra columns of the pages do not matter, since only the id and the URL are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def url_host(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, _PARTS, 1), F.lit("")), _UPPER, _LOWER)


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def _digest(host: Column, path: Column) -> Column:
    """Digest of an expression in which host and path can't run into each other."""
    return F.sha2(F.concat(F.length(host).cast("string"), F.lit(":"), host, path), 256)


def make_rules(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """``(host, path, verdict)`` rows as a table."""
    rows = [F.struct(F.lit(h).alias("host"), F.lit(p).alias("path"), F.lit(v).alias("verdict")) for h, p, v in rules]
    if not rows:
        return spark.sql("SELECT '' AS host, '' AS path, '' AS verdict WHERE false")
    return spark.range(1).select(F.inline(F.array(*rows)))


def judge_urls(
    pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url",
    default: str = "allow", prefix_hex: int = 8, max_broadcast_rules: int = 100_000,
) -> DataFrame:
    """``id, host, path, rule, verdict`` of every row of ``pages``.

    ``rules`` has ``host, path, verdict``; a rule fits its host and all its subdomains if the path starts
    with the rule's, and the longest one wins (then the one with the longer host, then block).  The rules
    are broadcast while at most ``max_broadcast_rules`` of them were counted, and shuffled beyond.
    """
    rules = (
        rules.where("host IS NOT NULL AND path IS NOT NULL AND verdict IS NOT NULL")
        .select(F.translate("host", _UPPER, _LOWER).alias("r_host"), F.col("path").alias("r_path"), "verdict")
        .groupBy("r_host", "r_path").agg(F.max("verdict").alias("verdict"))
        .withColumn("rule", F.concat("r_host", "r_path"))
        .withColumn("digest", _digest(F.col("r_host"), F.col("r_path")))
        .withColumn("short", F.substring("digest", 1, prefix_hex))
    )
    # The shapes that rules have: (labels of the host, length of the path); as many as different ones, whatever the number of rules.
    shapes = rules.select(F.size(F.split("r_host", r"\.")).alias("n"), F.length("r_path").alias("m")).distinct()
    found = [(r.n, r.m) for r in shapes.collect()]
    n_rules = rules.count()

    keyed = pages.select(F.col(id_col).alias("_id"), F.col(url_col).alias("_url")).select("_id", url_host(F.col("_url")).alias("host"), url_path(F.col("_url")).alias("path"))
    if not found:
        return keyed.select(F.col("_id").alias(id_col), "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))

    labels = F.split("host", r"\.")
    shape = F.array(*[F.struct(F.lit(n).alias("n"), F.lit(m).alias("m")) for n, m in sorted(found)])
    fits = F.filter(shape, lambda s: (s["n"] <= F.size(labels)) & (s["m"] <= F.length("path")))
    expressions = F.transform(fits, lambda s: F.struct(F.concat_ws(".", F.slice(labels, F.size(labels) - s["n"] + 1, s["n"])).alias("h"), F.substring(F.col("path"), F.lit(1), s["m"]).alias("p")))
    hashed = (
        keyed.distinct()
        .withColumn("expression", F.explode(expressions))
        .select("_id", "host", "path", _digest(F.col("expression.h"), F.col("expression.p")).alias("url_digest"))
        .withColumn("url_short", F.substring("url_digest", 1, prefix_hex))
    )
    side = F.broadcast(rules) if n_rules <= max_broadcast_rules else rules
    rank = F.struct(F.length("rule"), F.length("r_host"), "verdict", "rule")
    best = (
        hashed.join(side, hashed.url_short == rules.short)
        .where("url_digest = digest")
        .groupBy("_id", "host", "path").agg(F.max(rank).alias("best"))
        .select(F.col("_id").alias("b_id"), F.col("host").alias("b_host"), F.col("path").alias("b_path"), "best.rule", "best.verdict")
    )
    same = keyed._id.eqNullSafe(best.b_id) & (keyed.host == best.b_host) & (keyed.path == best.b_path)
    return keyed.join(best, same, "left").select(F.col("_id").alias(id_col), "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict"))


#: Fixed values of the query's contract.
OP5_RULES = [("com", "/en/", "block"), ("example.com", "/en/7", "allow"), ("net", "/de/", "allow"), ("example.net", "/de/8", "block"), ("org", "/es/", "block")]

OP5_SQL = r"""
WITH p AS (
  SELECT page_id,
         translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path
  FROM pages),
r(h, q, v) AS (VALUES ('com', '/en/', 'block'), ('example.com', '/en/7', 'allow'), ('net', '/de/', 'allow'), ('example.net', '/de/8', 'block'), ('org', '/es/', 'block')),
j AS (
  SELECT p.*, (SELECT max({'n': length(h) + length(q), 'm': length(h), 'v': v, 'rule': h || q})
               FROM r WHERE (p.host = h OR p.host LIKE '%.' || h) AND starts_with(p.path, q)) AS best
  FROM p)
SELECT page_id, host, path, best.rule AS rule, coalesce(best.v, 'allow') AS verdict FROM j"""


def op5_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return judge_urls(pages, make_rules(spark, OP5_RULES))
