"""Queries over page URLs: normal forms, domain counts, anti-joins, counters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from minewright.functions.urls import domain, normalize_url, origin
from minewright.operators.domains import domain_list, drop_domains, top_domains
from minewright.plans.catalog import query
from minewright.staging import table

#: DuckDB form of normalize_url and domain over column ``url``.
SQL_NORMAL = r"""
  SELECT page_id, regexp_replace(regexp_replace(regexp_replace(lower(regexp_replace(url, '^\s+|\s+$', '', 'g')),
         '(?s)#.*$', ''), '^([^?]*)\?$', '\1'),
         '^((?:[a-z][a-z0-9+.-]*:)?//[^/?]*/(?:[^?]*/)?[^/?;]*);(\?|$)', '\1\2') AS norm_url
  FROM pages WHERE url IS NOT NULL"""
SQL_DOMAIN = f"""
  SELECT page_id, norm_url,
         regexp_replace(regexp_extract(norm_url, '^(?:[a-z][a-z0-9+.-]*:)?//([^/?#]*)', 1), '^www\\.', '') AS domain
  FROM ({SQL_NORMAL}) n"""


def page_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url").where(F.col("url").isNotNull())
    return pages.select("page_id", normalize_url(F.col("url")).alias("norm_url")).withColumn("domain", domain(F.col("norm_url")))


@query("url_normalize", f"SELECT page_id, norm_url, domain FROM ({SQL_DOMAIN}) d")
def url_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_urls(spark, sf_dir)


@query(
    "domain_stats",
    f"""
WITH u AS (SELECT DISTINCT norm_url, domain FROM ({SQL_DOMAIN}) d WHERE domain <> ''),
c AS (SELECT domain, count(*) AS n_urls FROM u GROUP BY domain)
SELECT domain, n_urls, printf('%.2f%%', 100.0 * n_urls / (SELECT sum(n_urls) FROM c)) AS percentage FROM c""",
)
def domain_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    urls = page_urls(spark, sf_dir).where("domain <> ''").select("norm_url", "domain").distinct()
    counts = urls.groupBy("domain").agg(F.count(F.lit(1)).alias("n_urls"))
    total = counts.agg(F.sum("n_urls").alias("total"))
    return (
        counts.join(F.broadcast(total))  # one row
        .select("domain", "n_urls", F.format_string("%.2f%%", 100.0 * F.col("n_urls") / F.col("total")).alias("percentage"))
        .orderBy(F.desc("n_urls"), "domain")
    )


#: A fixed list of sites that hold no questions, as a filter table.
USELESS = ["tionsh.example.net", "thther.example.org", " M.ththth.example.net ", ""]
_USELESS_SQL = "(VALUES ('tionsh.example.net'), ('thther.example.org'), ('m.ththth.example.net')) t(domain)"


@query("useless_domain_filter", f"SELECT page_id, norm_url, domain FROM ({SQL_DOMAIN}) d WHERE domain NOT IN (SELECT domain FROM {_USELESS_SQL})")
def useless_domain_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_domains(page_urls(spark, sf_dir), domain_list(spark, USELESS))


@query("useless_domains_met", f"SELECT domain, count(*) AS n_pages FROM ({SQL_DOMAIN}) d WHERE domain IN (SELECT domain FROM {_USELESS_SQL}) GROUP BY domain")
def useless_domains_met(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_urls(spark, sf_dir).join(domain_list(spark, USELESS), "domain", "left_semi").groupBy("domain").agg(F.count(F.lit(1)).alias("n_pages"))


@query(
    "topk_domain_antijoin",
    f"""
WITH d AS ({SQL_DOMAIN}),
top AS (SELECT domain FROM (SELECT DISTINCT norm_url, domain FROM d) u GROUP BY domain ORDER BY count(*) DESC, domain LIMIT 10)
SELECT page_id, norm_url, domain FROM d WHERE domain NOT IN (SELECT domain FROM top)""",
)
def topk_domain_antijoin(spark: SparkSession, sf_dir: str) -> DataFrame:
    urls = page_urls(spark, sf_dir)
    return drop_domains(urls, top_domains(urls, 10).select("domain"))


@query(
    "top_domain_shares",
    f"""
WITH d AS ({SQL_DOMAIN}), u AS (SELECT DISTINCT norm_url, domain FROM d), c AS (SELECT domain, count(*) AS n_urls FROM u GROUP BY domain)
SELECT domain, n_urls, CAST(row_number() OVER (ORDER BY n_urls DESC, domain) AS INTEGER) AS rank,
       n_urls * 100.0 / (SELECT count(*) FROM u) AS share_of_urls,
       n_urls * 100.0 / (SELECT sum(n_urls) FROM c WHERE domain <> '') AS share_of_counts
FROM c WHERE domain <> '' ORDER BY n_urls DESC, domain LIMIT 10""",
)
def top_domain_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten largest domains with both shares: of unique URLs, and of the counter's sum."""
    urls = page_urls(spark, sf_dir).select("norm_url", "domain").distinct()
    totals = urls.agg(F.count(F.lit(1)).alias("all_urls"), F.count_if(F.col("domain") != "").alias("counted"))
    return (
        top_domains(urls, 10).join(F.broadcast(totals))
        .select("domain", "n_urls", "rank", (F.col("n_urls") * 100.0 / F.col("all_urls")).alias("share_of_urls"), (F.col("n_urls") * 100.0 / F.col("counted")).alias("share_of_counts"))
    )


@query(
    "url_counters",
    f"""
WITH d AS ({SQL_DOMAIN}), k AS (SELECT *, domain IN (SELECT domain FROM {_USELESS_SQL}) AS useless FROM d)
SELECT count(*) AS total_urls, count(*) FILTER (useless) AS filtered_urls, count(DISTINCT norm_url) FILTER (NOT useless) AS unique_urls,
       100.0 * count(*) FILTER (useless) / nullif(count(*), 0) AS filtered_percent FROM k""",
)
def url_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All occurrences, those filtered out, unique kept ones, and the rate; null for no URL at all."""
    marked = page_urls(spark, sf_dir).withColumn("useless", F.col("domain").isin([d.strip().lower() for d in USELESS if d.strip()]))
    each = marked.groupBy("norm_url").agg(F.count(F.lit(1)).alias("n"), F.count_if("useless").alias("f"))
    return each.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_urls"), F.coalesce(F.sum("f"), F.lit(0)).alias("filtered_urls"),
        F.count_if(F.col("f") == 0).alias("unique_urls"), F.expr("try_divide(100.0D * sum(f), sum(n))").alias("filtered_percent"))


@query("page_keys", "SELECT page_id, md5(url) AS key, substr(md5(url), 1, 2) AS p1, substr(md5(url), 3, 2) AS p2 FROM pages WHERE url IS NOT NULL")
def page_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Storage key of a page and its two partition columns."""
    key = F.md5("url")
    return table(spark, sf_dir, "pages").where("url IS NOT NULL").select("page_id", key.alias("key"), F.substring(key, 1, 2).alias("p1"), F.substring(key, 3, 2).alias("p2"))


@query("page_origin", r"SELECT page_id, CASE WHEN regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]+)', 1) <> '' THEN lower(regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*)://', 1)) || '://' || regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]+)', 1) END AS base_url FROM pages")
def page_origin(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", origin(F.col("url")).alias("base_url"))


@query("download_errors", r"""
SELECT left(CASE WHEN html IS NULL OR length(html) = 0 THEN 'empty page' WHEN length(html) > 4000 THEN 'page too long: ' || regexp_extract(url, '^([a-z]+)://', 1) END, 100) AS error, count(*) AS n FROM pages
GROUP BY 1""")
def download_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Download outcomes counted by the first hundred characters of their error, null for a success."""
    error = F.when(F.coalesce(F.length("html"), F.lit(0)) == 0, "empty page").when(F.length("html") > 4000, F.concat(F.lit("page too long: "), F.regexp_extract("url", "^([a-z]+)://", 1)))
    return table(spark, sf_dir, "pages").groupBy(F.substring(error, 1, 100).alias("error")).agg(F.count(F.lit(1)).alias("n"))
