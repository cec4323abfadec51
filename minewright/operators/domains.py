"""Domain filters: small lists, the most frequent domains, and anti-joins against them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: A list of domains up to this many rows is broadcast, a longer one is shuffled.
BROADCAST_ROWS = 200_000


def domain_list(spark: SparkSession, domains: list[str]) -> DataFrame:
    """Trimmed, lower-cased, without blanks and repeats."""
    return spark.createDataFrame([(d,) for d in domains], "domain string").select(F.lower(F.trim("domain")).alias("domain")).where("domain <> ''").distinct()


def drop_domains(urls: DataFrame, domains: DataFrame, counted: int | None = None) -> DataFrame:
    """Rows whose ``domain`` is not listed; the list is broadcast only if it was counted to be short."""
    n = domains.count() if counted is None else counted
    return urls.join(F.broadcast(domains) if n <= BROADCAST_ROWS else domains, "domain", "left_anti").select(*urls.columns)


def top_domains(urls: DataFrame, k: int) -> DataFrame:
    """``domain, n_urls, rank`` of the k domains with most unique URLs; ties by name, empty domains left out."""
    counts = urls.where("domain <> ''").select("norm_url", "domain").distinct().groupBy("domain").agg(F.count(F.lit(1)).alias("n_urls"))
    best = counts.orderBy(F.desc("n_urls"), "domain").limit(k)
    return best.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("n_urls"), "domain")))  # k rows
