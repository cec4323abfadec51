"""Streaming forms: new search results to domain counts, and windowed event counts. An extension of the batch jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from minewright.functions.urls import domain, normalize_url


def new_links(spark: SparkSession, folder: str) -> DataFrame:
    """Links of search files as they arrive, each normalised URL once within the watermark of its arrival."""
    files = spark.readStream.schema("visual_matches array<struct<link:string>>").option("multiLine", True).json(folder)
    links = files.select(F.explode("visual_matches").alias("m"), F.current_timestamp().alias("seen")).where("m.link IS NOT NULL")
    urls = links.select(normalize_url(F.col("m.link")).alias("norm_url"), "seen")
    return urls.withColumn("domain", domain(F.col("norm_url"))).withWatermark("seen", "1 day").dropDuplicatesWithinWatermark(["norm_url"])


def domain_counts(links: DataFrame) -> DataFrame:
    return links.where("domain <> ''").groupBy("domain").agg(F.count(F.lit(1)).alias("n_urls"))


def event_counts(events: DataFrame, size: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Counts and sums by window and type; rows later than the watermark are left out."""
    stamped = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)
    return stamped.groupBy(F.window("ts", size).alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("start"), "event_type", "n", "total")
