"""Readers of search results, pages, line lists, records and dataset mixtures."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SEARCH = "visual_matches array<struct<link:string>>, _corrupt_record string"
PAGE = "url string, html string, timestamp timestamp"


def search_links(spark: SparkSession, folders: list[str]) -> DataFrame:
    """``file, link`` of search result files, one JSON object each; malformed files and matches without a link give no row."""
    files = spark.read.schema(SEARCH).option("multiLine", True).option("mode", "PERMISSIVE").option("pathGlobFilter", "*.json").json(folders)
    rows = files.select(F.input_file_name().alias("file"), F.explode("visual_matches").alias("m"))
    return rows.select("file", F.col("m.link").alias("link")).where("link IS NOT NULL")


def pages(spark: SparkSession, folder: str) -> DataFrame:
    """Downloaded pages below a folder, at any depth."""
    return spark.read.schema(PAGE).option("multiLine", True).option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").json(folder)


def lines(spark: SparkSession, path: str, lower: bool = False) -> DataFrame:
    """Distinct trimmed lines without blanks."""
    value = F.trim("value")
    return spark.read.text(path).select((F.lower(value) if lower else value).alias("value")).where("value <> ''").distinct()


def domain_counts(spark: SparkSession, path: str, top: int | None = None) -> DataFrame:
    """A domain statistics file, or its first rows by count."""
    rows = spark.read.schema("domain string, count long, percentage string").option("header", True).csv(path).where("domain IS NOT NULL AND `count` IS NOT NULL")
    return rows if top is None else rows.orderBy(F.desc("count"), "domain").limit(top)


def records(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines; the first bad line is an error."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def qa_items(spark: SparkSession, path: str, item: str) -> DataFrame:
    """Items of files that hold ``{"qa_items": [...]}`` or a bare list."""
    wrapped = spark.read.schema(f"qa_items array<{item}>").option("multiLine", True).json(path).where("qa_items IS NOT NULL").select(F.inline("qa_items"))
    bare = spark.read.text(path, wholetext=True).where(F.col("value").rlike(r"^\s*\[")).select(F.from_json("value", f"array<{item}>").alias("x")).select(F.inline("x"))
    return wrapped.unionByName(bare)


def braces(pattern: str) -> list[str]:
    """``dir/{a,b}.json`` spelled out."""
    found = re.search(r"\{([^{}]*)\}", pattern)
    if not found:
        return [pattern]
    return [x for part in found[1].split(",") for x in braces(pattern[: found.start()] + part + pattern[found.end() :])]


def mixture_entry(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """One dataset of a mixture, ``.json`` or ``.jsonl``."""
    if not path.endswith((".json", ".jsonl")):
        raise ValueError(f"unknown dataset format: {path}")
    reader = spark.read if schema is None else spark.read.schema(schema)
    return (reader.option("multiLine", True) if path.endswith(".json") else reader).json(braces(path))


def mixture_entries(spark: SparkSession, paths: list[str], schema: str | None = None) -> DataFrame:
    """The datasets of a list under each other; columns that one lacks are null there."""
    if not paths:
        raise ValueError("no datasets")
    out = mixture_entry(spark, paths[0], schema)
    for p in paths[1:]:
        out = out.unionByName(mixture_entry(spark, p, schema), allowMissingColumns=True)
    return out


def logged_replies(spark: SparkSession, path: str, schema: str, key: str, reply: str, order: str) -> DataFrame:
    """``key, reply`` of logs of earlier runs; the last one logged for a key counts."""
    return spark.read.schema(schema).json(path).where(F.col(key).isNotNull()).groupBy(key).agg(F.max_by(reply, order).alias(reply))
