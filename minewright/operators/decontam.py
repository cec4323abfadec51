"""Benchmark contamination by shared word n-grams: an inverted-index equi-join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def ngram_rows(rows: DataFrame, key: str, n: int) -> DataFrame:
    """``key, gram``: the distinct word n-grams of each text, none for shorter ones.

    The words are a column of their own, so that they are split once and not for every n-gram.
    """
    split = rows.select(key, words(F.col("text")).alias("w")).where(F.size("w") >= n)
    grams = F.transform(F.sequence(F.lit(1), F.size("w") - n + 1), lambda i: F.array_join(F.slice(F.col("w"), i, n), " "))
    return split.select(key, F.explode(F.array_distinct(grams)).alias("gram"))


def gram_hashes(rows: DataFrame, key: str, n: int) -> DataFrame:
    """``key, h``: hashes of all word n-grams of each text; words are hashed once and no n-gram is spelled.

    Hashes of one, two, four and more words in a row are paired with their shifted selves, so that an n-gram costs as
    many steps as its length has binary digits.  Each array is a column of its own and worked out once.
    """
    shifted = lambda c, by: F.slice(c, by + 1, F.greatest(F.size(c) - by, F.lit(0)))
    paired = lambda a, b: F.zip_with(a, b, lambda x, y: F.xxhash64(x, y))
    step = rows.select(key, F.transform(F.split(F.lower("text"), r"[^\p{L}\p{N}]+"), lambda w: F.xxhash64(w)).alias("all"))
    # The split leaves an empty word where a text begins or ends with what is no word.
    step = step.select(key, F.filter("all", lambda h: h != F.xxhash64(F.lit(""))).alias("power")).select(key, F.size("power").alias("words"), "power", F.lit(None).cast("array<bigint>").alias("gram"))
    size, done = 1, 0
    while size <= n:
        if n & size:
            step = step.select(key, "words", "power", (paired(F.col("gram"), shifted(F.col("power"), done)) if done else F.col("power")).alias("gram"))
            done += size
        size *= 2
        if size <= n:
            step = step.select(key, "words", paired(F.col("power"), shifted(F.col("power"), size // 2)).alias("power"), "gram")
    whole = F.slice("gram", F.lit(1), F.greatest(F.col("words") - n + 1, F.lit(0)))
    return step.select(key, F.explode(whole).alias("h"))


def contaminated(documents: DataFrame, benchmark: DataFrame, n: int = 8, least: float = 0.0, broadcast_grams: int = 1_000_000) -> DataFrame:
    """``doc_id, item_id, shared, share``: documents that hold n-grams of a benchmark item, and which share of them.

    Documents without a hash of the benchmark's n-grams go first; the n-grams of the others are then compared as they are.
    The benchmark's index is broadcast while its n-grams were counted to be few.
    """
    items = ngram_rows(benchmark, "item_id", n)
    sizes = items.groupBy("item_id").agg(F.count(F.lit(1)).alias("size"))
    small = items.count() <= broadcast_grams
    side = (lambda x: F.broadcast(x)) if small else (lambda x: x)
    hashes = gram_hashes(benchmark, "item_id", n).select("h").distinct()
    hit = gram_hashes(documents, "doc_id", n).join(side(hashes), "h", "left_semi").select("doc_id").distinct()
    grams = ngram_rows(documents.join(hit, "doc_id", "left_semi"), "doc_id", n)
    shared = grams.join(side(items), "gram").groupBy("doc_id", "item_id").agg(F.count(F.lit(1)).alias("shared"))
    scored = shared.join(side(sizes), "item_id").withColumn("share", F.col("shared") / F.col("size"))
    return scored.where(F.col("share") >= least).select("doc_id", "item_id", "shared", "share")


def decontaminate(documents: DataFrame, benchmark: DataFrame, n: int = 8, least: float = 0.5) -> DataFrame:
    """Documents that hold less than such a share of every benchmark item."""
    return documents.join(contaminated(documents, benchmark, n, least).select("doc_id").distinct(), "doc_id", "left_anti")
