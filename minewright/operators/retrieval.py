"""Passages of documents for questions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from minewright.functions.text import words


def passages(docs: DataFrame, key: str, text: str, size: int = 200) -> DataFrame:
    """``key, place, passage``: runs of ``size`` words."""
    split = docs.select(key, words(F.col(text)).alias("_w")).where(F.size("_w") > 0)
    places = split.select(key, "_w", F.explode(F.sequence(F.lit(0), F.size("_w") - 1, F.lit(size))).alias("_at"))
    return places.select(key, F.expr(f"CAST(_at / {size} AS INT)").alias("place"), F.array_join(F.slice("_w", F.col("_at") + 1, F.lit(size)), " ").alias("passage"))


def best_passages(chunks: DataFrame, key: str, score: Column, k: int = 8) -> DataFrame:
    """Per key the k best passages by a score column, best first, joined by line breaks."""
    w = Window.partitionBy(key).orderBy(F.desc("_s"), "place")
    top = chunks.withColumn("_s", score).withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= k)
    ordered = F.sort_array(F.collect_list(F.struct("_n", "passage")))
    return top.groupBy(key).agg(F.array_join(F.transform(ordered, lambda x: x["passage"]), "\n").alias("context"))


#: Query vectors up to this number are broadcast to the passages.
FEW_VECTORS = 50_000


def late_interaction(passages: DataFrame, queries: DataFrame, on: list[str], place: str) -> DataFrame:
    """``on, place, score``: the greatest inner product of each query vector with any of a passage, averaged over the query's vectors.

    ``passages`` have ``on, place, v`` and ``queries`` ``on, at, v``, a row for each vector.  Passages meet the queries of their
    ``on`` alone; the vectors of one passage go before the shuffle but for one number for each query vector.
    """
    asked = queries.where("v IS NOT NULL").select(*on, "at", F.col("v").alias("_q"))
    asked = F.broadcast(asked) if asked.count() <= FEW_VECTORS else asked
    inner = F.aggregate(F.zip_with("v", "_q", lambda x, y: x * y), F.lit(0.0), lambda a, x: a + x)
    met = passages.where("v IS NOT NULL").join(asked, on).where(F.size("v") == F.size("_q"))
    best = met.groupBy(*on, place, "at").agg(F.max(inner).alias("_best"))
    return best.groupBy(*on, place).agg(F.avg("_best").alias("score"))


def first_passages(scores: DataFrame, on: list[str], place: str, k: int = 8) -> DataFrame:
    """The ``k`` best places of each ``on``, with their ``rank``."""
    w = Window.partitionBy(*on).orderBy(F.desc("score"), place)
    return scores.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
