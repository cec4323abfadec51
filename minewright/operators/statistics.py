"""Resampled errors, ratings of battles, and corpus text metrics from summable rows."""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from minewright.functions.edits import edit_distance


def bootstrap(values: DataFrame, by: list[str], value: str, statistic=np.mean, iterations: int = 1000, chunk: int = 100) -> DataFrame:
    """``stderr, low, high`` of a statistic per group, by resampling with replacement.

    A group is first reduced to counts of its distinct values, which is the same resampling by weights, and resampled in
    ``iterations / chunk`` tasks, each with its own seed; a task holds a group's distinct values.
    """
    counts = values.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count(F.lit(1)).alias("_n"))
    tasks = counts.crossJoin(F.broadcast(values.sparkSession.range(math.ceil(iterations / chunk)).withColumnRenamed("id", "_chunk")))  # a few rows

    def draw(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(value, ignore_index=True)
        seed = int(pdf["_chunk"].iloc[0])
        rng = np.random.default_rng(seed)
        x, n = pdf[value].to_numpy(float), pdf["_n"].to_numpy()
        out = []
        for _ in range(min(chunk, iterations - seed * chunk)):
            m = rng.multinomial(n.sum(), n / n.sum())
            out.append(float((x * m).sum() / m.sum()) if statistic is np.mean else float(statistic(np.repeat(x, m))))
        return pd.DataFrame({**{b: [pdf[b].iloc[0]] * len(out) for b in by}, "s": out})

    types = {f.name: f.dataType.simpleString() for f in values.schema.fields}
    drawn = tasks.groupBy(*by, "_chunk").applyInPandas(draw, ", ".join([f"{b} {types[b]}" for b in by] + ["s double"]))
    return drawn.groupBy(*by).agg(F.stddev_samp("s").alias("stderr"), F.percentile("s", F.lit(0.025)).alias("low"), F.percentile("s", F.lit(0.975)).alias("high"))


def elo(battles: DataFrame, baseline: str, scale: float = 400.0, base: float = 10.0, anchor: float = 1000.0, rounds: int = 100) -> DataFrame:
    """Maximum-likelihood ratings of ``model_a, model_b, winner``; a tie is a win for each, the baseline is at the anchor.

    Battles are reduced to wins per pair, so that what is fitted is bounded by the pairs of models.
    """
    a_wins, b_wins = F.col("winner") == "model_a", F.col("winner") == "model_b"
    pairs = battles.groupBy("model_a", "model_b").agg(
        F.sum(F.when(a_wins, 2.0).when(b_wins, 0.0).otherwise(1.0)).alias("won"), F.sum(F.lit(2.0)).alias("n"))

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        names = sorted(set(pdf["model_a"]) | set(pdf["model_b"]))
        at = {m: i for i, m in enumerate(names)}
        i, j = pdf["model_a"].map(at).to_numpy(), pdf["model_b"].map(at).to_numpy()
        won, n, r = pdf["won"].to_numpy(), pdf["n"].to_numpy(), np.zeros(len(names))
        for _ in range(rounds):  # Newton steps with a little ridge: ratings of unbeaten models stay finite
            p = 1 / (1 + np.exp(-(r[i] - r[j])))
            g, h = -1e-3 * r, 1e-3 * np.eye(len(names))
            np.add.at(g, i, won - n * p)
            np.add.at(g, j, n * p - won)
            w = n * p * (1 - p)
            np.add.at(h, (i, i), w), np.add.at(h, (j, j), w), np.add.at(h, (i, j), -w), np.add.at(h, (j, i), -w)
            step = np.linalg.solve(h, g)
            r = r + step
            if np.abs(step).max() < 1e-10:
                break
        rating = r * scale / math.log(base)
        return pd.DataFrame({"model": names, "rating": rating - rating[at[baseline]] + anchor if baseline in at else rating + anchor})

    return pairs.groupBy(F.lit(0).alias("_all")).applyInPandas(fit, "model string, rating double")


def win_rates(battles: DataFrame) -> DataFrame:
    """Share of battles that a model wins against another, ties as half."""
    score = F.when(F.col("winner") == "model_a", 1.0).when(F.col("winner") == "model_b", 0.0).otherwise(0.5)
    one = battles.select(F.col("model_a").alias("model"), F.col("model_b").alias("against"), score.alias("s"))
    two = battles.select(F.col("model_b").alias("model"), F.col("model_a").alias("against"), (1 - score).alias("s"))
    return one.union(two).groupBy("model", "against").agg(F.avg("s").alias("win_rate"), F.count(F.lit(1)).alias("n"))


def _grams(words: list[str], n: int) -> Counter:
    return Counter(tuple(words[i : i + n]) for i in range(len(words) - n + 1))


def _ngram_counts(pred: pd.Series, ref: pd.Series) -> pd.DataFrame:
    rows = []
    for p, r in zip(pred, ref, strict=True):
        a, b = (p or "").split(), (r or "").split()
        match = [sum((_grams(a, n) & _grams(b, n)).values()) for n in range(1, 5)]
        rows.append((len(a), len(b), match, [max(0, len(a) - n + 1) for n in range(1, 5)]))
    return pd.DataFrame(rows, columns=["hyp", "ref", "match", "total"])


def corpus_bleu(rows: DataFrame, by: list[str], pred: str, ref: str) -> DataFrame:
    """Corpus BLEU from summed n-gram counts; partial sums combine before the shuffle."""
    counts = F.pandas_udf(_ngram_counts, "struct<hyp:long,ref:long,match:array<long>,total:array<long>>")
    s = rows.select(*by, counts(pred, ref).alias("s"))
    agg = s.groupBy(*by).agg(F.sum("s.hyp").alias("hyp"), F.sum("s.ref").alias("ref"), *[F.sum(F.col(f"s.{k}")[n]).alias(f"{k}{n}") for k in ("match", "total") for n in range(4)])
    logs = sum((F.log(F.col(f"match{n}") / F.col(f"total{n}")) for n in range(4)), F.lit(0.0)) / 4
    brief = F.when(F.col("hyp") >= F.col("ref"), 0.0).otherwise(1 - F.col("ref") / F.col("hyp"))
    ok = F.least(*[F.col(f"match{n}") for n in range(4)]) > 0
    return agg.select(*by, F.when(ok, 100 * F.exp(logs + brief)).otherwise(0.0).alias("bleu"))


def _distances(pred: pd.Series, ref: pd.Series) -> pd.Series:
    return pd.Series([edit_distance((p or "").split(), (r or "").split()) for p, r in zip(pred, ref, strict=True)], dtype="int64")


def word_error_rate(rows: DataFrame, by: list[str], pred: str, ref: str) -> DataFrame:
    """Summed edit distances over summed reference lengths, in percent."""
    size = F.size(F.filter(F.split(F.trim(F.col(ref)), r"\s+"), lambda w: w != ""))
    s = rows.select(*by, F.pandas_udf(_distances, "long")(pred, ref).alias("d"), size.alias("n"))
    return s.groupBy(*by).agg((F.try_divide(F.sum("d"), F.sum("n")) * 100).alias("wer"))
