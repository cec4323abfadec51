"""Group aggregations over long-form scores, as native aggregate expressions that combine partially."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from minewright.operators.sampling import ranked_within


def perplexity(x: Column) -> Column:
    return F.exp(-F.avg(x))


def weighted_mean(x: Column, weight: Column) -> Column:
    return F.try_divide(F.sum(x), F.sum(weight))


def weighted_perplexity(x: Column, weight: Column) -> Column:
    return F.exp(-weighted_mean(x, weight))


def bits_per_byte(x: Column, n_bytes: Column) -> Column:
    return -weighted_mean(x, n_bytes) / F.log(F.lit(2.0))


def mean_stderr(x: Column) -> Column:
    """Sample deviation over the root of n; null for a single value."""
    return F.when(F.count(x) > 1, F.stddev_samp(x) / F.sqrt(F.count(x)))


def unsorted_median(values: DataFrame, by: list[str], value: str, seq: str) -> DataFrame:
    """The value at place ``n // 2`` in order of arrival, as the parity form of the median has it."""
    return ranked_within(values, by, [seq]).where(F.col("_rank") - 1 == F.expr("_count div 2")).select(*by, F.col(value).alias("median_unsorted"))


def confusion(gold: Column, predicted: Column) -> dict[str, Column]:
    """Counts of a binary classification; nulls count nowhere."""
    return {
        "tp": F.count_if((gold == 1) & (predicted == 1)), "fp": F.count_if((gold == 0) & (predicted == 1)),
        "fn": F.count_if((gold == 1) & (predicted == 0)), "tn": F.count_if((gold == 0) & (predicted == 0)),
    }


def f1(tp: Column, fp: Column, fn: Column) -> Column:
    return F.coalesce(F.try_divide(2.0 * tp, 2.0 * tp + fp + fn), F.lit(0.0))


def matthews(tp: Column, fp: Column, fn: Column, tn: Column) -> Column:
    """Matthews correlation; 0 where a margin is empty."""
    d = [x.cast("double") for x in (tp + fp, tp + fn, tn + fp, tn + fn)]
    under = F.sqrt(d[0] * d[1] * d[2] * d[3])
    return F.when(under == 0, 0.0).otherwise((tp.cast("double") * tn - fp.cast("double") * fn) / under)


def pooled_stderr(stderr: Column, n: Column) -> Column:
    """Root of the pooled variance over the total size."""
    total = F.sum(n).cast("double")
    return F.sqrt(F.try_divide(F.sum((n - 1) * stderr * stderr * n), total - F.count(n)) / total)


def macro_mean(scores: DataFrame, by: list[str], category: str, value: str) -> DataFrame:
    """Mean of the categories' means."""
    inner = scores.groupBy(*by, category).agg(F.avg(value).alias("_m"))
    return inner.groupBy(*by).agg(F.avg("_m").alias("macro_mean"), F.count(F.lit(1)).alias("n_categories"))


def all_correct(scores: DataFrame, by: list[str], value: str) -> DataFrame:
    """Per group whether every answer is right."""
    return scores.groupBy(*by).agg(F.bool_and(F.col(value) == 1).alias("all_right"))


def roll_up(leaves: DataFrame, tree: DataFrame) -> DataFrame:
    """Group results over a closure table.

    ``leaves`` has ``task, metric, value, stderr, n``; ``tree`` has ``group, leaf, weight_by_size``, every group
    with all leaves below it.  A missing leaf error makes the group's error null.
    """
    size = F.when(F.col("weight_by_size"), F.col("n")).otherwise(F.lit(1))
    joined = leaves.join(tree, leaves.task == tree.leaf)
    return joined.groupBy("group", "metric").agg(
        F.try_divide(F.sum(F.col("value") * size), F.sum(size)).alias("value"),
        F.when(F.count("stderr") == F.count(F.lit(1)), pooled_stderr(F.col("stderr"), F.col("n"))).alias("stderr"),
        F.sum("n").alias("n"),
    )


def combined_stderr(rows: DataFrame, by: list[str], mean: str, stderr: str, n: str) -> DataFrame:
    """Errors merged pair by pair in order of the mean, folding the between-group part in."""
    parts = F.sort_array(F.collect_list(F.struct(F.col(mean).alias("m"), F.col(stderr).alias("s"), F.col(n).cast("double").alias("n"))))
    start = F.struct(F.lit(0.0).alias("m"), F.lit(0.0).alias("v"), F.lit(0.0).alias("n"))

    def step(acc: Column, x: Column) -> Column:
        total = acc["n"] + x["n"]
        between = acc["n"] * x["n"] / (total * (total - 1)) * (acc["m"] - x["m"]) * (acc["m"] - x["m"])
        joined = ((acc["n"] - 1) * acc["v"] + (x["n"] - 1) * x["s"] * x["s"]) / (total - 1) + between
        v = F.when(acc["n"] == 0, x["s"] * x["s"]).otherwise(joined)
        return F.struct(((acc["m"] * acc["n"] + x["m"] * x["n"]) / total).alias("m"), v.alias("v"), total.alias("n"))

    return rows.groupBy(*by).agg(F.sqrt(F.aggregate(parts, start, step)["v"]).alias("combined_stderr"))


def paired_references(predictions: DataFrame, references: DataFrame) -> DataFrame:
    """``index, category, text, video, group``: whether both halves of a pair are right as texts, as videos, and as all four.

    ``predictions`` have ``index, half, kind, category, pred`` (kind ``text`` or ``video``, half ``pos`` or ``neg``), ``references``
    ``index, half, kind, gold``; a prediction counts by its first letter in any case, one that is missing is wrong.
    """
    met = predictions.join(references, ["index", "half", "kind"])
    right = F.coalesce(F.lower(F.substring("pred", 1, 1)) == F.lower("gold"), F.lit(False))
    both = lambda kind: F.sum(F.when((F.col("kind") == kind) & right, 1).otherwise(0)) == 2
    return met.groupBy("index", "category").agg(both("text").alias("text"), both("video").alias("video")).withColumn("group", F.col("text") & F.col("video"))


def route_counts(rows: DataFrame, routes: dict[str, Column], by: list[str] | None = None) -> DataFrame:
    """How many rows took each route; a row may take several."""
    return rows.groupBy(*(by or [])).agg(F.count(F.lit(1)).alias("total"), *[F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in routes.items()])


def extraction_summary(files: DataFrame, n_items: str, seconds: str) -> DataFrame:
    """One row: files, those with items, items, items for each file that has some, and seconds for each file."""
    return files.agg(
        F.count(F.lit(1)).alias("n_files"), F.count_if(F.col(n_items) > 0).alias("n_valid"), F.coalesce(F.sum(n_items), F.lit(0)).alias("n_items"),
        F.coalesce(F.try_divide(F.sum(n_items), F.count_if(F.col(n_items) > 0)), F.lit(0.0)).alias("items_per_valid"), F.coalesce(F.avg(seconds), F.lit(0.0)).alias("seconds_per_file"))
