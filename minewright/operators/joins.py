"""Lookup joins: last row wins, upserts by priority, diffs, caches, grouped requests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from minewright.operators.sampling import ranked


def last_by_key(rows: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """One row per key, the last in ``order``; null keys are dropped, as a lookup built from rows has them."""
    newest = F.row_number().over(Window.partitionBy(*keys).orderBy(*[F.desc(o) if isinstance(o, str) else o for o in order]))
    kept = rows.dropna(subset=keys).withColumn("_n", newest).where("_n = 1").drop("_n")
    return kept


def lookup(left: DataFrame, right: DataFrame, left_key: str, right_key: str, order: list[Column | str]) -> DataFrame:
    """Every left row with the last right row of its key, or nulls."""
    table = last_by_key(right, [right_key], order)
    return left.join(table, left[left_key] == table[right_key], "left")


def grouped_requests(requests: DataFrame, doc: str, index: str, fields: list[str]) -> DataFrame:
    """A row per document with its requests in order of ``index``."""
    parts = F.sort_array(F.collect_list(F.struct(index, *fields)))
    return requests.groupBy(doc).agg(parts.alias("requests"), F.count(F.lit(1)).alias("n"))


def following(rows: DataFrame, by: str, order: list[str], value: str, name: str) -> DataFrame:
    """Every row that has a next one in its group, with that row's ``value`` as ``name``.

    Rows meet by global rank, so that a long group is no more work for a task than many short ones.
    """
    placed = ranked(rows, [F.col(by), *map(F.col, order)])
    after = placed.select((F.col("_rank") - 1).alias("_rank"), F.col(by).alias("_by"), F.col(value).alias(name))
    return placed.join(after, "_rank").where(F.col(by).eqNullSafe(F.col("_by"))).drop("_rank", "_by")


def _substrings(c: Column, longest: int | None) -> Column:
    """All different substrings of up to ``longest`` letters, the empty one too."""
    n = F.length(c)
    sizes = F.sequence(F.lit(1), n if longest is None else F.least(n, F.lit(longest)))
    cuts = F.flatten(F.transform(sizes, lambda k: F.transform(F.sequence(F.lit(1), n - k + 1), lambda i: F.substr(c, i, k))))
    return F.array_union(F.array(F.lit("")), F.when(n > 0, cuts).otherwise(F.array().cast("array<string>")))


def least_contained(asked: DataFrame, names: DataFrame, longest: int | None = None) -> DataFrame:
    """``group, text, least``: per asked text the smallest key of a name of its group that holds it or that it holds.

    ``asked`` has ``group, text``, ``names`` has ``group, text, key``; no asked text is longer than ``longest``, if given.
    A text holds another if that is one of its substrings, so both sides meet in equal strings and no pair is tried that
    is no match; equal texts are one row before.  Substrings grow with the square of a name's length, not with a group.
    """
    asked = asked.where("text IS NOT NULL").distinct()
    names = names.where("text IS NOT NULL").groupBy("group", "text").agg(F.min("key").alias("key"))
    held = names.select("group", F.explode(_substrings(F.col("text"), longest)).alias("text"), "key").groupBy("group", "text").agg(F.min("key").alias("key"))
    holding = asked.join(held, ["group", "text"]).select("group", "text", "key")
    parts = asked.select("group", F.col("text").alias("whole"), F.explode(_substrings(F.col("text"), None)).alias("text"))
    holds = parts.join(names, ["group", "text"]).select("group", F.col("whole").alias("text"), "key")
    return holding.union(holds).groupBy("group", "text").agg(F.min("key").alias("least"))


def upsert(old: DataFrame, new: DataFrame, keys: list[str], priority: str, seq: str) -> DataFrame:
    """Per key the row of highest ``priority``, then of greatest ``seq``."""
    both = old.unionByName(new, allowMissingColumns=True)
    return last_by_key(both, keys, [F.col(priority).desc(), F.col(seq).desc()])


def changed(before: DataFrame, after: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Rows of ``after`` that are new or differ from ``before``."""
    old = before.select(*keys, *[F.col(v).alias(f"_old_{v}") for v in values], F.lit(True).alias("_there"))
    same = F.col("_there").isNotNull()
    for v in values:
        same = same & F.col(v).eqNullSafe(F.col(f"_old_{v}"))
    return after.join(old, keys, "left").where(~same).select(*after.columns)


def cache_split(requests: DataFrame, cache: DataFrame, key: str, bypass: Column) -> tuple[DataFrame, DataFrame]:
    """Requests answered by the cache, and those to compute: missing ones and those that must not be cached."""
    hits = requests.where(~bypass).join(cache, key)
    misses = requests.where(~bypass).join(cache, key, "left_anti").unionByName(requests.where(bypass))
    return hits, misses


def alignment_outcome(rows: DataFrame, key: Column, question: Column, answer: Column, reference: Column, aligned: Column) -> DataFrame:
    """The five outcomes of comparing a generated answer with a known one.

    No key, no reference, reference not found and aligned all keep the generated answer and close the
    question with a request for a conclusion; an answer that is not aligned gives way to the reference.
    """
    state = (
        F.when(key.isNull(), "no_key").when(reference.isNull(), "no_match")
        .when(F.lower(F.trim(reference)) == "not found", "not_found").when(F.coalesce(aligned, F.lit(False)), "aligned").otherwise("not_aligned")
    )
    out = rows.withColumn("outcome", state)
    replaced = F.col("outcome") == "not_aligned"
    return (
        out.withColumn("is_aligned", F.when(F.col("outcome") == "aligned", True).when(replaced, False))
        .withColumn("final_question", F.when(replaced, question).otherwise(F.concat(question, F.lit(CONCLUDE))))
        .withColumn("final_answer", F.when(replaced, reference).otherwise(answer))
    )


#: Appended to a question whose answer is kept.
CONCLUDE = " Please conclude with the final answer."
