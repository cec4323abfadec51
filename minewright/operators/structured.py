"""Structured scores: fields of a reply by their own metrics, joined to items, tasks and the whole."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from minewright.functions import answers as A
from minewright.functions import choices, expressions
from minewright.functions import sets as S


def _number(f) -> Column:
    p, g = F.trim("response").try_cast("double"), F.trim("target").try_cast("double")
    return F.when(g.isNull() | p.isNull(), 0.0).otherwise(f(p, g))


def _items(c: str) -> Column:
    """A list as text: items by commas, with brackets of any kind around all and quotes around each or not."""
    inner = F.regexp_replace(F.trim(c), r"(?s)^\[(.*)\]$|^\((.*)\)$|^\{(.*)\}$", "$1$2$3")
    items = F.transform(F.split(inner, ","), lambda x: F.regexp_replace(F.trim(x), r"^([\"'])(.*)\1$", "$2"))
    return F.filter(items, lambda x: x != "")


def _lower(c: str) -> Column:
    return F.transform(_items(c), lambda x: F.lower(x))


def _moves(c: str) -> Column:
    """Chess moves without the marks of a good move or a mate."""
    return F.array_distinct(F.transform(_items(c), lambda m: F.regexp_replace(F.regexp_replace(m, "!$", ""), "#$", "")))


def _share(n: Column, of: Column) -> Column:
    return F.when(of == 0, 0.0).otherwise(n / of)


def _places(a: Column, b: Column) -> Column:
    """Share of places with equal items, 0 for lists of other lengths."""
    hits = F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda x: x))
    return F.when(F.size(a) != F.size(b), 0.0).otherwise(_share(hits, F.size(b)))


def _prefix(a: Column, b: Column) -> Column:
    """Length of the common beginning over the gold list's."""
    n = F.least(F.size(a), F.size(b))
    agree = F.transform(F.zip_with(F.slice(a, F.lit(1), n), F.slice(b, F.lit(1), n), lambda x, y: x == y), lambda x: x)
    first = F.array_position(agree, False).cast("int")
    return _share(F.when(first > 0, first - 1).otherwise(n), F.size(b))


def _map(c: str) -> Column:
    return F.from_json(c, "map<string,string>")


def _mean_error() -> Column:
    p, g = (F.transform(_items(c), lambda x: x.try_cast("double")) for c in ("response", "target"))
    ok = (F.size(p) == F.size(g)) & (F.size(g) > 0) & F.forall(p, lambda x: x.isNotNull()) & F.forall(g, lambda x: x.isNotNull())
    error = F.aggregate(F.zip_with(p, g, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda a, x: a + x) / F.size(g)
    return F.when(ok, F.exp(-error)).otherwise(0.0)


#: Metric of a field by name, over the columns ``response`` and ``target``; -1 is no score.
METRICS = {
    "exact": lambda: (F.trim("response") == F.trim("target")).cast("double"),
    "exact_any_case": lambda: (F.lower(F.trim("response")) == F.lower(F.trim("target"))).cast("double"),
    "simple": lambda: A.simple_match(F.col("response"), F.col("target")).cast("double"),
    "number_ratio": lambda: _number(S.number_closeness),
    "positive_int": lambda: A.positive_int_match(F.col("response"), F.col("target")).cast("double"),
    "list_jaccard": lambda: S.jaccard(F.array_distinct(_items("response")), F.array_distinct(_items("target"))),
    "list_precision": lambda: S.set_precision(_items("response"), F.array_distinct(_items("target"))),
    "order": lambda: (_items("response") == _items("target")).cast("double"),
    "order_any_case": lambda: (_lower("response") == _lower("target")).cast("double"),
    "places_any_case": lambda: _places(_lower("response"), _lower("target")),
    "common_beginning": lambda: _prefix(_items("response"), _items("target")),
    "set": lambda: (F.array_sort(F.array_distinct(_items("response"))) == F.array_sort(F.array_distinct(_items("target")))).cast("double"),
    "set_any_case": lambda: (F.array_sort(F.array_distinct(_lower("response"))) == F.array_sort(F.array_distinct(_lower("target")))).cast("double"),
    "any_reference": lambda: F.exists(_items("target"), lambda t: A.simple_match(F.col("response"), t)).cast("double"),
    "chess_moves": lambda: S.jaccard(_moves("response"), _moves("target")),
    "map_recall": lambda: F.coalesce(A.key_recall(_map("response"), _map("target")), F.lit(0.0)),
    "mean_error": _mean_error,
}

#: Metrics of two texts that no column expression says; one batched call serves all of them.
PYTHON_METRICS = {
    "number": expressions.number_score,
    "expression": lambda p, g: float(expressions.answers_equal(p, g)),
    "near": lambda p, g: float(choices.near_match(p, g)),
    "edit_similarity": lambda p, g: 1 - choices.damerau(p, g) / max(len(p), len(g), 1),
}


def _python_scores(metric: pd.Series, response: pd.Series, target: pd.Series) -> pd.Series:
    known = zip(metric, response, target, strict=True)
    return pd.Series([PYTHON_METRICS[m](p, g) if m in PYTHON_METRICS and p is not None and g is not None else None for m, p, g in known], dtype="float64")


def field_scores(fields: DataFrame, python: bool = True) -> DataFrame:
    """``fields`` (``metric, response, target`` and more) with ``score``: by the metric that the row names; a missing reply scores 0.

    Without ``python`` all rows stay in the JVM, and the metrics of ``PYTHON_METRICS`` are unknown.
    """
    unknown = F.raise_error(F.concat(F.lit("unknown metric "), F.coalesce("metric", F.lit("null")))).cast("double")
    score = None
    for name, make in METRICS.items():
        score = F.when(F.col("metric") == name, make()) if score is None else score.when(F.col("metric") == name, make())
    if python:
        score = score.when(F.col("metric").isin(*PYTHON_METRICS), F.pandas_udf(_python_scores, "double")("metric", "response", "target"))
    return fields.withColumn("score", F.when(F.col("response").isNull(), 0.0).otherwise(F.coalesce(score.otherwise(unknown), F.lit(0.0))))


#: How a task's replies are read, by name: JSON in the outermost braces, what follows the answer mark as the one field, or the whole reply for every field.
PARSERS = ("json", "answer", "whole")
#: A task table of up to so many rows is broadcast to the replies.
FEW_TASKS = 100_000


def _with_tasks(rows: DataFrame, tasks: DataFrame, on: str) -> DataFrame:
    return rows.join(F.broadcast(tasks) if tasks.count() <= FEW_TASKS else tasks, on)


def reply_fields(replies: DataFrame, tasks: DataFrame, fields: DataFrame) -> DataFrame:
    """``task, item, field, metric, weight, combine, response, target``: a row for each field that the task's table asks of a reply.

    ``replies`` have ``task, item, reply, answer`` (a JSON object), ``tasks`` ``task, parser, combine``, ``fields`` ``task, field, metric, weight``.
    Tasks without a row in the tables are left out, as are fields without one; quotes around a value go.
    """
    bare = lambda c: F.regexp_replace(c, r"(?s)^([\"'])(.*)\1$", "$2")
    asked = _with_tasks(replies.withColumn("_gold", F.from_json("answer", "map<string,string>")), tasks.select("task", "parser", "combine"), "task")
    held = asked.withColumn("_read", F.when(F.col("parser") == "json", A.json_part(F.col("reply"), "map<string,string>"))).withColumn("_text", F.when(F.col("parser") == "answer", A.answer_part(F.col("reply"))).when(F.col("parser") == "whole", F.col("reply")))
    known = F.when(F.col("parser").isin(*PARSERS), F.lit(True)).otherwise(F.raise_error(F.concat(F.lit("unknown parser "), F.coalesce("parser", F.lit("null")))).cast("boolean"))
    rows = _with_tasks(held.where(known), fields.select("task", "field", "metric", F.col("weight").cast("double").alias("weight")), "task")
    return rows.select(
        "task", "item", "field", "metric", "weight", "combine", bare(F.when(F.col("parser") == "json", F.try_element_at("_read", "field")).otherwise(F.col("_text"))).alias("response"),
        bare(F.coalesce(F.try_element_at("_gold", "field"), F.lit(""))).alias("target"))


def changed_tasks(replies: DataFrame, previous: DataFrame) -> DataFrame:
    """``task``: those with a reply or answer that ``previous`` (``task, item, reply, answer, score``) lacks, has otherwise or without a score, or with fewer rows than there."""
    old = previous.select("task", "item", F.col("reply").alias("_reply"), F.col("answer").alias("_answer"), F.col("score").alias("_score"), F.lit(True).alias("_there"))
    both = replies.select("task", "item", "reply", "answer", F.lit(True).alias("_here")).join(old, ["task", "item"], "full")
    same = F.col("_here").isNotNull() & F.col("_there").isNotNull() & F.col("reply").eqNullSafe(F.col("_reply")) & F.col("answer").eqNullSafe(F.col("_answer")) & F.col("_score").isNotNull()
    return both.groupBy("task").agg(F.bool_and(same).alias("_same"), F.count("_here").alias("_n")).where("NOT _same AND _n > 0").select("task")


def evaluate_tasks(replies: DataFrame, tasks: DataFrame, fields: DataFrame, previous: DataFrame | None = None) -> DataFrame:
    """``task, item, reply, answer, score``: every reply scored as its task's tables say; tasks in which nothing changed keep the scores of ``previous``.

    ``item`` is unique in a task.  A task without any field scores -1, which counts 0 in its mean.
    """
    work, kept = replies, None
    if previous is not None:
        names = changed_tasks(replies, previous)
        changed = F.broadcast(names) if names.count() <= FEW_TASKS else names
        work = replies.join(changed, "task", "left_semi")
        kept = previous.join(changed, "task", "left_anti").join(replies.select("task", "item"), ["task", "item"], "left_semi").select("task", "item", "reply", "answer", "score")
    python = not fields.where(F.col("metric").isin(*PYTHON_METRICS)).isEmpty()
    scored = item_scores(field_scores(reply_fields(work, tasks, fields), python))
    fresh = work.select("task", "item", "reply", "answer").join(scored, ["task", "item"], "left").withColumn("score", F.coalesce("score", F.lit(-1.0)))
    return fresh if kept is None else fresh.unionByName(kept)


def item_scores(fields: DataFrame, weight: str = "weight", combine: str = "combine") -> DataFrame:
    """``task, item, score``: the weighted mean, or with ``min`` the least, of an item's scores that are no -1; -1 if none is."""
    ok = F.col("score") >= 0
    grouped = fields.groupBy("task", "item").agg(
        F.max(combine).alias("_how"), F.min(F.when(ok, F.col("score"))).alias("_least"),
        F.try_divide(F.sum(F.when(ok, F.col("score") * F.col(weight))), F.sum(F.when(ok, F.col(weight)))).alias("_mean"))
    return grouped.select("task", "item", F.coalesce(F.when(F.col("_how") == "min", F.col("_least")).otherwise(F.col("_mean")), F.lit(-1.0)).alias("score"))


def task_scores(items: DataFrame) -> DataFrame:
    """``task, n_items, score``: the mean over a task's items, those without a score counting 0."""
    return items.groupBy("task").agg(F.count(F.lit(1)).alias("n_items"), F.avg(F.greatest("score", F.lit(0.0))).alias("score"))


def summary(tasks: DataFrame) -> DataFrame:
    """One row: tasks, items, the mean over tasks and the mean over items."""
    return tasks.agg(
        F.count(F.lit(1)).alias("n_tasks"), F.sum("n_items").alias("n_items"), F.avg("score").alias("macro"),
        F.try_divide(F.sum(F.col("score") * F.col("n_items")), F.sum("n_items")).alias("micro"))
