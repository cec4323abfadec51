"""Requests of documents: one for each choice, few-shot examples, predictions from losses, order by length and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from minewright.operators.sampling import hash_order, ranked


def choice_requests(docs: DataFrame, key: str, context: str, choices: str, unconditional: bool = False) -> DataFrame:
    """``key, idx, context, continuation``: a request for each choice, and with ``unconditional`` another of each without its context."""
    rows = docs.select(key, F.col(context).alias("context"), F.posexplode(choices).alias("idx", "continuation"))
    if not unconditional:
        return rows.select(key, "idx", "context", "continuation")
    both = F.array(F.struct(F.col("idx"), F.col("context")), F.struct((F.col("idx") + F.col("n")).alias("idx"), F.lit("").alias("context")))
    sized = docs.select(key, F.size(choices).alias("n"), F.col(context).alias("context"), F.posexplode(choices).alias("idx", "continuation"))
    return sized.select(key, "continuation", F.inline(both)).select(key, "idx", "context", "continuation")


def choose(losses: Column, lengths: Column | None = None) -> Column:
    """Place of the least loss, or of the least loss by length; the first of equals."""
    scored = losses if lengths is None else F.zip_with(losses, lengths, lambda a, b: a / b)
    return (F.array_position(scored, F.array_min(scored)) - 1).cast("int")


def gold_or_none(gold: Column, choices: Column) -> Column:
    """The gold place, or -100 outside the choices; negative places count from the end."""
    n = F.size(choices)
    return F.when((gold >= -n) & (gold < 0), gold + n).when((gold >= 0) & (gold < n), gold).otherwise(-100)


def mutual_information(conditional: Column, unconditional: Column) -> Column:
    """Place of the greatest gain of the conditional over the unconditional log-likelihood."""
    gain = F.zip_with(conditional, unconditional, lambda a, b: a - b)
    return (F.array_position(gain, F.array_max(gain)) - 1).cast("int")


def few_shot(docs: DataFrame, pool: DataFrame, key: str, text: str, n: int, seed: int = 0) -> DataFrame:
    """``key, shot, example``: ``n`` examples for each document from a fixed shuffle of the pool, never the document itself.

    One more than ``n`` examples is drawn, so that the join has ``n + 1`` rows on its side whatever the pool's size.
    """
    drawn = pool.select(F.col(key).alias("_from"), F.col(text).alias("example")).orderBy(hash_order(F.col("_from"), seed), "_from").limit(n + 1)
    listed = drawn.agg(F.sort_array(F.collect_list(F.struct(hash_order(F.col("_from"), seed).alias("h"), F.col("_from"), F.col("example")))).alias("_all"))  # n + 1 examples
    met = docs.select(key, F.col(text).alias("_own"), F.lit(1).alias("_k")).join(F.broadcast(listed.withColumn("_k", F.lit(1))), "_k")  # one row
    others = F.slice(F.filter("_all", lambda x: ~((x["_from"] == F.col(key)) & x["example"].eqNullSafe(F.col("_own")))), 1, n)
    return met.select(key, F.posexplode(others).alias("shot", "_x")).select(key, "shot", F.col("_x.example").alias("example"))


def shuffled_choices(docs: DataFrame, key: str, right: str, wrong: str, seed: int = 0) -> DataFrame:
    """``key, choices, answer``: the right and the wrong answers in a fixed shuffle, and the letter of the right one."""
    every = F.array_union(F.array(F.struct(F.lit(True).alias("ok"), F.col(right).alias("c"))), F.transform(wrong, lambda c: F.struct(F.lit(False).alias("ok"), c.alias("c"))))
    order = F.sort_array(F.transform(every, lambda x: F.struct(F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}:"), x["c"])).alias("h"), x["ok"].alias("ok"), x["c"].alias("c"))))
    return docs.select(key, order.alias("_o")).select(key, F.col("_o.c").alias("choices"), F.char(F.array_position(F.transform("_o", lambda x: x["ok"]), F.lit(True)) + 64).alias("answer"))


def by_length(rows: DataFrame, key: str, length: str, batch: int) -> DataFrame:
    """``rows`` with ``batch``: longest first, so many at a time, without gathering rows in one task."""
    placed = ranked(rows, [F.desc(length), F.col(key)])
    return placed.withColumn("batch", F.floor((F.col("_rank") - 1) / batch)).drop("_rank")


def restored(batched: DataFrame, key: str) -> DataFrame:
    """Rows of batches in their first order again."""
    return batched.orderBy(key)


def variable_length_groups(rows: DataFrame, key: str, length: str, batch: int, world: int, mega: int = 8, seed: int = 0) -> DataFrame:
    """``rows`` with ``place``: mega-batches of similar length, shuffled inside, whose batches are shuffled again.

    Ranks are global, so every step is a range sort.
    """
    size = batch * world
    long = ranked(rows, [F.desc(length), F.col(key)], "_long").withColumn("_mega", F.floor((F.col("_long") - 1) / (size * mega)))
    mixed = ranked(long, [F.col("_mega"), hash_order(F.col(key), seed).desc(), F.col(key)], "_mixed").withColumn("_batch", F.floor((F.col("_mixed") - 1) / size))
    return ranked(mixed, [hash_order(F.col("_batch"), seed + 1), F.col("_batch"), F.col("_mixed")], "place").drop("_long", "_mega", "_mixed", "_batch")


def modality_batches(rows: DataFrame, key: str, length: str, batch: int, world: int, seed: int = 0, merge: bool = True) -> DataFrame:
    """``rows`` with ``mega``: batches of one modality (the sign of ``length``) of ``batch * world`` rows in a fixed shuffle.

    What does not fill a batch at either end is joined as the last batch, or dropped without ``merge``, which is the feature there.
    """
    size = batch * world
    parts = []
    for kind, own in ((0, rows.where(F.col(length) > 0)), (1, rows.where(F.col(length) <= 0))):
        placed = ranked(own, [hash_order(F.col(key), seed), F.col(key)], "_place")
        parts.append(placed.withColumn("_b", F.floor((F.col("_place") - 1) / size)).withColumn("_kind", F.lit(kind)))
    both = parts[0].union(parts[1])
    sizes = both.groupBy("_kind", "_b").agg((F.count(F.lit(1)) == size).alias("_full"))
    full = both.join(sizes, ["_kind", "_b"])
    out = full.withColumn("mega", F.when(F.col("_full"), F.concat(F.when(F.col("_kind") == 0, "image ").otherwise("text "), F.col("_b").cast("string"))).otherwise("rest"))
    out = out if merge else out.where("_full")
    return out.drop("_place", "_b", "_kind", "_full")
