"""Samples, splits, shards and batches with a total order in place of chance."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from minewright.staging import drop_staged, stage


def hash_order(key: Column, seed: int) -> Column:
    """A fixed shuffle that other engines can repeat."""
    return F.md5(F.concat(key.cast("string"), F.lit(f":{seed}")))


def ranked(rows: DataFrame, order: list[Column], name: str = "_rank") -> DataFrame:
    """Global row numbers from 1 by a range sort and partition offsets, without gathering rows in one task."""
    spark = rows.sparkSession
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Written once, so that a row's partition and place are the same for both uses.
    placed = stage(rows.repartitionByRange(width, *order).sortWithinPartitions(*order).withColumn("_p", F.spark_partition_id()).withColumn("_o", F.monotonically_increasing_id()), "ranked")
    inner = placed.withColumn("_n", (F.col("_o") - F.shiftleft(F.col("_p").cast("long"), 33)) + 1)
    sizes = placed.groupBy("_p").agg(F.count(F.lit(1)).alias("_size"))
    before = sizes.select("_p", (F.sum("_size").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1))).alias("_before"))  # a row per partition
    return inner.join(F.broadcast(before), "_p").withColumn(name, F.col("_n") + F.coalesce("_before", F.lit(0))).drop("_p", "_o", "_n", "_before")


def ranked_within(rows: DataFrame, by: list[str], order: list[str], size: str | None = None) -> DataFrame:
    """Per group ``_rank`` from 1, ``_count`` of all its rows and ``_run``, the sum of ``size`` up to a row.

    Rows are range-sorted by group and order; a task sees a group's rows of one range, and the sums and counts of the
    ranges before it, a row per group and range, give the rest.
    """
    width = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Written once, so that a row's range is the same for both uses.
    placed = stage(rows.repartitionByRange(width, *by, *order).withColumn("_p", F.spark_partition_id()), "ranked-within")
    amount = F.coalesce(F.col(size), F.lit(0)) if size else F.lit(0)
    here = Window.partitionBy(*by, "_p").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    inner = placed.withColumn("_n", F.row_number().over(here)).withColumn("_s", F.sum(amount).over(here))
    ranges = placed.groupBy(*by, "_p").agg(F.count(F.lit(1)).alias("_size"), F.sum(amount).alias("_sum"))
    whole = Window.partitionBy(*by)
    before = whole.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranges.select(
        *[F.col(b).alias(f"_by{i}") for i, b in enumerate(by)], F.col("_p").alias("_q"), F.sum("_size").over(whole).alias("_count"),
        F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_rows_before"), F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_sum_before"))
    same = F.col("_p") == F.col("_q")
    for i, b in enumerate(by):
        same = same & F.col(b).eqNullSafe(F.col(f"_by{i}"))
    joined = inner.join(offsets, same)
    return joined.select(*rows.columns, (F.col("_n") + F.col("_rows_before")).alias("_rank"), "_count", (F.col("_s") + F.col("_sum_before")).alias("_run"))


def ntile(rows: DataFrame, by: list[str], order: list[str], parts: int, name: str) -> DataFrame:
    """Each group in ``parts`` even parts in order, the larger ones first."""
    q, r, at = F.expr(f"_count div {parts}"), F.expr(f"_count % {parts}"), F.col("_rank") - 1
    tile = F.when(at < r * (q + 1), F.floor(at / (q + 1))).otherwise(r + F.floor((at - r * (q + 1)) / F.greatest(q, F.lit(1))))
    return ranked_within(rows, by, order).select(*rows.columns, (tile + 1).cast("int").alias(name))


def wanted(strategy: str, n: int) -> tuple[str, int]:
    """``first:2``, ``end:10%``, ``random:5``, ``all`` as a kind and a count; shares round up."""
    kind, _, size = strategy.partition(":")
    if kind == "all":
        return kind, n
    if kind not in ("first", "end", "random") or not size:
        raise ValueError(f"unknown sampling strategy {strategy!r}")
    return kind, math.ceil(n * int(size[:-1]) / 100) if size.endswith("%") else int(size)


#: Rows of a sample that one task may hold.
FEW_ROWS = 10_000


def sample(rows: DataFrame, strategy: str, order: str, seed: int = 0) -> DataFrame:
    """Rows of a mixture entry: all, the first, the last or a hashed choice of so many."""
    if strategy == "all":
        return rows
    kind, k = wanted(strategy, rows.count())
    by = {"first": [F.col(order).asc()], "end": [F.col(order).desc()], "random": [hash_order(F.col(order), seed), F.col(order)]}[kind]
    if k <= FEW_ROWS:
        return rows.orderBy(*by).limit(k)  # a bounded heap in each task
    return ranked(rows, by).where(F.col("_rank") <= k).drop("_rank")


def mixture(entries: list[tuple[DataFrame, str]], order: str, seed: int = 0) -> DataFrame:
    """Sampled datasets under each other; missing columns are null."""
    parts = [sample(df, s, order, seed) for df, s in entries]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def top_per_group(rows: DataFrame, by: list[str], order: list[Column], k: int) -> DataFrame:
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("rank") <= k)


def word_length(conversations: Column, image: Column) -> Column:
    """Words of all turns, and 128 more with an image; negative for text alone."""
    words = F.aggregate(F.transform(conversations, lambda c: F.size(F.filter(F.split(F.trim(c), r"\s+"), lambda w: w != ""))), F.lit(0), lambda a, x: a + x)
    return F.when(image, words + 128).otherwise(-words)


def length_batches(rows: DataFrame, key: str, length: str, batch: int, world: int, seed: int = 0, by: list[str] | None = None) -> DataFrame:
    """Hash-shuffled mega-batches of ``batch * world`` rows, each sorted by length and dealt evenly over workers.

    ``megabatch``, ``worker``: a mega-batch's rows go longest first to the least loaded worker with room, in one task of its bounded size.
    """
    size = batch * world
    keyed = ranked(rows, [hash_order(F.col(key), seed), F.col(key)], "_rank").withColumn("megabatch", F.floor((F.col("_rank") - 1) / size)).drop("_rank")

    def deal(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values([length, key], ascending=[False, True], ignore_index=True)
        room = -(-len(pdf) // world)
        load, held, worker = np.zeros(world), np.zeros(world, int), []
        for n in pdf[length]:
            w = int(np.lexsort((np.arange(world), np.where(held < room, load, np.inf)))[0])
            load[w] += n
            held[w] += 1
            worker.append(w)
        return pdf.assign(worker=worker)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in keyed.schema.fields) + ", worker int"
    return keyed.groupBy("megabatch", *(by or [])).applyInPandas(deal, schema)


def _squares(v: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Least squared distance of each row to the centres."""
    out = np.full(len(v), np.inf)
    for c in centres:
        np.minimum(out, ((v - c) ** 2).sum(axis=1), out=out)
    return out


def kcenter(vectors: DataFrame, k: int, ident: str = "vec_id", vector: str = "embedding", ahead: int = 512) -> DataFrame:
    """``step, id`` of a greedy k-center choice: from the smallest id on, always the row farthest from all chosen.

    A round is one pass over the staged rows with the newest centres; a row keeps its least distance.  It brings the
    ``ahead`` farthest rows to the driver, and as distances only shrink, the choice goes on among these while their
    farthest is farther than any row that was left behind; so a round gives many exact steps.
    """
    live = stage(vectors.select(F.col(ident).alias("id"), F.col(vector).cast("array<double>").alias("v")).where("v IS NOT NULL").withColumn("d", F.lit(float("inf"))), "kcenter")
    first = live.orderBy("id").first()
    chosen: list[int] = []
    new = [np.array(first.v)] if first and k > 0 else []
    if new:
        chosen.append(first.id)
    while new and len(chosen) < k:
        centres = np.stack(new)

        def nearer(batches: Iterator[pa.RecordBatch], centres: np.ndarray = centres) -> Iterator[pa.RecordBatch]:
            for b in batches:
                v = b.column(1).flatten().to_numpy().reshape(b.num_rows, -1) if b.num_rows else np.zeros((0, centres.shape[1]))
                yield pa.record_batch([b.column(0), b.column(1), pa.array(np.minimum(b.column(2).to_numpy(), _squares(v, centres)))], names=["id", "v", "d"])

        live, old = stage(live.mapInArrow(nearer, live.schema), "kcenter"), live
        drop_staged(old)
        far = live.where(~F.col("id").isin(chosen)).orderBy(F.desc("d"), "id").limit(ahead).collect()
        new = []
        if not far:
            break
        ids, v, d = np.array([r.id for r in far]), np.array([r.v for r in far]), np.array([r.d for r in far])
        left = d[-1] if len(far) == ahead else -1.0  # no row left behind is farther
        while len(chosen) < k and len(ids):
            at = np.lexsort((ids, -d))[0]
            if new and not d[at] > left:
                break
            chosen.append(int(ids[at]))
            new.append(v[at])
            d = np.minimum(d, _squares(v, v[at : at + 1]))
            keep = np.arange(len(ids)) != at
            ids, v, d = ids[keep], v[keep], d[keep]
    drop_staged(live)
    return vectors.sparkSession.createDataFrame([(i, x) for i, x in enumerate(chosen)], "step int, id long")


def windows(tokens: Column, max_len: int, context: int = 1) -> Column:
    """Rolling windows of tokens: a first one of ``max_len``, then as many new tokens with ``context`` before them."""
    step = max_len - context + 1
    n = F.size(tokens)
    starts = F.when(n == 0, F.array().cast("array<int>")).otherwise(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0)), F.lit(step)))
    return F.transform(starts, lambda s: F.struct(s.alias("start"), F.slice(tokens, s + 1, F.lit(step)).alias("tokens")))


def running_buckets(rows: DataFrame, by: list[str], order: str, size: str, limit: int) -> DataFrame:
    """``bucket``: how often the running size has passed the limit before a row."""
    placed = ranked_within(rows, by, [order], size)
    return placed.select(*rows.columns, F.floor((F.col("_run") - F.col(size)) / limit).alias("bucket"))
