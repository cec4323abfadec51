"""Connected components by alternating large-star and small-star steps.

Every step is a grouped minimum (with partial aggregation, so that a node with
very many neighbours costs no more than its rows) and a join; nodes with a ten-
thousandth of the edges or more are joined by broadcast.  Edges are staged between rounds; nothing of them
passes through the driver but those hubs and two numbers that tell whether a round changed
anything.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from minewright.staging import drop_staged, stage


#: A node with more neighbours than this and than the edges' ten-thousandth is met by broadcast; there are ten thousand of them at most.
HOT, SHARE = 1000, 10_000


def _star(edges: DataFrame, small: bool, total: int) -> DataFrame:
    """``u, v`` rows hung on each node's smallest neighbour: the larger ones by large-star, the smaller ones by small-star."""
    if small:
        e = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    else:
        e = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = e.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n")).withColumn("m", F.least("m", "u"))
    hot = low.where(F.col("n") > max(HOT, 2 * total // SHARE)).select("u", "m").collect() if total > HOT else []
    if hot:
        hubs = F.broadcast(edges.sparkSession.createDataFrame(hot, "u long, m long"))
        hung = e.join(hubs, "u").union(e.join(hubs.select("u"), "u", "left_anti").join(low.select("u", "m"), "u"))
    else:
        hung = e.join(low.select("u", "m"), "u")
    if small:
        out = hung.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v")))
    else:
        out = hung.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return out.where("u <> v").distinct()


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``node, component`` for every node of ``edges`` (``u long, v long``); a component is named by its smallest node.

    Self-loops, nulls, repeated and reversed edges are allowed; nodes with self-loops only are their own component.
    """
    edges = edges.where("u IS NOT NULL AND v IS NOT NULL")
    current = stage(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    loops = current.where("u = v").select(F.col("u").alias("node"))
    work, seen, total = current.where("u <> v"), None, current.count()
    for _ in range(max_rounds):
        step = stage(_star(_star(work, small=False, total=total), small=True, total=total), "edges")
        now = tuple(step.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if hasattr(work, "_staged_at"):
            drop_staged(work)
        work = step
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError("components did not settle")
    stars = work.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = work.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
    alone = loops.join(work.select(F.col("u").alias("node")).union(work.select(F.col("v").alias("node"))).distinct(), "node", "left_anti").distinct().select("node", F.col("node").alias("component"))
    return stars.union(roots).union(alone)


def with_least(rows: DataFrame, component: str, value: str, hot_rows: int = HOT) -> DataFrame:
    """``rows``, a staged table, with ``least``: the smallest value in the row's component; null for rows without one.

    Components of over ``hot_rows`` rows and a ten-thousandth of all, which are ten thousand at most, are met by broadcast,
    so that no task gets all rows of one.
    """
    least = rows.where(F.col(component).isNotNull()).groupBy(component).agg(F.min(value).alias("least"), F.count(F.lit(1)).alias("_n"))
    bound = max(hot_rows, rows.count() // SHARE)
    found = least.where(F.col("_n") > bound).select(component, "least")
    hot = found.collect()
    if not hot:
        return rows.join(least.drop("_n"), component, "left")
    hubs = F.broadcast(rows.sparkSession.createDataFrame(hot, found.schema))
    rest = rows.join(hubs.select(component), component, "left_anti").join(least.drop("_n"), component, "left")
    return rows.join(hubs, component).unionByName(rest)
