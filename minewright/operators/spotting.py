"""Text spotting: found boxes against an image's gold boxes, by a grid join and one-to-one matching in rounds.

A found box that shares more than half of both boxes' union, or of its own area, with a
gold box has its centre in that box.  So gold boxes go to the cells of a grid as coarse
as they are large, four at most, a found box's centre to its cell of every grid in use,
and only what meets in a cell is measured.  Boxes of a crowded image are so dealt by
place and not by image alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from minewright.staging import drop_staged, stage

#: The marks allowed at either end of a gold text, and the text of regions that are left out.
MARKS = "!?.:,*\"()·[]/'"
LEFT_OUT = "###"


def texts_match(gold: Column, found: Column) -> Column:
    """Equal in any case, or equal without a mark at the gold text's beginning, its end, or both."""
    g, f = F.upper(gold), F.upper(found)
    marks = F.array(*[F.lit(m) for m in MARKS])
    n = F.length(g)
    first, last = F.array_contains(marks, F.substring(g, 1, 1)), F.array_contains(marks, F.substring(g, -1, 1))
    cut = lambda a, b: F.substring(g, F.lit(a), F.greatest(n - b, F.lit(0)))
    return (g == f) | ((n > 0) & ((first & (cut(2, 1) == f)) | (last & (cut(1, 1) == f)) | (first & last & (cut(2, 2) == f))))


def _area(p: str) -> Column:
    return (F.col(f"{p}_x2") - F.col(f"{p}_x1")) * (F.col(f"{p}_y2") - F.col(f"{p}_y1"))


def _named(boxes: DataFrame, p: str) -> DataFrame:
    return boxes.select("image", F.col("box").alias(f"{p}_box"), *[F.col(c).cast("double").alias(f"{p}_{c}") for c in ("x1", "y1", "x2", "y2")], F.col("text").alias(f"{p}_text"))


def box_pairs(gold: DataFrame, found: DataFrame) -> DataFrame:
    """Pairs of an image's boxes where the gold one holds the found one's centre, with ``iou`` and ``covered``, the part of the found box.

    Both have ``image, box, x1, y1, x2, y2, text``; found boxes without an area take no part, gold ones can't be met.
    """
    g = _named(gold, "g").where("g_x2 > g_x1 AND g_y2 > g_y1").withColumn("level", F.ceil(F.log2(F.greatest(F.col("g_x2") - F.col("g_x1"), F.col("g_y2") - F.col("g_y1")))).cast("int"))
    f = _named(found, "f").where("f_x2 > f_x1 AND f_y2 > f_y1")
    levels = [r.level for r in g.select("level").distinct().collect()]  # powers of two: two thousand at most, by the range of doubles
    cell = F.pow(F.lit(2.0), F.col("level"))
    span = lambda a, b: F.explode(F.sequence(F.floor(F.col(a) / cell), F.floor(F.col(b) / cell)))
    placed = g.withColumn("cx", span("g_x1", "g_x2")).withColumn("cy", span("g_y1", "g_y2"))
    middle = lambda a: F.floor((F.col(f"f_{a}1") + F.col(f"f_{a}2")) / 2 / cell)
    asked = f.withColumn("level", F.explode(F.array(*[F.lit(x) for x in levels]).cast("array<int>"))).withColumn("cx", middle("x")).withColumn("cy", middle("y"))
    shared = lambda a: F.greatest(F.least(f"g_{a}2", f"f_{a}2") - F.greatest(f"g_{a}1", f"f_{a}1"), F.lit(0.0))
    both = shared("x") * shared("y")
    return placed.join(asked, ["image", "level", "cx", "cy"]).withColumn("both", both).where("both > 0").select(
        "image", "g_box", "f_box", "g_text", "f_text", (F.col("both") / (_area("g") + _area("f") - F.col("both"))).alias("iou"), (F.col("both") / _area("f")).alias("covered"))


def matched(edges: DataFrame, max_rounds: int = 1000) -> DataFrame:
    """A greedy one-to-one choice of ``edges`` (``image, g_box, f_box`` and more), gold boxes in order, each with its first free found box.

    An edge that comes first at both its ends is in the choice whatever else is; each round takes all of these and drops what they meet.
    """
    left, out = stage(edges, "spotting-edges"), []
    for _ in range(max_rounds):
        if left.isEmpty():
            break
        at = lambda a, b: F.min(b).over(Window.partitionBy("image", a))
        ranked = left.withColumn("_f", at("g_box", "f_box")).withColumn("_g", at("f_box", "g_box"))
        taken = stage(ranked.where("_f = f_box AND _g = g_box").drop("_f", "_g"), "spotting-taken")
        out.append(taken)
        rest = left.join(taken.select("image", "g_box"), ["image", "g_box"], "left_anti").join(taken.select("image", "f_box"), ["image", "f_box"], "left_anti")
        rest = stage(rest, "spotting-edges")
        drop_staged(left)
        left = rest
    else:
        raise RuntimeError("the matching did not end")
    whole = left
    for taken in out:
        whole = whole.unionByName(taken)
    return whole


def spotting_counts(gold: DataFrame, found: DataFrame, iou: float = 0.5, covered: float = 0.5) -> DataFrame:
    """``image, n_right, n_gold, n_found``: found boxes matched to a gold one of the same text, and boxes of both kinds that count.

    Gold boxes with the text ``###`` are left out, and so are found boxes with more than ``covered`` of their area in one.
    """
    if min(iou, covered) < 0.5:
        raise ValueError("boxes are met by their centres, which takes a half of them in common")
    pairs = stage(box_pairs(gold, found), "spotting-pairs")
    off = pairs.where((F.col("g_text") == LEFT_OUT) & (F.col("covered") > covered)).select("image", "f_box").distinct()
    edges = pairs.where((F.coalesce("g_text", F.lit("")) != LEFT_OUT) & (F.col("iou") > iou)).join(off, ["image", "f_box"], "left_anti")
    right = matched(edges).withColumn("right", texts_match(F.coalesce("g_text", F.lit("")), F.coalesce("f_text", F.lit(""))).cast("long"))
    count = lambda df, name: df.groupBy("image").agg(F.count(F.lit(1)).alias(name))
    kept = found.where("x2 > x1 AND y2 > y1").select("image", F.col("box").alias("f_box")).join(off, ["image", "f_box"], "left_anti")
    images = gold.select("image").union(found.select("image")).distinct()
    met = images.join(right.groupBy("image").agg(F.sum("right").alias("n_right")), "image", "left")
    met = met.join(count(gold.where(F.coalesce("text", F.lit("")) != LEFT_OUT), "n_gold"), "image", "left").join(count(kept, "n_found"), "image", "left")
    return met.na.fill(0, ["n_right", "n_gold", "n_found"])


def _rates(right: Column, n_gold: Column, n_found: Column, empty_is_right: bool) -> list[Column]:
    none = F.when(n_found > 0, 0.0).otherwise(1.0) if empty_is_right else F.lit(0.0)
    precision = F.when(n_gold == 0, none).otherwise(F.coalesce(F.try_divide(right, n_found), F.lit(0.0)))
    recall = F.when(n_gold == 0, 1.0 if empty_is_right else 0.0).otherwise(F.try_divide(right, n_gold))
    return [precision.alias("precision"), recall.alias("recall"), F.coalesce(F.try_divide(2 * precision * recall, precision + recall), F.lit(0.0)).alias("f_mean")]


def spotting_by_image(counts: DataFrame) -> DataFrame:
    """Rates of each image; without gold boxes that count, recall is 1 and precision 1 if nothing was found either."""
    return counts.select("image", "n_right", "n_gold", "n_found", *_rates(F.col("n_right"), F.col("n_gold"), F.col("n_found"), empty_is_right=True))


def spotting_whole(counts: DataFrame) -> DataFrame:
    """One row of rates from the sums over all images."""
    sums = counts.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n_right", "n_gold", "n_found")])
    return sums.select("n_right", "n_gold", "n_found", *_rates(F.col("n_right"), F.col("n_gold"), F.col("n_found"), empty_is_right=False))
