"""Boxes, points and spans, as native arithmetic on arrays of four doubles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def area(b: Column) -> Column:
    return F.greatest(F.lit(0.0), b[2] - b[0]) * F.greatest(F.lit(0.0), b[3] - b[1])


def iou(a: Column, b: Column) -> Column:
    """Intersection over union of ``[x1, y1, x2, y2]``; 0 for two empty boxes."""
    w = F.greatest(F.lit(0.0), F.least(a[2], b[2]) - F.greatest(a[0], b[0]))
    h = F.greatest(F.lit(0.0), F.least(a[3], b[3]) - F.greatest(a[1], b[1]))
    union = area(a) + area(b) - w * h
    return F.when(union <= 0, 0.0).otherwise(w * h / union)


def center_inside(pred: Column, gold: Column) -> Column:
    x, y = (pred[0] + pred[2]) / 2, (pred[1] + pred[3]) / 2
    return (x >= gold[0]) & (x <= gold[2]) & (y >= gold[1]) & (y <= gold[3])


def mean_best_iou(preds: Column, golds: Column) -> Column:
    """Mean over predictions of the best overlap with any gold box."""
    best = F.transform(preds, lambda p: F.array_max(F.transform(golds, lambda g: iou(p, g))))
    return F.when((F.size(preds) == 0) | (F.size(golds) == 0), 0.0).otherwise(F.aggregate(best, F.lit(0.0), lambda a, x: a + x) / F.size(preds))


def parse_box(s: Column) -> Column:
    """First bracketed list of four numbers, or zeros."""
    n = r"\s*(-?[0-9]*\.?[0-9]+)\s*"
    pattern = rf"\[{n},{n},{n},{n}\]"
    found = F.array(*[F.regexp_extract(s, pattern, i).try_cast("double") for i in range(1, 5)])
    return F.when(F.rlike(s, F.lit(pattern)), found).otherwise(F.array(*[F.lit(0.0)] * 4))


def span_iou(a: Column, b: Column) -> Column:
    """Overlap of two ``[start, end]`` spans."""
    inter = F.greatest(F.lit(0.0), F.least(a[1], b[1]) - F.greatest(a[0], b[0]))
    union = F.greatest(a[1], b[1]) - F.least(a[0], b[0])
    return F.when(union <= 0, 0.0).otherwise(inter / union)


def point_closeness(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    return F.greatest(F.lit(0.0), 1 - F.sqrt(F.pow(x1 - x2, 2) + F.pow(y1 - y2, 2)))


def keypoint_score(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    return F.exp(-10 * F.sqrt(F.pow(x1 - x2, 2) + F.pow(y1 - y2, 2)) / F.sqrt(F.lit(2.0)))


def geo_closeness(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """exp of minus the great-circle distance in hundreds of kilometres."""
    a, b = F.radians(lat1), F.radians(lat2)
    h = F.pow(F.sin((b - a) / 2), 2) + F.cos(a) * F.cos(b) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return F.exp(-2 * 6371.0 * F.asin(F.sqrt(F.least(F.lit(1.0), h))) / 100)


def best_resolution(width: Column, height: Column, candidates: list[tuple[int, int]]) -> Column:
    """Of the candidate sizes the one that keeps most pixels, then wastes least."""
    best = None
    for i, (w, h) in enumerate(candidates):
        scale = F.least(F.lit(w) / width, F.lit(h) / height)
        effective = F.least(F.floor(width * scale) * F.floor(height * scale), width * height)
        option = F.struct(effective.alias("e"), (effective - w * h).alias("waste"), F.lit(-i).alias("i"), F.lit(w).alias("w"), F.lit(h).alias("h"))
        best = option if best is None else F.greatest(best, option)
    return F.struct(best["w"].alias("w"), best["h"].alias("h"))


def boxes_of(text: Column) -> Column:
    """All ``[x1, y1, x2, y2]`` of a list of boxes, one bare box, or ``<box>`` marks; those that are no four numbers go."""
    marked = F.regexp_extract_all(text, F.lit(r"(?s)<box>(.*?)</box>"), 1)
    bare = F.regexp_extract_all(text, F.lit(r"[\[(]([^\[\]()]*)[\])]"), 1)
    lists = F.transform(F.when(F.size(marked) > 0, marked).otherwise(bare), lambda b: F.transform(F.split(b, ","), lambda x: F.trim(x).try_cast("double")))
    return F.filter(lists, lambda b: (F.size(b) == 4) & ~F.exists(b, lambda x: x.isNull()))


def sequence_iou(preds: Column, golds: Column) -> Column:
    """Mean overlap of boxes at equal places; 0 for another number of boxes or none."""
    each = F.zip_with(preds, golds, iou)
    mean = F.aggregate(each, F.lit(0.0), lambda a, x: a + x) / F.size(golds)
    return F.when((F.size(preds) != F.size(golds)) | (F.size(golds) == 0), 0.0).otherwise(mean)
