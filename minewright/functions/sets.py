"""Scores of lists, sets, sequences and maps, as native columns; -1 is never a score here, null in gives null out."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def jaccard(a: Column, b: Column) -> Column:
    """Size of the intersection over the union; two empty sets agree."""
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, 1.0).otherwise(F.size(F.array_intersect(a, b)) / union)


def set_equality(a: Column, b: Column) -> Column:
    return (F.size(F.array_except(a, b)) == 0) & (F.size(F.array_except(b, a)) == 0)


def set_precision(pred: Column, ref: Column) -> Column:
    p = F.array_distinct(pred)
    return F.when(F.size(p) == 0, F.when(F.size(ref) == 0, 1.0).otherwise(0.0)).otherwise(F.size(F.array_intersect(p, ref)) / F.size(p))


def sequence_equality(a: Column, b: Column) -> Column:
    return a == b


def position_accuracy(pred: Column, ref: Column) -> Column:
    """Share of places that agree; 0 for another length."""
    same = F.aggregate(F.zip_with(pred, ref, lambda x, y: F.when(x == y, 1).otherwise(0)), F.lit(0), lambda a, x: a + x)
    return F.when(F.size(pred) != F.size(ref), 0.0).when(F.size(ref) == 0, 1.0).otherwise(same / F.size(ref))


def common_prefix_ratio(pred: Column, ref: Column) -> Column:
    """Length of the common beginning over the reference's."""
    agree = F.zip_with(pred, ref, lambda x, y: x.eqNullSafe(y) & y.isNotNull())
    stop = F.array_position(agree, F.lit(False))
    n = F.when(stop > 0, stop - 1).otherwise(F.least(F.size(pred), F.size(ref)))
    return F.when(F.size(ref) == 0, F.when(F.size(pred) == 0, 1.0).otherwise(0.0)).otherwise(n / F.size(ref))


def map_precision(pred: Column, ref: Column) -> Column:
    """Share of the predicted keys whose values are right."""
    right = F.size(F.filter(F.map_keys(pred), lambda k: F.try_element_at(ref, k).eqNullSafe(F.try_element_at(pred, k)) & F.map_contains_key(ref, k)))
    return F.when(F.size(pred) == 0, F.when(F.size(ref) == 0, 1.0).otherwise(0.0)).otherwise(right / F.size(pred))


def any_reference(pred: Column, refs: Column) -> Column:
    return F.exists(refs, lambda r: F.lower(F.trim(r)) == F.lower(F.trim(pred)))


def consensus(pred: Column, answers: Column) -> Column:
    """Mean over leaving one annotator out, by position, of min(1, matches among the others / 3)."""
    hits = F.transform(answers, lambda a: F.when(a == pred, 1.0).otherwise(0.0))
    total = F.aggregate(hits, F.lit(0.0), lambda a, x: a + x)
    each = F.transform(hits, lambda h: F.least(F.lit(1.0), (total - h) / 3))
    return F.try_divide(F.aggregate(each, F.lit(0.0), lambda a, x: a + x), F.size(answers))


def number_closeness(pred: Column, gold: Column) -> Column:
    """One less the relative difference, not under 0."""
    return F.when(gold == 0, F.when(pred == 0, 1.0).otherwise(0.0)).otherwise(F.greatest(F.lit(0.0), 1 - F.abs((pred - gold) / gold)))


def rmse_score(pred: Column, gold: Column, low: float = 0.0, high: float = 0.1) -> Column:
    """Root mean square error of two vectors clipped to a range and turned into a score."""
    square = F.aggregate(F.zip_with(pred, gold, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda a, x: a + x)
    error = F.sqrt(square / F.size(gold))
    return 1 - (F.least(F.greatest(error, F.lit(low)), F.lit(high)) - low) / (high - low)
