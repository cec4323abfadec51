"""Scores of nested records: tree edit distance and best-matching word n-grams; Arrow-batched, a row at a time inside."""

from __future__ import annotations

import bisect
import difflib
import json
import math
import operator
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

Tree = tuple[str, list]


def tree_of(value: object, name: str = "") -> Tree:
    """A JSON value as a tree: keys in order, list items and leaves as nodes."""
    if isinstance(value, dict):
        return name, [tree_of(v, f"key:{k}") for k, v in sorted(value.items())]
    if isinstance(value, list):
        return name, [tree_of(v, "item") for v in value]
    return name, [(f"leaf:{value}", [])]


def _size(t: Tree) -> int:
    return 1 + sum(map(_size, t[1]))


def _post(t: Tree, labels: list[str], first: list[int]) -> int:
    """Labels in postorder, and of each node the place of its leftmost leaf."""
    leaf = None
    for c in t[1]:
        at = _post(c, labels, first)
        leaf = at if leaf is None else leaf
    labels.append(t[0])
    first.append(len(labels) - 1 if leaf is None else leaf)
    return first[-1]


def tree_distance(a: Tree, b: Tree, rename: Callable[[object, object], float] = operator.ne) -> float:
    """Least cost of inserted, deleted and renamed nodes between two ordered trees; the first two cost 1 each.

    Nodes whose places in postorder differ by more than the distance are never paired, so pairs within a strip are enough
    where the result is no wider than that; the strip is widened until it is.  Like trees cost their size and not its square.
    """
    if a == b:
        return 0
    la, fa, lb, fb = [], [], [], []
    _post(a, la, fa), _post(b, lb, fb)
    number: dict[object, int] = {}
    ia, ib = ([number.setdefault(x, len(number)) for x in labels] for labels in (la, lb))
    known: dict[tuple[int, int], float] = {}

    def cost(p: int, q: int) -> float:
        pair = ia[p], ib[q]
        if pair not in known:
            known[pair] = rename(la[p], lb[q])
        return known[pair]

    roots_a, roots_b = (sorted({f: i for i, f in enumerate(first)}.values()) for first in (fa, fb))
    width = max(4, abs(len(la) - len(lb)))
    while True:
        found = _strip_distance(fa, fb, roots_a, roots_b, cost, width)
        if found <= width or width >= len(la) + len(lb):
            return found
        width *= 2


def _strip_distance(fa: list[int], fb: list[int], roots_a: list[int], roots_b: list[int], cost: Callable[[int, int], float], k: int) -> float:
    """The distance if it is ``k`` or less, else some number above; of pairs of places in postorder no more than ``k`` apart."""
    none: dict[int, float] = {}
    tree: dict[tuple[int, int], float] = {}
    for i in roots_a:
        for j in roots_b[bisect.bisect_left(roots_b, fa[i] - k) :]:
            left, top = fb[j] - 1, fa[i] - 1
            if left + 1 > i + k:
                continue
            if left + 1 == j and top + 1 == i:  # two leaves
                if abs(i - j) <= k:
                    tree[i, j] = min(2, cost(i, j))
                continue
            rows: dict[int, dict[int, float]] = {}
            for p in range(max(top, left - k), min(i, j + k) + 1):
                above, row = rows.get(p - 1, none), {}
                for q in range(max(left, p - k), min(j, p + k) + 1):
                    if p == top:
                        row[q] = q - left
                    elif q == left:
                        row[q] = p - top
                    else:
                        least = min(above.get(q, math.inf), row.get(q - 1, math.inf)) + 1
                        if fa[p] == top + 1 and fb[q] == left + 1:
                            row[q] = tree[p, q] = min(least, above.get(q - 1, math.inf) + cost(p, q))
                        else:
                            row[q] = min(least, rows.get(fa[p] - 1, none).get(fb[q] - 1, math.inf) + tree.get((p, q), math.inf))
                rows[p] = row
    return tree.get((len(fa) - 1, len(fb) - 1), math.inf)


def record_similarity(pred: str | None, gold: str | None) -> float | None:
    """One less the tree edit distance of two JSON texts over the size of the gold tree, not under 0; null for a gold text that does not parse, 0 for such a reply."""
    try:
        g = tree_of(json.loads(gold))
    except (TypeError, ValueError):
        return None
    try:
        p = tree_of(json.loads(pred))
    except (TypeError, ValueError):
        return 0.0
    return max(0.0, 1 - tree_distance(p, g) / _size(g))


def leaves(value: object, path: str = "") -> list[str]:
    """Every leaf of a JSON value with its path."""
    if isinstance(value, dict):
        return [x for k, v in value.items() for x in leaves(v, f"{path}.{k}")]
    if isinstance(value, list):
        return [x for v in value for x in leaves(v, path)]
    return [f"{path}={value}"]


def best_ngram(reply: str | None, gold: str | None) -> tuple[float, str, float, float, float, float, bool]:
    """The word n-gram of a reply, as long as the gold text, that is most like it: similarity, the n-gram, precision, recall, F1 and Jaccard of the words, and equality."""
    want = (gold or "").split()
    have = (reply or "").split()
    best, at = 0.0, []
    for i in range(len(have) - len(want) + 1) if want else []:
        gram = have[i : i + len(want)]
        if not set(gram).isdisjoint(want):
            s = difflib.SequenceMatcher(None, " ".join(gram), gold).ratio()
            if s > best:
                best, at = s, gram
    if not at:
        return 0.0, "", 0.0, 0.0, 0.0, 0.0, False
    p, r = set(at), set(want)
    both = len(p & r)
    return best, " ".join(at), both / len(p), both / len(r), 2 * both / (len(p) + len(r)), both / len(p | r), at == want


def matched(reply: Column, gold: Column) -> Column:
    @F.pandas_udf("struct<similarity:double,ngram:string,precision:double,recall:double,f1:double,jaccard:double,exact:boolean>")
    def run(a: pd.Series, b: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([best_ngram(x, y) for x, y in zip(a, b, strict=True)], columns=["similarity", "ngram", "precision", "recall", "f1", "jaccard", "exact"])

    return run(reply, gold)
