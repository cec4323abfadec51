"""Edit distances of sequences, bit-parallel, and the translation edit rate's search for block shifts; small helpers inside Arrow batches."""

from __future__ import annotations

import itertools
from collections.abc import Hashable, Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


class Target:
    """Distances of other sequences to one: a column of the distance table is two integers of a bit per item, and a number.

    ``extend`` carries a column over one more item, so sequences that begin alike share their columns.
    """

    def __init__(self, items: Sequence[Hashable]):
        self.items, self.n = items, len(items)
        self.full, self.top = (1 << self.n) - 1, 1 << self.n >> 1
        self.where: dict[Hashable, int] = {}
        for i, x in enumerate(items):
            self.where[x] = self.where.get(x, 0) | 1 << i
        self.start = (self.full, 0, self.n)

    def extend(self, column: tuple[int, int, int], item: Hashable) -> tuple[int, int, int]:
        up, down, score = column  # where the column rises by one from item to item, and where it falls
        same = self.where.get(item, 0)
        x = (((same & up) + up) ^ up) | same | down
        more, less = down | (self.full & ~(x | up)), up & x
        score += bool(more & self.top) - bool(less & self.top)
        more, less = more << 1 | 1, less << 1
        return (less | ~(x | more)) & self.full, more & x & self.full, score

    def columns(self, other: Sequence[Hashable], first: tuple[int, int, int] | None = None) -> list[tuple[int, int, int]]:
        out = [first or self.start]
        for x in other:
            out.append(self.extend(out[-1], x))
        return out

    def distance(self, other: Sequence[Hashable]) -> int:
        if not self.n:
            return len(other)
        column = self.start
        for x in other:
            column = self.extend(column, x)
        return column[2]


def edit_distance(a: Sequence[Hashable], b: Sequence[Hashable]) -> int:
    return Target(a).distance(b)


def _alignment(hyp: list, ref: list) -> tuple[list[int], list[bool], list[bool]]:
    """For each reference word the hypothesis' place it lies at, and which words of both are in error; a pair of words goes before a removal, that before an insertion."""
    n, m = len(hyp), len(ref)
    d = [list(range(m + 1))]
    for i in range(1, n + 1):
        before, row, word = d[-1], [i], hyp[i - 1]
        for j in range(1, m + 1):
            row.append(min(before[j - 1] + (word != ref[j - 1]), before[j] + 1, row[-1] + 1))
        d.append(row)
    at, h_err, r_err = [0] * m, [False] * n, [False] * m
    i, j = n, m
    while i or j:
        if i and j and d[i][j] == d[i - 1][j - 1] + (hyp[i - 1] != ref[j - 1]):
            i, j = i - 1, j - 1
            at[j] = i
            h_err[i] = r_err[j] = hyp[i] != ref[j]
        elif i and d[i][j] == d[i - 1][j] + 1:
            i -= 1
            h_err[i] = True
        else:
            j -= 1
            at[j], r_err[j] = i - 1, True
    return at, h_err, r_err


def _shifted(words: list, start: int, size: int, to: int) -> list:
    """The words with a block moved before the word that stood at ``to``; into itself, it stays."""
    block = words[start : start + size]
    if to < start:
        return words[:to] + block + words[to:start] + words[start + size :]
    if to > start + size:
        return words[:start] + words[start + size : to] + block + words[to:]
    return words


def _shifts(hyp: list, ref: list, room: int, longest: int, farthest: int) -> list[tuple[int, int, int]] | None:
    """``-size, start, to`` of the shifts to try; null if they are ``room`` or more."""
    at, h_err, r_err = _alignment(hyp, ref)
    h_sum, r_sum = [0, *itertools.accumulate(h_err)], [0, *itertools.accumulate(r_err)]
    places: dict[Hashable, list[int]] = {}
    for j, w in enumerate(ref):
        places.setdefault(w, []).append(j)
    out = []
    for start, word in enumerate(hyp):
        for j in places.get(word, ()):
            if abs(j - start) > farthest:
                continue
            size = 0
            while size < longest and start + size < len(hyp) and j + size < len(ref) and hyp[start + size] == ref[j + size]:
                size += 1
                if h_sum[start + size] == h_sum[start] or r_sum[j + size] == r_sum[j] or start <= at[j] < start + size:
                    continue
                seen = -1
                for k in range(j - 1, j + size):
                    to = at[k] + 1 if k >= 0 else 0
                    if to != seen:
                        out.append((-size, start, to))
                    seen = to
            if len(out) >= room:
                return None
    return out


def _best_shift(hyp: list, shifts: list[tuple[int, int, int]], target: Target) -> list | None:
    """The words after the shift that lowers the distance most, of equals the longest, the earliest, to the earliest place; null if none does.

    A block moved saves two edits a word at most, so shorter ones are tried only while they can still win.  A shifted text
    is read from where it differs, and no further than where its column of the table is that of the text as it was.
    """
    columns = target.columns(hyp)
    gained, best = 0, None
    for negative, start, to in sorted(shifts):
        size = -negative
        if 2 * size <= gained:
            break
        words = _shifted(hyp, start, size, to)
        if words is hyp:
            continue
        first, last = min(start, to), max(start + size, to)
        column = columns[first]
        for i in range(first, len(words)):
            column = target.extend(column, words[i])
            if i + 1 >= last and column[0] == columns[i + 1][0] and column[1] == columns[i + 1][1]:
                gain = columns[i + 1][2] - column[2]
                break
        else:
            gain = columns[-1][2] - column[2]
        if gain > gained:
            gained, best = gain, words
    return best


def shift_edits(hyp: list, ref: list, candidates: int = 1000, longest: int = 10, farthest: int = 50) -> int:
    """Word edits and block shifts that turn ``hyp`` into ``ref``: shifts are taken one by one while the best of them lowers the distance.

    A block is moved only where it stands in the reference, and only if it and its place there hold an error.  ``candidates`` bounds the shifts
    tried for a pair, the size and distance of a shift are bounded too: these are the measure's own bounds.
    """
    if not ref:
        return len(hyp)
    target, done = Target(ref), 0
    while (shifts := _shifts(hyp, ref, candidates, longest, farthest)) is not None:
        candidates -= len(shifts)
        words = _best_shift(hyp, shifts, target)
        if words is None:
            break
        hyp, done = words, done + 1
    return done + target.distance(hyp)


def _ter(pred: pd.Series, refs: pd.Series) -> pd.DataFrame:
    out = []
    for p, rs in zip(pred, refs, strict=True):
        hyp = (p or "").lower().split()
        known = [(r or "").lower().split() for r in rs] if rs is not None and len(rs) else [[]]
        out.append((min(shift_edits(hyp, r) for r in known), sum(map(len, known)) / len(known)))
    return pd.DataFrame(out, columns=["edits", "words"])


def edit_rate_counts(pred: Column, refs: Column) -> Column:
    """``edits`` to the nearest of ``refs`` (an array) and their mean number of ``words``; sums of both give a corpus' rate."""
    return F.pandas_udf(_ter, "edits long, words double")(pred, refs)
