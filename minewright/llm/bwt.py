"""Burrows-Wheeler transforms of string collections, merged by refining their interleave.

A collection is one array of symbols in which 0 ends each string.  A shard is
sorted once; shards are then merged without sorting suffixes again: the order of
all suffixes by their first h symbols is an interleave of the shards' orders,
and one pass over the transforms refines it to h + 1 symbols.  The pass in which
neighbours come apart gives their common prefix, and intervals of neighbours
with long common prefixes are the repeats.
"""

from __future__ import annotations

import numpy as np


def suffixes(symbols: np.ndarray, depth: int) -> np.ndarray:
    """Positions of a collection ordered by ``depth`` symbols at least, by prefix doubling; ends differ from each other."""
    end = np.flatnonzero(symbols == 0)
    rank = symbols.astype(np.int64) + len(end)
    rank[end] = np.arange(len(end))
    k = 1
    while k < depth:
        after = np.zeros_like(rank)
        after[:-k] = rank[k:]
        _, new = np.unique(rank * (int(rank.max()) + 1) + after, return_inverse=True)
        k *= 2
        rank = new
        if int(rank.max()) == len(rank) - 1:
            break
    return np.argsort(rank, kind="stable")


def transform(symbols: np.ndarray, order: np.ndarray) -> np.ndarray:
    """The symbol before each suffix in order; a string's own end before its whole."""
    return np.where(order > 0, symbols[order - 1], 0).astype(symbols.dtype)


def merge(transforms: list[np.ndarray], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Shard of each suffix in the merged order by ``depth`` symbols, and the symbols it shares with the suffix before it, ``depth`` at most.

    The pass in which two neighbours come apart is the length of their common prefix.
    """
    shard = np.repeat(np.arange(len(transforms), dtype=np.uint8 if len(transforms) < 256 else np.uint32), list(map(len, transforms)))
    flat = np.concatenate(transforms)
    common = np.full(len(flat), depth, np.int32)
    common[:1] = 0
    block = np.zeros(len(flat), np.int32)
    blocks = 1
    for h in range(depth):
        before = np.empty_like(flat)
        before[np.argsort(shard, kind="stable")] = flat  # each shard's transform in its own order, interleaved
        move = np.argsort(before, kind="stable")
        before, block = before[move], block[move]
        new = np.append(False, (before[1:] != before[:-1]) | (block[1:] != block[:-1]) | (before[1:] == 0))
        common[new & (common == depth)] = h
        block = np.cumsum(new, dtype=np.int32)
        moved = shard[move]
        now = int(block[-1]) + 1
        if now == len(block) or (now == blocks and np.array_equal(moved, shard)):
            shard = moved
            break
        shard, blocks = moved, now
    return shard, common


def intervals(common: np.ndarray, depth: int) -> np.ndarray:
    """Number of the interval of suffixes that share ``depth`` symbols, for each suffix of a merged order."""
    return np.cumsum(common < depth) - 1


def repeated(flat: np.ndarray, size: np.ndarray, weight: np.ndarray, depth: int, shard_strings: int) -> np.ndarray:
    """For every symbol of the strings (``flat``, one string of ``size`` after the other): whether the ``depth`` symbols from it on occur elsewhere.

    A string of ``weight`` w stands for w equal ones, so that it repeats itself if w is over one.
    """
    if not len(size):
        return np.zeros(0, bool)
    ends = np.cumsum(size)
    orders, transforms, lengths = [], [], []
    per = max(shard_strings, -(-len(size) // 250))
    for a in range(0, len(size), per):
        b = min(a + per, len(size))
        begin = ends[a] - size[a]
        own = np.zeros(ends[b - 1] - begin + b - a, flat.dtype)
        own[np.arange(ends[b - 1] - begin) + np.repeat(np.arange(b - a), size[a:b])] = flat[begin : ends[b - 1]]
        order = suffixes(own, depth)
        orders.append(order)
        transforms.append(transform(own, order))
        lengths.append(len(own))
    shard, common = merge(transforms, depth)
    base = np.cumsum(lengths) - lengths
    position = np.empty(len(common), np.int64)  # of each merged suffix: its shard's suffixes come in the shard's order
    position[np.argsort(shard, kind="stable")] = np.concatenate([o + b for o, b in zip(orders, base, strict=True)])
    same = intervals(common, depth)
    each = np.repeat(weight, size + 1)[position]
    # A suffix that ends before ``depth`` symbols is an interval of its own, whatever its weight.
    last = np.repeat(np.cumsum(size + 1), size + 1)
    whole = (last - np.arange(len(common)))[position] > depth
    flag = np.zeros(len(common), bool)
    flag[position] = (np.bincount(same, each)[same] > 1) & whole
    inside = np.ones(len(flag), bool)
    inside[np.cumsum(size + 1) - 1] = False
    return flag[inside]
