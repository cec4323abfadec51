"""Anchored windows of byte strings: what equal windows agree on, found without comparing them.

Every window of ``length`` bytes is assigned the position of the least hash of
``GRAM`` bytes among its first ``SPAN`` positions (its anchor).  Equal windows
have their anchor at the same distance and agree on the bytes after it, so a
window repeats only if its anchor's core, the bytes that all windows of that
anchor share, repeats.
"""

from __future__ import annotations

import numpy as np

GRAM, SPAN = 16, 128


class RollingHash:
    """64-bit polynomial hashes of all substrings of one array, from prefix sums."""

    def __init__(self, seed: int):
        rng = np.random.default_rng(seed)
        self.table = rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        base = int(rng.integers(2**40, 2**62)) * 8 + 5
        self.base, self.inverse = np.uint64(base % 2**64), np.uint64(pow(base, -1, 2**64))
        self.power = self.back = np.zeros(0, np.uint64)

    @staticmethod
    def _powers(b: np.uint64, n: int) -> np.ndarray:
        out = np.full(n, b, np.uint64)
        out[:1] = 1
        return np.multiply.accumulate(out)

    def load(self, data: np.ndarray) -> None:
        if len(self.power) <= len(data):
            self.power, self.back = self._powers(self.base, len(data) + 1), self._powers(self.inverse, len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.table[data] * self.power[: len(data)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of ``data[start:end]`` for arrays of positions."""
        return mix((self.sums[end] - self.sums[start]) * self.back[start])

    def grams(self, n: int) -> np.ndarray:
        """Hashes of the ``n`` bytes from every position that has them."""
        m = len(self.sums) - n
        return mix((self.sums[n:] - self.sums[:m]) * self.back[:m]) if m > 0 else np.zeros(0, np.uint64)


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(32))
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


def sliding_least(x: np.ndarray, span: int) -> np.ndarray:
    """Least of ``x[i:i + span]`` for every i that has so many."""
    m = len(x) - span + 1
    if m <= 0:
        return x[:0]
    pad = -len(x) % span
    y = np.concatenate([x, np.full(pad, np.iinfo(x.dtype).max, x.dtype)]).reshape(-1, span)
    ahead = np.minimum.accumulate(y, axis=1).ravel()
    behind = np.minimum.accumulate(y[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:m], ahead[span - 1 : span - 1 + m])


def anchors(data: np.ndarray, begin: np.ndarray, end: np.ndarray, one: RollingHash, two: RollingHash, length: int) -> dict[str, np.ndarray]:
    """Anchors of all windows inside the strings ``data[begin:end]``.

    ``text`` number, ``at`` position in data, ``near`` and ``far`` (least and greatest distance of its
    windows' starts before it), ``core`` and ``extent`` hashes.
    """
    one.load(data), two.load(data)
    empty = {k: np.zeros(0, t) for k, t in (("text", np.int64), ("at", np.int64), ("near", np.int64), ("far", np.int64), ("core", np.uint64), ("extent", np.uint64))}
    if len(data) < length:
        return empty
    place = np.arange(len(data) - GRAM + 1, dtype=np.uint64)
    least = sliding_least((one.grams(GRAM) & np.uint64(0xFFFFFFFF00000000)) | place, SPAN)
    anchor = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    starts = np.maximum(end - begin - length + 1, 0)  # windows of each text
    text = np.repeat(np.arange(len(begin)), starts)
    i = np.repeat(begin - (np.cumsum(starts) - starts), starts) + np.arange(starts.sum())
    if not len(i):
        return empty
    a = anchor[i]
    first = np.flatnonzero(np.append(True, (a[1:] != a[:-1]) | (text[1:] != text[:-1])))
    last = np.append(first[1:], len(i)) - 1
    at, far, near = a[first], a[first] - i[first], a[last] - i[last]
    return {"text": text[first], "at": at, "near": near, "far": far, "core": one.of(at, at + length - SPAN + 1), "extent": two.of(at - far, at - near + length)}
