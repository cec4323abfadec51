"""Texts as sequences of independent units whose tokens are worked out once."""

from __future__ import annotations

import re
from collections.abc import Callable, Collection, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Unicode's White_Space, which the tokenizers split on (Python's ``\s`` has four control characters more).
WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_GAPS = re.compile(f"[{WHITE}]+")
_ODD = "\x1c\x1d\x1e\x1f"


def white_split(text: str) -> list[str]:
    """The runs between white space."""
    if any(c in text for c in _ODD):
        return [x for x in _GAPS.split(text) if x]
    return text.split()


def white_split_array(texts: pa.Array) -> pa.Array:
    """Lists of the runs between white space; empty strings may stand among them, null texts have no runs."""
    texts = pc.fill_null(texts, "")
    if pc.any(pc.match_substring_regex(texts, f"[{_ODD}]")).as_py():  # Arrow splits at these as well
        return pa.array([white_split(t) for t in texts.to_pylist()], pa.list_(texts.type))
    return pc.utf8_split_whitespace(texts)


class UnitMemory:
    """Token ids of units, in one growing array; forgotten when there are more than ``bound`` units.

    ``work`` takes new units and returns the ids of all, one after the other, with their counts.
    """

    def __init__(self, work: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], bound: int = 500_000):
        self.work, self.bound = work, bound
        self.forget()

    def forget(self) -> None:
        self.slot: dict[str, int] = {}
        self.ids = np.zeros(1 << 16, np.uint32)
        self.start, self.size = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64)
        self.used = 0

    @staticmethod
    def _room(a: np.ndarray, n: int) -> np.ndarray:
        return a if n <= len(a) else np.concatenate([a, np.zeros(max(n, 2 * len(a)) - len(a), a.dtype)])

    def learn(self, units: Collection[str]) -> None:
        """Take up distinct units."""
        if len(self.slot) >= self.bound:
            self.forget()
        new = sorted(u for u in units if u not in self.slot)
        if not new:
            return
        self.add(new, *self.work(new))

    def add(self, new: list[str], ids: np.ndarray, size: np.ndarray) -> None:
        """Remember units that are not known yet, with their ids one after the other and their counts."""
        n = len(self.slot)
        self.ids, self.start, self.size = self._room(self.ids, self.used + len(ids)), self._room(self.start, n + len(new)), self._room(self.size, n + len(new))
        self.ids[self.used : self.used + len(ids)] = ids
        self.start[n : n + len(new)] = self.used + np.cumsum(size) - size
        self.size[n : n + len(new)] = size
        self.used += len(ids)
        self.slot.update(zip(new, range(n, n + len(new)), strict=True))

    def encode(self, texts: Sequence[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and where each text ends."""
        self.learn(set().union(*texts))
        slots = np.concatenate([np.fromiter(map(self.slot.__getitem__, t), np.int64, len(t)) for t in texts]) if texts else np.zeros(0, np.int64)
        return self.gather(slots, np.cumsum([len(t) for t in texts], dtype=np.int64))

    def encode_array(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """As ``encode``, for an array of lists without nulls; a unit is looked up once, however often it is there."""
        coded = texts.flatten().dictionary_encode()
        units = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        self.learn(units)
        slots = np.fromiter(map(self.slot.__getitem__, units), np.int64, len(units))[coded.indices.to_numpy()]
        return self.gather(slots, np.cumsum(pc.list_value_length(texts).to_numpy(), dtype=np.int64))

    def gather(self, slots: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of units by their slots, and where those of each text end whose units end at ``ends``."""
        size = self.size[slots]
        upto = np.cumsum(size)
        at = np.repeat(self.start[slots] - (upto - size), size) + np.arange(upto[-1] if len(upto) else 0)
        return self.ids[at], np.concatenate([[0], upto])[ends]


def slices(texts: Sequence[str | None], chars: int = 1 << 22) -> list[tuple[int, int]]:
    """Ranges of rows with about ``chars`` characters together; one longer text is a range of its own."""
    return ranges([len(t or "") for t in texts], chars)


def ranges(sizes: Sequence[int], most: int) -> list[tuple[int, int]]:
    """Ranges of rows whose sizes add up to about ``most``; a larger row is a range of its own."""
    out, start, held = [], 0, 0
    for i, n in enumerate(sizes):
        if held and held + n > most:
            out.append((start, i))
            start, held = i, 0
        held += n
    if start < len(sizes):
        out.append((start, len(sizes)))
    return out
