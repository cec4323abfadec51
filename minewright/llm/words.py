"""Letter words of whole texts, and bounded memory of what was worked out for them."""

from __future__ import annotations

import functools
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

_RUNS = re.compile(r"[^\W\d_]+")
#: Words remembered by a Python worker before it starts afresh.
MEMORY = 400_000


def letter_words(text: str | None) -> list[str]:
    """Lower-cased runs of letters; numerals that are no digits are cut out of them."""
    if not text:
        return []
    found = _RUNS.findall(text.lower())
    if all(map(str.isalpha, found)):
        return found
    clean = ("".join(c if c.isalpha() else " " for c in w) for w in found)
    return [w for x in clean for w in x.split()]


#: Characters worked on at a time; a longer text is read in parts, cut where no letter run is. A run longer than that is read whole.
WINDOW = 1 << 17


@dataclass
class Runs:
    """Letter runs of some texts: ``codes`` of all characters, where a run starts, how long it is, and the number of its text."""

    codes: np.ndarray
    start: np.ndarray
    size: np.ndarray
    owner: np.ndarray


@functools.cache
def _letters() -> np.ndarray:
    return np.fromiter(map(str.isalpha, map(chr, range(0x110000))), bool, 0x110000)


def _parts(text: str, window: int) -> Iterator[str]:
    """The text in parts of ``window`` characters, cut after the last character that is no letter, or at the end of a run as long as that."""
    at = 0
    while len(text) - at > window:
        cut = next((i for i in range(at + window, at, -1) if not text[i - 1].isalpha()), None)
        if cut is None:
            cut = next((i for i in range(at + window, len(text)) if not text[i].isalpha()), len(text))
        yield text[at:cut]
        at = cut
    yield text[at:]


def letter_runs(texts: pa.Array, window: int = WINDOW) -> Iterator[Runs]:
    """Lower-cased letter runs of all texts, about ``window`` characters at a time; owners never fall."""
    held: list[str] = []
    owner: list[int] = []
    n = 0

    def runs() -> Runs:
        codes = np.frombuffer("\0".join(held).encode("utf-32-le", "surrogatepass"), np.uint32)
        mask = np.zeros(len(codes) + 2, np.int8)
        mask[1:-1] = _letters()[codes]
        edge = np.diff(mask)
        start, end = np.flatnonzero(edge > 0), np.flatnonzero(edge < 0)
        begin = np.cumsum([0, *(len(h) + 1 for h in held)])[:-1]
        return Runs(codes, start, end - start, np.array(owner, np.int64)[np.searchsorted(begin, start, "right") - 1])

    for i, t in enumerate(texts):
        if text := t.as_py():
            for part in _parts(text, window):
                part = part.lower()
                if held and n + len(part) > window:
                    yield runs()
                    held.clear(), owner.clear()
                    n = 0
                held.append(part), owner.append(i)
                n += len(part) + 1
    if held:
        yield runs()


class Remembered(dict):
    """``word -> work(word)``, worked out once; emptied by ``trim`` when it has grown over its bound."""

    def __init__(self, work: Callable[[str], object], bound: int = MEMORY):
        super().__init__()
        self.work, self.bound = work, bound

    def __missing__(self, word: str) -> object:
        self[word] = found = self.work(word)
        return found

    def trim(self) -> None:
        if len(self) > self.bound:
            self.clear()


def fold(doc_id: Column, parts: int) -> Column:
    """``crc32(doc_id as text) mod parts``."""
    return F.crc32(doc_id.cast("string").cast("binary")) % parts


def hash_sample(doc_id: Column, wanted: int, there: int, seed: int = 11) -> Column:
    """True for about ``wanted`` of ``there`` rows, chosen by a hash of the id; for all if there are no more."""
    if there <= wanted:
        return F.lit(True)
    return F.pmod(F.xxhash64(doc_id, F.lit(seed)), F.lit(1 << 40)) < int(wanted / there * (1 << 40))


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, with underscores after those that a column of ``df`` has, whatever its case."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out


def beside(df: DataFrame, added: str) -> tuple[DataFrame, StructType]:
    """``df`` without columns of the added names (``"a int, b string"``), which are replaced, and the schema of both together."""
    new = StructType.fromDDL(added)
    kept = df.drop(*new.names)
    return kept, StructType([*kept.schema.fields, *new.fields])
