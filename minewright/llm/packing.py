"""Best-fit packing of documents into token sequences by the sum-of-squares rule.

A document is tokenized, closed by an end id and, only if it is longer than a
sequence, cut into full pieces and a last one.  A word's ids are put together
from those of its pre-tokens, of which the library encodes each once per worker;
words with other characters than ``_PLAIN`` go to the library as they are.

Pieces are placed longest first.
With N(g) open sequences of residual gap g, a piece goes where the sum of N(g)^2
over all open gaps becomes smallest; among equal sums into the open sequence
that it fills best, and into a new sequence last.

Pieces are dealt to groups by a hash; each group is packed in one task from the
pieces' lengths alone, so a group's cost is bounded by ``group_pieces`` whatever
the corpus.  What stays open in a group is under the average sequence for a
group, a share that does not grow with the data.

Defined cases: null and empty texts are the end id alone; repeated rows are
documents of their own; ids may be null; extra columns are not read.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Callable, Collection, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from minewright.llm.token_counts import byte_letters
from minewright.llm.units import UnitMemory, ranges, white_split_array
from minewright.staging import stage

CAPACITY, END_ID = 4096, 1
_MEMORY: dict[str, UnitMemory] = {}


#: Words whose ids a Python worker remembers, of about 250 bytes each.
WORDS_KEPT = 1_400_000

#: Letters of which none combines with another or is lower-cased by its place (Latin, Cyrillic), and all characters of plain words.
_LETTERS = "a-zªµºß-öø-įı-ſѐ-џа-я"
_PLAIN = re.compile("[!-~¡-±´-¸»¿-įı-ſЀ-џ‐-‧‰-⁞€]*")
#: What a file has to say for plain words to be split here: the steps before its byte pairs.
_STEPS = {
    "normalizer": {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
}
_PARTS = re.compile(rf"'(?:s|t|re|ve|m|ll|d)|[{_LETTERS}]+|[0-9]|[^\n{_LETTERS}0-9]+|\n")


class WordMemory(UnitMemory):
    """Ids of words by their pre-tokens, which are units as well; ``pairs`` gives those of pre-tokens, ``work`` those of words that are not ``plain``."""

    def __init__(self, work: Callable, pairs: Callable, plain: Callable[[str], bool], bound: int):
        self.pairs, self.plain = pairs, plain
        super().__init__(work, bound)

    def forget(self) -> None:
        super().forget()
        self.add(["\n"], np.zeros(0, np.uint32), np.zeros(1, np.int64))  # stands between words, is none

    def learn(self, units: Collection[str]) -> None:
        if len(self.slot) >= self.bound:
            self.forget()
        new = [u for u in units if u not in self.slot]
        if not self.plain("".join(new)):
            odd = [u for u in new if not self.plain(u)]
            if odd:
                self.add(odd, *self.work(odd))
            new = [u for u in new if u not in self.slot]
        if not new:
            return
        parts = _PARTS.findall("\n".join(new).lower() + "\n")
        unknown = [p for p in dict.fromkeys(parts) if p not in self.slot]
        self.add(unknown, *self.pairs(unknown))
        slots = np.fromiter(map(self.slot.__getitem__, parts), np.int64, len(parts))
        ids, ends = self.gather(slots, np.flatnonzero(slots == 0) + 1)
        size = np.diff(ends, prepend=0)
        left = np.fromiter((u not in self.slot for u in new), bool, len(new))
        self.add([u for u, x in zip(new, left.tolist(), strict=True) if x], ids[np.repeat(left, size)], size[left])


def library_units(path: str, words_kept: int = WORDS_KEPT) -> UnitMemory:
    """Ids of a ``tokenizers`` file whose words are independent; a Python worker keeps one memory for all its tasks."""
    if path in _MEMORY:
        _MEMORY[path].bound = words_kept
    else:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)

        apart = next((t.content for t in tokenizer.get_added_tokens_decoder().values() if t.special), None)
        mark = tokenizer.token_to_id(apart) if apart else None

        def each(units: list[str]) -> tuple[np.ndarray, np.ndarray]:
            parts = [e.ids for e in tokenizer.encode_batch_fast(units, add_special_tokens=False)]
            size = np.fromiter(map(len, parts), np.int64, len(parts))
            return np.fromiter((x for p in parts for x in p), np.uint32, int(size.sum())), size

        def work(units: list[str]) -> tuple[np.ndarray, np.ndarray]:
            """Units are joined around a special token, which the library encodes faster than many short texts."""
            if apart is None or any(apart in u for u in units):
                return each(units)
            joined = [f" {apart} ".join(units[i : i + 64]) + f" {apart}" for i in range(0, len(units), 64)]
            ids = [np.array(e.ids, np.uint32) for i in range(0, len(joined), 512) for e in tokenizer.encode_batch_fast(joined[i : i + 512], add_special_tokens=False)]
            flat = np.concatenate(ids)
            ends = np.flatnonzero(flat == mark)
            return flat[flat != mark], np.diff(np.append(-1, ends)) - 1

        added = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
        model, letters = tokenizer.model, {b: c for c, b in byte_letters().items()}

        def pairs(parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
            ids, size = [], []
            for p in parts:
                found = model.tokenize(p if p.isascii() else p.encode().decode("latin-1").translate(letters))
                ids.extend([t.id for t in found])
                size.append(len(found))
            return np.array(ids, np.uint32), np.array(size, np.int64)

        def plain(text: str) -> bool:
            return _PLAIN.fullmatch(text) is not None and not any(a in text for a in added)

        steps = json.loads(tokenizer.to_str())
        known = all(steps[k] == v for k, v in _STEPS.items())
        _MEMORY[path] = WordMemory(work, pairs, plain, words_kept) if known else UnitMemory(work, words_kept)
    return _MEMORY[path]


def tokenized_pieces(documents: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False, words_kept: int = WORDS_KEPT) -> DataFrame:
    """``doc_id, row, piece, start, length, ids_crc32`` (and ``ids``) of every document's pieces; ``row`` tells repeated ids apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = library_units(path, words_kept)
        yield from pieces_of(memory, batches)
        if words_kept < WORDS_KEPT:  # the caller has little memory: nothing stays in the worker
            memory.forget()

    def pieces_of(memory: UnitMemory, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, ids, rows = batch.column(1), batch.column(0).to_pylist(), batch.column(2).to_pylist()
            for a, b in ranges(pc.fill_null(pc.binary_length(texts), 0).to_pylist(), 1 << 22):
                flat, ends = memory.encode_array(white_split_array(texts.slice(a, b - a)))
                out: list[list] = [[] for _ in range(7)]
                begin = 0
                for i, end in zip(range(a, b), ends.tolist(), strict=True):
                    own = np.append(flat[begin:end], np.uint32(end_id)).astype("<u4")
                    begin = end
                    for piece, start in enumerate(range(0, len(own), capacity)):
                        part = own[start : start + capacity]
                        for column, x in zip(out, (ids[i], rows[i], piece, start, len(part), zlib.crc32(part.tobytes()), part if with_ids else None), strict=True):
                            column.append(x)
                types = [batch.schema.types[0], pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
                names = ["doc_id", "row", "piece", "start", "length", "ids_crc32", "ids"]
                n = 7 if with_ids else 6
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out[:n], types, strict=False)], names=names[:n])

    kind = documents.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, row long, piece int, start long, length long, ids_crc32 long" + ", ids array<long>" * with_ids
    return documents.select("doc_id", "text", F.monotonically_increasing_id().alias("row")).mapInArrow(run, schema)


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of each piece, in the given order."""
    count = np.zeros(capacity + 1, np.int64)  # open sequences by gap
    open_at: list[list[int]] = [[] for _ in range(capacity + 1)]
    fill: list[int] = []
    where, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    gaps = np.arange(capacity + 1)
    for i, s in enumerate(lengths.tolist()):
        best, gap = (2 * count[capacity - s] + 1 if s < capacity else 0), -1
        there = gaps[s:][count[s:] > 0]
        if len(there):
            left = there - s
            change = np.where(left > 0, 2 * count[left] + 1, 0) - 2 * count[there] + 1
            j = int(np.argmin(change))  # the first is the best fit of equal ones
            if change[j] <= best:
                gap = int(there[j])
        if gap < 0:
            b, gap = len(fill), capacity
            fill.append(0)
        else:
            b = open_at[gap].pop()
            count[gap] -= 1
        where[i], offset[i] = b, fill[b]
        fill[b] += s
        if gap > s:
            open_at[gap - s].append(b)
            count[gap - s] += 1
    return where, offset


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY, group_pieces: int = 16_000) -> DataFrame:
    """``pieces`` (with ``length``, a multiple-read-safe table) with ``sequence_id`` and ``offset``."""
    groups = max(1, -(-pieces.count() // group_pieces))
    columns = [c for c in pieces.columns if c not in ("sequence_id", "offset", "pack_group")]
    keyed = pieces.select(*columns, F.pmod(F.xxhash64("row", "piece"), F.lit(groups)).alias("pack_group"))

    def run(key: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
        t = t.sort_by([("length", "descending"), ("row", "ascending"), ("piece", "ascending")])
        where, offset = sum_of_squares(t["length"].to_numpy(), capacity)
        return t.append_column("sequence_id", pa.array(key[0].as_py() * 2**32 + where, pa.int64())).append_column("offset", pa.array(offset, pa.int64()))

    schema = StructType([*keyed.schema.fields, StructField("sequence_id", LongType()), StructField("offset", LongType())])
    return keyed.groupBy("pack_group").applyInArrow(run, schema).drop("pack_group")


def pack_documents(documents: DataFrame, path: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False, words_kept: int = WORDS_KEPT) -> DataFrame:
    """Tokenize, cut and pack ``doc_id, text`` rows; with ``with_ids`` each piece carries its token ids; ``words_kept`` bounds a worker's memory."""
    path = path or public_tokenizers.path("word_bpe_49k.json")
    return pack_pieces(stage(tokenized_pieces(documents, path, capacity, end_id, with_ids, words_kept), "pieces"), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id, ids``: the sequences themselves, from pieces packed with their ids; a sequence has ``capacity`` ids at most."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return pack_documents(documents).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
