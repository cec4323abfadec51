"""SentencePiece encoding and decoding by suffix-array matching.

The distinct words of a batch are concatenated and indexed by a suffix array.
Every piece of the model finds the range of suffixes that begin with it by
binary search; the ranges give all occurrences, which are edges from a piece's
start to its end.  Edges are sorted by position and relaxed in that order: a
piece may continue the encoding that reaches its start if the pair of pieces
encodes to itself, and of the pieces that end at a position just one may.  The
last pieces are then followed back.  All of it runs on whole arrays.

Models are of the BPE kind with byte fallback, as the given one.  Characters
without a piece stand alone as their bytes.  Runs of several spaces, whose
pieces all have one score, are merged pair by pair as the library does.

Defined cases: null and empty texts have no ids and decode to the empty text;
repeated rows each get a row; ids outside the model raise an error; bytes that
are no UTF-8 decode to U+FFFD; extra columns are not read.
"""

from __future__ import annotations

import heapq
import re
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from minewright.llm.units import UnitMemory, slices

SPACE = "▁"
_WORD = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")
_NONE, _BEGIN = -1, -2


class PieceModel:
    """A model's pieces and what the lattice needs of them; ``bound`` limits the remembered pairs."""

    def __init__(self, path: str, bound: int = 1_500_000):
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = sp.get_piece_size()
        plain = [i for i in range(self.size) if not (sp.is_unknown(i) or sp.is_control(i) or sp.is_unused(i) or sp.is_byte(i))]
        self.text = {i: sp.id_to_piece(i) for i in plain}
        self.id = {p: i for i, p in self.text.items()}
        self.score = {p: sp.get_score(i) for p, i in self.id.items()}
        self.byte = {int(sp.id_to_piece(i)[3:5], 16): i for i in range(self.size) if sp.is_byte(i)}
        self.chars = {p for p in self.id if len(p) == 1}
        # Pieces that encode to themselves; no other is ever output. Runs of spaces are not for the lattice.
        self.usable = sorted(p for p in self.id if (SPACE not in p[1:]) and self.merge(p) == [p])
        self.longest = max(map(len, self.usable))
        self.raw = {i: p.replace(SPACE, " ").encode() for i, p in self.text.items()} | {i: bytes([b]) for b, i in self.byte.items()}
        self.raw |= {i: " ⁇ ".encode() if sp.is_unknown(i) else b"" for i in range(self.size) if i not in self.raw}
        self.bound, self.pairs = bound, {}

    def merge(self, symbols: str) -> list[str]:
        """Merge neighbours into the best-scored piece, the left ones of equals, until none is left."""
        parts: list[str | None] = list(symbols)
        right, left = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
        score = self.score
        heap = [(-score[p], i, p) for i in range(len(parts) - 1) if (p := parts[i] + parts[i + 1]) in score]
        heapq.heapify(heap)
        while heap:
            _, i, both = heapq.heappop(heap)
            if parts[i] is None or (j := right[i]) >= len(parts) or parts[i] + parts[j] != both:
                continue
            parts[i], parts[j] = both, None
            right[i] = right[j]
            if right[i] < len(parts):
                left[right[i]] = i
            for a, b in ((left[i], i), (i, right[i])):
                if a >= 0 and b < len(parts) and (p := parts[a] + parts[b]) in score:
                    heapq.heappush(heap, (-score[p], a, p))
        return [p for p in parts if p is not None]

    def may_follow(self, codes: np.ndarray) -> np.ndarray:
        """For pairs coded ``first * size + second``: whether they stay apart when encoded together."""
        if len(self.pairs) > self.bound:
            self.pairs.clear()
        one, where = np.unique(codes, return_inverse=True)
        known = self.pairs
        out = np.zeros(len(one), bool)
        for k, code in enumerate(one.tolist()):
            if (ok := known.get(code)) is None:
                a, b = self.text[code // self.size], self.text[code % self.size]
                known[code] = ok = self.merge(a + b) == [a, b]
            out[k] = ok
        return out[where]

    # One batch of words.

    def lattice(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words made of known characters, one word after the other, and how many each has."""
        text = np.frombuffer("\0".join(["", *words, ""]).encode("utf-32-le"), np.uint32)
        letters, codes = np.unique(text, return_inverse=True)  # code 0 parts the words
        codes = codes.astype(np.int64)
        order = suffix_order(codes, self.longest)
        code_of = {chr(c): k for k, c in enumerate(letters.tolist())}
        pieces = [p for p in self.usable if all(c in code_of for c in p)]
        length = np.fromiter(map(len, pieces), np.int64, len(pieces))
        spelled = np.zeros((len(pieces), self.longest), np.int64)
        for k, p in enumerate(pieces):
            spelled[k, : len(p)] = [code_of[c] for c in p]
        lo, hi = find_ranges(codes, order, spelled, length)
        n = hi - lo
        start = order[np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())]
        piece = np.repeat(np.array([self.id[p] for p in pieces], np.int64), n)
        end = start + np.repeat(length, n)
        size = np.fromiter(map(len, words), np.int64, len(words))
        first = 1 + np.cumsum(size + 1) - (size + 1)
        begin = np.zeros(len(codes) + 1, np.int64)
        begin[first] = first
        begin = np.maximum.accumulate(begin)
        reach = end - begin[start]  # how far into its word an edge ends
        by_reach = np.argsort(reach, kind="stable")
        start, end, piece, reach = start[by_reach], end[by_reach], piece[by_reach], reach[by_reach]
        last = np.full(len(codes) + 1, _NONE, np.int64)
        last[first] = _BEGIN
        cuts = np.searchsorted(reach, np.arange(1, size.max(initial=0) + 2))
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            before = last[start[a:b]]
            ok = before == _BEGIN
            inner = np.nonzero(before >= 0)[0]
            ok[inner] = self.may_follow(before[inner] * self.size + piece[a:b][inner])
            last[end[a:b][ok]] = piece[a:b][ok]
        width = np.zeros(self.size, np.int64)
        for p in self.usable:
            width[self.id[p]] = len(p)
        word, at, steps = np.arange(len(words)), first + size, []
        while len(word):
            steps.append((word, last[at]))
            at = at - width[last[at]]
            going = at > first[word]
            word, at = word[going], at[going]
        owner = np.concatenate([w for w, _ in steps])[::-1]
        ids = np.concatenate([p for _, p in steps])[::-1]
        order = np.argsort(owner, kind="stable")
        return ids[order].astype(np.uint32), np.bincount(owner, None, len(words))

    def encode_words(self, words: list[str], chars: int = 1_000_000) -> tuple[np.ndarray, np.ndarray]:
        """Ids of any words, one after the other, and how many each has."""
        odd = "".join(sorted(set().union(*words) - self.chars)) if words else ""
        split = re.compile("([" + re.escape(odd) + "])").split if odd else lambda w: [w]
        parts = [split(w) if SPACE + SPACE not in w else [w] for w in words]
        plain = sorted({p for ps in parts for p in ps if p and p not in odd and SPACE + SPACE not in p})
        ids: dict[str, list[int]] = {}
        for a, b in slices(plain, chars):
            flat, n = self.lattice(plain[a:b])
            ends = np.cumsum(n)
            flat = flat.tolist()
            for w, e, k in zip(plain[a:b], ends.tolist(), n.tolist(), strict=True):
                ids[w] = flat[e - k : e]
        out = []
        for ps in parts:
            own: list[int] = []
            for p in ps:
                if p in ids:
                    own += ids[p]
                elif p:
                    for x in self.merge(p):
                        own += [self.id[x]] if x in self.id else [self.byte[b] for b in x.encode()]
            out.append(own)
        size = np.fromiter(map(len, out), np.int64, len(out))
        return np.fromiter((x for o in out for x in o), np.uint32, int(size.sum())), size

    def decode(self, ids: list[int]) -> str:
        text = b"".join(map(self.raw.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


def suffix_order(codes: np.ndarray, depth: int) -> np.ndarray:
    """Positions sorted by the ``depth`` codes that follow, by prefix doubling."""
    rank, k = codes, 1
    while k < depth:
        after = np.zeros_like(rank)
        after[:-k] = rank[k:]
        _, rank = np.unique(rank * (int(rank.max()) + 2) + after, return_inverse=True)
        k *= 2
    return np.argsort(rank, kind="stable")


def find_ranges(codes: np.ndarray, order: np.ndarray, spelled: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each spelled piece the range of ``order`` whose suffixes begin with it; all pieces at once, a letter at a time."""
    lo, hi = np.zeros(len(length), np.int64), np.full(len(length), len(order))

    def bound(lo: np.ndarray, hi: np.ndarray, want: np.ndarray, d: int, upper: bool) -> np.ndarray:
        lo, hi = lo.copy(), hi.copy()
        while (open_ := lo < hi).any():
            mid = (lo + hi) // 2
            at = order[np.minimum(mid, len(order) - 1)] + d
            c = np.where(at < len(codes), codes[np.minimum(at, len(codes) - 1)], 0)
            right = open_ & ((c <= want) if upper else (c < want))
            lo, hi = np.where(right, mid + 1, lo), np.where(open_ & ~right, mid, hi)
        return lo

    for d in range(spelled.shape[1]):
        more = np.nonzero((length > d) & (lo < hi))[0]
        a, b = lo[more], hi[more]
        lo[more], hi[more] = bound(a, b, spelled[more, d], d, False), bound(a, b, spelled[more, d], d, True)
    return lo, hi


_MODELS: dict[str, tuple[PieceModel, UnitMemory]] = {}


def piece_model(path: str) -> tuple[PieceModel, UnitMemory]:
    """One model and word memory for each Python worker."""
    if path not in _MODELS:
        model = PieceModel(path)
        _MODELS[path] = model, UnitMemory(model.encode_words)
    return _MODELS[path]


def _words(text: str | None) -> list[str]:
    return _WORD.findall(SPACE + text.replace(" ", SPACE)) if text else []


def default_path() -> str:
    return public_tokenizers.path("piece_bpe_32k.model")


def encode_texts(documents: DataFrame, path: str | None = None, digest: bool = False) -> DataFrame:
    """``doc_id, ids array<int>`` of every row; with ``digest`` instead ``n_ids, ids_crc32`` and whether decoding gives the text back."""
    path = path or default_path()
    kind = documents.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, memory = piece_model(path)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for a, b in slices(texts):
                flat, ends = memory.encode([_words(t) for t in texts[a:b]])
                each = np.split(flat, ends[:-1])
                keys = batch.column(0).slice(a, b - a)
                if digest:
                    crc = [zlib.crc32(x.astype("<u4").tobytes()) for x in each]
                    same = [model.decode(x.tolist()) == (t or "") for x, t in zip(each, texts[a:b], strict=True)]
                    yield pa.record_batch([keys, pa.array(list(map(len, each)), pa.int64()), pa.array(crc, pa.int64()), pa.array(same)], names=["doc_id", "n_ids", "ids_crc32", "round_trip"])
                else:
                    yield pa.record_batch([keys, pa.array([x.astype(np.int32) for x in each], pa.list_(pa.int32()))], names=["doc_id", "ids"])

    schema = f"doc_id {kind}, " + ("n_ids long, ids_crc32 long, round_trip boolean" if digest else "ids array<int>")
    return documents.select("doc_id", "text").mapInArrow(run, schema)


def decode_ids(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, text`` of ``doc_id, ids`` rows; null ids give a null text."""
    path = path or default_path()
    kind = encoded.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, _ = piece_model(path)
        for batch in batches:
            texts = [None if x is None else model.decode(x) for x in batch.column(1).to_pylist()]
            yield pa.record_batch([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, text string")


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_texts(spark.read.parquet(f"{sf_dir}/documents.parquet"), digest=True)
