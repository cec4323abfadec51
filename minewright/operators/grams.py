"""N-grams of pairs of texts, counted by sorted integers in tasks that hold some rows at a time.

What leaves a task are sums, never n-gram rows: shared letter n-grams as numbers of each pair, word n-grams as sorted
hashes of many rows at once whose document frequencies come back in the same order.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.taskcontext import TaskContext

from minewright.staging import shuffle_width, stage

_MIX = np.uint64(0x9E3779B97F4A7C15)


def in_order(rows: DataFrame, key: list[str]) -> DataFrame:
    """Rows in the order of their keys, equal keys in one task."""
    return rows.repartitionByRange(shuffle_width(rows.sparkSession), *key).sortWithinPartitions(*key)


def together(rows: DataFrame, key: list[str]) -> DataFrame:
    """Rows of which those of one key follow each other: as they lie where no key is repeated, else in order."""
    again = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    return rows if again.isEmpty() else in_order(rows, key)


def keyed(batches: Iterator[pa.RecordBatch], key: list[str], texts: list[str], size: int) -> Iterator[tuple[pa.Table, np.ndarray, np.ndarray]]:
    """Tables of consecutive rows with some ``size`` bytes of text, the number of each row's key there, and whether it has no null; rows of one key stay together."""

    def numbers(t: pa.Table) -> np.ndarray:
        same = np.ones(max(t.num_rows - 1, 0), bool)
        for k in key:
            a, b = t[k].slice(1), t[k].slice(0, len(same))
            equal = pc.fill_null(pc.equal(a, b), False)
            same &= pc.or_(equal, pc.and_(pc.is_null(a), pc.is_null(b))).to_numpy()
        return np.append(0, np.cumsum(~same))

    held = None
    for batch in chain(batches, [None]):
        if batch is not None:
            held = pa.concat_tables([*([held] if held else []), pa.Table.from_batches([batch])])
        while held is not None and held.num_rows:
            upto = np.cumsum(sum(pc.fill_null(pc.binary_length(held[c]), 0).to_numpy().astype(np.int64) for c in texts))
            if batch is not None and upto[-1] < size:
                break
            n = numbers(held)
            end = int(np.searchsorted(n, n[min(int(np.searchsorted(upto, size)), len(n) - 1)], "right"))
            if batch is not None and end == len(n):  # its last key may go on
                break
            now = held.slice(0, end)
            yield now, n[:end], np.logical_and.reduce([pc.is_valid(now[k]).to_numpy() for k in key])
            held = held.slice(end)


def _letters(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of all texts without white space, the text of each, and how many each text has."""
    codes = np.frombuffer("".join(x or "" for x in texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    text = np.repeat(np.arange(len(texts)), [len(x or "") for x in texts])
    keep = (codes != 32) & ((codes < 9) | (codes > 13))
    return codes[keep], text[keep], np.bincount(text[keep], None, len(texts)).astype(np.int64)


def letter_matches(pred: list[str | None], ref: list[str | None], of: np.ndarray, order: int) -> np.ndarray:
    """``m, p, r`` (an array of keys, 3, orders): shared n-grams of letters of the texts of each key, and how many each side has.

    ``of`` is the key of each pair, from 0 and in order.  All places of both sides are sorted once by their next ``order``
    letters, of which the n-grams of lower orders are prefixes; of a run with a and b places min(a, b) are shared.
    """
    keys, n = int(of[-1]) + 1 if len(of) else 0, np.arange(1, order + 1)
    out = np.zeros((keys, 3, order), np.int64)
    sides = [_letters(x) for x in (pred, ref)]
    for k, (_, _, size) in enumerate(sides):
        np.add.at(out[:, k + 1], of, np.maximum(size[:, None] - n + 1, 0))
    codes, size = np.concatenate([s[0] for s in sides]), np.concatenate([s[2] for s in sides])
    text = np.concatenate([sides[0][1], sides[1][1] + len(of)])
    symbols, letter = np.unique(codes, return_inverse=True)
    bits = len(symbols).bit_length()
    if keys.bit_length() + order * bits + 1 > 64 and keys > 1:
        cut = int(np.searchsorted(of, keys // 2))
        return np.concatenate([letter_matches(pred[:cut], ref[:cut], of[:cut], order), letter_matches(pred[cut:], ref[cut:], of[cut:] - of[cut], order)])
    place = np.arange(len(codes)) + text * (order - 1)
    padded = np.zeros(len(codes) + (len(size) + 1) * order, np.uint64)
    padded[place] = letter.astype(np.uint64) + np.uint64(1)  # 0 is past the end
    pair = np.concatenate([of, of]).astype(np.uint64)[text]
    side = np.where(text < len(of), 1, -1)
    odd = np.zeros((keys, order))
    if order * bits + keys.bit_length() + 1 <= 64:
        whole = np.zeros(len(codes) + len(size) * order, np.uint64)
        for j in range(order):
            whole = (whole << np.uint64(bits)) | padded[j : j + len(whole)]
        gram = np.sort(((pair << np.uint64(order * bits) | whole[place]) << np.uint64(1)) | (side < 0).astype(np.uint64))
        more = 1 - 2 * (gram & np.uint64(1)).astype(np.int64)
        gram >>= np.uint64(1)
        for k in range(order, 0, -1):
            start = np.flatnonzero(np.append(True, gram[1:] != gram[:-1])[: len(gram)])
            if len(start):
                gram, more = gram[start], np.add.reduceat(more, start)
                there = (gram & np.uint64((1 << bits) - 1)) > 0
                odd[:, k - 1] = np.bincount((gram[there] >> np.uint64(k * bits)).astype(np.int64), np.abs(more[there]), keys)
                gram = gram >> np.uint64(bits)
    else:  # one key of very many different letters: n-grams are numbered order by order
        number = np.zeros(len(codes), np.uint64)
        for k in range(order):
            last = padded[place + k]
            _, number = np.unique(number * np.uint64(len(symbols) + 1) + last, return_inverse=True)
            number = number.astype(np.uint64)
            there = last > 0
            odd[0, k] = np.abs(np.bincount(number[there].astype(np.int64), side[there])).sum()
    out[:, 0] = (out[:, 1] + out[:, 2] - odd.astype(np.int64)) // 2
    return out


def letter_sums(by: list[str], key: list[str], pred: str, ref: str, order: int, size: int = 1 << 18) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``*by, m, p, r`` of the keys of rows that lie together; keys with a null share nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, of, known in keyed(batches, [*by, *key], [pred, ref], size):
            found = letter_matches(t[pred].to_pylist(), t[ref].to_pylist(), of, order)
            first = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
            found[~known[first], 0] = 0
            lists = [pa.array(list(found[:, i]), pa.list_(pa.int64())) for i in range(3)]
            own = t.select(by).take(pa.array(first)).combine_chunks()
            yield from pa.table([*own.columns, *lists], names=[*by, "m", "p", "r"]).combine_chunks().to_batches()

    return run


#: A batch of rows: their keys, the distinct texts as word numbers of the batch, and which key and texts each row has.
_PACKED = {"batch": pa.int64(), "grams": pa.int64(), "rows": pa.int64(), "hashes": pa.binary(), "words": pa.binary(), "sizes": pa.binary(), "pred": pa.binary(), "ref": pa.binary(), "of": pa.binary(), "known": pa.binary()}
_PACKED_DDL = "batch long, grams long, rows long, hashes binary, words binary, sizes binary, pred binary, ref binary, of binary, known binary"


def _pack(key: list[str], size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        for i, (t, of, known) in enumerate(keyed(batches, key, ["_p", "_r"], size)):
            texts: dict[str, int] = {}
            pred, ref = (np.array([texts.setdefault(x or "", len(texts)) for x in t[c].to_pylist()], "<i4") for c in ("_p", "_r"))
            split = [x.split() for x in texts]
            vocabulary = {w: k for k, w in enumerate(dict.fromkeys(chain.from_iterable(split)))}
            words = np.fromiter(map(vocabulary.__getitem__, chain.from_iterable(split)), "<i4")
            sizes = np.array(list(map(len, split)), "<i4")
            hashes = b"".join(hashlib.blake2b(w.encode(), digest_size=8).digest() for w in vocabulary)
            grams = int(sum(np.maximum(sizes - n, 0).sum() for n in range(4)))
            row = [part << 33 | i, grams, t.num_rows, hashes, words.tobytes(), sizes.tobytes(), pred.tobytes(), ref.tobytes(), of.astype("<i4").tobytes(), known.tobytes()]
            own = [pa.ListArray.from_arrays(pa.array([0, t.num_rows], pa.int32()), t[k].combine_chunks()) for k in key]
            yield pa.RecordBatch.from_arrays([*own, *[pa.array([x], kind) for x, kind in zip(row, _PACKED.values(), strict=True)]], names=[*key, *_PACKED])

    return run


class Batch:
    """A packed batch's distinct n-grams of one to four words as sorted hashes, and how often each stands for each key."""

    def __init__(self, row: dict):
        col = lambda name, kind="<i4": np.frombuffer(row[name], kind)
        self.pred, self.ref, self.of, self.sizes, self.known = col("pred"), col("ref"), col("of").astype(np.int64), col("sizes").astype(np.int64), col("known", bool)
        h, begin = col("hashes", "<u8")[col("words")], np.cumsum(self.sizes) - self.sizes
        grams, texts, orders = [], [], []
        for n in range(1, 5):
            m = np.maximum(self.sizes - n + 1, 0)
            at = np.repeat(begin - (np.cumsum(m) - m), m) + np.arange(m.sum())
            g = np.full(len(at), n, np.uint64)
            for i in range(n):
                g = (g ^ h[at + i]) * _MIX
                g ^= g >> np.uint64(29)
            grams.append(g), texts.append(np.repeat(np.arange(len(m)), m)), orders.append(np.full(len(at), n, np.int8))
        self.grams, first, number = np.unique(np.concatenate(grams), return_index=True, return_inverse=True)
        self.order = np.concatenate(orders)[first].astype(np.int64)
        text = np.concatenate(texts)
        by = np.argsort(text, kind="stable")
        self.number, self.size = number[by], np.bincount(text, None, len(self.sizes))
        self.begin = np.cumsum(self.size) - self.size
        self.keys = int(self.of[-1]) + 1

    def counts(self, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Key, n-gram and how often it stands in the key's texts, by key and n-gram; ``texts`` has one of each row."""
        m = self.size[texts]
        at = np.repeat(self.begin[texts] - (np.cumsum(m) - m), m) + np.arange(m.sum())
        cell, c = np.unique(np.repeat(self.of, m) * max(len(self.grams), 1) + self.number[at], return_counts=True)
        return *np.divmod(cell, max(len(self.grams), 1)), c


def _planes(x: np.ndarray) -> bytes:
    """Integers by the significance of their bytes, which compresses well where they are small."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(len(x), -1).T).tobytes()


def _unplaned(raw: bytes, kind: str) -> np.ndarray:
    n = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(n, -1).T).view(kind).ravel()


def _block(grams: np.ndarray, blocks: int) -> np.ndarray:
    """Ranges of hashes, so that sorted hashes are sorted by block."""
    return ((grams >> np.uint64(32)) * np.uint64(blocks) >> np.uint64(32)).astype(np.int64)


def _ask(blocks: int):
    """A batch's n-grams by block, each with the number of keys whose references have it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                b = Batch(row)
                have = np.bincount(b.counts(b.ref)[1], None, len(b.grams)).astype("<u4")
                edge = np.searchsorted(_block(b.grams, blocks), np.arange(blocks + 1))
                full = [k for k in range(blocks) if edge[k] < edge[k + 1]]
                cut = lambda k: slice(edge[k], edge[k + 1])
                yield pa.record_batch([
                    pa.array(full, pa.int32()), pa.array([row["batch"]] * len(full), pa.int64()),
                    pa.array([_planes(np.diff(b.grams[cut(k)], prepend=np.uint64(0))) for k in full], pa.binary()), pa.array([_planes(have[cut(k)]) for k in full], pa.binary())], names=["block", "batch", "grams", "have"])

    return run


def _answer(key: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
    """Document frequencies of each batch's n-grams in a block, in their order."""
    grams = [np.cumsum(_unplaned(x, "<u8"), dtype=np.uint64) for x in t["grams"].to_pylist()]
    have = np.concatenate([_unplaned(x, "<u4") for x in t["have"].to_pylist()])
    _, number = np.unique(np.concatenate(grams), return_inverse=True)
    df = np.bincount(number, have)[number].astype("<u8")
    cuts = np.cumsum([len(g) for g in grams])[:-1]
    return pa.table({"batch": t["batch"], "block": pa.array([key[0].as_py()] * t.num_rows, pa.int32()), "df": pa.array([_planes(x) for x in np.split(df, cuts)], pa.binary())})


def _score(key: list[str], logs: float, sigma: float):
    def run(packed: pa.Table, answers: pa.Table) -> pa.Table:
        row = packed.drop_columns(key).to_pylist()[0]
        b = Batch(row)
        df = [_unplaned(x, "<u8") for x in answers.sort_by("block")["df"].to_pylist()]
        weight = logs - np.log(np.maximum(np.concatenate([*df, np.zeros(0, "<u8")]), 1).astype(float))
        (of, gram, c), (ref_of, ref_gram, ref_c) = b.counts(b.pred), b.counts(b.ref)
        cell = lambda of, gram: of * 4 + b.order[gram] - 1
        x, y = c * weight[gram], ref_c * weight[ref_gram]
        total = lambda at, v: np.bincount(at, v, b.keys * 4).reshape(-1, 4).astype(float)
        norm = np.sqrt(total(cell(of, gram), x * x)), np.sqrt(total(cell(ref_of, ref_gram), y * y))
        _, i, j = np.intersect1d(of * max(len(b.grams), 1) + gram, ref_of * max(len(b.grams), 1) + ref_gram, assume_unique=True, return_indices=True)
        dot = total(cell(of[i], gram[i]), np.minimum(x[i], y[j]) * y[j])
        both = norm[0] * norm[1]
        s = np.divide(dot, both, out=dot.copy(), where=both != 0).sum(axis=1)
        size = np.maximum(b.sizes - 1, 0)  # lengths are counted in bigrams, as the metric has it
        damped = np.exp(-((size[b.pred] - size[b.ref]) ** 2) / (2 * sigma * sigma))
        score = 10 * np.where(b.known, s[b.of], 0.0) / 4 * damped
        own = [pc.list_flatten(packed[k]) for k in key]
        return pa.table([*own, pa.array(score)], names=[*key, "score"])

    return run


def consensus(rows: DataFrame, key: list[str], pred: str, ref: str, sigma: float, size: int = 1 << 20, block_grams: int = 2_000_000) -> DataFrame:
    """``*key, score`` of rows whose texts are words parted by spaces; see ``captions.consensus_scores``."""
    spark = rows.sparkSession
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    own = rows.select(*key, F.col(pred).alias("_p"), F.col(ref).alias("_r"))
    packed = stage(in_order(own, key).mapInArrow(_pack(key, size), ", ".join([f"`{k}` array<{kinds[k]}>" for k in key] + [_PACKED_DDL])), "consensus-batches")
    grams, there = packed.agg(F.sum("grams"), F.sum("rows")).first()
    blocks = max(shuffle_width(spark), -(-(grams or 0) // block_grams))
    asked = packed.drop(*key).mapInArrow(_ask(blocks), "block int, batch long, grams binary, have binary")
    answers = asked.groupBy("block").applyInArrow(_answer, "batch long, block int, df binary")
    scored = packed.groupBy("batch").cogroup(answers.groupBy("batch"))
    return scored.applyInArrow(_score(key, float(np.log(max(there or 0, 1))), sigma), ", ".join([f"`{k}` {kinds[k]}" for k in key] + ["score double"]))
