"""Removal of repeated byte strings, by merged Burrows-Wheeler transforms of the places that can repeat.

A start of ``length`` bytes repeats if the same bytes start anywhere else.

1. Each text's starts are assigned to anchors (see ``anchors``).  Anchors whose
   core occurs once are unique and go; only hashes travel for that.  Of anchors
   with the same extent one stands for all, with their number as its weight; the
   others follow what is found for it.
2. Anchors whose core recurs become short strings: what the starts in question
   share is one symbol.  Where all occurrences of a core have the same extent,
   they share all of it, and the string is that symbol.  Where an equal core lies
   in different surroundings the bytes are fetched; the starts of an anchor are
   cut into ``SLICE`` neighbours, which share all but a few bytes, and the few
   bytes on either side stand beside the symbol.
3. The strings of a bucket are split into shards and the shards' transforms are
   merged by refining their interleave.  The passes give the common prefixes, and
   intervals that share the whole depth and weigh more than one are the starts
   that repeat.
4. The strings of a core with over ``crowd`` different surroundings are not
   gathered: their starts are counted one by one, by hashes, with partial
   aggregation.

Defined cases: null and empty texts have no bytes; texts under ``length`` keep
all; copies of a text repeat each other; overlapping occurrences in one text
count; ids may be null or repeated; other columns are kept, except those named
as an output column, which are replaced.  A byte that is cut out of the middle
of a character leaves the rest of it in ``kept`` and none of it in the decoded
``text``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from minewright.llm.anchors import SPAN, RollingHash, anchors
from minewright.llm.bwt import repeated
from minewright.llm.words import beside, unused
from minewright.staging import shuffle_width, stage

LENGTH, SLICE = 400, 32
_ENTRY = np.dtype([("core", "<u8"), ("extent", "<u8"), ("key", "<i8"), ("at", "<u4"), ("near", "u1"), ("far", "u1"), ("count", "<u4")])
_SPAN = np.dtype([("key", "<i8"), ("first", "<u4"), ("last", "<u4")])
#: An extent that stands for its equals: ``kind`` numbers it in its block of anchors.
_REP = np.dtype([("kind", "<u4"), ("key", "<i8"), ("at", "<u4"), ("near", "u1"), ("far", "u1"), ("count", "<u4"), ("crowd", "u1")])
_MEMBER = np.dtype([("kind", "<u4"), ("key", "<i8"), ("first", "<u4")])
#: A string: its symbol, the extent it is of and the place of its first start there, its weight, and the bytes on either side.
_STRING = np.dtype([("symbol", "<u8"), ("block", "<i4"), ("kind", "<u4"), ("first", "u1"), ("weight", "<u4"), ("left", "u1"), ("right", "u1")])
_FOUND = np.dtype([("kind", "<u4"), ("first", "u1"), ("last", "u1")])


def _hashes() -> tuple[RollingHash, RollingHash]:
    return RollingHash(101), RollingHash(202)


#: Bytes worked on at a time; a longer text is cut into segments that overlap by a window less one byte.
SEGMENT = 1 << 20


def _segments(texts: Iterable[pa.Scalar], length: int) -> Iterator[tuple[list[int], list[int], list[bytes]]]:
    """Groups of segments: number of the text, where the segment begins in it, its bytes."""
    owner: list[int] = []
    base: list[int] = []
    parts: list[bytes] = []
    held = 0
    for i, t in enumerate(texts):
        raw = (t.as_py() or "").encode("utf-8")
        for at in range(0, max(len(raw) - length + 1, 0), SEGMENT):
            part = raw[at : at + SEGMENT + length - 1]
            if held and held + len(part) > SEGMENT:
                yield owner, base, parts
                owner, base, parts, held = [], [], [], 0
            owner.append(i), base.append(at), parts.append(part)
            held += len(part)
    if parts:
        yield owner, base, parts


def _by(values: np.ndarray, part: np.ndarray) -> dict[int, bytes]:
    order = np.argsort(part, kind="stable")
    cuts = np.flatnonzero(np.diff(part[order])) + 1
    return {int(part[i[0]]): values[i].tobytes() for i in np.split(order, cuts) if len(i)}


def _spans(key: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    out = np.zeros(len(key), _SPAN)
    out["key"], out["first"], out["last"] = key, first, last
    return out


def _by_text(spans: np.ndarray, blocks: int) -> dict[int, bytes]:
    spans = np.unique(spans)
    return _by(spans, (np.ascontiguousarray(spans["key"]).view(np.uint64) % np.uint64(blocks)).astype(np.int32))


def _differs(e: np.ndarray, *names: str) -> np.ndarray:
    """Where a row differs from the one before in one of the fields."""
    new = np.ones(len(e), bool)
    if len(e):
        new[1:] = np.logical_or.reduce([e[n][1:] != e[n][:-1] for n in names])
    return new


def _map_anchors(length: int, blocks: int):
    """Anchors by core, one for each distinct extent of a batch with its number; the starts of the others of equal extent follow it and are done."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, two = _hashes()
        for batch in batches:
            texts, keys = batch.column(0), batch.column(1).to_numpy()
            for owner, base, parts in _segments(texts, length):
                size = np.array(list(map(len, parts)), np.int64)
                end = np.cumsum(size)
                begin = end - size
                got = anchors(np.frombuffer(b"".join(parts), np.uint8), begin, end, one, two, length)
                e = np.zeros(len(got["at"]), _ENTRY)
                for c in ("core", "extent", "near", "far"):
                    e[c] = got[c]
                e["key"] = keys[np.array(owner)][got["text"]]
                e["at"] = got["at"] - begin[got["text"]] + np.array(base)[got["text"]]
                e = e[np.lexsort((e["at"], e["key"], e["far"], e["near"], e["extent"], e["core"]))]
                new = _differs(e, "core", "extent", "near", "far")
                rest = e[~new]
                count = np.diff(np.append(np.flatnonzero(new), len(e)))
                e = e[new]
                e["count"] = count
                entries = _by(e, ((e["core"] >> np.uint64(13)) % np.uint64(blocks)).astype(np.int32))
                ready = _by_text(_spans(rest["key"], rest["at"] - rest["far"], rest["at"] - rest["near"]), blocks)
                ids = sorted(entries.keys() | ready.keys())
                yield pa.record_batch([pa.array(ids, pa.int32()), pa.array([entries.get(i, b"") for i in ids], pa.binary()), pa.array([ready.get(i, b"") for i in ids], pa.binary())], names=["block", "entries", "done"])

    return run


_SETTLED = "part int, spans binary, block int, reps binary, members binary, strings long, crowded long"


def _settle(blocks: int, crowd: int):
    """Of a block of anchors: starts that repeat, dealt by text; extents to fetch, and which anchors have them.

    The batches' sorted extents are the shards here.
    """

    def run(key: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
        e = np.frombuffer(b"".join(t["entries"].to_pylist()), _ENTRY)
        done = np.frombuffer(b"".join(t["done"].to_pylist()), _SPAN)
        e = e[np.lexsort((e["at"], e["key"], e["far"], e["near"], e["extent"], e["core"]))]
        core_new, new = _differs(e, "core"), _differs(e, "core", "extent", "near", "far")
        core, kind = np.cumsum(core_new) - 1, np.cumsum(new) - 1
        first = np.flatnonzero(new)
        weight = np.bincount(kind, e["count"], len(first)).astype(np.int64)
        kinds = np.bincount(core[first], None, int(core_new.sum()))[core[first]]  # different extents of a core
        lone = kinds == 1
        # All occurrences of the core have one extent: a string of one symbol.
        symbols = (1 + np.arange(len(first))).astype(np.uint32)
        again = np.zeros(len(first), bool)
        again[lone] = repeated(symbols[lone], np.ones(int(lone.sum()), np.int64), weight[lone], 1, 1 << 20)
        same = e[again[kind]] if len(e) else e
        spans = _by_text(np.concatenate([done, _spans(same["key"], same["at"] - same["far"], same["at"] - same["near"])]), blocks)
        ask = ~lone
        reps = np.zeros(int(ask.sum()), _REP)
        for c in ("key", "at", "near", "far"):
            reps[c] = e[c][first[ask]]
        reps["kind"], reps["count"], reps["crowd"] = np.flatnonzero(ask), np.minimum(weight[ask], 2**32 - 1), kinds[ask] > crowd
        of = ask[kind] if len(e) else np.zeros(0, bool)
        members = np.zeros(int(of.sum()), _MEMBER)
        members["kind"], members["key"], members["first"] = kind[of], e["key"][of], e["at"][of] - e["far"][of]
        strings = (reps["far"] // SLICE).astype(np.int64) - reps["near"] // SLICE + 1
        out = [{"part": i, "spans": s} for i, s in sorted(spans.items())]
        if len(reps):
            out.append({"block": key[0].as_py(), "reps": reps.tobytes(), "members": np.unique(members).tobytes(), "strings": int(strings.sum()), "crowded": int(strings[reps["crowd"] > 0].sum())})
        kinds_of = (("part", pa.int32()), ("spans", pa.binary()), ("block", pa.int32()), ("reps", pa.binary()), ("members", pa.binary()), ("strings", pa.int64()), ("crowded", pa.int64()))
        return pa.table({c: pa.array([r.get(c) for r in out], k) for c, k in kinds_of})

    return run


def _spell_reps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block, raw in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            r = np.frombuffer(raw.as_py(), _REP)
            columns = [r["key"], np.full(len(r), block, np.int32), r["kind"].astype(np.int64), r["at"].astype(np.int64), r["near"].astype(np.int32), r["far"].astype(np.int32), r["count"].astype(np.int64), r["crowd"] > 0]
            yield pa.record_batch([pa.array(c) for c in columns], names=["key", "block", "kind", "at", "near", "far", "count", "crowd"])


_PLACES = ("block", "kind", "at", "near", "far", "count", "crowd")


def _strings(length: int, buckets: int, flush: int = 20_000):
    """The fetched extents as strings, dealt to buckets by their symbol."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        sides: list[bytes] = []

        def dealt() -> pa.RecordBatch:
            s = np.zeros(len(held), _STRING)
            columns = list(zip(*held, strict=True))
            for c, v in zip(_STRING.names, columns, strict=False):
                s[c] = v
            crowd = np.array(columns[-1], bool)
            bucket = (s["symbol"] % np.uint64(buckets)).astype(np.int64) * 2 + crowd
            order = np.argsort(bucket, kind="stable")
            parts = [i for i in np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1) if len(i)]
            rows = [(int(bucket[i[0]]) >> 1, bool(bucket[i[0]] & 1), s[i].tobytes(), b"".join([sides[j] for j in i.tolist()])) for i in parts]
            return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), (pa.int32(), pa.bool_(), pa.binary(), pa.binary()), strict=True)], names=["bucket", "crowd", "strings", "sides"])

        for batch in batches:
            lists = batch.column(1)
            flat, offsets = lists.flatten(), np.append(0, np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False)))
            place = {c: flat.field(c).to_numpy(zero_copy_only=False) for c in _PLACES}
            for i, text in enumerate(batch.column(0)):
                raw = text.as_py().encode("utf-8")
                own = {c: v[offsets[i] : offsets[i + 1]].astype(np.int64) for c, v in place.items()}
                n = own["far"] // SLICE - own["near"] // SLICE + 1
                own = {c: np.repeat(v, n) for c, v in own.items()}
                k = (own["near"] // SLICE + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)) * SLICE
                hi, lo = np.minimum(own["far"], k + SLICE - 1), np.maximum(own["near"], k)
                stop = own["at"] + length - k - SLICE + 1  # end of what all starts of the slice share
                columns = (own["block"], own["kind"], own["far"] - hi, own["count"], own["crowd"], k, own["at"] - hi, own["at"] - k, stop, own["at"] + length - lo)
                for block, kind, first, count, crowd, slot, a, b, c, d in zip(*(x.tolist() for x in columns), strict=True):
                    sides.append(raw[a:b] + raw[c:d])
                    held.append((xxhash.xxh3_64_intdigest(raw[b:c], seed=slot), block, kind, first, count, b - a, d - c, crowd))
                if len(held) >= flush:
                    yield dealt()
                    held.clear(), sides.clear()
        if held:
            yield dealt()

    return run


def _unpack(strings: list[bytes], sides: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(strings), _STRING), np.frombuffer(b"".join(sides), np.uint8)


_RUNS_DDL = "block int, found binary"


def _runs(s: np.ndarray, owner: np.ndarray, inner: np.ndarray) -> pa.Table:
    """Starts that repeat (string and place in it, in order) as runs, dealt by the block of their extent."""
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (inner[1:] != inner[:-1] + 1)
    a = np.flatnonzero(new)
    b = np.append(a[1:], len(owner)) - 1 if len(a) else a
    found = np.zeros(len(a), _FOUND)
    found["kind"], found["first"], found["last"] = s["kind"][owner[a]], s["first"][owner[a]] + inner[a], s["first"][owner[a]] + inner[b]
    by = _by(found, s["block"][owner[a]])
    return pa.table({"block": pa.array(list(by), pa.int32()), "found": pa.array(list(by.values()), pa.binary())})


def _merge(shard_strings: int):
    """Starts of a bucket's strings that repeat."""

    def run(key: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
        s, sides = _unpack(t["strings"].to_pylist(), t["sides"].to_pylist())
        each = s["left"].astype(np.int64) + s["right"]
        names, which = np.unique(s["symbol"], return_inverse=True)
        keep = np.bincount(which, s["weight"])[which] > 1  # a symbol that weighs one repeats nothing
        sides = sides[np.repeat(keep, each)]
        s, each = s[keep], each[keep]
        names, which = np.unique(s["symbol"], return_inverse=True)
        size = each + 1
        left = s["left"].astype(np.int64)
        begin = np.cumsum(size) - size
        flat = np.zeros(size.sum(), np.uint16 if len(names) + 257 < 1 << 16 else np.uint32)
        at = np.arange(len(sides)) - np.repeat(np.cumsum(each) - each, each)  # place of a byte in its string
        flat[np.repeat(begin, each) + at + (at >= np.repeat(left, each))] = sides.astype(flat.dtype) + 1
        flat[begin + left] = 257 + which
        flag = repeated(flat, size, s["weight"].astype(np.int64), SLICE, shard_strings)
        # Starts are the symbols up to and with the shared one.
        owner = np.repeat(np.arange(len(size)), size)
        inner = np.arange(len(flat)) - np.repeat(begin, size)
        hit = np.flatnonzero(flag & (inner <= left[owner])) if len(flat) else np.zeros(0, np.int64)
        return _runs(s, owner[hit], inner[hit])

    return run


_SINGLE = "symbol long, w1 long, w2 long, block int, kind long, start int, weight long"


def _single_starts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every start of the strings of crowded cores, as hashes."""
    for batch in batches:
        for raw, body in zip(batch.column(0), batch.column(1), strict=True):
            s, sides = np.frombuffer(raw.as_py(), _STRING), body.as_py()
            at = 0
            rows: list[tuple] = []
            for symbol, block, kind, first, weight, n_left, n_right in s.tolist():
                left, right = sides[at : at + n_left], sides[at + n_left : at + n_left + n_right]
                at += n_left + n_right
                for i in range(n_left + 1):
                    need = SLICE - 1 - (n_left - i)
                    if need <= n_right:
                        d = hashlib.blake2b(left[i:] + b"|" + right[:need], digest_size=16, salt=bytes([n_left - i])).digest()
                        rows.append((symbol - (1 << 63), int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True), block, kind, first + i, weight))
            kinds = (*[pa.int64()] * 3, pa.int32(), pa.int64(), pa.int32(), pa.int64())
            yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows, strict=True) if rows else [[]] * 7, kinds, strict=True)], names=["symbol", "w1", "w2", "block", "kind", "start", "weight"])


def _pack_found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = np.zeros(batch.num_rows, _FOUND)
        found["kind"], found["first"], found["last"] = (batch.column(i).to_numpy() for i in (1, 2, 2))
        by = _by(found, batch.column(0).to_numpy())
        yield pa.record_batch([pa.array(list(by), pa.int32()), pa.array(list(by.values()), pa.binary())], names=["block", "found"])


def _spread(blocks: int):
    """What was found for the extents of a block, for every anchor that has one of them, dealt by text."""

    def run(key: tuple[pa.Scalar, ...], left: pa.Table, right: pa.Table) -> pa.Table:
        m = np.frombuffer(b"".join(left["members"].to_pylist()), _MEMBER)
        f = np.sort(np.frombuffer(b"".join(right["found"].to_pylist()), _FOUND), order="kind")
        lo, hi = np.searchsorted(f["kind"], m["kind"], "left"), np.searchsorted(f["kind"], m["kind"], "right")
        n = hi - lo
        at = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())
        first = np.repeat(m["first"], n)
        spans = _by_text(_spans(np.repeat(m["key"], n), first + f["first"][at], first + f["last"][at]), blocks)
        return pa.table({"part": pa.array(list(spans), pa.int32()), "spans": pa.array(list(spans.values()), pa.binary())})

    return run


def _union_spans(key: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
    """Per text the repeated starts as joined runs, one after the other."""
    s = np.unique(np.frombuffer(b"".join(t["spans"].to_pylist()), _SPAN))
    if not len(s):
        return pa.table({"key": pa.array([], pa.int64()), "runs": pa.array([], pa.list_(pa.int64()))})
    new_key = np.append(True, s["key"][1:] != s["key"][:-1])
    # The farthest end so far in the text, by an offset that grows with the text.
    step = np.cumsum(new_key).astype(np.int64) << 34
    reach = np.maximum.accumulate(s["last"].astype(np.int64) + step)
    new = new_key | np.append(True, s["first"][1:].astype(np.int64) + step[1:] > reach[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(s)) - 1
    runs = np.stack([s["first"][first].astype(np.int64), reach[last] - step[last]], axis=1).ravel()
    text = np.flatnonzero(new_key[first])
    offsets = np.append(text, len(first)) * 2
    return pa.table({"key": pa.array(s["key"][first][text]), "runs": pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(runs))})


def repeated_runs(texts: DataFrame, length: int = LENGTH, crowd: int = 8192, bucket: int = 12_000, shard_strings: int = 2000) -> DataFrame:
    """``key, runs``: for ``key long, text`` rows, the runs of starts that repeat, as ``[first, last, first, last, ...]``."""
    if length < 2 * SPAN:
        raise ValueError(f"length must be {2 * SPAN} at least")
    spark = texts.sparkSession
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(shuffle_width(spark), -(-total // (32 << 20)))
    settled = stage(
        texts.select("text", "key").mapInArrow(_map_anchors(length, blocks), "block int, entries binary, done binary")
        .groupBy("block").applyInArrow(_settle(blocks, crowd), _SETTLED), "repeat-anchors")
    strings, crowded = settled.agg(F.coalesce(F.sum("strings"), F.lit(0)), F.coalesce(F.sum("crowded"), F.lit(0))).first()
    spans = settled.where(F.octet_length("spans") > 0).select("part", "spans")
    if strings:
        buckets = max(shuffle_width(spark), -(-strings // bucket))
        asked = settled.where("reps IS NOT NULL")
        reps = asked.select("block", "reps").mapInArrow(_spell_reps, "key long, block int, kind long, at long, near int, far int, count long, crowd boolean")
        places = reps.groupBy("key").agg(F.collect_list(F.struct(*_PLACES)).alias("places"))  # of one text
        fetched = texts.groupBy("key").agg(F.first("text").alias("text")).join(places, "key").select("text", "places")
        dealt = fetched.mapInArrow(_strings(length, buckets), "bucket int, crowd boolean, strings binary, sides binary")
        if crowded:
            dealt = stage(dealt, "repeat-strings")
        found = dealt.where("NOT crowd").groupBy("bucket").applyInArrow(_merge(shard_strings), _RUNS_DDL)
        if crowded:
            single = dealt.where("crowd").select("strings", "sides").mapInArrow(_single_starts, _SINGLE)
            again = single.groupBy("symbol", "w1", "w2").agg(F.sum("weight").alias("w")).where("w > 1").select("symbol", "w1", "w2")
            found = found.union(single.join(again, ["symbol", "w1", "w2"]).select("block", "kind", "start").mapInArrow(_pack_found, _RUNS_DDL))
        spread = asked.select("block", "members").groupBy("block").cogroup(found.groupBy("block")).applyInArrow(_spread(blocks), "part int, spans binary")
        spans = spans.union(spread)
    return spans.groupBy("part").applyInArrow(_union_spans, "key long, runs array<long>")


_OUT = "n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _covered(runs: list[int], length: int) -> list[list[int]]:
    """Spans of bytes that runs of starts cover, joined where they meet."""
    cut: list[list[int]] = []
    for a, b in zip(runs[::2], runs[1::2], strict=True):
        if cut and a <= cut[-1][1]:
            cut[-1][1] = b + length
        else:
            cut.append([a, b + length])
    return cut


def _remove(columns: list[str], text_name: str, runs_name: str, passages_name: str, length: int, with_text: bool, passage: int | None, chars: int = 1 << 20):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole_batch in batches:
            sizes = pc.fill_null(pc.binary_length(whole_batch.column(whole_batch.schema.get_field_index(text_name))), 0).to_numpy(zero_copy_only=False)
            part = np.cumsum(sizes, dtype=np.int64) // chars
            cuts = np.append(np.append(0, np.flatnonzero(np.diff(part)) + 1), len(part))
            for start, stop in zip(cuts[:-1], cuts[1:], strict=True):
                batch = whole_batch.slice(start, stop - start)
                text, runs = (batch.column(batch.schema.get_field_index(c)) for c in (text_name, runs_name))
                out: list[list] = [[] for _ in range(7)]
                for t, r in zip(text, runs, strict=True):
                    whole = t.as_py()
                    raw = (whole or "").encode("utf-8")
                    cut = _covered(r.as_py() or [], length)
                    kept = b"".join(raw[a:b] for a, b in zip([0, *(c[1] for c in cut)], [*(c[0] for c in cut), len(raw)], strict=True))
                    if with_text:
                        out[4].append(cut), out[5].append(kept), out[6].append(whole if not cut else kept.decode("utf-8", "ignore"))
                    for c, x in zip(out, (len(raw), len(raw) - len(kept), len(cut), hashlib.sha256(kept).hexdigest()), strict=False):
                        c.append(x)
                types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.list_(pa.int64())), pa.binary(), pa.string()]
                names = ["n_bytes", "n_removed", "n_spans", "kept_sha256", "removed", "kept", "text"]
                n = 7 if with_text else 4
                rest = [batch.column(batch.schema.get_field_index(c)) for c in columns]
                more = [pa.array([len(_covered(r.as_py() or [], passage)) for r in batch.column(batch.schema.get_field_index(passages_name))], pa.int64())] if passage else []
                yield pa.RecordBatch.from_arrays([*rest, *(pa.array(c, k) for c, k in zip(out[:n], types, strict=False)), *more], names=[*columns, *names[:n], *["n_passages"] * len(more)])

    return run


def remove_repeats(documents: DataFrame, length: int = LENGTH, with_text: bool = True, passage: int | None = None, **options: int) -> DataFrame:
    """``documents`` with ``n_bytes, n_removed, n_spans, kept_sha256`` and, with ``with_text``, ``removed`` spans, ``kept`` bytes and the kept ``text``.

    With ``passage``, a shorter length, also ``n_passages``: how many runs of bytes repeat in strings of so many; they stay.
    """
    key, check, text_name, runs_name, passages_name = unused(documents, "_key", "_check", "_text", "_runs", "_passages")
    for seed in range(4):
        keyed = documents.withColumn(key, F.xxhash64("text", F.lit(17 + seed)))
        hashes = documents.select(F.xxhash64("text", F.lit(17 + seed)).alias(key), F.xxhash64(F.lit(23), F.col("text")).alias(check))
        clash = hashes.groupBy(key).agg((F.min(check) != F.max(check)).alias("c")).agg(F.max("c")).first()[0]
        if not clash:
            break
    else:
        raise RuntimeError("two texts have one 64-bit key with every seed")

    def runs_of(n: int, name: str) -> DataFrame:
        texts = keyed.where(F.octet_length("text") >= n).select(F.col(key).alias("key"), "text")
        return repeated_runs(texts, n, **options).select(F.col("key").alias(key), F.col("runs").alias(name))

    runs = runs_of(length, runs_name)
    if passage:
        runs = stage(runs, "repeat-runs").join(stage(runs_of(passage, passages_name), "repeat-passages"), key, "full")
    added = _OUT + (", removed array<array<long>>, kept binary, text string" if with_text else "") + (", n_passages long" if passage else "")
    kept, schema = beside(documents, added + ("" if with_text else ", text string"))
    if not with_text:
        schema = type(schema)([f for f in schema.fields if f.name != "text"])
    columns = kept.columns
    joined = keyed.join(runs, key, "left").withColumnRenamed("text", text_name)
    found = [runs_name, passages_name] if passage else [runs_name]
    return joined.select(*[F.col(f"`{c}`") for c in columns], text_name, *found).mapInArrow(_remove(columns, text_name, runs_name, passages_name, length, with_text, passage), schema)


#: Bytes of a passage of some fifty words: five a word with its space, and some.
PASSAGE = 256


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return remove_repeats(documents, with_text=False, passage=PASSAGE)
