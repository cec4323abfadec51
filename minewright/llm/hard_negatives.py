"""Hard negatives by a block matrix product over shards of rows and of dimensions.

1. A task packs the rows it reads into blocks and cuts their components into chunks
   of dimensions; no row moves for that, so no id, label or vector is a hot key.
   Anchors are packed again into blocks of their own.
2. The blocks of anchors, of bounded bytes, come to all row blocks of their chunk of
   dimensions.  Each meeting gives a partial tile of int64 scores; the tiles of a pair
   of blocks are shuffled together and added.
3. A whole tile gives each anchor's best rows of its label, which are merged to its
   positives.  These go back to the tiles, where each anchor and positive has a window
   of scores, and each tile gives its first rows in that window; these are merged again.

Anchors are taken in rounds of ``round_scores`` scores (eight million for each core, unless
given), which bounds the disk of tiles; every anchor has its round and every row is met.

Defined cases: rows with a null id, label or vector, an empty vector, or null or
non-finite components take no part; vectors of another length than the anchor's are
neither positives nor negatives; an anchor's own row is left out, other rows of its id
are not; repeated rows each count; ties go to the smaller id; a score beyond 64 bits is
an error; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from minewright.llm.topk import usable
from minewright.staging import drop_staged, small_batches, stage, table

_LOW = np.iinfo(np.int64).min
#: A row's place: the number of its block and its own within.
_ROW_BITS = 20


def _integers(data: bytes, rows: int) -> np.ndarray:
    return np.frombuffer(data, "<i8").reshape(rows, -1)


def _pack(rows: int, chunk: int):
    """Blocks of ``id, label, v``: a row of ``block, dim, chunk, ids, labels, data`` for each chunk of dimensions; ids rise within a block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, made, held = TaskContext.get().partitionId(), 0, defaultdict(list)

        def block(dim: int) -> Iterator[pa.RecordBatch]:
            nonlocal made
            ids, labels, v = (np.concatenate(x) for x in zip(*held.pop(dim), strict=True))
            order = np.argsort(ids, kind="stable")
            ids, labels, v = ids[order], labels[order], v[order]
            for c in range(0, dim, chunk):
                yield pa.record_batch({
                    "block": [(part << 24) + made], "dim": [dim], "chunk": [c // chunk], "chunks": [-(-dim // chunk)],
                    "ids": [ids.tobytes()], "labels": [labels.tobytes()], "data": [np.ascontiguousarray(v[:, c : c + chunk]).tobytes()]})
            made += 1

        for b in batches:
            flat = b.column("v")
            dims = np.diff(flat.offsets.to_numpy())
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                v = flat.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).reshape(len(at), dim)
                if float(np.abs(v).max()) >= 2.0**63:
                    raise OverflowError("a component does not fit into 64 bits")
                for a in range(0, len(at), rows):
                    here = at[a : a + rows]
                    held[int(dim)].append((b.column("id").to_numpy()[here], b.column("label").to_numpy()[here], v[a : a + rows].astype("<i8")))
                    if sum(len(x[0]) for x in held[int(dim)]) >= rows:
                        yield from block(int(dim))
        for dim in list(held):
            yield from block(dim)

    return run


_BLOCK = "block long, dim long, chunk long, chunks long, ids binary, labels binary, data binary"


def _anchors(every: int):
    """The anchors of blocks, a row each: ``place, id, label`` and the chunk's components."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                ids, labels = np.frombuffer(r["ids"], "<i8"), np.frombuffer(r["labels"], "<i8")
                at = np.flatnonzero(ids % every == 0)
                v = _integers(r["data"], len(ids))
                n = len(at)
                yield pa.record_batch({
                    "place": (r["block"] << _ROW_BITS) + at, "id": ids[at], "label": labels[at], "dim": np.full(n, r["dim"]), "chunk": np.full(n, r["chunk"]),
                    "v": pa.array([v[i].tobytes() for i in at], pa.binary())})

    return run


def _gather(key: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
    """A block of anchors of one length and chunk, by place."""
    t = t.sort_by("place")
    own = {n: t[n].to_numpy().astype("<i8").tobytes() for n in ("place", "id", "label")}
    return pa.table({
        "a_block": [key[0].as_py()], "dim": [key[1].as_py()], "chunk": [key[2].as_py()], "n": [len(t)],
        "places": [own["place"]], "a_ids": [own["id"]], "a_labels": [own["label"]], "a_data": [b"".join(t["v"].to_pylist())]})


_ANCHORS = "a_block long, dim long, chunk long, n long, places binary, a_ids binary, a_labels binary, a_data binary"


def _product(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Integer scores of all rows with each other, in doubles where these hold them."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(x).max(initial=0)) * a.shape[1]
    if most < 2.0**53:
        return (a.astype(float) @ x.astype(float).T).astype(np.int64)
    if most >= 2.0**63:
        raise OverflowError("an inner product might not fit into 64 bits")
    return a @ x.T


def _shipped(tile: np.ndarray) -> bytes:
    """A tile in the narrowest integers that hold it, their bytes by significance, compressed."""
    low, high = int(tile.min(initial=0)), int(tile.max(initial=0))
    kind = next(k for k in ("<i2", "<i4", "<i8") if np.iinfo(k).min <= low and high <= np.iinfo(k).max)
    width = int(kind[-1])
    planes = np.ascontiguousarray(tile.astype(kind)).view(np.uint8).reshape(-1, width).T
    return bytes([width]) + pa.compress(np.ascontiguousarray(planes).tobytes(), codec="zstd", asbytes=True)


def _received(data: bytes, rows: int, columns: int) -> np.ndarray:
    width = data[0]
    planes = np.frombuffer(pa.decompress(data[1:], rows * columns * width, codec="zstd", asbytes=True), np.uint8).reshape(width, -1)
    return np.ascontiguousarray(planes.T).view(f"<i{width}").reshape(rows, columns).astype(np.int64)


def _multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial tiles; the ids and labels go with the first chunk's."""
    for b in batches:
        for r in b.to_pylist():
            n, m = r["n"], len(r["ids"]) // 8
            tile = _product(_integers(r["a_data"], n), _integers(r["data"], m))
            first = r["chunk"] == 0
            yield pa.record_batch({
                "a_block": [r["a_block"]], "block": [r["block"]], "chunks": [r["chunks"]], "n": [n], "m": [m], "tile": [_shipped(tile)],
                **{k: pa.array([r[k] if first else None], pa.binary()) for k in ("places", "a_ids", "a_labels", "ids", "labels")}})


_PARTIAL = "a_block long, block long, chunks long, n long, m long, tile binary, places binary, a_ids binary, a_labels binary, ids binary, labels binary"


def best(scores: np.ndarray, allowed: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of each row's ``k`` highest allowed scores, ties to the smaller column."""
    m = scores.shape[1]
    k = min(k, m)
    if int(np.abs(scores).max(initial=0)) < 2**62 // max(m, 1):
        key = np.where(allowed, scores * m + np.arange(m - 1, -1, -1), _LOW)
        top = np.argpartition(key, m - k, axis=1)[:, m - k :]
    else:
        top = np.argsort(np.where(allowed, ~scores, np.iinfo(np.int64).max), axis=1, kind="stable")[:, :k]
    rows, cols = np.repeat(np.arange(len(scores)), k), top.ravel()
    ok = allowed[rows, cols]
    return rows[ok], cols[ok]


def _add(k: int):
    """The whole tile of a pair of blocks, and the heads: each anchor's best ``k`` rows of its label."""

    def run(key: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
        parts = t.to_pylist()
        first = next(r for r in parts if r["ids"] is not None)
        n, m = first["n"], first["m"]
        assert len(parts) == first["chunks"]
        total = np.zeros((n, m), np.int64)
        for r in parts:
            tile = _received(r["tile"], n, m)
            more = total + tile
            if (((total ^ more) & (tile ^ more)) < 0).any():
                raise OverflowError("an inner product does not fit into 64 bits")
            total = more
        f = {x: np.frombuffer(first[x], "<i8") for x in ("places", "a_ids", "a_labels", "ids", "labels")}
        block = key[1].as_py()
        same = f["a_labels"][:, None] == f["labels"][None, :]
        own = (f["places"][:, None] - (block << _ROW_BITS)) == np.arange(m)[None, :]
        at, to = best(total, same & ~own, k)
        return pa.table({
            "a_block": [key[0].as_py()], "block": [block], "n": [n], "m": [m], "tile": [_shipped(total)],
            **{x: [first[x]] for x in ("places", "a_ids", "a_labels", "ids", "labels")},
            "heads": pa.array([[{"place": int(p), "anchor_id": int(a), "vec_id": int(v), "score": int(s)} for p, a, v, s in zip(f["places"][at], f["a_ids"][at], f["ids"][to], total[at, to], strict=True)]],
                              pa.list_(pa.struct([(x, pa.int64()) for x in ("place", "anchor_id", "vec_id", "score")])))})

    return run


_TILE = "a_block long, block long, n long, m long, tile binary, places binary, a_ids binary, a_labels binary, ids binary, labels binary, heads array<struct<place: long, anchor_id: long, vec_id: long, score: long>>"
_FOUND = "place long, anchor_id long, p_rank long, positive_id long, positive_score long, negative_id long, negative_score long"


def _windows(k: int, low: int, high: int):
    """Each tile's first ``k`` rows of another label in the window of each anchor and positive: ``low * p <= 100 * s <= high * p``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                n, m = r["n"], r["m"]
                f = {x: np.frombuffer(r[x], "<i8") for x in ("places", "a_ids", "a_labels", "ids", "labels")}
                tile = _received(r["tile"], n, m)
                other = f["a_labels"][:, None] != f["labels"][None, :]
                ranks = defaultdict(list)
                here = set(f["places"].tolist())  # anchors of another length can share the block's number
                for p in r["positives"]:
                    if p["place"] in here:
                        ranks[p["p_rank"]].append(p)
                for rank, ps in sorted(ranks.items()):
                    at = np.searchsorted(f["places"], [p["place"] for p in ps])  # places rise within a block of anchors
                    least = np.array([-(-low * p["score"] // 100) for p in ps], np.int64)[:, None]
                    most = np.array([high * p["score"] // 100 for p in ps], np.int64)[:, None]
                    s = tile[at]
                    rows, cols = best(s, other[at] & (s >= least) & (s <= most), k)
                    if len(rows):
                        pick = lambda name, rows=rows, ps=ps: np.array([p[name] for p in ps], np.int64)[rows]
                        yield pa.record_batch({
                            "place": pick("place"), "anchor_id": pick("anchor_id"), "p_rank": np.full(len(rows), rank, np.int64), "positive_id": pick("vec_id"), "positive_score": pick("score"),
                            "negative_id": f["ids"][cols], "negative_score": s[rows, cols]})

    return run


def hard_negatives(
    vectors: DataFrame, every: int = 50, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95,
    row_block: int = 4096, anchor_block: int = 256, dim_chunk: int = 32, round_scores: int | None = None, round_bytes: int = 32 << 20,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` of ``vectors``: ``id long, label long, v array<double>``, integer-valued.

    Anchors are rows whose id is divisible by ``every``; a window is ``low`` to ``high`` percent of the positive's score.
    """
    spark = vectors.sparkSession
    small_batches(spark)  # a row is a block
    rows = vectors.select("id", F.col("label").cast("long").alias("label"), "v").where(F.col("id").isNotNull() & F.col("label").isNotNull() & usable(F.col("v")))
    blocks = stage(rows.mapInArrow(_pack(row_block, dim_chunk), _BLOCK), "negatives-rows")
    size = blocks.where("chunk = 0").agg(F.coalesce(F.sum(F.expr("octet_length(ids) div 8")), F.lit(0)), F.coalesce(F.max("dim"), F.lit(1))).first()
    single = blocks.mapInArrow(_anchors(every), "place long, id long, label long, dim long, chunk long, v binary")
    n_anchors = single.where("chunk = 0").count()
    n_blocks = max(1, -(-n_anchors // anchor_block))
    anchors = stage(single.groupBy(F.pmod(F.xxhash64("place"), F.lit(n_blocks)).alias("a_block"), "dim", "chunk").applyInArrow(_gather, _ANCHORS), "negatives-anchors")
    round_scores = round_scores or spark.sparkContext.defaultParallelism << 23
    wide = max(1, min(round_scores // max(1, int(size[0])), round_bytes // (8 * (int(size[1]) + 3))))  # anchors of a round
    per_round = max(1, wide // anchor_block)
    found = []
    for lo in range(0, n_blocks, per_round):
        own = anchors.where(F.col("a_block").between(lo, lo + per_round - 1))
        partial = blocks.join(F.broadcast(own), ["dim", "chunk"]).mapInArrow(_multiply, _PARTIAL)
        tiles = stage(partial.groupBy("a_block", "block").applyInArrow(_add(positives), _TILE), "negatives-tiles")
        by_score = Window.partitionBy("place").orderBy(F.desc("score"), "vec_id")
        heads = tiles.select("a_block", F.inline("heads")).withColumn("p_rank", F.row_number().over(by_score).cast("long")).where(F.col("p_rank") <= positives)
        # A row for each block of anchors, with so many positives of each at most.
        chosen = heads.groupBy("a_block").agg(F.collect_list(F.struct("place", "anchor_id", "p_rank", "vec_id", "score")).alias("positives"))
        near = tiles.drop("heads").join(F.broadcast(chosen), "a_block").mapInArrow(_windows(negatives, low, high), _FOUND)
        first = Window.partitionBy("place", "p_rank").orderBy(F.desc("negative_score"), "negative_id")
        ranked = near.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= negatives)
        found.append(stage(ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"), "negatives-found"))
        drop_staged(tiles)
    drop_staged(blocks, anchors)
    out = found[0]
    for more in found[1:]:
        out = out.union(more)
    return out


OP12_SQL = """
WITH v AS (
  SELECT row_number() OVER () AS row, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.row AS anchor, a.vec_id AS anchor_id, c.row AS row, c.vec_id AS vec_id, a.label = c.label AS same, CAST(list_dot_product(a.e, c.e) AS BIGINT) AS score
  FROM v a JOIN v c ON a.vec_id % 50 = 0 AND a.row <> c.row),
p AS (SELECT *, row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id) AS p_rank FROM s WHERE same QUALIFY p_rank <= 5),
n AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, row_number() OVER (PARTITION BY p.anchor, p.p_rank ORDER BY n.score DESC, n.vec_id) AS rank, n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
  FROM p JOIN s n ON n.anchor = p.anchor AND NOT n.same AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3"""


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    v = F.transform("embedding", lambda x: F.floor(256 * x.cast("double")).cast("double"))
    return hard_negatives(rows.where(usable(F.col("embedding"))).select(F.col("vec_id").alias("id"), label.alias("label"), v.alias("v")))
