"""Exact top-k inner-product search by a three-phase uniform threshold.

The vector's components are dealt to ``lists`` lists.  A task holds one list's
components of a block of candidates and sees only local scores; a candidate's
score is the sum over the lists.

1. Every list gives each query its best ``depth * k`` local scores.  The
   candidates met there are scored exactly, and the k-th best score of a query is
   a cutoff below which no answer can lie; the deeper the lists are read, the
   higher it is and the less is collected.
2. The cutoff goes back to the lists with the queries.  A candidate that stays
   under ``cutoff / lists`` in every list can't reach it, so each list collects
   only entries at or over that uniform threshold; nothing else leaves a list.
3. What a collected candidate scores in the lists that did not collect it is
   looked up there, for these candidates alone, and the sums are ranked.

Candidates stay in their blocks; blocks of queries come to them, ``group_bytes``
of queries at a time, which bounds what is broadcast.  What is shuffled are
entries of (query, candidate), and once for a group of queries the candidate
blocks that phase 3 looks up.

Defined cases: vectors that are null, empty, or hold null or non-finite
components take no part, on either side; vectors of another length than the
query's are no candidates; a null id takes no part; every row counts, however
often it is there.  Queries named by a condition are rows of the table itself:
each has a list of its own, and its candidates are all rows but itself, those of
its id and its copies too.  Queries from another table share a list by their id,
and rows of that id are no candidates.  Ties go to the smaller vec_id; a score
beyond 64 bits raises an error instead of wrapping.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from minewright.staging import drop_staged, small_batches, stage


def usable(vector: Column) -> Column:
    """Not null, not empty, all components there and finite."""
    return vector.isNotNull() & (F.size(vector) > 0) & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))


def pack_blocks(vectors: DataFrame, per_block: int, lists: int, n_rows: int) -> DataFrame:
    """``block, dim, list, ids binary, rows binary, data binary`` of ``id, row, v``: each list's components of about ``per_block`` vectors of one length.

    ``row`` is what tells a query from its candidates; without it the id does.
    """
    n_blocks = max(1, -(-n_rows // per_block))
    keyed = vectors.select("id", (F.col("row") if "row" in vectors.columns else F.col("id")).alias("row"), "v").withColumn("block", F.pmod(F.xxhash64("id", "row"), F.lit(n_blocks)))

    def pack(key: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
        block, dim = key[0].as_py(), key[1].as_py()
        order = np.argsort(t["id"].to_numpy(), kind="stable")
        flat = t["v"].combine_chunks()
        x = flat.values.to_numpy(zero_copy_only=False)[flat.offsets[0].as_py() :].reshape(len(order), dim)[order].astype("<f8")
        ids, rows = (t[name].to_numpy()[order].astype("<i8").tobytes() for name in ("id", "row"))
        parts = [g for g in np.array_split(np.arange(dim), lists) if len(g)]
        n = len(parts)
        return pa.table({
            "block": pa.array([block] * n, pa.int64()), "dim": pa.array([dim] * n, pa.int64()), "list": pa.array(range(n), pa.int32()), "lists": pa.array([n] * n, pa.int32()),
            "ids": pa.array([ids] * n, pa.binary()), "rows": pa.array([rows] * n, pa.binary()), "data": pa.array([np.ascontiguousarray(x[:, g]).tobytes() for g in parts], pa.binary()),
        })

    return keyed.withColumn("dim", F.size("v").cast("long")).groupBy("block", "dim").applyInArrow(pack, "block long, dim long, list int, lists int, ids binary, rows binary, data binary")


def _local(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Local scores of integer-valued rows; exact, or an error where 64 bits do not hold them."""
    if float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0)) * q.shape[1] < 2.0**53:
        return q @ c.T
    whole = np.vectorize(int, otypes=[object])  # Python's integers
    exact = whole(q) @ whole(c).T
    if max(abs(int(v)) for v in exact.ravel()) >= 2**63:
        raise OverflowError("an inner product does not fit into 64 bits")
    return exact.astype(np.int64)


#: A row's place: its block and its number there.
_BLOCK_BITS = 32
_ENTRY = pa.schema([("q", pa.int64()), ("c", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("list", pa.int32()), ("lists", pa.int32()), ("local", pa.int64())])
_ENTRY_DDL = "q long, c long, query_id long, vec_id long, list int, lists int, local long"


def _meetings(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[tuple]:
    """A list's local scores of some queries and a block of candidates, a query's own row out of the way."""
    for batch in batches:
        for i in range(batch.num_rows):
            r = {n: batch.column(n)[i] for n in batch.schema.names}
            r = {n: np.frombuffer(x.as_buffer(), "<i8" if n in ("ids", "q_ids", "rows", "q_rows", "cutoffs") else "<f8") if isinstance(x, pa.BinaryScalar) and x.is_valid else x.as_py() for n, x in r.items()}
            qi, ci = r["q_ids"], r["ids"]
            q, c = r["q_data"].reshape(len(qi), -1), r["data"].reshape(len(ci), -1)
            for a in range(0, len(qi), rows):
                own = r["q_rows"][a : a + rows, None] == r["rows"][None, :]
                yield r, a, own, _local(q[a : a + rows], c)


def _batch(r: dict, a: int, at: np.ndarray, to: np.ndarray, local: np.ndarray) -> pa.RecordBatch:
    n = len(at)
    place = (r["q_block"] << _BLOCK_BITS) + a + at, (r["block"] << _BLOCK_BITS) + to
    columns = [*place, r["q_ids"][a + at], r["ids"][to], np.full(n, r["list"]), np.full(n, r["lists"]), local]
    return pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)).cast(f.type) for x, f in zip(columns, _ENTRY, strict=True)], schema=_ENTRY)


def _heads(k: int):
    """Phase 1: of each list and block the best ``k`` local entries of each query."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r, a, own, local in _meetings(batches):
            n = min(k, local.shape[1])
            low = np.where(own, np.iinfo(np.int64).min if local.dtype == np.int64 else -np.inf, local)
            top = np.argpartition(low, local.shape[1] - n, axis=1)[:, local.shape[1] - n :]
            at, to = np.repeat(np.arange(len(top)), n), top.ravel()
            keep = ~own[at, to]
            yield _batch(r, a, at[keep], to[keep], local[at[keep], to[keep]])

    return run


def _collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Phase 2: entries at or over ``cutoff / lists``; all entries of a query without a cutoff."""
    for r, a, own, local in _meetings(batches):
        if r["cutoffs"] is None:
            over = ~own
        else:
            cutoff = r["cutoffs"][a : a + len(own)]
            least = -(-cutoff // r["lists"])  # of integers, so that nothing is rounded away
            over = ((local >= least[:, None]) | (cutoff == _NO_CUTOFF)[:, None]) & ~own
        at, to = np.nonzero(over)
        yield _batch(r, a, at, to, local[at, to])


_NO_CUTOFF = -(2**62)


def _look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Phase 3: local scores of given pairs in one list."""
    for batch in batches:
        for i in range(batch.num_rows):
            r = {n: batch.column(n)[i].as_py() for n in batch.schema.names}
            qi, ci = np.frombuffer(r["q_ids"], "<i8"), np.frombuffer(r["ids"], "<i8")
            q, c = np.frombuffer(r["q_data"], "<f8").reshape(len(qi), -1), np.frombuffer(r["data"], "<f8").reshape(len(ci), -1)
            at, to = (np.array(r[n], np.int64) & (2**_BLOCK_BITS - 1) for n in ("qs", "cs"))
            for s in range(0, len(at), 1 << 16):
                x, y = q[at[s : s + (1 << 16)]], c[to[s : s + (1 << 16)]]
                if float(np.abs(x).max()) * float(np.abs(y).max()) * x.shape[1] < 2.0**53:
                    local = (x * y).sum(axis=1)
                else:
                    local = np.array([int(_local(u[None], v[None])[0, 0]) for u, v in zip(x, y, strict=True)], np.int64)
                yield _batch({"q_block": r["q_block"], "block": r["block"], "q_ids": qi, "ids": ci, "list": r["list"], "lists": r["lists"]}, 0, at[s : s + (1 << 16)], to[s : s + (1 << 16)], local)


def _resolve(pairs: DataFrame, candidates: DataFrame, queries: DataFrame, bounded: bool) -> DataFrame:
    """Entries of ``pairs`` (``q, c, list, dim``), looked up in the lists they name; ``bounded`` pairs are broadcast to the blocks."""
    asked = pairs.groupBy(F.shiftright("c", _BLOCK_BITS).alias("block"), F.shiftright("q", _BLOCK_BITS).alias("q_block"), "list", F.pmod("q", F.lit(64)).alias("part")).agg(
        F.collect_list(F.struct("q", "c")).alias("pairs")).select("block", "q_block", "list", F.col("pairs.q").alias("qs"), F.col("pairs.c").alias("cs"))
    asked = F.broadcast(asked) if bounded else asked
    met = candidates.join(asked, ["block", "list"])
    return met.join(F.broadcast(queries), ["dim", "list", "q_block"]).select("q_block", "block", "list", "lists", "ids", "data", "q_ids", "q_data", "qs", "cs").mapInArrow(_look_up, _ENTRY_DDL)


def _meet(candidates: DataFrame, queries: DataFrame) -> DataFrame:
    """Each block of a list beside the queries' blocks of that list; the candidates stay where they are."""
    return candidates.join(F.broadcast(queries), ["dim", "list"])


def cutoffs(candidates: DataFrame, queries: DataFrame, k: int, depth: int = 16) -> DataFrame:
    """``q, cutoff`` of queries for which ``k`` candidates were met at the heads of the lists."""
    heads = _meet(candidates, queries).mapInArrow(_heads(k * depth), _ENTRY_DDL)
    local = Window.partitionBy("q", "list").orderBy(F.desc("local"), "c")
    met = heads.withColumn("n", F.row_number().over(local)).where(F.col("n") <= k * depth).select("q", "c", "lists").distinct()
    every = met.select("q", "c", F.explode(F.sequence(F.lit(0), F.col("lists") - 1)).alias("list"))
    # k * depth * lists candidates of each query at most: a group's queries are as many as keep that under group_bytes.
    exact = _resolve(every, candidates, queries, bounded=True).groupBy("q", "c").agg(F.sum("local").alias("score"))
    return exact.withColumn("n", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score")))).where(F.col("n") == k).select("q", F.col("score").alias("cutoff"))


def _carry(queries: DataFrame, known: DataFrame) -> DataFrame:
    """Query blocks with a cutoff for each of their rows."""
    spelled = known.groupBy(F.shiftright("q", _BLOCK_BITS).alias("q_block")).agg(F.collect_list(F.struct("q", "cutoff")).alias("known"))  # of one block

    def carry(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.select(["q_ids", "known"]).to_pylist():
                own = np.full(len(r["q_ids"]) // 8, _NO_CUTOFF, "<i8")
                for x in r["known"] or []:
                    own[x["q"] & (2**_BLOCK_BITS - 1)] = x["cutoff"]
                out.append(own.tobytes())
            names = ["dim", "list", "q_block", "q_ids", "q_rows", "q_data"]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(out, pa.binary())], names=[*names, "cutoffs"])

    return queries.join(spelled, "q_block", "left").mapInArrow(carry, "dim long, list int, q_block long, q_ids binary, q_rows binary, q_data binary, cutoffs binary")


def collect_entries(candidates: DataFrame, queries: DataFrame, known: DataFrame) -> DataFrame:
    """Phase 2: what the lists give up for queries with their cutoffs."""
    return _meet(candidates, _carry(queries, known)).mapInArrow(_collect, _ENTRY_DDL)


def topk_search(
    vectors: DataFrame, queries: DataFrame | Column, k: int = 5, lists: int = 2,
    query_block: int = 2048, candidate_block: int = 4096, group_bytes: int = 32 << 20, depth: int = 16,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's k greatest inner products among ``vectors`` but itself.

    Frames have ``id long, v array<double>`` with integer-valued components; a column chooses queries among ``vectors``.
    """
    small_batches(vectors.sparkSession)  # a row is a block
    live = F.col("id").isNotNull() & usable(F.col("v"))
    vectors, numbered, key = vectors.where(live), None, "query_id"
    if isinstance(queries, Column):
        # Written once, so that a row's number is the same on both sides.
        numbered, key = stage(vectors.select("id", "v", queries.alias("asked")).withColumn("row", F.monotonically_increasing_id()), "topk-rows"), "q"
        vectors, queries = numbered.select("id", "v", "row"), numbered.where("asked").select("id", "v", "row")
    queries = queries.where(live)
    n_c, width = vectors.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("v")), F.lit(1))).first()
    n_q = queries.count()
    fits = lambda rows: max(1, min(rows, group_bytes // (8 * width)))
    c = stage(pack_blocks(vectors, fits(candidate_block), lists, n_c), "topk-candidates")
    q = stage(pack_blocks(queries, fits(query_block), lists, n_q).select("dim", "list", F.col("block").alias("q_block"), F.col("ids").alias("q_ids"), F.col("rows").alias("q_rows"), F.col("data").alias("q_data")), "topk-queries")
    if numbered is not None:
        drop_staged(numbered)
    per_group = max(1, group_bytes // (max(8 * width, 16 * k * depth * lists) * fits(query_block)))
    found = []
    for group in range(-(-max(1, -(-n_q // fits(query_block))) // per_group)):
        own = q.where(F.expr(f"q_block div {per_group} = {group}"))
        known = stage(cutoffs(c, own, k, depth), "topk-cutoffs")
        entries = stage(collect_entries(c, own, known), "topk-entries")
        seen = entries.groupBy("q", "c", "query_id", "vec_id", "lists").agg(F.sum("local").alias("sum"), F.bit_or(F.expr("shiftleft(1L, list)")).alias("seen"))
        done = seen.where("bit_count(seen) = lists").select("q", "query_id", "vec_id", F.col("sum").alias("score"))
        open_ = seen.where("bit_count(seen) < lists")
        asked = open_.select("q", "c", F.explode(F.expr("filter(sequence(0, lists - 1), l -> (seen & shiftleft(1L, l)) = 0)")).alias("list"))
        rest = _resolve(asked, c, own, bounded=False).select("q", "c", "query_id", "vec_id", "local")
        whole = rest.union(open_.select("q", "c", "query_id", "vec_id", F.col("sum").alias("local"))).groupBy("q", "c", "query_id", "vec_id").agg(F.sum("local").alias("score"))
        scores = done.union(whole.select("q", "query_id", "vec_id", "score")).join(known, "q", "left").where("cutoff IS NULL OR score >= cutoff")
        by_score = Window.partitionBy(key).orderBy(F.desc("score"), "vec_id")
        ranked = scores.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= k)
        found.append(stage(ranked.select("q", "query_id", "vec_id", "score"), "topk-found"))
        drop_staged(entries, known)
    drop_staged(c, q)
    both = found[0]
    for more in found[1:]:
        both = both.union(more)
    # Rows of one query id can lie in different groups.
    by_score = Window.partitionBy(key).orderBy(F.desc("score"), "vec_id")
    return both.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


OP2_SQL = """
WITH v AS (
  SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.row AS own, q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.row <> c.row),
r AS (SELECT *, row_number() OVER (PARTITION BY own ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5"""


def op2_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding").where(usable(F.col("embedding")))
    v = rows.select(F.col("vec_id").alias("id"), F.transform("embedding", lambda x: F.floor(256 * x.cast("double")).cast("double")).alias("v"))
    return topk_search(v, F.col("id") % 50 == 0, k=5)
