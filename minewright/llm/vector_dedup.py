"""Near-duplicate vectors by Euclidean p-stable hashing and exact cosine checks.

Equal vectors are one class with a count.  A class's normalised vector is
projected on Gaussian directions, shifted and quantised; ``hashes`` such numbers
make its bucket in one of ``tables`` tables.  Both follow from the number of
vectors: enough hashes that vectors far apart seldom meet, enough tables that a
pair exactly at the threshold is missed with probability ``miss`` at most.
Vectors that are joined by chains of shared buckets form a family; a family is
compared once, by exact cosines in blocks, dealt out as pairs of chunks.  A
family over ``family_rows`` is compared bucket by bucket instead, in pairs of
chunks too, and a pair that shares several buckets counts in the first one only;
so families and buckets of any size are done whole.  A block gives link counts
and a spanning forest, not its pairs.

Defined cases: vectors that are null, empty, zero, or hold null or non-finite
components link with nothing and are their own component; vectors of different
length never link; repeated rows are vectors of their own that link as copies;
a null vec_id counts as a neighbour but names no component.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from minewright.llm.components import connected_components, with_least
from minewright.llm.topk import usable
from minewright.staging import shuffle_width, stage

#: Quantisation width of a projection of unit vectors.
WIDTH = 2.0


def same_cell(distance: float, width: float = WIDTH) -> float:
    """Probability that two points so far apart fall into one cell of a p-stable hash."""
    t = width / distance
    phi = 0.5 * math.erfc(t / math.sqrt(2))
    return 1 - 2 * phi - 2 / (math.sqrt(2 * math.pi) * t) * (1 - math.exp(-t * t / 2))


def plan_tables(n: int, cosine: float, miss: float = 0.005, strangers: float = 0.001) -> tuple[int, int]:
    """``(hashes, tables)`` for ``n`` vectors: about ``strangers`` orthogonal vectors in a bucket,
    so few that chance does not join families, ``miss`` at the threshold."""
    near = same_cell(math.sqrt(max(2 - 2 * cosine, 1e-9)))
    hashes = max(6, math.ceil(math.log(max(n, 2) / strangers) / -math.log(same_cell(math.sqrt(2)))))
    return hashes, max(1, math.ceil(math.log(miss) / math.log1p(-(near**hashes))))


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _codes(hashes: int, tables: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, tuple] = {}
        mix = np.random.default_rng(seed + 1).integers(0, 2**63, hashes, dtype=np.uint64) | np.uint64(1)
        for batch in batches:
            flat, ids = batch.column(1), batch.column(0)
            width = np.diff(flat.offsets.to_numpy())
            values = flat.values.to_numpy(zero_copy_only=False)
            for d in np.unique(width):
                if d not in planes:
                    rng = np.random.default_rng([seed, int(d)])
                    planes[d] = rng.standard_normal((d, hashes * tables)), rng.uniform(0, WIDTH, hashes * tables)
                at = np.nonzero(width == d)[0]
                for part in np.array_split(at, max(1, len(at) // 2048)):
                    x = _unit(values[flat.offsets.to_numpy()[part][:, None] + np.arange(d)])
                    a, b = planes[d]
                    cell = np.floor((x @ a + b) / WIDTH).astype(np.int64).astype(np.uint64).reshape(len(part), tables, hashes)
                    with np.errstate(over="ignore"):
                        code = (cell * mix).sum(axis=2) + np.uint64(d)
                        code ^= code >> np.uint64(31)
                        code *= np.uint64(0x9E3779B97F4A7C15)
                    yield pa.record_batch([ids.take(pa.array(part)), pa.array(list(code.astype(np.int64)), pa.list_(pa.int64()))], names=["cls", "codes"])

    return run


def _compare(cosine: float):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        """Links within one chunk, or between the two chunks, of a bucket."""
        t, i, j = (int(pdf[c].iloc[0]) for c in ("t", "i", "j"))
        x = _unit(np.stack(pdf["v"].to_numpy()).astype(np.float64))
        ids, n, chunk = pdf["cls"].to_numpy(), pdf["n"].to_numpy(), pdf["chunk"].to_numpy()
        a, b = np.nonzero(chunk == i)[0], np.nonzero(chunk == j)[0]
        link = x[a] @ x[b].T >= cosine
        codes = np.stack(pdf["codes"].to_numpy()) if t >= 0 else None  # t is -1 for a family
        for s in range(t):  # an earlier table has the pair
            link &= (codes[a, s][:, None] != codes[b, s][None, :]) | (codes[a, s] == 0)[:, None]
        link &= ids[a][:, None] != ids[b][None, :]
        links = np.zeros(len(ids), np.int64)
        links[a] += link @ n[b]
        if i != j:
            links[b] += link.T @ n[a]
        root = np.arange(len(ids))

        def find(p: int) -> int:
            while root[p] != p:
                root[p] = root[root[p]]
                p = root[p]
            return p

        for p in range(len(a)):
            for q in np.unique(root[b[link[p]]]):
                x1, x2 = find(a[p]), find(q)
                root[max(x1, x2)] = min(x1, x2)
        tree = np.array([find(p) for p in range(len(ids))], int)
        keep = links > 0
        return pd.DataFrame({"cls": ids[keep], "links": links[keep], "root": ids[tree][keep]})

    return run


def vector_links(vectors: DataFrame, cosine: float = 0.95, miss: float = 0.005, chunk: int = 512, family_rows: int = 8192, seed: int = 7) -> DataFrame:
    """``id, n_links, component_id, kept`` of every row of ``vectors`` (``id long, v array<float or double>``)."""
    spark = vectors.sparkSession
    whole = usable(F.col("v")) & F.exists("v", lambda x: x != 0)
    rows = vectors.select("id", F.when(whole, F.col("v")).alias("v"))
    classes = stage(
        rows.where("v IS NOT NULL").groupBy("v").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("least")).withColumn("cls", F.monotonically_increasing_id()),
        "vector-classes",
    )
    hashes, tables = plan_tables(classes.count(), cosine, miss)
    width = shuffle_width(spark)
    coded = stage(classes.select("cls", F.col("v").cast("array<double>").alias("v")).repartition(width).mapInArrow(_codes(hashes, tables, seed), "cls long, codes array<long>"), "vector-codes")
    spelled = coded.select("cls", F.posexplode("codes").alias("t", "code"))
    # Tables repeat the same buckets; one of each set of members is enough.
    buckets = (
        spelled.groupBy("t", "code").agg(
            F.count(F.lit(1)).alias("size"), F.min("cls").alias("lo"), F.max("cls").alias("hi"),
            F.bit_xor(F.xxhash64("cls")).alias("s1"), F.bit_xor(F.xxhash64("cls", F.lit(1))).alias("s2"),
        )
        .where("size > 1")
        .groupBy("size", "lo", "hi", "s1", "s2").agg(F.min(F.struct("t", "code")).alias("b"))
        .select("b.t", "b.code", "size")
    )
    kept = stage(spelled.join(buckets, ["t", "code"]), "vector-buckets")
    hubs = kept.groupBy("t", "code").agg(F.min("cls").alias("hub"))
    families = stage(connected_components(kept.join(hubs, ["t", "code"]).select(F.col("cls").alias("u"), F.col("hub").alias("v"))), "vector-families")
    small = families.groupBy("component").agg((F.count(F.lit(1)) <= family_rows).alias("small"))
    placed = stage(
        kept.join(families.select(F.col("node").alias("cls"), "component"), "cls").join(small, "component")
        .select("cls", F.when(F.col("small"), -1).otherwise(F.col("t")).alias("t"), F.when(F.col("small"), F.col("component")).otherwise(F.col("code")).alias("code"))
        .distinct(),
        "vector-places",
    )
    # In large families: a class's kept buckets by table, 0 where it has none, which tell in which table a pair meets first.
    own = placed.where("t >= 0").groupBy("cls").agg(F.map_from_entries(F.collect_list(F.struct("t", "code"))).alias("m")).select(
        "cls", F.transform(F.sequence(F.lit(0), F.lit(tables - 1)), lambda t: F.coalesce(F.try_element_at(F.col("m"), t), F.lit(0).cast("long"))).alias("codes"))
    full = classes.select("cls", "n", F.col("v").cast("array<double>").alias("v")).join(own, "cls", "left")
    sizes = placed.groupBy("t", "code").agg(F.expr(f"CAST(ceil(count(1) / {chunk}) AS INT)").alias("chunks"))
    dealt = (
        placed.join(sizes, ["t", "code"])
        .withColumn("chunk", F.pmod(F.xxhash64("cls", "t"), F.col("chunks")).cast("int"))
        .withColumn("other", F.explode(F.expr("sequence(0, chunks - 1)")))
        .select("cls", "t", "code", "chunk", F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j"))
    )
    found = stage(dealt.join(full, "cls").groupBy("t", "code", "i", "j").applyInPandas(_compare(cosine), "cls long, links long, root long"), "vector-links")
    linked = found.groupBy("cls").agg(F.sum("links").alias("links"))
    comps = connected_components(found.select(F.col("cls").alias("u"), F.col("root").alias("v")))
    named = stage(comps.join(classes.select(F.col("cls").alias("node"), F.col("least").alias("own")), "node").select(F.col("node").alias("cls"), "component", "own"), "vector-named")
    least = with_least(named, "component", "own").select("cls", F.col("least").alias("component_id"))
    per_class = (
        classes.join(linked, "cls", "left").join(least, "cls", "left")
        .select("v", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("component_id", "least").alias("component_id"))
    )
    return (
        rows.join(per_class, "v", "left")
        .select("id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), F.coalesce("component_id", "id").alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)))
    )


OP4_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.95),
reach(a, b) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN l ON r.b = l.a)
SELECT e.vec_id, (SELECT count(*) FROM l WHERE l.a = e.vec_id) AS n_links,
       (SELECT min(b) FROM reach r WHERE r.a = e.vec_id) AS component_id,
       e.vec_id = (SELECT min(b) FROM reach r WHERE r.a = e.vec_id) AS kept
FROM embeddings e"""


def op4_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select(F.col("vec_id").alias("id"), F.col("embedding").alias("v"))
    return vector_links(rows, cosine=0.95).withColumnRenamed("id", "vec_id")
