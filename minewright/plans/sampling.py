"""Queries of samples, splits, batches and response filters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from minewright.operators import filters as R
from minewright.operators import sampling as P
from minewright.plans.catalog import query
from minewright.staging import table


@query("sample_first", "SELECT doc_id, lang FROM documents ORDER BY doc_id LIMIT 20")
def sample_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.sample(table(spark, sf_dir, "documents").select("doc_id", "lang"), "first:20", "doc_id")


@query("sample_end", "SELECT doc_id, lang FROM documents ORDER BY doc_id DESC LIMIT (SELECT CAST(ceil(count(*) * 0.03) AS BIGINT) FROM documents)")
def sample_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.sample(table(spark, sf_dir, "documents").select("doc_id", "lang"), "end:3%", "doc_id")


@query("sample_hash", "SELECT doc_id, lang FROM documents ORDER BY md5(doc_id || ':3'), doc_id LIMIT 50")
def sample_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.sample(table(spark, sf_dir, "documents").select("doc_id", "lang"), "random:50", "doc_id", seed=3)


@query("mixture", """
SELECT doc_id AS id, lang, CAST(NULL AS VARCHAR) AS role FROM (SELECT * FROM documents ORDER BY doc_id LIMIT 10) UNION ALL
SELECT conv_id, NULL, role FROM (SELECT * FROM (SELECT conv_id, min(role) AS role FROM conversations GROUP BY 1) c ORDER BY conv_id DESC LIMIT 5)""")
def mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "lang")
    talk = table(spark, sf_dir, "conversations").groupBy(F.col("conv_id").alias("id")).agg(F.min("role").alias("role"))
    return P.mixture([(docs, "first:10"), (talk, "end:5")], "id")


@query("top_n_per_group", "SELECT source, doc_id, n_chars, rank FROM (SELECT *, CAST(row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id) AS INTEGER) AS rank FROM documents) x WHERE rank <= 5")
def top_n_per_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("source", "doc_id", "n_chars")
    return P.top_per_group(docs, ["source"], [F.desc("n_chars"), F.col("doc_id")], 5)


@query("ntile_split", "SELECT lang, doc_id, CAST(ntile(4) OVER (PARTITION BY lang ORDER BY doc_id) AS INTEGER) AS part FROM documents")
def ntile_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.ntile(table(spark, sf_dir, "documents").select("lang", "doc_id"), ["lang"], ["doc_id"], 4, "part")


@query("shard_round_robin", "SELECT doc_id, CAST((row_number() OVER (ORDER BY doc_id) - 1) % 8 AS BIGINT) AS shard FROM documents")
def shard_round_robin(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Round-robin shards by global rank, from a range sort and partition offsets."""
    return P.ranked(table(spark, sf_dir, "documents").select("doc_id"), [F.col("doc_id")]).select("doc_id", ((F.col("_rank") - 1) % 8).alias("shard"))


@query("request_repeats", "SELECT conv_id, turn, CAST(unnest(range(1, 4)) AS INTEGER) AS repeat FROM conversations WHERE role = 'user'")
def request_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").where("role = 'user'").select("conv_id", "turn", F.explode(F.sequence(F.lit(1), F.lit(3))).alias("repeat"))


@query("modality_lengths", r"""
SELECT conv_id, CAST(CASE WHEN conv_id % 3 = 0 THEN w + 128 ELSE -w END AS INTEGER) AS length FROM (
  SELECT conv_id, sum(len(list_filter(string_split_regex(trim(text), '\s+'), lambda x: x <> ''))) AS w FROM conversations GROUP BY conv_id) t""")
def modality_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of a conversation, with the image's share; negative for text alone."""
    talk = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.collect_list("text").alias("turns"))
    return talk.select("conv_id", P.word_length(F.col("turns"), F.col("conv_id") % 3 == 0).alias("length"))


@query("length_batches")
def length_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    lengths = modality_lengths(spark, sf_dir).withColumn("length", F.abs("length"))
    return P.length_batches(lengths, "conv_id", "length", batch=4, world=4, seed=1)


@query("kcenter_select")
def kcenter_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.kcenter(table(spark, sf_dir, "embeddings"), 12)


@query("token_windows", """
WITH t AS (SELECT l_orderkey, list(l_partkey ORDER BY l_linenumber, l_partkey) AS k FROM lineitem GROUP BY 1), s AS (SELECT *, unnest(range(0, len(k), 3)) AS s FROM t)
SELECT l_orderkey, CAST(s AS INTEGER) AS start, k[s + 1:s + 3] AS tokens FROM s""")
def token_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.transform(F.sort_array(F.collect_list(F.struct("l_linenumber", "l_partkey"))), lambda x: x["l_partkey"]).alias("k"))
    return t.select("l_orderkey", F.explode(P.windows(F.col("k"), 3)).alias("w")).select("l_orderkey", "w.start", "w.tokens")


@query("size_buckets", "SELECT source, doc_id, CAST(floor((sum(n_chars) OVER (PARTITION BY source ORDER BY doc_id) - n_chars) / 20000) AS BIGINT) AS bucket FROM documents")
def size_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("source", "doc_id", "n_chars")
    return P.running_buckets(docs, ["source"], "doc_id", "n_chars", 20000).select("source", "doc_id", "bucket")


_ALL_RESPS = "SELECT user_id, list(event_type ORDER BY event_id) AS resps, list(props ORDER BY event_id) AS props FROM events GROUP BY user_id"


def _all_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The responses of all events."""
    rows = table(spark, sf_dir, "events").groupBy("user_id").agg(F.sort_array(F.collect_list(F.struct("event_id", "event_type", "props"))).alias("r"))
    return rows.select("user_id", F.transform("r", lambda x: x["event_type"]).alias("resps"), F.transform("r", lambda x: x["props"]).alias("props"))


@query("filter_regex_all", rf"""
SELECT user_id, list_transform(props, lambda x: CASE WHEN len(regexp_extract_all(x, '"k": ([0-9]+)', 1)) > 0 THEN trim(regexp_extract_all(x, '"k": ([0-9]+)', 1)[1]) ELSE '[invalid]' END) AS numbers FROM ({_ALL_RESPS}) r""")
def filter_regex_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _all_responses(spark, sf_dir).select("user_id", R.regex('"k": ([0-9]+)')(F.col("props")).alias("numbers"))


@query("filter_chain_all", f"SELECT user_id, list_transform(resps[1:2], lambda x: coalesce(CASE upper(x) WHEN 'CLICK' THEN 'A' WHEN 'VIEW' THEN 'B' END, 'Z')) AS kept FROM ({_ALL_RESPS}) r")
def filter_chain_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    steps = [("take_first_k", {"k": 2}), ("uppercase", {}), ("map", {"table": {"CLICK": "A", "VIEW": "B"}, "default": "Z"})]
    return R.filtered(_all_responses(spark, sf_dir), {"chain": steps}).select("user_id", F.col("filtered_resps")["chain"].alias("kept"))


@query("majority_vote_all", f"""
WITH v AS (SELECT user_id, unnest(resps) AS x, unnest(range(1, len(resps) + 1)) AS i FROM ({_ALL_RESPS}) r), c AS (SELECT user_id, x, count(*) AS n, min(i) AS first FROM v GROUP BY 1, 2)
SELECT user_id, x AS vote FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY n DESC, first) AS k FROM c) y WHERE k = 1""")
def majority_vote_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _all_responses(spark, sf_dir).select("user_id", R.majority_vote()(F.col("resps"))[0].alias("vote"))
