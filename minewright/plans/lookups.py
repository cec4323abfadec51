"""Queries of semi-joins, retrieval, spans, buckets, islands and rates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from minewright.functions import spans
from minewright.functions.text import words
from minewright.operators import retrieval
from minewright.plans.catalog import query
from minewright.staging import table


@query("id_filter", "SELECT doc_id, lang FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)")
def id_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "lang").join(table(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_semi")


@query("acc_all", """
WITH g AS (SELECT l_orderkey, l_returnflag, bool_and(l_quantity > 10) AS ok FROM lineitem GROUP BY 1, 2)
SELECT l_returnflag, avg(CASE WHEN ok THEN 1.0 ELSE 0.0 END) AS acc_all, stddev_samp(CASE WHEN ok THEN 1.0 ELSE 0.0 END) / sqrt(count(*)) AS stderr FROM g GROUP BY 1""")
def acc_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of questions whose answers are all right."""
    g = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_returnflag").agg(F.bool_and(F.col("l_quantity") > 10).alias("ok"))
    ok = F.col("ok").cast("double")
    return g.groupBy("l_returnflag").agg(F.avg(ok).alias("acc_all"), (F.stddev_samp(ok) / F.sqrt(F.count(ok))).alias("stderr"))


@query("macro_summary", """
WITH t AS (SELECT o_custkey, o_orderpriority <> '5-LOW' AS core, avg(o_totalprice) AS score FROM orders GROUP BY 1, 2), s AS (SELECT core, avg(score) AS macro, count(*) AS tasks FROM t GROUP BY core)
SELECT max(macro) FILTER (core) AS core_macro, max(macro) FILTER (NOT core) AS open_macro, sum(macro * tasks) / sum(tasks) AS overall FROM s""")
def macro_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Macro scores of two kinds of tasks, and their mean weighted by tasks."""
    t = table(spark, sf_dir, "orders").groupBy("o_custkey", (F.col("o_orderpriority") != "5-LOW").alias("core")).agg(F.avg("o_totalprice").alias("score"))
    s = t.groupBy("core").agg(F.avg("score").alias("macro"), F.count(F.lit(1)).alias("tasks"))
    pick = lambda x: F.max(F.when(F.col("core") == x, F.col("macro")))
    return s.agg(pick(True).alias("core_macro"), pick(False).alias("open_macro"), (F.sum(F.col("macro") * F.col("tasks")) / F.sum("tasks")).alias("overall"))


@query("bucket_means", """
WITH m(p, bucket, lang) AS (VALUES ('1-URGENT', 'ocr', 'en'), ('2-HIGH', 'ocr', 'en'), ('3-MEDIUM', 'math', 'en'), ('4-NOT SPECIFIED', 'math', 'cn'), ('5-LOW', 'ocr', 'cn')),
b AS (SELECT lang, bucket, avg(o_totalprice) AS score FROM orders JOIN m ON p = o_orderpriority GROUP BY 1, 2) SELECT lang, avg(score) AS score, count(*) AS buckets FROM b GROUP BY lang""")
def bucket_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Question types mapped to buckets: the mean of the buckets' means per language."""
    kinds = [("1-URGENT", "ocr", "en"), ("2-HIGH", "ocr", "en"), ("3-MEDIUM", "math", "en"), ("4-NOT SPECIFIED", "math", "cn"), ("5-LOW", "ocr", "cn")]
    m = spark.createDataFrame(kinds, "o_orderpriority string, bucket string, lang string")
    b = table(spark, sf_dir, "orders").join(F.broadcast(m), "o_orderpriority").groupBy("lang", "bucket").agg(F.avg("o_totalprice").alias("score"))
    return b.groupBy("lang").agg(F.avg("score").alias("score"), F.count(F.lit(1)).alias("buckets"))


@query("passage_retrieval", r"""
WITH w AS (SELECT doc_id, list_filter(string_split_regex(trim(text), '\s+'), lambda x: x <> '') AS w FROM documents WHERE text IS NOT NULL),
p AS (SELECT doc_id, unnest(range(0, len(w), 50)) AS pos, w FROM w WHERE len(w) > 0), c AS (SELECT doc_id, CAST(floor(pos / 50) AS INTEGER) AS place, w[pos + 1:pos + 50] AS q, len(list_filter(w[pos + 1:pos + 50], lambda x: x IN ('the', 'la', 'die', 'el'))) AS s FROM p),
r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY s DESC, place) AS n FROM c)
SELECT doc_id, string_agg(array_to_string(q, ' '), chr(10) ORDER BY n) AS context FROM r WHERE n <= 2 GROUP BY doc_id""")
def passage_retrieval(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The two passages of a document that hold most of a question's words, here articles; a model's score would be such a column."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    asked = F.array(*[F.lit(x) for x in ("the", "la", "die", "el")])
    score = F.size(F.filter(words(F.col("passage")), lambda x: F.array_contains(asked, x)))
    return retrieval.best_passages(retrieval.passages(docs, "doc_id", "text", 50), "doc_id", score, 2)


@query("time_spans", """
SELECT o_orderkey, CAST(least(o_custkey, o_orderkey % 100) AS DOUBLE) AS start, CAST(greatest(o_custkey, o_orderkey % 100) AS DOUBLE) AS stop FROM orders""")
def time_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    reply = F.concat(F.lit("It happens from "), F.col("o_custkey").cast("string"), F.lit(" to "), (F.col("o_orderkey") % 100).cast("string"), F.lit(" seconds."))
    s = table(spark, sf_dir, "orders").select("o_orderkey", spans.time_span(reply).alias("s"))
    return s.select("o_orderkey", F.col("s")[0].alias("start"), F.col("s")[1].alias("stop"))


@query("transcript_cleanup", r"""
SELECT conv_id, turn, trim(regexp_replace(regexp_replace(regexp_replace('<|en|>' || text || ' .', '<\|[^|]*\|>', ' ', 'g'), '\s+([,.?!;:])', '\1', 'g'), '\s+', ' ', 'g')) AS text FROM conversations""")
def transcript_cleanup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", spans.clean_transcript(F.concat(F.lit("<|en|>"), "text", F.lit(" ."))).alias("text"))


@query("text_islands", """
WITH c AS (SELECT *, CASE WHEN role = lag(role) OVER w THEN 0 ELSE 1 END AS new FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)),
i AS (SELECT *, sum(new) OVER (PARTITION BY conv_id ORDER BY turn, role, text ROWS UNBOUNDED PRECEDING) AS island FROM c)
SELECT conv_id, CAST(island AS BIGINT) AS island, any_value(role) AS role, string_agg(text, ' ' ORDER BY turn, text) AS text FROM i GROUP BY conv_id, island""")
def text_islands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Neighbouring turns of one role joined by a space."""
    w = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    new = F.when(F.col("role") == F.lag("role").over(w), 0).otherwise(1)
    rows = table(spark, sf_dir, "conversations").withColumn("new", new).withColumn("island", F.sum("new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    ordered = F.sort_array(F.collect_list(F.struct("turn", "text")))
    return rows.groupBy("conv_id", "island").agg(F.first("role").alias("role"), F.array_join(F.transform(ordered, lambda x: x["text"]), " ").alias("text"))


@query("call_rates", """
SELECT event_id, user_id, count(*) OVER (PARTITION BY user_id ORDER BY epoch(ts) RANGE BETWEEN 3600 PRECEDING AND CURRENT ROW) AS last_hour FROM events""")
def call_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calls of a user in the hour before each."""
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    w = Window.partitionBy("user_id").orderBy("at").rangeBetween(-3_600_000_000, 0)
    return table(spark, sf_dir, "events").withColumn("at", at).select("event_id", "user_id", F.count(F.lit(1)).over(w).alias("last_hour"))
