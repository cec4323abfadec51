"""Queries of lookup joins, upserts and diffs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from minewright.operators import joins as J
from minewright.plans.catalog import query
from minewright.staging import table


@query("lookup_last_wins", """
WITH r AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS n FROM orders WHERE o_custkey IS NOT NULL)
SELECT c_custkey, c_name, o_orderkey AS last_order, o_totalprice AS last_price FROM customer LEFT JOIN r ON o_custkey = c_custkey AND n = 1""")
def lookup_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    found = J.lookup(table(spark, sf_dir, "customer").select("c_custkey", "c_name"), orders, "c_custkey", "o_custkey", ["o_orderkey"])
    return found.select("c_custkey", "c_name", F.col("o_orderkey").alias("last_order"), F.col("o_totalprice").alias("last_price"))


_SUFFIX = J.CONCLUDE


@query("alignment_outcome", f"""
WITH a AS (SELECT d.doc_id, CASE WHEN d.doc_id % 7 <> 0 THEN d.doc_id END AS k, 'Q' || d.doc_id AS q, d.lang AS ans,
                  CASE WHEN l.doc_id IS NOT NULL THEN CASE WHEN l.quality = 0 THEN 'Not Found' ELSE d.source END END AS ref, l.toxic = 0 AS ok
           FROM documents d LEFT JOIN labels l ON l.doc_id = CASE WHEN d.doc_id % 7 <> 0 THEN d.doc_id END),
o AS (SELECT *, CASE WHEN k IS NULL THEN 'no_key' WHEN ref IS NULL THEN 'no_match' WHEN lower(trim(ref)) = 'not found' THEN 'not_found' WHEN coalesce(ok, false) THEN 'aligned' ELSE 'not_aligned' END AS outcome FROM a)
SELECT doc_id, outcome, CASE outcome WHEN 'aligned' THEN 'true' WHEN 'not_aligned' THEN 'false' END AS is_aligned,
  CASE WHEN outcome = 'not_aligned' THEN q ELSE q || '{_SUFFIX}' END AS final_question, CASE WHEN outcome = 'not_aligned' THEN ref ELSE ans END AS final_answer FROM o""")
def alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source").withColumn("k", F.when(F.col("doc_id") % 7 != 0, F.col("doc_id")))
    labels = table(spark, sf_dir, "labels").withColumnRenamed("doc_id", "idx")
    rows = J.lookup(docs, labels, "k", "idx", ["quality"])
    reference = F.when(F.col("idx").isNotNull(), F.when(F.col("quality") == 0, "Not Found").otherwise(F.col("source")))
    out = J.alignment_outcome(rows, F.col("k"), F.concat(F.lit("Q"), "doc_id"), F.col("lang"), reference, F.col("toxic") == 0)
    return out.select("doc_id", "outcome", F.col("is_aligned").cast("string").alias("is_aligned"), "final_question", "final_answer")


@query("grouped_requests", "SELECT conv_id, list(role ORDER BY turn, role, text) AS roles, count(*) AS n, CAST(sum(length(text)) AS BIGINT) AS chars FROM conversations GROUP BY conv_id")
def grouped_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    grouped = J.grouped_requests(table(spark, sf_dir, "conversations"), "conv_id", "turn", ["role", "text"])
    chars = F.aggregate("requests", F.lit(0).cast("long"), lambda a, r: a + F.length(r["text"]))
    return grouped.select("conv_id", F.transform("requests", lambda r: r["role"]).alias("roles"), "n", chars.alias("chars"))


@query("merge_priority", """
WITH u AS (SELECT o_custkey AS k, o_orderkey AS seq, o_totalprice AS v, false AS judged FROM orders WHERE o_orderkey % 2 = 0 UNION ALL SELECT o_custkey, o_orderkey, o_totalprice, o_orderstatus = 'F' FROM orders WHERE o_orderkey % 2 = 1)
SELECT k, seq, v, judged FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY judged DESC, seq DESC) AS n FROM u WHERE k IS NOT NULL) x WHERE n = 1""")
def merge_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A new result replaces an old one if it is judged, or later of the same kind."""
    orders = table(spark, sf_dir, "orders")
    rows = lambda o, judged: o.select(F.col("o_custkey").alias("k"), F.col("o_orderkey").alias("seq"), F.col("o_totalprice").alias("v"), judged.alias("judged"))
    return J.upsert(rows(orders.where("o_orderkey % 2 = 0"), F.lit(False)), rows(orders.where("o_orderkey % 2 = 1"), F.col("o_orderstatus") == "F"), ["k"], "judged", "seq")


@query("leaderboard_last", "SELECT event_type AS model, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) AS n FROM events) x WHERE n = 1")
def leaderboard_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select(F.col("event_type").alias("model"), "event_id", "ts", "value")
    return J.last_by_key(rows, ["model"], [F.col("ts").desc(), F.col("event_id").desc()]).drop("ts")


@query("regression_diff", """
WITH a AS (SELECT l_returnflag AS task, l_linestatus AS model, avg(l_discount) AS score FROM lineitem WHERE l_orderkey % 2 = 0 GROUP BY 1, 2),
b AS (SELECT l_returnflag AS task, l_linestatus AS model, avg(l_discount) AS score FROM lineitem WHERE l_orderkey % 2 = 1 GROUP BY 1, 2)
SELECT task, model, a.score AS before, b.score AS after, b.score - a.score AS change FROM a JOIN b USING (task, model)""")
def regression_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs side by side by task and model."""
    lines = table(spark, sf_dir, "lineitem")
    run = lambda r, name: lines.where(F.col("l_orderkey") % 2 == r).groupBy(F.col("l_returnflag").alias("task"), F.col("l_linestatus").alias("model")).agg(F.avg("l_discount").alias(name))
    return run(0, "before").join(run(1, "after"), ["task", "model"]).withColumn("change", F.col("after") - F.col("before"))


@query("incremental_changes", """
SELECT doc_id, lang, source FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND (CASE WHEN l.toxic = 1 THEN 'xx' ELSE d.lang END) = d.lang)""")
def incremental_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that a former run has not seen, or saw with another language."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    before = docs.join(table(spark, sf_dir, "labels"), "doc_id").withColumn("lang", F.when(F.col("toxic") == 1, "xx").otherwise(F.col("lang")))
    return J.changed(before, docs, ["doc_id"], ["lang"])


@query("cache_misses", """
SELECT o_orderkey, sha256(o_orderpriority || '|' || o_custkey) AS request_hash, o_orderkey % 10 = 0 AS sampled FROM orders
WHERE o_orderkey % 10 = 0 OR sha256(o_orderpriority || '|' || o_custkey) NOT IN (SELECT sha256(o_orderpriority || '|' || o_custkey) FROM orders WHERE o_orderkey <= 1000)""")
def cache_misses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests to compute: those not in the result cache and those that sample."""
    requests = table(spark, sf_dir, "orders").select("o_orderkey", F.sha2(F.concat_ws("|", "o_orderpriority", "o_custkey"), 256).alias("request_hash"), (F.col("o_orderkey") % 10 == 0).alias("sampled"))
    cache = requests.where("o_orderkey <= 1000").select("request_hash").distinct()
    return J.cache_split(requests, cache, "request_hash", F.col("sampled"))[1].select("o_orderkey", "request_hash", "sampled")


@query("dual_hit", """
WITH a AS (SELECT l_partkey AS idx, bool_and(l_quantity > 3) AS hit FROM lineitem WHERE l_linenumber = 1 GROUP BY 1), b AS (SELECT l_partkey AS idx, bool_and(l_quantity > 3) AS hit FROM lineitem WHERE l_linenumber = 2 GROUP BY 1)
SELECT idx, a.hit AND b.hit AS dual_hit FROM a JOIN b USING (idx)""")
def dual_hit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Questions of two variants that are right in both."""
    lines = table(spark, sf_dir, "lineitem")
    one = lambda n, name: lines.where(F.col("l_linenumber") == n).groupBy(F.col("l_partkey").alias("idx")).agg(F.bool_and(F.col("l_quantity") > 3).alias(name))
    return one(1, "a").join(one(2, "b"), "idx").select("idx", (F.col("a") & F.col("b")).alias("dual_hit"))


@query("reference_row", """
SELECT conv_id, turn, first_value(text) OVER (PARTITION BY conv_id ORDER BY turn, text ROWS UNBOUNDED PRECEDING) = text AS same_as_first FROM conversations""")
def reference_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each row against the reference row of its group."""
    w = Window.partitionBy("conv_id").orderBy("turn", "text").rowsBetween(Window.unboundedPreceding, 0)
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", (F.first("text").over(w) == F.col("text")).alias("same_as_first"))


def _least_file(asked: DataFrame, names: DataFrame, longest: int | None) -> DataFrame:
    asked = asked.select(F.col("p_partkey").alias("image"), F.col("p_brand").alias("group"), "text")
    found = J.least_contained(asked.select("group", "text"), names.select(F.col("p_brand").alias("group"), F.col("stem").alias("text"), F.col("p_partkey").alias("key")), longest)
    return asked.join(found, ["group", "text"]).select("image", F.col("least").alias("file"))


@query("fuzzy_name_match_all", """
WITH n AS (SELECT p_partkey, regexp_replace(lower(p_name), '[^a-z0-9]', '', 'g') AS stem, p_brand FROM part)
SELECT q.p_partkey AS image, min(n.p_partkey) AS file FROM n q JOIN n ON n.p_brand = q.p_brand AND (contains(n.stem, q.stem) OR contains(q.stem, n.stem)) GROUP BY 1""")
def fuzzy_name_match_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``fuzzy_name_match`` for all parts, by whole stems."""
    names = table(spark, sf_dir, "part").select("p_partkey", "p_brand", F.regexp_replace(F.lower("p_name"), "[^a-z0-9]", "").alias("stem"))
    return _least_file(names.withColumn("text", F.col("stem")), names, None)
