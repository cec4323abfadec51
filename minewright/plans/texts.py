"""Queries of text, set and box scores over columns of the tables."""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from minewright.functions import boxes as B
from minewright.functions import sets as S
from minewright.functions import text as T
from minewright.operators import joins as J
from minewright.operators.sampling import ranked_within
from minewright.plans.catalog import query
from minewright.staging import shuffle_width, table

_NORMAL = r"array_to_string(list_filter(string_split_regex(trim(regexp_replace(lower({x}), '[!\"#$%&''()*+,\-./:;<=>?@\[\\\]^_`{{|}}~]', '', 'g')), '\s+'), lambda w: w NOT IN ('a', 'an', 'the', '')), ' ')"
_TURNS = "SELECT conv_id, turn, role, text, left(text, 60) AS head FROM conversations"


@query("answer_normalize", f"SELECT conv_id, turn, {_NORMAL.format(x='text')} AS normal FROM ({_TURNS}) t")
def answer_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", T.normalize_answer(F.col("text")).alias("normal"))


#: Each turn's whole text with the next turn's of its conversation.
_NEXT = "SELECT * FROM (SELECT conv_id, turn, role, text, lead(text) OVER w AS ref, lead(true) OVER w AS has FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)) n WHERE has"


def _turn_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    talk = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return J.following(talk, "conv_id", ["turn", "role", "text"], "text", "ref")


_LOOSE = r"""regexp_replace(lower({x}), '[!"#$%&''()*+,\-./:;<=>?@\[\\\]^_`{{|}}~]', '', 'g')"""


@query("exact_match_turns", f"""
SELECT role, avg(CASE WHEN {_LOOSE.format(x='text')} = {_LOOSE.format(x='ref')} THEN 1.0 ELSE 0.0 END) AS exact_match, avg(CASE WHEN text = ref THEN 1.0 ELSE 0.0 END) AS strict_match FROM ({_NEXT}) p GROUP BY role""")
def exact_match_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``exact_match_norm`` on whole turns, each against the next."""
    loose, strict = T.exact_match(F.col("text"), F.col("ref"), ignore_case=True, ignore_punctuation=True), T.exact_match(F.col("text"), F.col("ref"))
    share = lambda c: F.avg(F.coalesce(c, F.lit(False)).cast("double"))
    return _turn_pairs(spark, sf_dir).groupBy("role").agg(share(loose).alias("exact_match"), share(strict).alias("strict_match"))


@query("yes_no_parse", """
SELECT r, count(*) AS n FROM (SELECT CASE WHEN x IN ('yes', 'no') THEN x WHEN x = 'y' THEN 'yes' WHEN x = 'n' THEN 'no' WHEN contains(left(x, 4), 'yes') THEN 'yes' WHEN contains(left(x, 4), 'no') THEN 'no' ELSE 'other' END AS r
  FROM (SELECT lower(trim(CASE event_type WHEN 'click' THEN 'Yes, it is' WHEN 'view' THEN ' N' WHEN 'error' THEN 'not so' ELSE event_type END)) AS x FROM events) y) z GROUP BY r""")
def yes_no_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("event_type")
    reply = F.when(e == "click", "Yes, it is").when(e == "view", " N").when(e == "error", "not so").otherwise(e)
    return table(spark, sf_dir, "events").groupBy(T.yes_no(reply).alias("r")).agg(F.count(F.lit(1)).alias("n"))


@query("choice_letter", r"""
SELECT c_custkey, regexp_extract(replace(replace(trim('The best answer is ' || c_mktsegment || ' (' || substr('ABCDE', c_custkey % 5 + 1, 1) || ')'), 'The best answer is', ''), 'The answer is', ''), '[ABCD]') AS letter FROM customer""")
def choice_letter(spark: SparkSession, sf_dir: str) -> DataFrame:
    reply = F.concat(F.lit("The best answer is "), "c_mktsegment", F.lit(" ("), F.substring(F.lit("ABCDE"), (F.col("c_custkey") % 5 + 1).cast("int"), F.lit(1)), F.lit(")"))
    return table(spark, sf_dir, "customer").select("c_custkey", T.choice_letter(reply).alias("letter"))


@query("relaxed_match", """
SELECT p_partkey, CASE WHEN p_size <> 0 THEN abs(p_retailprice / 20 - p_size) / abs(p_size) <= 0.05 ELSE false END AS close FROM part""")
def relaxed_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", T.relaxed_match((F.col("p_retailprice") / 20).cast("string"), F.col("p_size").cast("string")).alias("close"))


@query("levenshtein_anls", r"""
WITH p AS (SELECT p_partkey, p_name AS pred, [p_brand || ' ' || p_name, p_type] AS refs FROM part),
d AS (SELECT p_partkey, 1 - list_min(list_transform(refs, lambda r: CASE WHEN greatest(length(r), length(pred)) = 0 THEN 0.0
  ELSE CAST(levenshtein(lower(trim(regexp_replace(pred, '\s+', ' ', 'g'))), lower(trim(regexp_replace(r, '\s+', ' ', 'g')))) AS DOUBLE) / greatest(length(r), length(pred)) END)) AS s FROM p)
SELECT p_partkey, CASE WHEN s < 0.5 THEN 0.0 ELSE s END AS anls FROM d""")
def levenshtein_anls(spark: SparkSession, sf_dir: str) -> DataFrame:
    refs = F.array(F.concat("p_brand", F.lit(" "), "p_name"), "p_type")
    return table(spark, sf_dir, "part").select("p_partkey", T.anls(F.col("p_name"), refs).alias("anls"))


_A, _B = "list_filter(string_split_regex(trim(left(text, 200)), '\\s+'), lambda w: w <> '')", "list_filter(string_split_regex(trim(substr(text, 101, 200)), '\\s+'), lambda w: w <> '')"


_WA, _WB = (f"list_distinct(list_filter(string_split_regex(trim({x}), '\\s+'), lambda w: w <> ''))" for x in ("text", "ref"))


@query("token_f1_turns", f"""
SELECT conv_id, turn, CASE WHEN len(list_intersect({_WA}, {_WB})) = 0 THEN 0.0 ELSE 2.0 * len(list_intersect({_WA}, {_WB})) / (len({_WA}) + len({_WB})) END AS f1 FROM ({_NEXT}) p""")
def token_f1_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``token_f1`` on whole turns, each against the next."""
    return _turn_pairs(spark, sf_dir).select("conv_id", "turn", T.token_set_f1(F.col("text"), F.col("ref")).alias("f1"))


@query("jaccard_turns", f"""
SELECT conv_id, turn, CASE WHEN len(list_distinct(list_concat({_WA}, {_WB}))) = 0 THEN 1.0
  ELSE CAST(len(list_intersect({_WA}, {_WB})) AS DOUBLE) / len(list_distinct(list_concat({_WA}, {_WB}))) END AS jaccard, list_sort({_WA}) = list_sort({_WB}) AS same_set FROM ({_NEXT}) p""")
def jaccard_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``jaccard`` on whole turns, each against the next."""
    a, b = T.words(F.col("text")), T.words(F.col("ref"))
    return _turn_pairs(spark, sf_dir).select("conv_id", "turn", S.jaccard(a, b).alias("jaccard"), S.set_equality(a, b).alias("same_set"))


@query("sequence_scores", """
WITH v AS (SELECT l_orderkey, list(l_returnflag ORDER BY l_linenumber, l_returnflag, l_linestatus) AS a, list(CASE l_linestatus WHEN 'O' THEN 'N' ELSE 'R' END ORDER BY l_linenumber, l_returnflag, l_linestatus) AS b FROM lineitem GROUP BY 1)
SELECT l_orderkey, a = b AS same, CAST(len(list_filter(range(1, len(a) + 1), lambda i: a[i] = b[i])) AS DOUBLE) / len(b) AS position_accuracy,
  CAST(coalesce(list_min(list_filter(range(1, len(a) + 1), lambda i: a[i] <> b[i])) - 1, len(a)) AS DOUBLE) / len(b) AS prefix_ratio FROM v""")
def sequence_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = F.sort_array(F.collect_list(F.struct("l_linenumber", "l_returnflag", "l_linestatus")))
    v = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(parts.alias("r"))
    a, b = F.transform("r", lambda x: x["l_returnflag"]), F.transform("r", lambda x: F.when(x["l_linestatus"] == "O", "N").otherwise("R"))
    return v.select("l_orderkey", S.sequence_equality(a, b).alias("same"), S.position_accuracy(a, b).alias("position_accuracy"), S.common_prefix_ratio(a, b).cast("double").alias("prefix_ratio"))


@query("consensus_accuracy_all", """
WITH g AS (SELECT user_id, list(event_type ORDER BY event_id) AS answers FROM events GROUP BY 1),
h AS (SELECT user_id, answers, list_transform(answers, lambda a: CASE WHEN a = 'click' THEN 1.0 ELSE 0.0 END) AS hits FROM g)
SELECT user_id, list_sum(list_transform(hits, lambda x: least(1.0, (list_sum(hits) - x) / 3))) / len(hits) AS accuracy FROM h""")
def consensus_accuracy_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``consensus_accuracy`` over all events."""
    return table(spark, sf_dir, "events").groupBy("user_id").agg(F.collect_list("event_type").alias("a")).select("user_id", S.consensus(F.lit("click"), F.col("a")).alias("accuracy"))


_BOX = "SELECT l_orderkey, l_linenumber, l_quantity AS q, l_discount * 100 AS d, l_tax * 100 AS t FROM lineitem"


@query("box_iou", f"""
WITH b AS (SELECT l_orderkey, l_linenumber, q, d, t, greatest(0.0, least(q + 10, q + d + 12) - greatest(q, q + d)) AS w, greatest(0.0, least(10.0, t + 9) - greatest(0.0, t)) AS h FROM ({_BOX}) x)
SELECT l_orderkey, l_linenumber, w * h / (100 + 12 * 9 - w * h) AS iou, w * h / (100 + 12 * 9 - w * h) >= 0.5 AS hit, (q + d + 6 >= q AND q + d + 6 <= q + 10 AND t + 4.5 >= 0 AND t + 4.5 <= 10) AS center FROM b""")
def box_iou(spark: SparkSession, sf_dir: str) -> DataFrame:
    q, d, t = F.col("l_quantity"), F.col("l_discount") * 100, F.col("l_tax") * 100
    gold, pred = F.array(q, F.lit(0.0), q + 10, F.lit(10.0)), F.array(q + d, t, q + d + 12, t + 9)
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", B.iou(pred, gold).alias("iou"), (B.iou(pred, gold) >= 0.5).alias("hit"), B.center_inside(pred, gold).alias("center"))


@query("span_scores", """
SELECT o_orderkey, greatest(0.0, least(o_totalprice, 30000.0) - greatest(o_totalprice / 2, 10000.0)) / (greatest(o_totalprice, 30000.0) - least(o_totalprice / 2, 10000.0)) AS iou FROM orders""")
def span_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = F.col("o_totalprice")
    return table(spark, sf_dir, "orders").select("o_orderkey", B.span_iou(F.array(p / 2, p), F.array(F.lit(10000.0), F.lit(30000.0))).alias("iou"))


@query("number_scores", """
SELECT p_partkey, greatest(0.0, 1 - abs((p_retailprice / 20 - p_size) / p_size)) AS closeness, 1 - least(greatest(sqrt((power(p_retailprice / 30000 - p_size / 500.0, 2) + 0) / 2), 0.0), 0.1) / 0.1 AS rmse FROM part WHERE p_size > 0""")
def number_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    price, size = F.col("p_retailprice"), F.col("p_size")
    return table(spark, sf_dir, "part").where("p_size > 0").select(
        "p_partkey", S.number_closeness(price / 20, size).alias("closeness"), S.rmse_score(F.array(price / 30000, F.lit(1.0)), F.array(size / 500.0, F.lit(1.0))).alias("rmse"))


@query("geo_scores", """
SELECT s_suppkey, exp(-2 * 6371.0 * asin(sqrt(least(1.0, power(sin(radians(s_nationkey - s_suppkey % 90) / 2), 2) + cos(radians(s_suppkey % 90)) * cos(radians(s_nationkey)) * power(sin(radians(s_suppkey % 7) / 2), 2)))) / 100) AS closeness FROM supplier""")
def geo_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select("s_suppkey", B.geo_closeness((F.col("s_suppkey") % 90).cast("double"), F.lit(0.0), F.col("s_nationkey").cast("double"), (F.col("s_suppkey") % 7).cast("double")).alias("closeness"))


@query("hash_chain", """
WITH h AS (SELECT source, doc_id, sha256(coalesce(text, '')) AS h FROM documents) SELECT source, sha256(string_agg(h, '' ORDER BY doc_id, h)) AS task_hash, count(*) AS n FROM h GROUP BY source""")
def hash_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A digest per row, and per task the digest of its rows' digests in order.

    Sorted digests stream through one hash state per task, so that none is gathered; the digest of a string has to be
    taken in order, so a task's digests pass through one worker.  ``hash_chain_runs`` is the form without that.
    """
    rows = table(spark, sf_dir, "documents").select("source", "doc_id", F.sha2(F.coalesce("text", F.lit("")), 256).alias("h"))

    def chain(batches):
        name, state, n = None, None, 0
        for batch in batches:
            for source, h in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if state is None or source != name:
                    if state is not None:
                        yield pa.record_batch([pa.array([name], pa.string()), pa.array([state.hexdigest()]), pa.array([n])], names=["source", "task_hash", "n"])
                    name, state, n = source, hashlib.sha256(), 0
                state.update(h.encode())
                n += 1
        if state is not None:
            yield pa.record_batch([pa.array([name], pa.string()), pa.array([state.hexdigest()]), pa.array([n])], names=["source", "task_hash", "n"])

    placed = rows.repartition(shuffle_width(spark), "source").sortWithinPartitions("source", "doc_id", "h")
    return placed.select("source", "h").mapInArrow(chain, "source string, task_hash string, n long")


@query("hash_chain_runs", """
WITH h AS (SELECT source, doc_id, sha256(coalesce(text, '')) AS h FROM documents),
r AS (SELECT *, (row_number() OVER (PARTITION BY source ORDER BY doc_id, h) - 1) // 1000 AS run FROM h),
d AS (SELECT source, run, sha256(string_agg(h, '' ORDER BY doc_id, h)) AS d, count(*) AS n FROM r GROUP BY 1, 2)
SELECT source, sha256(string_agg(d, '' ORDER BY run)) AS task_hash, CAST(sum(n) AS BIGINT) AS n FROM d GROUP BY 1""")
def hash_chain_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``hash_chain``, by runs of 1000 rows: a digest of each run's digests, and per task the digest of these."""
    rows = table(spark, sf_dir, "documents").select("source", "doc_id", F.sha2(F.coalesce("text", F.lit("")), 256).alias("h"))
    placed = ranked_within(rows, ["source"], ["doc_id", "h"]).withColumn("run", F.expr("(_rank - 1) div 1000"))
    joined = lambda key, value: F.sha2(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(key, value))), lambda r: r[value]), ""), 256)
    runs = placed.groupBy("source", "run").agg(joined("_rank", "h").alias("d"), F.count(F.lit(1)).alias("n"))
    return runs.groupBy("source").agg(joined("run", "d").alias("task_hash"), F.sum("n").alias("n"))


@query("prompt_text", r"""
SELECT conv_id, turn, replace(regexp_replace(replace(trim(text), ' [title]', '. '), '\[.*?\]', '', 'g'), '  ', ' ') AS prompt FROM conversations WHERE text IS NOT NULL""")
def prompt_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").where("text IS NOT NULL").select("conv_id", "turn", T.clean_prompt(F.col("text")).alias("prompt"))
