"""Queries that score and aggregate: means, errors, confusion counts, groups, roll-ups."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from minewright.operators import aggregates as A
from minewright.plans.catalog import query
from minewright.staging import table

_JUDGED = "SELECT d.doc_id, d.lang, d.source, l.quality, l.toxic FROM documents d JOIN labels l USING (doc_id)"
_LINES = "SELECT l_returnflag, l_linestatus, l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem"


def judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    return docs.join(table(spark, sf_dir, "labels"), "doc_id")


@query("macro_accuracy", f"SELECT lang, avg(m) AS macro_mean, count(*) AS n_categories FROM (SELECT lang, source, avg(quality) AS m FROM ({_JUDGED}) j GROUP BY lang, source) x GROUP BY lang")
def macro_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.macro_mean(judged(spark, sf_dir), ["lang"], "source", "quality")


@query("micro_grouping_sets", f"SELECT lang, source, avg(quality) AS accuracy, count(*) AS n FROM ({_JUDGED}) j GROUP BY GROUPING SETS ((lang), (source), (lang, source), ())")
def micro_grouping_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(spark, sf_dir).groupingSets([["lang"], ["source"], ["lang", "source"], []], "lang", "source").agg(F.avg("quality").alias("accuracy"), F.count(F.lit(1)).alias("n"))


@query("weighted_rollup", f"""
WITH leaf AS (SELECT lang, source, avg(quality) AS acc, count(*) AS n FROM ({_JUDGED}) j GROUP BY lang, source)
SELECT lang, round(sum(acc * n) / sum(n), 5) AS accuracy, CAST(sum(n) AS BIGINT) AS n FROM leaf GROUP BY ROLLUP (lang)""")
def weighted_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    leaf = judged(spark, sf_dir).groupBy("lang", "source").agg(F.avg("quality").alias("acc"), F.count(F.lit(1)).alias("n"))
    return leaf.rollup("lang").agg(F.round(F.sum(F.col("acc") * F.col("n")) / F.sum("n"), 5).alias("accuracy"), F.sum("n").alias("n"))


@query("overlap_groups", f"""
WITH g AS (SELECT unnest([lang, source]) AS grp, quality FROM ({_JUDGED}) j),
a AS (SELECT grp, avg(quality) AS accuracy, count(*) AS n FROM g GROUP BY grp)
SELECT grp, accuracy, n FROM a UNION ALL SELECT 'overall', sum(accuracy * n) / sum(n), CAST(sum(n) AS BIGINT) FROM a""")
def overlap_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row counts in two groups, and so twice in the weighted overall."""
    each = judged(spark, sf_dir).select(F.explode(F.array("lang", "source")).alias("grp"), "quality")
    groups = each.groupBy("grp").agg(F.avg("quality").alias("accuracy"), F.count(F.lit(1)).alias("n"))
    overall = groups.agg(F.lit("overall").alias("grp"), (F.sum(F.col("accuracy") * F.col("n")) / F.sum("n")).alias("accuracy"), F.sum("n").alias("n"))
    return groups.unionByName(overall)


_CONFUSION = f"""SELECT lang, count(*) FILTER (quality = 1 AND toxic = 1) AS tp, count(*) FILTER (quality = 0 AND toxic = 1) AS fp,
  count(*) FILTER (quality = 1 AND toxic = 0) AS fn, count(*) FILTER (quality = 0 AND toxic = 0) AS tn, count(*) AS n FROM ({_JUDGED}) j GROUP BY lang"""


@query("yesno_prf", f"""
SELECT lang, CAST(tp + tn AS DOUBLE) / n AS accuracy, CAST(tp AS DOUBLE) / nullif(tp + fp, 0) AS "precision", CAST(tp AS DOUBLE) / nullif(tp + fn, 0) AS recall,
  CAST(tp + fn AS DOUBLE) / n AS gold_yes_ratio, CAST(tp + fp AS DOUBLE) / n AS predicted_yes_ratio FROM ({_CONFUSION}) c""")
def yesno_prf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both yes ratios: of the ground truth, as the parity form counts it, and of the predictions."""
    c = A.confusion(F.col("quality"), F.col("toxic"))
    t = judged(spark, sf_dir).groupBy("lang").agg(*[x.alias(k) for k, x in c.items()], F.count(F.lit(1)).alias("n"))
    ratio = lambda a, b: F.try_divide(a.cast("double"), b)
    tp, fp, fn, tn, n = map(F.col, ("tp", "fp", "fn", "tn", "n"))
    return t.select("lang", ratio(tp + tn, n).alias("accuracy"), ratio(tp, tp + fp).alias("precision"), ratio(tp, tp + fn).alias("recall"), ratio(tp + fn, n).alias("gold_yes_ratio"), ratio(tp + fp, n).alias("predicted_yes_ratio"))


@query("mcc_f1", f"""
SELECT lang, coalesce(2.0 * tp / nullif(2.0 * tp + fp + fn, 0), 0) AS f1,
  CASE WHEN CAST(tp + fp AS DOUBLE) * (tp + fn) * (tn + fp) * (tn + fn) = 0 THEN 0
       ELSE (CAST(tp AS DOUBLE) * tn - CAST(fp AS DOUBLE) * fn) / sqrt(CAST(tp + fp AS DOUBLE) * (tp + fn) * (tn + fp) * (tn + fn)) END AS mcc FROM ({_CONFUSION}) c""")
def mcc_f1(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = A.confusion(F.col("quality"), F.col("toxic"))
    t = judged(spark, sf_dir).groupBy("lang").agg(*[x.alias(k) for k, x in c.items()])
    return t.select("lang", A.f1(F.col("tp"), F.col("fp"), F.col("fn")).alias("f1"), A.matthews(F.col("tp"), F.col("fp"), F.col("fn"), F.col("tn")).alias("mcc"))


@query("brier", """
SELECT l_returnflag, avg(power(l_discount * 10 - CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END, 2) + power(1 - l_discount * 10 - CASE WHEN l_linestatus = 'F' THEN 0 ELSE 1 END, 2)) AS brier FROM lineitem GROUP BY l_returnflag""")
def brier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean squared distance of a probability vector from the one-hot gold."""
    gold = F.when(F.col("l_linestatus") == "F", 1.0).otherwise(0.0)
    p = F.array(F.col("l_discount") * 10, 1 - F.col("l_discount") * 10)
    one = F.array(gold, 1 - gold)
    row = F.aggregate(F.zip_with(p, one, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda a, x: a + x)
    return table(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(F.avg(row).alias("brier"))


@query("pair_score", f"""
WITH p AS (SELECT l_returnflag AS category, l_orderkey AS question, count(*) AS n, sum(CASE WHEN l_quantity > 25 THEN 1.0 ELSE 0.0 END) AS s FROM ({_LINES}) x WHERE l_linenumber <= 2 GROUP BY 1, 2 HAVING count(*) = 2)
SELECT category, avg(s / 2) * 100 AS acc, avg(CASE WHEN s = 2 THEN 1.0 ELSE 0.0 END) * 100 AS acc_plus, avg(s / 2) * 100 + avg(CASE WHEN s = 2 THEN 1.0 ELSE 0.0 END) * 100 AS score FROM p GROUP BY category""")
def pair_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Questions asked twice: share of right answers plus share of questions with both right."""
    right = F.when(F.col("l_quantity") > 25, 1.0).otherwise(0.0)
    pairs = table(spark, sf_dir, "lineitem").where("l_linenumber <= 2").groupBy(F.col("l_returnflag").alias("category"), "l_orderkey").agg(F.count(F.lit(1)).alias("n"), F.sum(right).alias("s")).where("n = 2")
    acc, plus = F.avg(F.col("s") / 2) * 100, F.avg(F.when(F.col("s") == 2, 1.0).otherwise(0.0)) * 100
    return pairs.groupBy("category").agg(acc.alias("acc"), plus.alias("acc_plus"), (acc + plus).alias("score"))


@query("all_correct_group", """
WITH g AS (SELECT event_type, user_id, bool_and(value > 20) AS all_right FROM events GROUP BY 1, 2)
SELECT event_type, avg(CASE WHEN all_right THEN 1.0 ELSE 0.0 END) AS accuracy, count(*) AS n_groups FROM g GROUP BY event_type""")
def all_correct_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_type", "user_id", (F.col("value") > 20).cast("int").alias("right"))
    return A.all_correct(events, ["event_type", "user_id"], "right").groupBy("event_type").agg(F.avg(F.col("all_right").cast("double")).alias("accuracy"), F.count(F.lit(1)).alias("n_groups"))


@query("circular_group", """
WITH g AS (SELECT o_custkey % 100 AS base, bool_and(o_totalprice > 20000) AS hit, count(*) AS n FROM orders GROUP BY 1)
SELECT base, hit, n FROM g""")
def circular_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with the same index modulo a base are rotations of one question; it counts if all are right."""
    return table(spark, sf_dir, "orders").groupBy((F.col("o_custkey") % 100).alias("base")).agg(F.bool_and(F.col("o_totalprice") > 20000).alias("hit"), F.count(F.lit(1)).alias("n"))


@query("pivot_groups", """
SELECT user_id, max(value) FILTER (event_type = 'click') AS click, max(value) FILTER (event_type = 'view') AS "view", max(value) FILTER (event_type = 'purchase') AS purchase,
  coalesce(max(value) FILTER (event_type = 'click') > max(value) FILTER (event_type = 'view'), false) AS click_wins FROM events GROUP BY user_id""")
def pivot_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = table(spark, sf_dir, "events").groupBy("user_id").pivot("event_type", ["click", "view", "purchase"]).agg(F.max("value"))
    return wide.withColumn("click_wins", F.coalesce(F.col("click") > F.col("view"), F.lit(False)))


@query("group_stderr", f"""
SELECT l_returnflag, l_linestatus, count(*) AS n, avg(l_quantity) AS mean, stddev_pop(l_quantity) AS sd_pop, stddev_samp(l_quantity) AS sd_samp,
  CASE WHEN count(*) > 1 THEN stddev_samp(l_quantity) / sqrt(count(*)) END AS stderr FROM ({_LINES}) x GROUP BY 1, 2""")
def group_stderr(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = F.col("l_quantity")
    return table(spark, sf_dir, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(F.count(q).alias("n"), F.avg(q).alias("mean"), F.stddev_pop(q).alias("sd_pop"), F.stddev_samp(q).alias("sd_samp"), A.mean_stderr(q).alias("stderr"))


_LEAF = f"SELECT l_returnflag, l_linestatus, count(*) AS n, avg(l_quantity) AS value, stddev_samp(l_quantity) / sqrt(count(*)) AS stderr FROM ({_LINES}) x GROUP BY 1, 2"


def _leaf(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = F.col("l_quantity")
    return table(spark, sf_dir, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(F.count(q).alias("n"), F.avg(q).alias("value"), A.mean_stderr(q).alias("stderr"))


@query("pooled_stderr", f"SELECT l_returnflag, sqrt(sum((n - 1) * stderr * stderr * n) / (sum(n) - count(*)) / sum(n)) AS pooled FROM ({_LEAF}) l GROUP BY 1")
def pooled_stderr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _leaf(spark, sf_dir).groupBy("l_returnflag").agg(A.pooled_stderr(F.col("stderr"), F.col("n")).alias("pooled"))


@query("group_rollup", f"""
WITH leaf AS ({_LEAF}), tree(grp, flag, w) AS (VALUES ('all', 'A', true), ('all', 'N', true), ('all', 'R', true), ('returned', 'A', false), ('returned', 'R', false))
SELECT grp AS "group", sum(CASE WHEN w THEN value * n ELSE value END) / sum(CASE WHEN w THEN n ELSE 1 END) AS value,
  sqrt(sum((n - 1) * stderr * stderr * n) / (sum(n) - count(*)) / sum(n)) AS stderr, CAST(sum(n) AS BIGINT) AS n FROM leaf JOIN tree ON flag = l_returnflag GROUP BY grp""")
def group_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    leaves = _leaf(spark, sf_dir).withColumn("task", F.col("l_returnflag")).withColumn("metric", F.lit("quantity"))
    tree = spark.createDataFrame([("all", x, True) for x in "ANR"] + [("returned", x, False) for x in "AR"], "`group` string, leaf string, weight_by_size boolean")
    return A.roll_up(leaves, tree).select("group", "value", "stderr", "n")


@query("perplexity_family", f"""
SELECT l_returnflag, exp(-avg(-l_discount)) AS perplexity, exp(-sum(-l_discount) / sum(l_quantity)) AS weighted_perplexity, -(sum(-l_discount) / sum(l_quantity)) / ln(2) AS bits_per_byte,
  sum(l_discount) / sum(l_quantity) AS weighted_mean FROM ({_LINES}) x GROUP BY 1""")
def perplexity_family(spark: SparkSession, sf_dir: str) -> DataFrame:
    loglik, weight = -F.col("l_discount"), F.col("l_quantity")
    return table(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(
        A.perplexity(loglik).alias("perplexity"), A.weighted_perplexity(loglik, weight).alias("weighted_perplexity"), A.bits_per_byte(loglik, weight).alias("bits_per_byte"), A.weighted_mean(-loglik, weight).alias("weighted_mean"))


@query("median_unsorted", """
SELECT o_orderpriority, o_totalprice AS median_unsorted FROM (SELECT *, count(*) OVER (PARTITION BY o_orderpriority) AS n, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) - 1 AS i FROM orders) x WHERE i = n // 2""")
def median_unsorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.unsorted_median(table(spark, sf_dir, "orders").select("o_orderpriority", "o_orderkey", "o_totalprice"), ["o_orderpriority"], "o_totalprice", "o_orderkey")


@query("higher_is_better", f"SELECT l_linenumber % 2 = 0 AS even, l_linestatus, CASE WHEN count(DISTINCT l_returnflag = 'N') = 1 THEN CAST(max(l_returnflag = 'N') AS VARCHAR) END AS higher_is_better FROM ({_LINES}) x GROUP BY 1, 2")
def higher_is_better(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A group's direction, null where its members disagree."""
    up = F.col("l_returnflag") == "N"
    return table(spark, sf_dir, "lineitem").groupBy((F.col("l_linenumber") % 2 == 0).alias("even"), "l_linestatus").agg(F.when(F.min(up) == F.max(up), F.max(up)).cast("string").alias("higher_is_better"))


@query("sample_size", "SELECT lang, count(*) AS n, CAST(ceil(count(*) * 0.1) AS BIGINT) AS tenth, least(count(*), 25) AS first_25 FROM documents GROUP BY lang")
def sample_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A limit below one is a share of each task's own size, rounded up."""
    n = F.count(F.lit(1))
    return table(spark, sf_dir, "documents").groupBy("lang").agg(n.alias("n"), F.ceil(n * F.lit(0.1)).alias("tenth"), F.least(n, F.lit(25).cast("long")).alias("first_25"))


@query("judge_scores", """
SELECT event_type, avg(value) FILTER (value >= 10) AS mean_valid, count(*) FILTER (value < 10) AS failed, 25 * (avg(value) FILTER (value >= 10) - 1) AS scaled FROM events GROUP BY 1""")
def judge_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Judge scores with the failures (here values under ten) left out of the mean."""
    ok = F.when(F.col("value") >= 10, F.col("value"))
    return table(spark, sf_dir, "events").groupBy("event_type").agg(F.avg(ok).alias("mean_valid"), F.count_if(F.col("value") < 10).alias("failed"), (25 * (F.avg(ok) - 1)).alias("scaled"))


@query("value_counts", "SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def value_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query("prediction_argmin", """
WITH s AS (SELECT l_orderkey, list(l_extendedprice ORDER BY l_linenumber, l_extendedprice, l_quantity) AS loss, list(l_quantity ORDER BY l_linenumber, l_extendedprice, l_quantity) AS size FROM lineitem GROUP BY 1)
SELECT l_orderkey, CAST(list_position(loss, list_min(loss)) AS INTEGER) AS choice,
  CAST(list_position(list_transform(range(1, len(loss) + 1), lambda i: loss[i] / size[i]), list_min(list_transform(range(1, len(loss) + 1), lambda i: loss[i] / size[i]))) AS INTEGER) AS choice_norm FROM s""")
def prediction_argmin(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The choice of least loss, plain and by length; requests are put in order first, ties go to the first."""
    s = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.sort_array(F.collect_list(F.struct("l_linenumber", "l_extendedprice", "l_quantity"))).alias("r"))
    loss, norm = F.transform("r", lambda x: x["l_extendedprice"]), F.transform("r", lambda x: x["l_extendedprice"] / x["l_quantity"])
    pick = lambda a: F.array_position(a, F.array_min(a)).cast("int")
    return s.select("l_orderkey", pick(loss).alias("choice"), pick(norm).alias("choice_norm"))
