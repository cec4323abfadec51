"""Queries of page parsing, question-answer records, images, contamination and conversations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from minewright.functions import conversations as C
from minewright.functions import html as H
from minewright.functions import images as I
from minewright.functions import qa as Q
from minewright.operators import decontam, statistics
from minewright.operators import joins as J
from minewright.plans.catalog import query
from minewright.staging import table


def _nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return pages.select("page_id", "url", H.nodes(F.col("html"), F.col("url")).alias("nodes"))


@query("page_nodes")
def page_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _nodes(spark, sf_dir).select("page_id", F.explode("nodes").alias("n")).select("page_id", "n.pos", "n.type", "n.content")


@query("page_image_links")
def page_image_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _nodes(spark, sf_dir).select("page_id", H.image_links(F.col("nodes")).alias("links"), H.inline_images(F.col("nodes")).alias("inline"))


@query("page_llm_doc")
def page_llm_doc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _nodes(spark, sf_dir).select("page_id", H.llm_document(F.col("nodes")).alias("document"))


def _replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replies in the reply format, made of conversations: a user's turn is a question, the next one its solution."""
    talk = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("t"))
    users = F.filter("t", lambda x: x["role"] == "user")
    clean = lambda c: F.trim(F.regexp_replace(c, r"\s+", " "))
    items = F.transform(users, lambda u: F.struct(clean(u["text"]).alias("question"), F.array(F.concat(F.lit("q"), u["turn"].cast("string"), F.lit(".png"))).alias("question_images"), clean(F.col("t")[0]["text"]).alias("solution"), F.array().cast("array<string>").alias("solution_images")))
    return talk.select("conv_id", items.alias("items"), Q.format_items(items).alias("reply"))


_CLEAN = r"trim(regexp_replace({0}, '\s+', ' ', 'g'))"


@query("qa_parse", rf"""
WITH f AS (SELECT conv_id, arg_min(text, turn) AS head FROM conversations GROUP BY 1)
SELECT c.conv_id, {_CLEAN.format('c.text')} AS question, 'q' || c.turn || '.png' AS image, {_CLEAN.format('f.head')} AS solution FROM conversations c JOIN f USING (conv_id) WHERE role = 'user'""")
def qa_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Formatting and parsing again gives the records back."""
    parsed = _replies(spark, sf_dir).select("conv_id", F.explode(Q.parse_items(F.col("reply"))).alias("i"))
    return parsed.select("conv_id", "i.question", F.col("i.question_images")[0].alias("image"), "i.solution")


@query("qa_validity_split", """
SELECT valid, count(*) AS n, printf('%.2f%%', 100.0 * count(*) / sum(count(*)) OVER ()) AS share FROM (SELECT quality = 1 AS valid FROM labels) l GROUP BY valid""")
def qa_validity_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Checker replies parsed to verdicts, with their shares."""
    reply = F.concat(F.lit("QUESTION_VALID: "), F.when(F.col("quality") == 1, "Yes").otherwise("No"), F.lit("\nQUESTION_IMAGES: 0,-1\nSOLUTION_IMAGES: x\nANALYSIS: fine: or not"))
    images = F.array(F.lit("a"), F.lit("b"))
    parsed = table(spark, sf_dir, "labels").select(Q.parse_filter_reply(reply, images, images).alias("p"))
    counts = parsed.groupBy(F.col("p.valid").alias("valid")).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("total"))
    return counts.join(F.broadcast(total)).select("valid", "n", F.format_string("%.2f%%", 100.0 * F.col("n") / F.col("total")).alias("share"))


@query("image_names")
def image_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", I.image_name(F.col("url")).alias("name"))


@query("unique_file_names", """
WITH f AS (SELECT source AS folder, lang || '.png' AS name, md5(coalesce(text, '')) AS digest, doc_id AS seq FROM documents),
k AS (SELECT folder, name, digest, row_number() OVER (PARTITION BY folder, name ORDER BY min(seq)) - 1 AS k FROM f GROUP BY 1, 2, 3)
SELECT f.folder, f.seq, CASE WHEN k = 0 THEN name ELSE regexp_replace(name, '\\.[^.]*$', '') || '_' || k || regexp_extract(name, '(\\.[^.]*)$', 1) END AS saved_as FROM f JOIN k USING (folder, name, digest)""".replace("\\\\", "\\"))
def unique_file_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = table(spark, sf_dir, "documents").select(F.col("source").alias("folder"), F.concat("lang", F.lit(".png")).alias("name"), F.md5(F.coalesce("text", F.lit(""))).alias("digest"), F.col("doc_id").alias("seq"))
    return I.unique_names(files, "folder", "name", "digest").select("folder", "seq", "saved_as")


@query("inline_images", "SELECT item_id, 'jpg' AS format, CAST(octet_length(encode(text)) AS BIGINT) AS n_bytes, md5(text) AS digest FROM benchmark")
def inline_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Data URIs decoded, their padding cut off before."""
    uri = F.concat(F.lit("data:image/jpeg;base64,"), F.regexp_replace(F.base64(F.col("text").cast("binary")), "[=\\s]+", ""))
    d = table(spark, sf_dir, "benchmark").select("item_id", I.decode_inline(uri).alias("d"))
    return d.select("item_id", "d.format", F.length("d.data").cast("long").alias("n_bytes"), F.md5("d.data").alias("digest"))


_GRAMS = "list_filter(string_split_regex(lower(text), '[^\\p{L}\\p{N}]+'), lambda w: w <> '')"


@query("contamination", f"""
WITH b AS (SELECT item_id, {_GRAMS} AS w FROM benchmark), bi AS (SELECT DISTINCT item_id, unnest(list_transform(range(1, len(w) - 6), lambda i: array_to_string(w[i:i + 7], ' '))) AS g FROM b WHERE len(w) >= 8),
d AS (SELECT doc_id, {_GRAMS} AS w FROM documents), di AS (SELECT DISTINCT doc_id, unnest(list_transform(range(1, len(w) - 6), lambda i: array_to_string(w[i:i + 7], ' '))) AS g FROM d WHERE len(w) >= 8),
n AS (SELECT item_id, count(*) AS size FROM bi GROUP BY 1)
SELECT doc_id, item_id, count(*) AS shared, CAST(count(*) AS DOUBLE) / any_value(size) AS share FROM di JOIN bi USING (g) JOIN n USING (item_id) GROUP BY 1, 2""")
def contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("role_remap", r"""
SELECT conv_id, list_concat(['system'], list(CASE role WHEN 'user' THEN 'user' ELSE role END ORDER BY turn, role, text)[CASE WHEN arg_min(role, (turn, role, text)) = 'user' THEN 1 ELSE 2 END:]) AS roles FROM conversations GROUP BY conv_id""")
def role_remap(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.when(F.col("role") == "user", "human").when(F.col("role") == "assistant", "gpt").otherwise(F.col("role"))
    talk = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text", name.alias("from")))).alias("t"))
    turns = F.transform("t", lambda x: F.struct(x["from"].alias("from"), x["text"].alias("value")))
    return talk.select("conv_id", F.transform(C.chat_roles(turns, "You are helpful."), lambda x: x["role"]).alias("roles"))


@query("image_mark_whole", r"""
SELECT conv_id, turn, CASE WHEN turn % 2 = 0 THEN '<image>' || chr(10) || trim(text) ELSE text END AS marked FROM conversations""")
def image_mark_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``image_mark_first`` on whole turns."""
    marked = F.when(F.col("turn") % 2 == 0, F.concat("text", F.lit("<image>"))).otherwise(F.col("text"))
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", C.image_first(marked).alias("marked"))


@query("padded_tokens", """
WITH t AS (SELECT l_orderkey, list(l_partkey ORDER BY l_linenumber, l_partkey)[1:4] AS k FROM lineitem GROUP BY 1)
SELECT l_orderkey, list_concat(k, list_transform(range(4 - len(k)), lambda x: CAST(0 AS BIGINT))) AS ids, len(k) AS kept FROM t""")
def padded_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.transform(F.sort_array(F.collect_list(F.struct("l_linenumber", "l_partkey"))), lambda x: x["l_partkey"]).alias("k"))
    p = t.select("l_orderkey", C.padded(F.col("k"), 4, 0).alias("p"))
    return p.select("l_orderkey", "p.ids", F.aggregate("p.mask", F.lit(0), lambda a, x: a + x).cast("long").alias("kept"))


def _battles(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice", F.col("o_custkey") % 7)
    a, b = F.col("o_orderpriority"), F.element_at(F.array(*[F.lit(x) for x in ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")]), (F.col("o_orderkey") % 5 + 1).cast("int"))
    winner = F.when(F.col("o_totalprice") % 3 < 1, "model_a").when(F.col("o_totalprice") % 3 < 2, "model_b").otherwise("tie")
    return o.select(a.alias("model_a"), b.alias("model_b"), winner.alias("winner")).where("model_a <> model_b")


@query("elo_ratings")
def elo_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return statistics.elo(_battles(spark, sf_dir), "3-MEDIUM")


@query("win_rates", """
WITH b AS (SELECT o_orderpriority AS a, ['1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED', '5-LOW'][o_orderkey % 5 + 1] AS b, CASE WHEN o_totalprice % 3 < 1 THEN 1.0 WHEN o_totalprice % 3 < 2 THEN 0.0 ELSE 0.5 END AS s FROM orders),
u AS (SELECT a AS model, b AS against, s FROM b WHERE a <> b UNION ALL SELECT b, a, 1 - s FROM b WHERE a <> b)
SELECT model, against, avg(s) AS win_rate, count(*) AS n FROM u GROUP BY 1, 2""")
def win_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return statistics.win_rates(_battles(spark, sf_dir))


@query("bootstrap_interval")
def bootstrap_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    return statistics.bootstrap(table(spark, sf_dir, "labels").select("quality", "toxic"), ["quality"], "toxic", iterations=300)


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole turns against the next turn of their conversation."""
    talk = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return J.following(talk, "conv_id", ["turn", "role", "text"], "text", "ref").select("role", F.col("text").alias("pred"), "ref")


@query("corpus_bleu")
def corpus_bleu(spark: SparkSession, sf_dir: str) -> DataFrame:
    return statistics.corpus_bleu(_pairs(spark, sf_dir), ["role"], "pred", "ref")


@query("word_error_rate")
def word_error_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return statistics.word_error_rate(_pairs(spark, sf_dir), ["role"], "pred", "ref")
