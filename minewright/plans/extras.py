"""Queries of paired references, prompt forms, named options, box sequences, sentence scores and summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from minewright.functions import boxes as B
from minewright.functions import choices as CH
from minewright.functions import conversations as CV
from minewright.functions import text as T
from minewright.operators import aggregates as A
from minewright.operators import captions as C
from minewright.operators import joins as J
from minewright.plans.catalog import query
from minewright.staging import table


@query("paired_references", """
WITH d AS (SELECT doc_id // 2 AS i, doc_id % 2 AS h, min(lang) AS lang, n_chars % 7 AS n FROM documents GROUP BY doc_id, n_chars),
r AS (SELECT i, h, CASE WHEN n < 5 THEN 1 ELSE 0 END AS t, CASE WHEN n > 1 THEN 1 ELSE 0 END AS v FROM d),
p AS (SELECT i, i % 3 AS category, sum(t) = 2 AS t, sum(v) = 2 AS v FROM r GROUP BY i)
SELECT category, count(*) AS n, 100.0 * avg(CAST(t AS INTEGER)) AS text, 100.0 * avg(CAST(v AS INTEGER)) AS video, 100.0 * avg(CAST(t AND v AS INTEGER)) AS both FROM p GROUP BY category""")
def paired_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents in pairs as the halves of an item, asked as text and as video; the gold letters are a table of their own."""
    k, n = F.col("doc_id"), F.col("n_chars") % 7
    half = F.when(k % 2 == 0, "pos").otherwise("neg")
    docs = table(spark, sf_dir, "documents").select(F.expr("doc_id div 2").alias("index"), half.alias("half"), n.alias("n"), (F.expr("doc_id div 2") % 3).alias("category"))
    kinds = F.explode(F.array(F.lit("text"), F.lit("video")))
    asked = docs.select("*", kinds.alias("kind"))
    pred = F.when(F.col("kind") == "text", F.when(F.col("n") < 5, "a) this").otherwise("B")).otherwise(F.when(F.col("n") > 1, "B. that").otherwise("none"))
    gold = docs.select("index", "half", kinds.alias("kind")).select("index", "half", "kind", F.when(F.col("kind") == "text", "A").otherwise("b").alias("gold"))
    scored = A.paired_references(asked.select("index", "half", "kind", "category", pred.alias("pred")), gold)
    share = lambda c: (100 * F.avg(F.col(c).cast("double")))
    return scored.groupBy("category").agg(F.count(F.lit(1)).alias("n"), share("text").alias("text"), share("video").alias("video"), share("group").alias("both"))


_TALK = """t AS (SELECT conv_id, list({'r': role, 'x': text} ORDER BY turn, role, text) AS l FROM conversations GROUP BY conv_id),
b AS (SELECT conv_id, CASE WHEN l[1].r = 'user' THEN l ELSE l[2:] END AS l FROM t),
f AS (SELECT conv_id, l, len(list_filter(l, lambda x, i: x.r <> CASE WHEN i % 2 = 1 THEN 'user' ELSE 'assistant' END)) = 0 AS fair FROM b)"""


@query("prompt_forms", f"""
WITH {_TALK}
SELECT conv_id, form, CASE WHEN fair THEN md5(CASE form
  WHEN 'two_seps' THEN 'Be kind. ' || array_to_string(list_transform(l, lambda x, i: CASE WHEN i % 2 = 1 THEN 'USER: ' || x.x || ' ' ELSE 'ASSISTANT: ' || x.x || '</s>' END), '')
  WHEN 'inst' THEN regexp_replace(array_to_string(list_transform(l, lambda x, i: CASE WHEN i % 2 = 1 THEN '<s>[INST] ' || CASE WHEN i = 1 THEN '<<SYS>>' || chr(10) || 'Be kind.' || chr(10) || '<</SYS>>' || chr(10) || chr(10) ELSE '' END || x.x || ' [/INST]' ELSE ' ' || x.x || ' </s>' END), ''), '^<s>', '')
  WHEN 'turns' THEN array_to_string(list_transform(l, lambda x, i: '<start_of_turn>' || CASE WHEN i % 2 = 1 THEN 'user' ELSE 'model' END || chr(10) || x.x || '<end_of_turn>' || chr(10)), '')
  WHEN 'headers' THEN '<|begin_of_text|><|start_header_id|>system<|end_header_id|>' || chr(10) || chr(10) || 'Be kind.<|eot_id|>' || array_to_string(list_transform(l, lambda x, i: '<|start_header_id|>' || x.r || '<|end_header_id|>' || chr(10) || chr(10) || x.x || '<|eot_id|>'), '')
  WHEN 'im_tight' THEN '<|im_start|>system' || chr(10) || 'Be kind.<|im_end|>' || array_to_string(list_transform(l, lambda x: '<|im_start|>' || x.r || chr(10) || x.x || '<|im_end|>'), '')
  WHEN 'im_lines' THEN '<|im_start|>system' || chr(10) || 'Be kind.<|im_end|>' || chr(10) || array_to_string(list_transform(l, lambda x: '<|im_start|>' || x.r || chr(10) || x.x || '<|im_end|>' || chr(10)), '')
  ELSE array_to_string(list_transform(l, lambda x, i: x.x || CASE WHEN i % 2 = 0 THEN chr(10) ELSE '' END), '') END) END AS digest
FROM f, (VALUES {', '.join(f"('{n}')" for n in CV.FORMS)}) v(form)""")
def prompt_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation in each of the seven forms, as a digest; null where its turns do not alternate."""
    name = F.when(F.col("role") == "user", "human").when(F.col("role") == "assistant", "gpt").otherwise(F.col("role"))
    talk = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text", name.alias("from")))).alias("t"))
    turns = F.transform("t", lambda x: F.struct(x["from"].alias("from"), x["text"].alias("value")))
    forms = F.inline(F.array(*[F.struct(F.lit(n).alias("form"), F.md5(CV.chat_prompt(turns, n, "Be kind.").cast("binary")).alias("digest")) for n in CV.FORMS]))
    return talk.select("conv_id", forms)


@query("named_options", """
SELECT doc_id, CASE doc_id % 7 WHEN 0 THEN chr(65 + CAST(n_chars % 5 AS INTEGER)) WHEN 1 THEN 'B' WHEN 2 THEN chr(65 + CAST(n_chars % 4 AS INTEGER)) WHEN 3 THEN NULL WHEN 4 THEN 'C' WHEN 5 THEN NULL ELSE CASE WHEN lang = 'en' THEN 'A' END END AS answer,
  CASE WHEN doc_id % 2 = 0 THEN true ELSE false END AS exact FROM documents""")
def named_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replies that name an option bare, between affixes, twice, by its text, or not at all."""
    k = F.col("doc_id") % 7
    letter = lambda n: F.char(65 + F.col("n_chars") % n)
    reply = (
        F.when(k == 0, F.concat(F.lit("it is "), letter(5))).when(k == 1, "A thing that is clear: (B).").when(k == 2, F.concat(F.lit("I say "), letter(4), F.lit(", not that"))).when(k == 3, "B or C")
        .when(k == 4, "Perhaps A or so, but the GREEN one").when(k == 5, "red or blue").otherwise(F.when(F.col("lang") == "en", "the Red").otherwise("who knows")))
    options = F.array(F.lit("red"), F.lit("blue"), F.lit("green"))
    given = F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("("), letter(26), F.lit(") because"))).otherwise(F.concat(F.lit("no "), letter(26)))
    return table(spark, sf_dir, "documents").select("doc_id", CH.named_option(reply, options).alias("answer"), CH.letter_or_exact(given, letter(26)).alias("exact"))


@query("box_sequences", """
WITH v AS (SELECT vec_id, vec_id % 5 AS d, 1 + vec_id % 3 AS n FROM embeddings)
SELECT vec_id, CASE WHEN vec_id % 4 = 3 THEN 0.0 ELSE (10.0 - d) * 20 / (400 - (10.0 - d) * 20) END AS tracked FROM v""")
def box_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tracks of one to three boxes, replies in marks or lists that are moved aside, in every fourth with a box too many."""
    k = F.col("vec_id")
    d, n = (k % 5).cast("double"), (k % 3).cast("int")
    box = lambda i, dx, a, b: F.concat(F.lit(a), (i * 100 + dx).cast("string"), F.lit(", 0, "), (i * 100 + 10 + dx).cast("string"), F.lit(", 20"), F.lit(b))
    many = lambda more, dx, a, b, sep: F.array_join(F.transform(F.sequence(F.lit(0), n + more), lambda i: box(i, dx, a, b)), sep)
    more = F.when(k % 4 == 3, 1).otherwise(0)
    reply = F.when(k % 2 == 0, F.concat(F.lit("Here: "), many(more, d, "<box>", "</box>", " then "))).otherwise(F.concat(F.lit("["), many(more, d, "(", ")", ", "), F.lit("]")))
    gold = F.concat(F.lit("["), many(F.lit(0), F.lit(0.0), "[", "]", ", "), F.lit("]"))
    return table(spark, sf_dir, "embeddings").select("vec_id", B.sequence_iou(B.boxes_of(reply), B.boxes_of(gold)).alias("tracked"))


@query("sentence_bleu")
def sentence_bleu(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean BLEU of single turns against the next turn, by role; tested against a plain count."""
    talk = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    pairs = J.following(talk, "conv_id", ["turn", "role", "text"], "text", "ref")
    return pairs.groupBy("role").agg(F.avg(C.sentence_bleu_score(F.col("text"), F.col("ref"))).alias("bleu"))


@query("weighted_token_f1", r"""
WITH n AS (SELECT * FROM (SELECT conv_id, role, text, lead(text) OVER w AS ref, lead(true) OVER w AS has FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)) n WHERE has),
w AS (SELECT conv_id, list_distinct(list_filter(string_split_regex(trim(text), '\s+'), lambda x: x <> '')) AS a, list_distinct(list_filter(string_split_regex(trim(ref), '\s+'), lambda x: x <> '')) AS b, conv_id % 4 AS g FROM n),
s AS (SELECT g, conv_id, avg(CASE WHEN len(list_intersect(a, b)) = 0 THEN 0.0 ELSE 2.0 * len(list_intersect(a, b)) / (len(a) + len(b)) END) AS f1, count(*) AS k FROM w GROUP BY g, conv_id)
SELECT g, count(*) AS groups, sum(f1 * k) / sum(k) AS f1 FROM s GROUP BY g""")
def weighted_token_f1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word-set F1 of turns and the next ones, by conversation, and over conversations with their numbers of turns as weights."""
    talk = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    pairs = J.following(talk, "conv_id", ["turn", "role", "text"], "text", "ref")
    each = pairs.groupBy("conv_id").agg(F.avg(T.token_set_f1(F.col("text"), F.col("ref"))).alias("f"), F.count(F.lit(1)).alias("k"))
    return each.groupBy((F.col("conv_id") % 4).alias("g")).agg(F.count(F.lit(1)).alias("groups"), (F.sum(F.col("f") * F.col("k")) / F.sum("k")).alias("f1"))


@query("exact_set_groups", """
WITH c AS (SELECT conv_id, array_to_string(list_sort(list_distinct(list(role))), '+') AS roles, count(*) AS n FROM conversations GROUP BY conv_id)
SELECT roles, count(*) AS n_members, avg(n) AS mean_turns FROM c GROUP BY roles""")
def exact_set_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations grouped by exactly the set of roles that they have."""
    talk = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_join(F.array_sort(F.collect_set("role")), "+").alias("roles"), F.count(F.lit(1)).alias("n"))
    return talk.groupBy("roles").agg(F.count(F.lit(1)).alias("n_members"), F.avg("n").alias("mean_turns"))


@query("extraction_summary", """
WITH p AS (SELECT len(regexp_extract_all(html, '<p>')) AS n, strlen(html) / 1000.0 AS s FROM pages)
SELECT count(*) AS n_files, count(*) FILTER (n > 0) AS n_valid, CAST(sum(n) AS BIGINT) AS n_items, coalesce(sum(n) / nullif(count(*) FILTER (n > 0), 0), 0.0) AS items_per_valid, avg(s) AS seconds_per_file FROM p""")
def extraction_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as files whose items are their paragraphs; their size stands for the time they took."""
    files = table(spark, sf_dir, "pages").select(F.regexp_count("html", F.lit("<p>")).alias("n"), (F.octet_length("html") / 1000.0).alias("s"))
    return A.extraction_summary(files, "n", "s")


@query("route_counts", r"""
WITH p AS (SELECT *, regexp_extract(url, '://([^/?#]*)', 1) AS host, strlen(html) AS n FROM pages)
SELECT page_id % 2 AS side, count(*) AS total, count(*) FILTER (starts_with(host, 'm.') OR starts_with(host, 'blog.')) AS mirrored, count(*) FILTER (contains(url, '#') OR contains(url, '?')) AS decorated,
  count(*) FILTER (n < 1000) AS too_small, count(*) FILTER (n >= 1000) AS large_enough, count(*) FILTER (contains(html, '<img')) AS with_image FROM p GROUP BY page_id % 2""")
def route_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many pages of each half took each route of the processing."""
    host, n = F.regexp_extract("url", "://([^/?#]*)", 1), F.octet_length("html")
    routes = {"mirrored": F.startswith(host, F.lit("m.")) | F.startswith(host, F.lit("blog.")), "decorated": F.contains("url", F.lit("#")) | F.contains("url", F.lit("?")), "too_small": n < 1000, "large_enough": n >= 1000, "with_image": F.contains("html", F.lit("<img"))}
    return A.route_counts(table(spark, sf_dir, "pages").withColumn("side", F.col("page_id") % 2), routes, ["side"])


@query("open_responses", """
WITH d AS (SELECT doc_id, n_chars, doc_id % 6 AS k, n_chars % 3 = 0 AS w FROM documents)
SELECT doc_id, CASE k WHEN 0 THEN NOT w WHEN 1 THEN true WHEN 2 THEN NOT w WHEN 3 THEN false WHEN 4 THEN true ELSE NOT w END AS correct FROM d""")
def open_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replies that lead to a number, a word or a letter in several ways, against the gold ones."""
    k, n = F.col("doc_id") % 6, F.col("n_chars")
    off = F.when(n % 3 == 0, 1).otherwise(0)
    s = lambda c: c.cast("string")
    reply = (
        F.when(k == 0, F.concat(F.lit("Let me see: 7 and 8.\nSo the answer is "), s(n + off), F.lit("."))).when(k == 1, F.concat(F.lit("x = "), F.format_string("%,d", n * 1000), F.lit("\ntherefore it IS Blue")))
        .when(k == 2, F.concat(F.lit("n = 3 = "), s(n + off), F.lit(".004"))).when(k == 3, "no idea").when(k == 4, "Final Result is option b here").otherwise(F.concat(F.lit("thus 1"), s(n + off), F.lit("e2 it could be "), s(n), F.lit("1 "))))
    gold = (
        F.when(k == 0, F.array(s(n))).when(k == 1, F.array(F.lit("red"), F.lit("BLUE"))).when(k == 2, F.array(F.lit("x"), F.concat(s(n), F.lit(".00")))).when(k == 3, F.array(F.lit("an idea"), s(n)))
        .when(k == 4, F.array(F.lit("B"))).otherwise(F.array(F.concat(s(n + off), F.lit("1")))))
    return table(spark, sf_dir, "documents").select("doc_id", CH.open_match(reply, gold).alias("correct"))


@query("page_text_overlap", r"""
WITH n AS (SELECT * FROM (SELECT conv_id, turn, role, text, lead(text) OVER w AS ref, lead(true) OVER w AS has FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)) n WHERE has),
w AS (SELECT role, list_distinct(list_filter(string_split_regex(text, '\s+'), lambda x: x <> '')) AS a, list_distinct(list_filter(string_split_regex(ref, '\s+'), lambda x: x <> '')) AS b FROM n),
s AS (SELECT role, len(list_intersect(a, b)) AS k, len(a) AS a, len(b) AS b FROM w)
SELECT role, avg(coalesce(k / nullif(a, 0), 0)) AS precision, avg(coalesce(k / nullif(b, 0), 0)) AS recall, avg(coalesce(2 * k / nullif(a + b, 0), 0)) AS f_measure FROM s GROUP BY role""")
def page_text_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns as read pages against the next ones, by role."""
    return _page_scores(spark, sf_dir, ["precision", "recall", "f_measure"])


@query("page_text_edits")
def page_text_edits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean share of character edits, by role; tested against a plain table of distances."""
    return _page_scores(spark, sf_dir, ["edits"])


def _page_scores(spark: SparkSession, sf_dir: str, names: list[str]) -> DataFrame:
    talk = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    pairs = J.following(talk, "conv_id", ["turn", "role", "text"], "text", "ref")
    scores = pairs.select("role", C.page_text_scores(F.col("text"), F.col("ref")).alias("s"))
    return scores.groupBy("role").agg(*[F.avg(f"s.{n}").alias(n) for n in names])
