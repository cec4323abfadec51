"""Queries of answer normalisers, caption metrics, structured scores, requests and batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from minewright.functions import answers as A
from minewright.functions import names as N
from minewright.functions import text as T
from minewright.functions import trees
from minewright.operators import captions as C
from minewright.operators import filters as R
from minewright.operators import joins as J
from minewright.operators import requests as Q
from minewright.operators import structured as S
from minewright.plans.catalog import query
from minewright.staging import table


def _sql(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _cases(pairs: dict[str, str]) -> str:
    return "CASE w " + " ".join(f"WHEN {_sql(k)} THEN {_sql(v)}" for k, v in pairs.items()) + " ELSE w END"


_SPACES = "' ' || chr(9) || chr(10) || chr(13) || chr(12) || chr(11)"
_MARKED = "x"
for _p in A.MARKS:
    _MARKED = f"replace({_MARKED}, {_sql(_p)}, CASE WHEN contains(x, {_sql(_p + ' ')}) OR contains(x, {_sql(' ' + _p)}) THEN '' ELSE ' ' END)"


@query("vqa_answers", f"""
WITH a AS (SELECT conv_id, turn, trim(translate(trim(replace(translate(lower(text), ',?', ''), '''s', ' ''s'), {_SPACES}), chr(10) || chr(9), '  ')) AS x FROM conversations),
b AS (SELECT conv_id, turn, string_split(regexp_replace({_MARKED}, '\\.([0-9])', chr(1) || '\\1', 'g'), '.') AS l FROM a),
c AS (SELECT conv_id, turn, replace(array_to_string(l[1:{A.STOPS}], '') || array_to_string(l[{A.STOPS + 1}:], '.'), chr(1), '.') AS y FROM b),
d AS (SELECT conv_id, turn, list_filter(list_transform(list_filter(string_split_regex(trim(y), '\\s+'), lambda w: w <> ''), lambda w: {_cases(A.NUMBER_WORDS)}), lambda w: w NOT IN ('a', 'an', 'the')) AS l FROM c)
SELECT conv_id, turn, array_to_string(list_transform(l, lambda w: {_cases(A.CONTRACTIONS)}), ' ') AS answer FROM d""")
def vqa_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", A.vqa_answer(F.col("text")).alias("answer"))


@query("detokenize", r"""
SELECT conv_id, turn, regexp_replace(replace(replace(replace(replace(replace(text, ' n''t', 'n''t'), ' )', ')'), '( ', '('), '" ', '"'), ' "', '"'), ' ([''.,])', '\1', 'g') AS plain
FROM (SELECT conv_id, turn, replace(replace(text, '.', ' .'), ',', ' ,') AS text FROM conversations) t""")
def detokenize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns whose stops and commas stand apart, put together again."""
    apart = F.replace(F.replace("text", F.lit("."), F.lit(" .")), F.lit(","), F.lit(" ,"))
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", A.detokenize(apart).alias("plain"))


_TYPED = """
SELECT p_partkey, [p_type, p_brand, p_name] AS choices, CASE p_partkey % 3 WHEN 0 THEN 'choice' WHEN 1 THEN 'integer' ELSE 'float' END AS kind,
  CASE p_partkey % 3 WHEN 0 THEN CASE p_partkey % 4 WHEN 0 THEN 'it is (b) I think' WHEN 1 THEN ' C ' WHEN 2 THEN substr(p_type, 3) ELSE p_name || 'x' END WHEN 1 THEN CASE WHEN p_partkey % 5 = 0 THEN 'many' ELSE CAST(p_retailprice AS VARCHAR) END ELSE CAST(p_retailprice AS VARCHAR) END AS reply
FROM part"""


@query("typed_answers", f"""
WITH t AS ({_TYPED}),
n AS (SELECT *, CASE WHEN regexp_extract(trim(reply), '\\(([a-zA-Z])\\)', 1) <> '' THEN upper(regexp_extract(trim(reply), '\\(([a-zA-Z])\\)', 1)) ELSE trim(reply) END AS named FROM t)
SELECT p_partkey, CASE kind
  WHEN 'choice' THEN CASE WHEN named IN ('A', 'B', 'C') THEN choices[ascii(named) - 64]
    ELSE list_sort([{{'d': levenshtein(named, choices[1]), 'i': 1, 'c': choices[1]}}, {{'d': levenshtein(named, choices[2]), 'i': 2, 'c': choices[2]}}, {{'d': levenshtein(named, choices[3]), 'i': 3, 'c': choices[3]}}])[1].c END
  WHEN 'integer' THEN CAST(CAST(trunc(TRY_CAST(trim(reply) AS DOUBLE)) AS BIGINT) AS VARCHAR)
  ELSE printf('%.1f', TRY_CAST(trim(reply) AS DOUBLE)) END AS answer
FROM n""")
def typed_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replies that name a choice by letter or by a misspelt text, a whole number, or a rounded one."""
    k, kind = F.col("p_partkey"), F.element_at(F.array(F.lit("choice"), F.lit("integer"), F.lit("float")), (F.col("p_partkey") % 3 + 1).cast("int"))
    named = F.when(k % 4 == 0, "it is (b) I think").when(k % 4 == 1, " C ").when(k % 4 == 2, F.substring("p_type", F.lit(3), F.length("p_type"))).otherwise(F.concat("p_name", F.lit("x")))
    price = F.col("p_retailprice").cast("string")
    reply = F.when(k % 3 == 0, named).when((k % 3 == 1) & (k % 5 == 0), "many").otherwise(price)
    return table(spark, sf_dir, "part").select("p_partkey", A.typed_answer(reply, F.array("p_type", "p_brand", "p_name"), kind, F.lit(1)).alias("answer"))


@query("choice_by_text", r"""
WITH t AS (SELECT p_partkey, trim(p_type) AS a, trim(p_name) AS b, trim(regexp_replace(CASE WHEN p_partkey % 3 = 0 THEN 'it must be ' || p_name || '!' WHEN p_partkey % 3 = 1 THEN p_type || ', not ' || p_name ELSE 'no idea.' END, '[^a-zA-Z0-9_\s]', '', 'g')) AS r FROM part)
SELECT p_partkey, CASE WHEN contains(r, a) AND (NOT contains(r, b) OR instr(r, a) <= instr(r, b)) THEN 'A' WHEN contains(r, b) THEN 'B' ELSE r END AS answer FROM t""")
def choice_by_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Choices mined from the question, met in replies by their text."""
    k = F.col("p_partkey")
    question = F.concat(F.lit("Which one?\nA. "), "p_type", F.lit("\nB. "), "p_name")
    reply = F.when(k % 3 == 0, F.concat(F.lit("it must be "), "p_name", F.lit("!"))).when(k % 3 == 1, F.concat("p_type", F.lit(", not "), "p_name")).otherwise("no idea.")
    return table(spark, sf_dir, "part").select("p_partkey", R.choice_text(question, F.array(reply, F.lit("unread"))).alias("answer"))


#: Each turn's whole text with the next turn's of its conversation.
_NEXT = "SELECT * FROM (SELECT conv_id, turn, role, text, lead(text) OVER w AS ref, lead(true) OVER w AS has FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)) n WHERE has"


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    talk = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return J.following(talk, "conv_id", ["turn", "role", "text"], "text", "ref")


_W = r"list_filter(string_split_regex(trim({x}), '\s+'), lambda w: w <> '')"


@query("short_or_near", f"""
WITH t AS (SELECT conv_id, turn, replace(trim(lower(text)), chr(10), ' ') AS p, replace(trim(lower(ref)), chr(10), ' ') AS r, array_to_string({_W.format(x='lower(ref)')}[1:2], ' ') AS s FROM ({_NEXT}) n)
SELECT conv_id, turn, greatest(CASE WHEN contains(p, s) THEN 1.0 ELSE 0.0 END, CASE WHEN len({_W.format(x='r')}) < 5 THEN CASE WHEN contains(p, r) THEN 1.0 ELSE 0.0 END
  WHEN greatest(length(p), length(r)) = 0 THEN 1.0 WHEN 1 - levenshtein(p, r) / greatest(length(p), length(r)) >= 0.5 THEN 1 - levenshtein(p, r) / greatest(length(p), length(r)) ELSE 0.0 END) AS score,
  CASE WHEN contains(p, s) OR contains(p, r) THEN 1 ELSE 0 END AS contained FROM t""")
def short_or_near(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A turn against the first two words of the next and the whole of it."""
    refs = F.array(F.array_join(F.slice(T.words(F.lower("ref")), 1, 2), " "), F.col("ref"))
    return _pairs(spark, sf_dir).select("conv_id", "turn", A.short_or_near(F.col("text"), refs).alias("score"), A.contains_answer(F.col("text"), refs).alias("contained"))


@query("multiset_f1", f"""
WITH t AS (SELECT conv_id, turn, {_W.format(x='lower(text)')} AS a, {_W.format(x='lower(ref)')} AS b FROM ({_NEXT}) n),
c AS (SELECT conv_id, turn, len(a) AS m, len(b) AS n, coalesce(list_sum(list_transform(list_distinct(list_intersect(a, b)), lambda t: least(len(list_filter(a, lambda x: x = t)), len(list_filter(b, lambda x: x = t))))), 0) AS shared FROM t)
SELECT conv_id, turn, CASE WHEN m = 0 OR n = 0 THEN CASE WHEN m = n THEN 1.0 ELSE 0.0 END ELSE 2.0 * shared / (m + n) END AS f1 FROM c""")
def multiset_f1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pairs(spark, sf_dir).select("conv_id", "turn", A.multiset_f1(T.words(F.lower("text")), T.words(F.lower("ref"))).alias("f1"))


@query("simple_match", """
SELECT p_brand, avg(CASE WHEN lower(translate(p_name, ' -.' || chr(10) || chr(9), '')) = lower(translate(CASE WHEN p_partkey % 2 = 0 THEN replace(upper(p_name), ' ', '-') ELSE p_name || ' x' END, ' -.' || chr(10) || chr(9), '')) THEN 1.0 ELSE 0.0 END) AS simple,
  sum(CASE WHEN p_size - 25 <= 0 AND p_partkey % 5 - 2 <= 0 THEN 0 ELSE 1 END) AS scored, sum(CASE WHEN p_size - 25 <= 0 AND p_partkey % 5 - 2 <= 0 THEN 0 WHEN p_size - 25 = p_partkey % 5 - 2 THEN 1 ELSE 0 END) AS right_ints
FROM part GROUP BY p_brand""")
def simple_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    reply = F.when(k % 2 == 0, F.replace(F.upper("p_name"), F.lit(" "), F.lit("-"))).otherwise(F.concat("p_name", F.lit(" x")))
    whole = A.positive_int_match((k % 5 - 2).cast("string"), (F.col("p_size") - 25).cast("string"))
    return table(spark, sf_dir, "part").groupBy("p_brand").agg(
        F.avg(A.simple_match(reply, F.col("p_name")).cast("double")).alias("simple"), F.sum((whole >= 0).cast("long")).alias("scored"), F.sum(F.greatest(whole, F.lit(0))).alias("right_ints"))


@query("near_names", """
SELECT p_partkey, p_partkey % 2 = 0 AS near, p_partkey % 3 = 0 AS same FROM part""")
def near_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names in another case and order of two letters are near, their first letters alone are not; numbers agree in every third row."""
    from minewright.functions import choices

    k, name = F.col("p_partkey"), F.concat(F.col("p_name"), F.lit(" of some length"))
    swapped = F.concat(F.substring(name, 2, 1), F.substring(name, 1, 1), F.upper(F.substring(name, F.lit(3), F.length(name))))
    other = F.when(k % 2 == 0, swapped).otherwise(F.substring(name, 1, 4))
    number = F.concat(F.lit("so "), (F.col("p_size") + F.when(k % 3 == 0, 0).otherwise(1)).cast("string"))
    return table(spark, sf_dir, "part").select(
        "p_partkey", choices.scored(choices.near_match, other, name, "boolean").alias("near"), choices.scored(choices.numeric_match, number, F.col("p_size").cast("string"), "boolean").alias("same"))


@query("latex_answers", """
SELECT p_partkey, p_partkey % 2 = 0 AS equal, p_partkey % 2 = 0 AS sets FROM part""")
def latex_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    r"""Sizes as ``\dfrac`` of themselves and two, against decimals, and two numbers in another order."""
    q, odd = F.col("p_size"), F.col("p_partkey") % 2
    reply = F.concat(F.lit("x = \\left\\dfrac{"), q.cast("string"), F.lit("}{2}\\right"))
    gold = (q / 2 + odd).cast("string")
    pair = F.concat(F.lit("("), (q + 1).cast("string"), F.lit(", \\frac{"), q.cast("string"), F.lit("}{4})"))
    want = F.concat((q / 4).cast("string"), F.lit(","), (q + 1 + 2 * odd).cast("string"))
    return table(spark, sf_dir, "part").select("p_partkey", A.latex_equal(reply, gold).alias("equal"), A.number_sets_equal(pair, want).alias("sets"))


_TOK = "regexp_extract_all(lower({x}), '[a-z0-9]+')"
_GRAMS = """
c AS (SELECT conv_id, turn, {t1} AS a, {t2} AS b FROM ({next}) n),
pg AS (SELECT conv_id, turn, n, gram, count(*) AS c FROM (SELECT conv_id, turn, n, unnest(list_transform(range(1, len(a) - n + 2), lambda i: array_to_string(a[i:i + n - 1], ' '))) AS gram FROM c, (VALUES (1), (2), (3), (4)) v(n)) x GROUP BY ALL),
rg AS (SELECT conv_id, turn, n, gram, count(*) AS c FROM (SELECT conv_id, turn, n, unnest(list_transform(range(1, len(b) - n + 2), lambda i: array_to_string(b[i:i + n - 1], ' '))) AS gram FROM c, (VALUES (1), (2), (3), (4)) v(n)) x GROUP BY ALL)""".format(t1=_TOK.format(x="text"), t2=_TOK.format(x="ref"), next=_NEXT)


@query("caption_bleu", f"""
WITH {_GRAMS},
o AS (SELECT n, sum(least(pg.c, coalesce(rg.c, 0))) AS m, sum(pg.c) AS t FROM pg LEFT JOIN rg USING (conv_id, turn, n, gram) GROUP BY n),
z AS (SELECT CASE WHEN sum(len(a)) >= sum(len(b)) THEN 0.0 ELSE 1 - sum(len(b)) / sum(len(a)) END AS brief FROM c),
k AS (SELECT k, min(m) AS least, sum(ln(CASE WHEN m > 0 THEN m / t ELSE 1 END)) / k AS logs FROM (VALUES (1), (2), (3), (4)) v(k) JOIN o ON n <= k GROUP BY k)
SELECT max(CASE WHEN k = 1 THEN s END) AS bleu_1, max(CASE WHEN k = 2 THEN s END) AS bleu_2, max(CASE WHEN k = 3 THEN s END) AS bleu_3, max(CASE WHEN k = 4 THEN s END) AS bleu_4
FROM (SELECT k, CASE WHEN least > 0 THEN exp(logs + brief) ELSE 0.0 END AS s FROM k, z) x""")
def caption_bleu(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.bleu_scores(_pairs(spark, sf_dir), ["conv_id", "turn"], "text", "ref")


@query("caption_consensus", f"""
WITH {_GRAMS},
df AS (SELECT n, gram, count(*) AS df FROM rg GROUP BY n, gram), logs AS (SELECT ln(count(*)) AS g FROM c),
wa AS (SELECT conv_id, turn, pg.n, pg.gram, pg.c * (g - ln(greatest(coalesce(df, 0), 1))) AS w FROM pg LEFT JOIN df ON pg.n = df.n AND pg.gram = df.gram, logs),
wb AS (SELECT conv_id, turn, rg.n, rg.gram, rg.c * (g - ln(greatest(df, 1))) AS w FROM rg JOIN df ON rg.n = df.n AND rg.gram = df.gram, logs),
na AS (SELECT conv_id, turn, n, sqrt(sum(w * w)) AS v FROM wa GROUP BY ALL), nb AS (SELECT conv_id, turn, n, sqrt(sum(w * w)) AS v FROM wb GROUP BY ALL),
d AS (SELECT conv_id, turn, n, sum(least(wa.w, wb.w) * wb.w) AS dot FROM wa JOIN wb USING (conv_id, turn, n, gram) GROUP BY ALL),
s AS (SELECT conv_id, turn, sum(CASE WHEN na.v = 0 OR nb.v = 0 THEN dot ELSE dot / (na.v * nb.v) END) AS s FROM d JOIN na USING (conv_id, turn, n) JOIN nb USING (conv_id, turn, n) GROUP BY ALL)
SELECT conv_id, turn, 10 * coalesce(s, 0) / 4 * exp(-pow(greatest(len(a) - 1, 0) - greatest(len(b) - 1, 0), 2) / 72.0) AS score FROM c LEFT JOIN s USING (conv_id, turn)""")
def caption_consensus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.consensus_scores(_pairs(spark, sf_dir), ["conv_id", "turn"], "text", "ref")


@query("caption_rouge_l")
def caption_rouge_l(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean of the longest common subsequences' F-measures by role; tested against brute force."""
    return _pairs(spark, sf_dir).groupBy("role").agg(F.avg(C.rouge_l(F.col("text"), F.col("ref"))).alias("rouge_l"))


@query("chrf", rf"""
WITH c AS (SELECT conv_id, turn, role, regexp_replace(text, '\s+', '', 'g') AS a, regexp_replace(ref, '\s+', '', 'g') AS b FROM ({_NEXT}) n),
v(n) AS (VALUES (1), (2), (3), (4), (5), (6)),
pg AS (SELECT conv_id, turn, role, n, gram, count(*) AS c FROM (SELECT conv_id, turn, role, n, unnest(list_transform(range(1, length(a) - n + 2), lambda i: substr(a, i, n))) AS gram FROM c, v) x GROUP BY ALL),
rg AS (SELECT conv_id, turn, role, n, gram, count(*) AS c FROM (SELECT conv_id, turn, role, n, unnest(list_transform(range(1, length(b) - n + 2), lambda i: substr(b, i, n))) AS gram FROM c, v) x GROUP BY ALL),
s AS (SELECT role, n, sum(least(coalesce(pg.c, 0), coalesce(rg.c, 0))) AS m, sum(coalesce(pg.c, 0)) AS p, sum(coalesce(rg.c, 0)) AS r FROM pg FULL JOIN rg USING (conv_id, turn, role, n, gram) GROUP BY role, n),
w AS (SELECT role, avg(m / p) AS p, avg(m / r) AS r FROM s WHERE p > 0 AND r > 0 GROUP BY role)
SELECT role, 100 * coalesce(5 * p * r / nullif(4 * p + r, 0), 0) AS chrf FROM w""")
def chrf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.chrf(_pairs(spark, sf_dir), ["role"], ["conv_id", "turn"], "text", "ref")


@query("character_error_rate")
def character_error_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By role; tested against brute force, as the other engine's edit distance counts bytes."""
    return C.character_error_rate(_pairs(spark, sf_dir), ["role"], "text", "ref")


def _fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four fields of each order as a structured reply has them."""
    k, price = F.col("o_orderkey"), F.floor("o_totalprice")
    field = lambda name, metric, reply, target, weight: F.struct(F.lit(name).alias("field"), F.lit(metric).alias("metric"), reply.cast("string").alias("response"), target.cast("string").alias("target"), F.lit(weight).alias("weight"))
    fields = F.array(
        field("status", "exact", F.when(k % 3 == 0, "F").otherwise(F.col("o_orderstatus")), F.col("o_orderstatus"), 1.0),
        field("price", "number_ratio", F.floor(price * 1.25), price, 2.0),
        field("priority", "simple", F.when(k % 5 == 0, None).otherwise(F.replace(F.upper("o_orderpriority"), F.lit("-"), F.lit(" "))), F.col("o_orderpriority"), 1.0),
        field("count", "positive_int", F.col("o_custkey") % 5 - 2, k % 3 - 1, 4.0))
    return table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("task"), k.alias("item"), F.when(F.col("o_custkey") % 2 == 0, "min").otherwise("mean").alias("combine"), F.inline(fields))


_ITEMS = """
f AS (SELECT o_orderpriority AS task, o_orderkey AS item, o_custkey % 2 = 0 AS least,
  CASE WHEN CASE WHEN o_orderkey % 3 = 0 THEN 'F' ELSE o_orderstatus END = o_orderstatus THEN 1.0 ELSE 0.0 END AS a,
  CASE WHEN floor(o_totalprice) = 0 THEN 1.0 ELSE greatest(0.0, 1 - abs((floor(floor(o_totalprice) * 1.25) - floor(o_totalprice)) / floor(o_totalprice))) END AS b,
  CASE WHEN o_orderkey % 5 = 0 THEN 0.0 ELSE 1.0 END AS c,
  CASE WHEN o_custkey % 5 - 2 <= 0 AND o_orderkey % 3 - 1 <= 0 THEN -1.0 WHEN o_custkey % 5 - 2 = o_orderkey % 3 - 1 THEN 1.0 ELSE 0.0 END AS d FROM orders),
i AS (SELECT task, item, CASE WHEN least THEN least(a, b, c, CASE WHEN d < 0 THEN 1.0 ELSE d END) WHEN d < 0 THEN (a + 2 * b + c) / 4 ELSE (a + 2 * b + c + 4 * d) / 8 END AS score FROM f)"""


@query("structured_tasks", f"WITH {_ITEMS} SELECT task, count(*) AS n_items, avg(score) AS score FROM i GROUP BY task")
def structured_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.task_scores(S.item_scores(S.field_scores(_fields(spark, sf_dir), python=False)))


@query("structured_summary", f"WITH {_ITEMS}, t AS (SELECT task, count(*) AS n, avg(score) AS s FROM i GROUP BY task) SELECT count(*) AS n_tasks, CAST(sum(n) AS BIGINT) AS n_items, avg(s) AS macro, sum(n * s) / sum(n) AS micro FROM t")
def structured_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.summary(structured_tasks(spark, sf_dir))


@query("reply_parsers", r"""
SELECT p_partkey, CASE p_partkey % 4 WHEN 3 THEN p_name ELSE p_type END AS answer, CASE WHEN p_partkey % 2 = 0 THEN p_size END AS size FROM part""")
def reply_parsers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers behind a mark, in a code block, in quotes, or bare; a number from the braces of a reply that has some."""
    k = F.col("p_partkey")
    reply = (
        F.when(k % 4 == 0, F.concat(F.lit("I think.\nAnswer: no\nANSWER : "), "p_type")).when(k % 4 == 1, F.concat(F.lit("Answer:\n```text\n"), "p_type", F.lit("\n```\nso")))
        .when(k % 4 == 2, F.concat(F.lit("answer: \""), "p_type", F.lit("\""))).otherwise(F.col("p_name")))
    braces = F.when(k % 2 == 0, F.concat(F.lit("so {\"size\": "), F.col("p_size").cast("string"), F.lit("} then"))).otherwise("none")
    return table(spark, sf_dir, "part").select("p_partkey", A.answer_part(reply).alias("answer"), A.json_part(braces, "size int")["size"].alias("size"))


@query("choice_requests", """
WITH c AS (SELECT c_custkey, c_name, [c_mktsegment, 'nothing', 'all of it'] AS l FROM customer),
r AS (SELECT c_custkey, c_name, l, unnest(range(0, 6)) AS idx FROM c)
SELECT c_custkey, CAST(idx AS INTEGER) AS idx, CASE WHEN idx < 3 THEN c_name ELSE '' END AS context, l[idx % 3 + 1] AS continuation FROM r""")
def choice_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_name", F.array("c_mktsegment", F.lit("nothing"), F.lit("all of it")).alias("choices"))
    return Q.choice_requests(rows, "c_custkey", "c_name", "choices", unconditional=True)


@query("loss_predictions", """
WITH t AS (SELECT l_orderkey, l_linenumber, [l_quantity, l_tax * 300, l_discount * 300] AS c, [l_tax * 100, l_discount * 100, l_quantity / 10] AS u, l_linenumber - 4 AS g FROM lineitem)
SELECT l_orderkey, l_linenumber, CAST(list_position(c, list_min(c)) - 1 AS INTEGER) AS least,
  CAST(list_position(list_transform(c, lambda x, i: x / i), list_min(list_transform(c, lambda x, i: x / i))) - 1 AS INTEGER) AS by_length,
  CAST(list_position(list_transform(c, lambda x, i: x - u[i]), list_max(list_transform(c, lambda x, i: x - u[i]))) - 1 AS INTEGER) AS gained,
  CAST(CASE WHEN g >= -3 AND g < 0 THEN g + 3 WHEN g >= 0 AND g < 3 THEN g ELSE -100 END AS INTEGER) AS gold FROM t""")
def loss_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Choices by loss, by loss for its length, and by gain over the loss without context; gold places outside the choices are marked."""
    c, u = F.array("l_quantity", F.col("l_tax") * 300, F.col("l_discount") * 300), F.array(F.col("l_tax") * 100, F.col("l_discount") * 100, F.col("l_quantity") / 10)
    sizes = F.array(*[F.lit(float(i)) for i in (1, 2, 3)])
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", Q.choose(c).alias("least"), Q.choose(c, sizes).alias("by_length"), Q.mutual_information(c, u).alias("gained"), Q.gold_or_none(F.col("l_linenumber") - 4, c).cast("int").alias("gold"))


@query("few_shot_examples", """
WITH p AS (SELECT doc_id, lang || '/' || source AS t FROM documents),
d AS (SELECT doc_id AS f, t, row_number() OVER (ORDER BY md5(doc_id || ':5'), doc_id) AS h FROM p QUALIFY h <= 5),
m AS (SELECT p.doc_id, d.t AS example, row_number() OVER (PARTITION BY p.doc_id ORDER BY h) - 1 AS shot FROM p JOIN d ON d.f <> p.doc_id)
SELECT doc_id, CAST(shot AS INTEGER) AS shot, example FROM m WHERE shot < 4""")
def few_shot_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select("doc_id", F.concat_ws("/", "lang", "source").alias("t"))
    return Q.few_shot(rows, rows, "doc_id", "t", 4, seed=5)


@query("shuffled_choices", """
WITH t AS (SELECT p_partkey, list_sort(list_transform(list_distinct([{'ok': true, 'c': p_type}, {'ok': false, 'c': p_brand}, {'ok': false, 'c': p_name}]), lambda x: {'h': md5(p_partkey || ':0:' || x.c), 'ok': x.ok, 'c': x.c})) AS o FROM part)
SELECT p_partkey, array_to_string(list_transform(o, lambda x: x.c), '|') AS choices, chr(64 + CAST(list_position(list_transform(o, lambda x: x.ok), true) AS INTEGER)) AS answer FROM t""")
def shuffled_choices(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "part").select("p_partkey", "p_type", F.array("p_brand", "p_name").alias("wrong"))
    return Q.shuffled_choices(rows, "p_partkey", "p_type", "wrong").select("p_partkey", F.array_join("choices", "|").alias("choices"), "answer")


@query("length_order", "SELECT doc_id, CAST((row_number() OVER (ORDER BY n_chars DESC, doc_id) - 1) // 16 AS BIGINT) AS batch FROM documents")
def length_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents longest first, sixteen at a time, in their first order again."""
    return Q.restored(Q.by_length(table(spark, sf_dir, "documents").select("doc_id", "n_chars"), "doc_id", "n_chars", 16), "doc_id").select("doc_id", "batch")


@query("variable_length_groups", """
WITH a AS (SELECT doc_id, (row_number() OVER (ORDER BY n_chars DESC, doc_id) - 1) // 64 AS mega FROM documents),
b AS (SELECT doc_id, row_number() OVER (ORDER BY mega, md5(doc_id || ':0') DESC, doc_id) AS mixed FROM a)
SELECT doc_id, row_number() OVER (ORDER BY md5((mixed - 1) // 8 || ':1'), (mixed - 1) // 8, mixed) AS place FROM b""")
def variable_length_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.variable_length_groups(table(spark, sf_dir, "documents").select("doc_id", "n_chars"), "doc_id", "n_chars", 4, 2).select("doc_id", "place")


@query("modality_batches", """
WITH a AS (SELECT doc_id, doc_id % 3 = 0 AS image, (row_number() OVER (PARTITION BY doc_id % 3 = 0 ORDER BY md5(doc_id || ':0'), doc_id) - 1) // 8 AS b FROM documents),
s AS (SELECT *, count(*) OVER (PARTITION BY image, b) AS n FROM a)
SELECT doc_id, CASE WHEN n < 8 THEN 'rest' WHEN image THEN 'image ' || b ELSE 'text ' || b END AS mega FROM s""")
def modality_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    signed = F.when(F.col("doc_id") % 3 == 0, F.col("n_chars") + 1).otherwise(-F.col("n_chars") - 1)
    return Q.modality_batches(table(spark, sf_dir, "documents").select("doc_id", signed.alias("length")), "doc_id", "length", 4, 2).select("doc_id", "mega")


_PATH = r"regexp_extract(url, '(?s)^(?:[a-zA-Z][a-zA-Z0-9+.\-]*:)?(?://[^/?#]*)?([^?#;]*)', 1)"


@query("url_file_names", rf"""
WITH p AS (SELECT page_id, string_split({_PATH}, '/') AS l FROM pages),
n AS (SELECT page_id, l, CASE WHEN l[-1] = '' THEN 'image.jpg' ELSE regexp_replace(l[-1], '[<>:"/\\|?*]', '_', 'g') END AS f, list_filter(l, lambda x: contains(x, '.')) AS d FROM p)
SELECT page_id, CASE WHEN contains(f, '.') THEN f WHEN len(d) > 0 THEN regexp_replace(d[-1], '[<>:"/\\|?*]', '_', 'g') ELSE f || '.jpg' END AS file, regexp_replace(array_to_string(l, '/') || '.json', '\.json$', '') AS folder FROM n""")
def url_file_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = F.regexp_extract("url", r"(?s)^(?:[a-zA-Z][a-zA-Z0-9+.\-]*:)?(?://[^/?#]*)?([^?#;]*)", 1)
    return table(spark, sf_dir, "pages").select("page_id", N.file_name_of_url(F.col("url")).alias("file"), N.page_folder(F.concat(path, F.lit(".json"))).alias("folder"))


@query("roles_of_talk", """
SELECT conv_id, array_to_string(list_sort(list_distinct(list(role))), ',') AS roles FROM conversations GROUP BY conv_id""")
def roles_of_talk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The distinct values of a group as one list, as kept per page."""
    return table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_join(F.array_sort(F.collect_set("role")), ",").alias("roles"))


@query("prompts", r"""
SELECT s_suppkey, 'Supplier ' || s_name || ' has ' || CAST(CAST(floor(s_acctbal) AS BIGINT) AS VARCHAR) || '.' || chr(10) || 'A. yes' || chr(10) || 'B. ' || s_name AS prompt,
  regexp_replace(s_name || '/a:b', '["<>:/|\\?*\[\]]+', '__', 'g') AS safe, CASE WHEN length(s_name) > 10 THEN left(s_name, 5) || '...' || right(s_name, 5) ELSE s_name END AS short, length(s_name) < 255 AS fits FROM supplier""")
def prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.col("s_name")
    text = N.rendered("Supplier {{ name }} has {{ balance }}.", name=name, balance=F.floor("s_acctbal"))
    return table(spark, sf_dir, "supplier").select(
        "s_suppkey", N.lettered(text, F.array(F.lit("yes"), name)).alias("prompt"), N.safe_name(F.concat(name, F.lit("/a:b"))).alias("safe"), N.shortened(name, 10).alias("short"), N.path_fits(name).alias("fits"))


@query("normalised_boxes", """
SELECT l_orderkey, l_linenumber, l_quantity / 100 AS x1, l_tax / 2 AS y1, (l_quantity + 10) / 100 AS x2, (l_tax + l_discount) / 2 AS y2 FROM lineitem""")
def normalised_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    box = N.normalised_box(F.col("l_quantity"), F.col("l_tax"), F.lit(10.0), F.col("l_discount"), F.lit(100.0), F.lit(2.0))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", box.alias("b")).select("l_orderkey", "l_linenumber", *[F.col("b")[i].alias(n) for i, n in enumerate(("x1", "y1", "x2", "y2"))])


@query("best_ngrams")
def best_ngrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each part's description the words most like its name; tested on rows whose best is known."""
    reply = F.concat(F.lit("they say that "), F.lower("p_name"), F.lit(" is the one of "), "p_brand")
    return table(spark, sf_dir, "part").select("p_partkey", trees.matched(reply, F.col("p_name")).alias("m")).select("p_partkey", "m.similarity", "m.ngram", "m.precision", "m.recall", "m.f1", "m.jaccard", "m.exact")


@query("record_similarity")
def record_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tree edit similarity of each customer's record with one that lacks a field in every third row."""
    from minewright.functions import choices

    record = F.to_json(F.struct("c_name", F.col("c_nationkey").alias("nation"), F.array("c_mktsegment", F.lit("x")).alias("tags")))
    less = F.to_json(F.struct("c_name", F.array("c_mktsegment", F.lit("x")).alias("tags")))
    reply = F.when(F.col("c_custkey") % 3 == 0, less).otherwise(record)
    return table(spark, sf_dir, "customer").select("c_custkey", choices.scored(trees.record_similarity, reply, record).alias("similarity"))


@query("logged_replies", """
SELECT o_orderkey, CASE WHEN o_orderkey % 4 <> 0 THEN o_orderstatus END AS reply, o_orderkey % 4 <> 0 AS found FROM orders""")
def logged_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replies read back from a log by document, which has some twice and lacks others; the last one logged counts."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    log = orders.where("o_orderkey % 4 <> 0").select("o_orderkey", F.inline(F.array(F.struct(F.lit(1).alias("seq"), F.lit("old").alias("reply")), F.struct(F.lit(2).alias("seq"), F.col("o_orderstatus").alias("reply")))))
    last = log.groupBy("o_orderkey").agg(F.max_by("reply", "seq").alias("reply"))
    return orders.select("o_orderkey").join(last, "o_orderkey", "left").select("o_orderkey", "reply", F.col("reply").isNotNull().alias("found"))
