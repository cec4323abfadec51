"""Queries of text spotting, table similarity, translation edit rate, per-row instructions and tasks scored from tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from minewright.functions import edits as E
from minewright.functions import expressions as X
from minewright.functions import spoken as W
from minewright.functions import tables as T
from minewright.operators import constraints as CO
from minewright.operators import instructions as I
from minewright.operators import joins as J
from minewright.operators import retrieval as R
from minewright.operators import spotting as SP
from minewright.operators import statistics as ST
from minewright.operators import structured as S
from minewright.plans.catalog import query
from minewright.staging import shuffle_width, table


def _boxes(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Sixteen vectors as the gold boxes of an image, placed by their components; found are all of them, moved a little, and read with other marks."""
    part = lambda i, scale, n: (F.floor(F.abs(F.col("embedding")[i].cast("double")) * scale) % n).cast("double")
    lines = table(spark, sf_dir, "embeddings").select(
        F.expr("vec_id div 16").alias("image"), F.col("vec_id").alias("box"), (part(0, 4000, 40) * 6).alias("x"), (part(1, 4000, 10) * 12).alias("y"), (part(2, 4000, 50) + 6).alias("w"), (part(3, 4000, 20) + 8).alias("h"),
        F.col("vec_id").alias("m"), F.concat(F.lit("t"), F.col("label").cast("string")).alias("t"))
    corner = lambda dx, dy: [(F.col("x") + dx).alias("x1"), (F.col("y") + dy).alias("y1"), (F.col("x") + dx + F.col("w")).alias("x2"), (F.col("y") + dy + F.col("h")).alias("y2")]
    gold = lines.select("image", "box", *corner(F.lit(0), F.lit(0)), F.when(F.col("m") % 11 == 0, "###").when(F.col("m") % 3 == 0, F.concat(F.lit("("), "t", F.lit(")"))).otherwise(F.col("t")).alias("text"))
    found = lines.select("image", "box", *corner(F.col("m") % 4, -(F.col("m") % 3)), F.when(F.col("m") % 5 == 0, F.concat("t", F.lit("x"))).when(F.col("m") % 6 == 0, F.concat("t", F.lit(")"))).otherwise(F.lower("t")).alias("text"))
    return gold, found


_SPOTTED = """
l AS (
  SELECT vec_id // 16 AS image, vec_id AS box, floor(abs(CAST(embedding[1] AS DOUBLE)) * 4000) % 40 * 6 AS x, floor(abs(CAST(embedding[2] AS DOUBLE)) * 4000) % 10 * 12 AS y, floor(abs(CAST(embedding[3] AS DOUBLE)) * 4000) % 50 + 6 AS w,
    floor(abs(CAST(embedding[4] AS DOUBLE)) * 4000) % 20 + 8 AS h, vec_id AS m, 't' || label AS t FROM embeddings),
g AS (SELECT image, box, x AS x1, y AS y1, x + w AS x2, y + h AS y2, CASE WHEN m % 11 = 0 THEN '###' WHEN m % 3 = 0 THEN '(' || t || ')' ELSE t END AS text FROM l),
d AS (SELECT image, box, x + m % 4 AS x1, y - m % 3 AS y1, x + m % 4 + w AS x2, y - m % 3 + h AS y2, CASE WHEN m % 5 = 0 THEN t || 'x' WHEN m % 6 = 0 THEN t || ')' ELSE lower(t) END AS text FROM l),
p AS (
  SELECT g.image, g.box AS gb, d.box AS db, g.text AS gt, upper(d.text) AS dt, greatest(least(g.x2, d.x2) - greatest(g.x1, d.x1), 0) * greatest(least(g.y2, d.y2) - greatest(g.y1, d.y1), 0) AS common,
    (g.x2 - g.x1) * (g.y2 - g.y1) AS ga, (d.x2 - d.x1) * (d.y2 - d.y1) AS da FROM g JOIN d USING (image)),
o AS (SELECT DISTINCT image, db FROM p WHERE gt = '###' AND common / da > 0.5),
e AS (SELECT p.* FROM p LEFT JOIN o USING (image, db) WHERE o.db IS NULL AND gt <> '###' AND common / (ga + da - common) > 0.5),
s AS (SELECT image, list({'g': gb, 'd': db, 'ok': CAST(upper(gt) = dt OR upper(gt[2:]) = dt AND gt[1] = '(' OR upper(gt[:-2]) = dt AND gt[-1] = ')' OR upper(gt[2:-2]) = dt AND gt[1] = '(' AS BIGINT)} ORDER BY gb, db) AS edges FROM e GROUP BY image),
r AS (SELECT image, list_reduce(edges, lambda a, x: CASE WHEN list_contains(a.gs, x.g) OR list_contains(a.ds, x.d) THEN a ELSE {'gs': list_append(a.gs, x.g), 'ds': list_append(a.ds, x.d), 'n': a.n + x.ok} END,
    {'gs': CAST([] AS BIGINT[]), 'ds': CAST([] AS BIGINT[]), 'n': CAST(0 AS BIGINT)}).n AS n_right FROM s),
c AS (
  SELECT image, coalesce(n_right, 0) AS n_right, n_gold, n_found FROM (SELECT image, count(*) FILTER (text <> '###') AS n_gold FROM g GROUP BY image) a
  JOIN (SELECT d.image, count(*) FILTER (o.db IS NULL) AS n_found FROM d LEFT JOIN o ON o.image = d.image AND o.db = d.box GROUP BY d.image) b USING (image) LEFT JOIN r USING (image))"""


@query("spotting_images", f"""
WITH {_SPOTTED},
q AS (SELECT *, CASE WHEN n_gold = 0 THEN CASE WHEN n_found > 0 THEN 0.0 ELSE 1.0 END WHEN n_found = 0 THEN 0.0 ELSE n_right / n_found END AS precision, CASE WHEN n_gold = 0 THEN 1.0 ELSE n_right / n_gold END AS recall FROM c)
SELECT *, CASE WHEN precision + recall = 0 THEN 0.0 ELSE 2 * precision * recall / (precision + recall) END AS f_mean FROM q""")
def spotting_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    return SP.spotting_by_image(SP.spotting_counts(*_boxes(spark, sf_dir)))


@query("spotting_total", f"""
WITH {_SPOTTED},
q AS (SELECT CAST(sum(n_right) AS BIGINT) AS n_right, CAST(sum(n_gold) AS BIGINT) AS n_gold, CAST(sum(n_found) AS BIGINT) AS n_found FROM c)
SELECT *, n_right / n_found AS precision, n_right / n_gold AS recall, 2 * (n_right / n_found) * (n_right / n_gold) / (n_right / n_found + n_right / n_gold) AS f_mean FROM q""")
def spotting_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return SP.spotting_whole(SP.spotting_counts(*_boxes(spark, sf_dir)))


@query("table_similarity", r"""
WITH r AS (SELECT conv_id, count(*) AS n, list(role ORDER BY turn, role)[1] AS a FROM conversations GROUP BY conv_id),
s AS (SELECT conv_id, n, 2.0 + 4 * n AS size, a, a || '+' || n AS b FROM r)
SELECT conv_id, CASE conv_id % 4 WHEN 0 THEN 1.0 WHEN 1 THEN 1.0 - 4 / size WHEN 2 THEN 1.0 - (levenshtein(a, b) / length(b)) / size ELSE 1.0 - 1 / size END AS similarity FROM s""")
def table_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A conversation's turns as a table under a row of one wide cell; replies lack the last row, misread a cell, or give the wide cell another span."""
    k = F.col("conv_id")
    cell = lambda c: F.concat(F.lit("<td>"), c, F.lit("</td>"))
    turn = F.struct("turn", "role", F.length("text").cast("string").alias("size"))
    # As many tasks as the session has partitions, however few bytes the rows have: the distances are the work.
    talk = table(spark, sf_dir, "conversations").select("conv_id", turn.alias("t")).repartition(shuffle_width(spark), "conv_id").groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("rows"), F.count(F.lit(1)).alias("n"))
    first = F.concat(F.col("rows")[0]["role"], F.lit("+"), F.col("n").cast("string"))
    row = lambda x, role: F.concat(F.lit("<tr>"), cell(role), cell(x["turn"].cast("string")), cell(x["size"]), F.lit("</tr>"))
    whole = lambda span, rows: F.concat(F.lit("<html><body><table><tr><td colspan='"), span, F.lit("'>all</td></tr>"), F.array_join(rows, "\n"), F.lit("</table></body></html>"))
    plain = F.transform("rows", lambda x: row(x, x["role"]))
    misread = F.transform("rows", lambda x, i: row(x, F.when(i == 0, first).otherwise(x["role"])))
    reply = F.when(k % 4 == 1, whole(F.lit("3"), F.slice(plain, F.lit(1), F.col("n").cast("int") - 1))).when(k % 4 == 2, whole(F.lit("3"), misread)).when(k % 4 == 3, whole(F.lit("2"), plain)).otherwise(whole(F.lit("3"), plain))
    return talk.select("conv_id", T.table_scores(reply, whole(F.lit("3"), plain)).alias("similarity"))


@query("markdown_tables", """
SELECT n_nationkey, '<html><body><table><tr><td>name</td><td> </td><td>region</td></tr><tr><td>' || n_name || '</td><td>' || n_nationkey || '</td><td></td></tr><tr><td>' || lower(n_name) || '</td><td> </td><td>' || n_regionkey || '</td></tr></table></body></html>' AS markup FROM nation""")
def markdown_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.concat(F.lit("```markdown\n| name | | region |\n|---|---|---|\n|"), "n_name", F.lit(" |  "), F.col("n_nationkey").cast("string"), F.lit("|| \n  | "), F.lower("n_name"), F.lit("|   | "), F.col("n_regionkey").cast("string"), F.lit(" |\n```"))
    return table(spark, sf_dir, "nation").select("n_nationkey", T.markdown_table_markup(text).alias("markup"))


@query("translation_edit_rate")
def translation_edit_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By role, whole turns against the next turn of their conversation; tested against a plain search."""
    talk = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    pairs = J.following(talk, "conv_id", ["turn", "role", "text"], "text", "ref")
    counts = pairs.select("role", E.edit_rate_counts(F.col("text"), F.array("ref")).alias("c"))
    rate = F.coalesce(F.try_divide(F.sum("c.edits"), F.sum("c.words")), F.when(F.sum("c.edits") > 0, 1.0).otherwise(0.0))
    return counts.groupBy("role").agg(F.sum("c.edits").alias("edits"), F.sum("c.words").alias("words"), (100 * rate).alias("edit_rate"))


_READ = r"""
t AS (SELECT conv_id, turn, '*Sure*, here:' || chr(10) || text || chr(10) || 'bye, *all*.' AS reply, lower(regexp_extract(text, '[a-zA-Z]{3,}')) AS w FROM conversations),
l AS (SELECT conv_id, turn, w, reply, string_split(reply, chr(10)) AS l FROM t),
p AS (SELECT conv_id, turn, w, reply, [array_to_string(l[2:], chr(10)), array_to_string(l[:len(l) - 1], chr(10)), array_to_string(l[2:len(l) - 1], chr(10))] AS parts FROM l),
b AS (SELECT conv_id, turn, w, list_concat([reply], list_transform(parts, lambda x: regexp_replace(regexp_replace(x, '^\s+', ''), '\s+$', ''))) AS four FROM p),
r AS (SELECT conv_id, turn, w, i, CASE WHEN i <= 4 THEN four[i] ELSE replace(four[i - 4], '*', '') END AS x FROM b, range(1, 9) n(i)),
a AS (
  SELECT *, CASE turn % 4
      WHEN 0 THEN CASE WHEN conv_id % 2 = 0 THEN len(regexp_extract_all(x, '[\p{L}\p{N}\p{M}_]+')) < 40 + conv_id % 60 ELSE len(regexp_extract_all(x, '[\p{L}\p{N}\p{M}_]+')) >= 40 + conv_id % 60 END
      WHEN 1 THEN length(x) - length(replace(lower(x), 'e', '')) >= 1 + conv_id % 90 WHEN 2 THEN NOT contains(x, ',') ELSE suffix(lower(x), CASE WHEN conv_id % 2 = 0 THEN '*all*.' ELSE 'bye, all.' END) END AS one,
    CASE conv_id % 3 WHEN 0 THEN contains(lower(x), w) AND contains(lower(x), 'the') WHEN 1 THEN NOT regexp_matches(lower(x), '\bsure\b') ELSE len(regexp_extract_all(lower(x), 'the')) < turn + 2 END AS two,
    len(regexp_extract_all(x, '\*[^\n*]*[^\s*][^\n*]*\*')) >= 2 AS three FROM r WHERE x <> ''),
j AS (SELECT conv_id, turn, unnest([{'at': 0, 'i': i, 'ok': one}, {'at': 1, 'i': i, 'ok': two}, {'at': 2, 'i': i, 'ok': three}]) AS o FROM a),
k AS (SELECT conv_id, turn, CAST(o.at AS INTEGER) AS at, bool_or(o.ok AND o.i = 1) AS strict, bool_or(o.ok) AS loose FROM j GROUP BY ALL)"""


def _instructed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns between an opening and an ending, each with three instructions that follow from its numbers and words."""
    c, t = F.col("conv_id"), F.col("turn")
    row = lambda name, **args: F.struct(F.lit(name).alias("name"), F.to_json(F.struct(*[(v if not isinstance(v, str) else F.lit(v)).alias(k) for k, v in args.items()] or [F.lit(None).alias("none")])).alias("args"))
    relation = F.when(c % 2 == 0, "less than").otherwise("at least")
    one = F.when(t % 4 == 0, row("length_constraints:number_words", num_words=40 + c % 60, relation=relation)).when(t % 4 == 1, row("keywords:letter_frequency", letter="E", let_frequency=1 + c % 90, let_relation="at least")).when(
        t % 4 == 2, row("punctuation:no_comma")).otherwise(row("startend:end_checker", end_phrase=F.when(c % 2 == 0, " *ALL*.").otherwise("Bye, all.")))
    word = F.lower(F.regexp_extract("text", "[a-zA-Z]{3,}", 0))
    two = F.when(c % 3 == 0, row("keywords:existence", keywords=F.array(F.lit("THE"), word))).when(c % 3 == 1, row("keywords:forbidden_words", forbidden_words=F.array(F.lit("sure")))).otherwise(row("keywords:frequency", keyword="the", frequency=t + 2, relation="less than"))
    asked = F.array(one, two, row("detectable_format:number_highlighted_sections", num_highlights=F.lit(2)))
    reply = F.concat(F.lit("*Sure*, here:\n"), "text", F.lit("\nbye, *all*."))
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", reply.alias("reply"), asked.alias("asked"))
    return I.row_instructions(rows.select("conv_id", "turn", "reply", F.col("asked.name").alias("names"), F.col("asked.args").alias("args")), ["conv_id", "turn"], "reply", "names", "args")


@query("row_instructions", f"WITH {_READ} SELECT * FROM k")
def row_instructions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _instructed(spark, sf_dir).drop("instruction")


@query("instruction_accuracy", f"""
WITH {_READ},
m AS (SELECT conv_id, turn, bool_and(strict) AS s, bool_and(loose) AS l, sum(CAST(strict AS INTEGER)) AS ns, sum(CAST(loose AS INTEGER)) AS nl, count(*) AS n FROM k GROUP BY ALL)
SELECT turn, avg(CAST(s AS INTEGER)) AS prompt_strict, avg(CAST(l AS INTEGER)) AS prompt_loose, sum(ns) / sum(n) AS instruction_strict, sum(nl) / sum(n) AS instruction_loose FROM m GROUP BY turn""")
def instruction_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.instruction_accuracy(_instructed(spark, sf_dir), ["conv_id", "turn"], ["turn"])


def _task_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Documents' languages, sizes and ids as replies of a task for each language, with tables that say how a task is read and scored."""
    k, size = F.col("doc_id"), F.col("n_chars")
    s = lambda c: c.cast("string")
    answer = F.to_json(F.struct(F.col("source").alias("status"), s(size).alias("price"), F.concat(F.lit("["), s(k), F.lit(", "), s(k + 1), F.lit("]")).alias("list"), F.col("source").alias("note")))
    reply = F.concat(
        F.lit('I say {"status": "'), F.when(k % 3 == 0, "f").otherwise(F.upper("source")), F.lit('", "price": "$'), s(F.floor(size * F.when(k % 2 == 0, 1.005).otherwise(1.2))),
        F.lit('", "list": "('), s(k + 1), F.lit(","), s(k + k % 2), F.lit(')"} so.'))
    spoken = F.concat(F.lit("Well.\nAnswer: "), F.when(k % 4 == 0, F.upper("source")).otherwise(F.lit("none")))
    told = lambda c: F.col(c).isin("en", "de", "fr")
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    replies = docs.select(F.col("lang").alias("task"), k.alias("item"), F.when(told("lang"), reply).otherwise(spoken).alias("reply"), answer.alias("answer"))
    names = docs.select(F.col("lang").alias("task")).distinct()
    tasks = names.select("task", F.when(told("task"), "json").otherwise("answer").alias("parser"), F.when(F.col("task") == "de", "min").otherwise("mean").alias("combine"))
    row = lambda f, m, w: F.struct(F.lit(f).alias("field"), F.lit(m).alias("metric"), F.lit(w).alias("weight"))
    fields = names.select("task", F.inline(F.when(told("task"), F.array(row("status", "exact_any_case", 1.0), row("price", "number", 2.0), row("list", "set", 1.0))).otherwise(F.array(row("note", "simple", 1.0)))))
    return replies, tasks, fields


_SCORED = """
f AS (SELECT lang AS task, doc_id AS k, CASE WHEN doc_id % 3 = 0 THEN 'f' ELSE lower(source) END = lower(source) AS a,
    abs(floor(n_chars * CASE WHEN doc_id % 2 = 0 THEN CAST(1.005 AS DOUBLE) ELSE CAST(1.2 AS DOUBLE) END) - n_chars) <= n_chars * CAST(0.01 AS DOUBLE) AS b, doc_id % 2 = 0 AS s, doc_id % 4 = 0 AS n FROM documents),
e AS (SELECT task, k AS item, CASE WHEN task IN ('en', 'fr') THEN (CAST(a AS INTEGER) + 2 * CAST(b AS INTEGER) + CAST(s AS INTEGER)) / 4.0 WHEN task = 'de' THEN CASE WHEN a AND b AND s THEN 1.0 ELSE 0.0 END ELSE CASE WHEN n THEN 1.0 ELSE 0.0 END END AS score FROM f)"""


@query("task_table_scores", f"WITH {_SCORED} SELECT task, count(*) AS n_items, avg(score) AS score FROM e GROUP BY task")
def task_table_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tasks read and scored as their tables say: JSON fields by three metrics with weights or their least, and answers behind a mark."""
    return S.task_scores(S.evaluate_tasks(*_task_tables(spark, sf_dir)))


@query("task_table_rerun", f"""
WITH {_SCORED} SELECT task, avg(CASE WHEN task = 'es' THEN 0.5 ELSE score END) AS score, count(*) AS n_items FROM e GROUP BY task""")
def task_table_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An evaluation after one that scored all 0.5: one task has the same replies, one lacked a reply there, one had another, one no score."""
    replies, tasks, fields = _task_tables(spark, sf_dir)
    first = replies.groupBy("task").agg(F.min("item").alias("least"))
    is_first, task = F.col("item") == F.col("least"), F.col("task")
    old = replies.join(F.broadcast(first), "task").where((task != "de") | ~is_first).select(  # a row for each language
        "task", "item", F.when((task == "fr") & is_first, "other").otherwise(F.col("reply")).alias("reply"), "answer", F.when((task != "en") | ~is_first, 0.5).alias("score"))
    return S.task_scores(S.evaluate_tasks(replies, tasks, fields, old))


@query("expression_answers", """
SELECT doc_id, (doc_id + n_chars) % 5 <> 0 AS fraction, doc_id % 3 = 0 AND n_chars % 50 > 0 AS equation, doc_id % 2 = 0 AS interval, doc_id % 3 < 2 AS near FROM documents""")
def expression_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents' numbers as answers in notation: a fraction with a root against a quotient, a line's equation scaled and turned, an interval's end, and a size within a share."""
    k, size = F.col("doc_id"), F.col("n_chars")
    q, n = size % 50, k % 7 + 1
    text = lambda *parts: F.concat(*[F.lit(x) if isinstance(x, str) else x.cast("string") for x in parts])
    fraction = X.equal_answers(text("x = \\frac{", q + 1, "\\sqrt{", n * n * 4, "}}{7}"), text("(", (q + 1) * 2, " * ", n + F.when((k + size) % 5 == 0, 1).otherwise(0), ")/7"))
    equation = X.equal_answers(text("y = ", q, "x + ", n), text(q * 2, "x - 2y + ", n * 2 + F.when((k % 3 == 0) & (q > 0), 0).otherwise(1), " = 0"))
    interval = X.equal_answers(text("\\left(-", q, ", \\frac{", n * 3, "}{3}\\right]"), text("(", -q, ",", n, F.when(k % 2 == 0, "]").otherwise(")")))
    near = X.number_scores(text("about \\approx ", size + size * (k % 3) / 100, " kg"), text(size)) == 1
    return table(spark, sf_dir, "documents").select("doc_id", fraction.alias("fraction"), equation.alias("equation"), interval.alias("interval"), near.alias("near"))


def _spoken(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents' numbers said in words: a year, a sum of money and a percentage, in every fifth with a word too many."""
    word = lambda of, i: F.element_at(F.array(*[F.lit(w) for w in of]), (i + 1).cast("int"))
    tens, unit = word(W.TENS, F.col("doc_id") % 8), word(W.UNITS[1:], F.col("n_chars") % 9)
    said = F.concat(
        F.lit("[noise] It's, um, Mr X (laughs): nineteen "), tens, F.lit("-"), unit, F.lit(". They WON'T pay "), unit, F.lit(" hundred and "), tens, F.lit(" dollars or "), tens, F.lit(" "), unit, F.lit(" percent!"),
        F.when(F.col("doc_id") % 5 == 0, " Really.").otherwise(""))
    return table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars", said.alias("said"))


_WRITTEN = "'it is mister x 19' || (doc_id % 8 + 2) || (n_chars % 9 + 1) || ' they will not pay $' || (n_chars % 9 + 1) || (doc_id % 8 + 2) || '0 or ' || (doc_id % 8 + 2) || (n_chars % 9 + 1) || '%'"


@query("written_transcripts", f"SELECT doc_id, {_WRITTEN} || CASE WHEN doc_id % 5 = 0 THEN ' really' ELSE '' END AS written FROM documents")
def written_transcripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _spoken(spark, sf_dir).select("doc_id", W.written_english(F.col("said")).alias("written"))


@query("transcript_error_rate", """
SELECT lang, 100 * CAST(sum(CASE WHEN doc_id % 5 = 0 THEN 1 ELSE 0 END) AS DOUBLE) / (12 * count(*)) AS wer FROM documents GROUP BY lang""")
def transcript_error_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word errors of spoken numbers against written ones, both brought to one form first."""
    k, n = F.col("doc_id") % 8 + 2, F.col("n_chars") % 9 + 1
    text = lambda *parts: F.concat(*[F.lit(x) if isinstance(x, str) else x.cast("string") for x in parts])
    gold = text("It is Mister X, 19", k, n, ". They will not pay $", n, k, "0 or ", k, n, "%.")
    rows = _spoken(spark, sf_dir).select("lang", W.written_english(F.col("said")).alias("said"), W.written_english(gold).alias("gold"))
    return ST.word_error_rate(rows, ["lang"], "said", "gold")


@query("late_interaction", """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings),
p AS (SELECT vec_id // 64 AS doc, vec_id % 64 // 8 AS place, v FROM v), q AS (SELECT vec_id // 64 - 1 AS doc, vec_id AS a, v FROM v WHERE vec_id % 64 < 6),
b AS (SELECT doc, place, a, max(list_dot_product(p.v, q.v)) AS best FROM p JOIN q USING (doc) GROUP BY ALL),
s AS (SELECT doc, place, avg(best) AS score FROM b GROUP BY ALL)
SELECT doc, place, score, CAST(row_number() OVER (PARTITION BY doc ORDER BY score DESC, place) AS INTEGER) AS rank FROM s QUALIFY rank <= 3""")
def late_interaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of eight vectors as the passages of a document, asked with six vectors of the next one."""
    k = F.col("vec_id")
    v = table(spark, sf_dir, "embeddings").select("vec_id", F.transform("embedding", lambda x: F.floor(256 * x.cast("double")).cast("double")).alias("v"))
    passages = v.select(F.expr("vec_id div 64").alias("doc"), F.expr("vec_id % 64 div 8").alias("place"), "v")
    queries = v.where(k % 64 < 6).select((F.expr("vec_id div 64") - 1).alias("doc"), k.alias("at"), "v")
    return R.first_passages(R.late_interaction(passages, queries, ["doc"], "place"), ["doc"], "place", 3)


@query("constrained_replies", r"""
WITH t AS (SELECT conv_id, turn, role, 'Two suns rise here. A moon sets, two moons set. ' || text AS r, text FROM conversations),
s AS (SELECT *, lower(r) AS l FROM t)
SELECT conv_id, turn, CASE turn % 4
  WHEN 0 THEN CASE WHEN conv_id % 2 = 0 THEN 1 ELSE 0 END
  WHEN 1 THEN CASE WHEN len(regexp_extract_all(r, '[\p{L}\p{N}\p{M}_]+')) < 20 + conv_id % 80 THEN 1 ELSE 0 END
  WHEN 2 THEN CASE WHEN conv_id % 3 = 0 THEN 1 ELSE 0 END
  ELSE CASE WHEN role[1] = 'u' THEN 1 ELSE 0 END END AS score FROM s""")
def constrained_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns behind two known sentences: words at their place, how often a word occurs there, the reply's length, and first letters of lines."""
    c, t = F.col("conv_id"), F.col("turn")
    opening = F.lit("Two suns rise here. A moon sets, two moons set. ")
    reply = F.when(t % 4 == 0, opening).when(t % 4 == 1, F.concat(opening, "text")).when(t % 4 == 2, opening).otherwise(F.concat(F.col("role"), F.lit("\n\n**two** tall trees")))
    key = F.when(t % 4 == 0, "contain1##position").when(t % 4 == 1, "length").when(t % 4 == 2, "contain##times2").otherwise("acrostic_alliteration")
    value = F.when(t % 4 == 0, F.concat(F.lit('"Moon, star"##'), F.when(c % 2 == 0, "2").otherwise("1"))).when(t % 4 == 1, F.concat(F.lit("<"), (20 + c % 80).cast("string"))).when(
        t % 4 == 2, F.concat(F.lit("moons##"), F.when(c % 3 == 0, "2").otherwise("1"))).otherwise("U T")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", reply.alias("reply"), key.alias("key"), value.alias("value"))
    return CO.constraint_scores(rows, "reply", "key", "value").select("conv_id", "turn", "score")
