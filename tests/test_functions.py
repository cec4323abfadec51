"""Hand-derived cases of the expressions and operators."""

import base64
import struct

import pytest
from pyspark.sql import functions as F

from minewright.functions import boxes as B
from minewright.functions import conversations as C
from minewright.functions import html as H
from minewright.functions import images as I
from minewright.functions import qa as Q
from minewright.functions import sets as S
from minewright.functions import text as T
from minewright.functions.urls import domain, normalize_url, origin
from minewright.operators import aggregates, decontam, filters, joins, sampling, statistics
from minewright.operators.domains import domain_list, drop_domains
from minewright.sources import readers, sinks


def one(spark, column, *rows, schema="x string"):
    return [r[0] for r in spark.createDataFrame([r if isinstance(r, tuple) else (r,) for r in rows], schema).select(column).collect()]


def test_urls(spark):
    u = F.col("x")
    given = [" HTTP://WWW.A.com/B?Q=1#f ", "http://a.com/x?", "http://a.com/x?y=1?", "http://a.com/p;?q", "//b.com", "nothing", None, "http://u:p@A.com:80/"]
    assert one(spark, normalize_url(u), *given) == ["http://www.a.com/b?q=1", "http://a.com/x", "http://a.com/x?y=1?", "http://a.com/p?q", "//b.com", "nothing", None, "http://u:p@a.com:80/"]
    assert one(spark, domain(normalize_url(u)), *given) == ["a.com", "a.com", "a.com", "a.com", "b.com", "", None, "u:p@a.com:80"]
    assert one(spark, origin(u), "HTTPS://A.com/x/y", "x") == ["https://A.com", None]


def test_html(spark):
    page = """<html><head><title>t</title></head><body><!-- note --><nav>menu</nav><p>one<p>two <b>bold</b><img src='/a.png' alt='pic'><div class='x AD'>no<img src='b.png'></div>
      <div class='ads'>kept</div><div id='thread'>by id</div><script>s</script><img alt='none'><img src='data:image/png;base64,AA'><img src='//c.com/d.png'>end</body></html>"""
    url = "http://site.org/deep/page"
    got = [(n["type"], n["content"]) for n in H.page_nodes(page, url, True)]
    assert got == [
        ("text", "note one two bold"), ("image", "[Image: pic] Source: http://site.org/a.png"), ("text", "kept"), ("image", "[Image: ] Source: data:image/png;base64,AA"), ("image", "[Image: ] Source: //c.com/d.png"), ("text", "end")]
    assert "note" not in H.page_nodes(page, url, False)[0]["content"] and H.page_nodes(None, url, True) is None and H.page_nodes("", None, True) is None
    df = spark.createDataFrame([(page, url)], "h string, u string").select(H.nodes(F.col("h"), F.col("u")).alias("n"))
    r = df.select(H.image_links(F.col("n")).alias("l"), H.inline_images(F.col("n")).alias("i"), H.llm_document(F.col("n")).alias("d")).first()
    assert r.l == ["http://site.org/a.png", "//c.com/d.png"] and len(r.i) == 1
    assert r.d.startswith("<document>\nnote one two bold\n\n<image alt='pic' src='http://site.org/a.png'></image>\n\nkept") and r.d.endswith("\n</document>")


REPLY = """Intro
**Question 1:**
What is it?
**Images:**
* [a.png]
* No images available
**Solution:**
  step one

  step two
**Images in Solution:**
* none
**Question 2:**
Lost, it has no image section
**Solution:**
x
**Question 3:**
Not found
**Images:**
* [b.png]
**Question 4:**
Last?
**Images:**
* No images available
"""


def test_replies(spark):
    items = Q.parse_reply(REPLY)
    assert [i["question"] for i in items] == ["What is it?", "Last?"]
    assert items[0]["question_images"] == ["a.png"] and items[0]["solution"] == "  step one\n  step two" and items[0]["solution_images"] == []
    assert items[1]["solution"] == "Not found" and Q.parse_reply(None) == []
    df = spark.createDataFrame([(REPLY,)], "x string").select(Q.parse_items(F.col("x")).alias("i"))
    again = df.select(Q.parse_items(Q.format_items(F.col("i"))).alias("j"), "i").first()
    assert again.i == again.j
    checker = "QUESTION_VALID: Yes\nQUESTION_IMAGES: [0, -1, 7]\nSOLUTION_IMAGES: 0, x\nANALYSIS: good: but"
    p = one(spark, Q.parse_filter_reply(F.col("x"), F.array(F.lit("a"), F.lit("b")), F.array(F.lit("c"))), checker, "nothing")
    assert (p[0].valid, p[0].question_images, p[0].solution_images, p[0].analysis) == (True, ["a", "b"], [], "good") and not p[1].valid
    a = one(spark, Q.parse_alignment(F.col("x")), "Yes\nbecause", "no")
    assert (a[0].is_aligned, a[0].explanation, a[1].is_aligned, a[1].explanation) == (True, "because", False, "")


def test_texts(spark):
    x = F.col("x")
    assert one(spark, T.normalize_answer(x), "The  Cat, a dog!", "été the") == ["cat dog", "été"]
    assert one(spark, T.yes_no(x), "Yes", " y", "it: no", "n0 yes", "noway") == ["yes", "yes", "other", "other", "no"]
    assert one(spark, T.choice_letter(x), "The best answer is (C)", "none here at") == ["C", ""]
    assert one(spark, T.two_scores(x), "8, 9\nrest", "8", "a b", None) == [[8.0, 9.0], [-1.0, -1.0], [-1.0, -1.0], [-1.0, -1.0]]
    assert one(spark, T.clean_prompt(x), "a [title] b [x] c", None) == ["a. b c", " "]
    assert one(spark, T.boxed(x), r"so \boxed{1} and \boxed{x+2}", "no") == ["x+2", None]
    assert one(spark, T.relaxed_match(x, F.lit("100")), "104", "106", "1e2", "x") == [True, False, True, False]
    assert one(spark, T.relaxed_match(x, F.lit("5%")), "0.05", "6%") == [True, False]
    assert one(spark, T.leading_choice(F.lit("B"), x), "B.", "(b) x", "Option B", "the answer is b", "x B") == [True, True, True, True, False]
    assert one(spark, T.anls(x, F.array(F.lit("hello"))), "hello", "hallo", "zzzzz") == pytest.approx([1.0, 0.8, 0.0])


def test_sets_and_boxes(spark):
    a = F.split("x", ",")
    ref = F.array(F.lit("p"), F.lit("q"))
    assert one(spark, S.jaccard(a, ref), "p,q", "p,z", "z") == pytest.approx([1.0, 1 / 3, 0.0])
    assert one(spark, S.position_accuracy(a, ref), "p,z", "p") == [0.5, 0.0]
    assert one(spark, S.common_prefix_ratio(a, ref), "p,z", "z,q", "p,q,r") == [0.5, 0.0, 1.0]
    assert one(spark, S.consensus(F.lit("a"), a), "a,a,a,b", "b") == pytest.approx([(2 / 3 * 3 + 1.0) / 4, 0.0])
    assert one(spark, B.parse_box(F.col("x")), "at [0.1, .2,3,4] x", "no") == [[0.1, 0.2, 3.0, 4.0], [0.0] * 4]
    box = lambda *v: F.array(*[F.lit(float(y)) for y in v])
    assert one(spark, B.iou(box(0, 0, 2, 2), box(1, 1, 3, 3)), "x")[0] == pytest.approx(1 / 7)
    assert one(spark, B.iou(box(0, 0, 0, 0), box(0, 0, 0, 0)), "x") == [0.0]
    assert one(spark, B.best_resolution(F.lit(800), F.lit(600), [(336, 672), (672, 336), (672, 672)]), "x")[0].asDict() == {"w": 672, "h": 672}


def test_images(spark):
    assert I.safe_name("http://a/b/Caf%C3%A9.png?x") == "Cafe.png" and I.safe_name("http://a/").startswith("img_") and I.safe_name(None) is None
    long = I.safe_name("http://a/" + "x" * 200 + ".png")
    assert len(long) == 32 + 1 + 8 + 4 and long.endswith(".png")
    png = b"\x89PNG\r\n\x1a\n" + b"\0" * 8 + struct.pack(">II", 120, 30) + b"\0" * 9
    assert I.image_size(png) == (120, 30, False) and I.image_size(b"GIF89a" + struct.pack("<HH", 5, 6) + b"\x21\xf9\x04" * 2) == (5, 6, True) and I.image_size(b"?") is None
    assert [r.width for r in one(spark, I.image_header(F.col("x")), bytearray(png), None, schema="x binary")] == [120, None]
    uri = "data:image/jpeg;base64," + base64.b64encode(b"hello").decode().rstrip("=")
    got = one(spark, I.decode_inline(F.col("x")), uri)[0]
    assert (got.format, bytes(got.data)) == ("jpg", b"hello")
    cut = spark.createDataFrame([("p", 1, "abcx"), ("p", 2, "zzz")], "k string, cut_id int, head string")
    whole = spark.createDataFrame([("p", 7, "abcdef"), ("p", 8, "abz")], "k string, whole_id int, body string")
    assert [(r.cut_id, r.whole_id, r.score) for r in I.best_prefix(cut, whole, "k").collect()] == [(1, 7, 0.75)]


def test_conversations(spark):
    assert one(spark, C.image_first(F.col("x")), "look <image> here", "<image> a", "no", "<image><image>") == ["<image>\nlook  here", "<image> a", "no", "<image><image>"]
    df = spark.createDataFrame([([("gpt", "hi"), ("human", "q"), ("gpt", "a")],)], "t array<struct<from:string,value:string>>")
    r = df.select(C.chat_roles(F.col("t"), "S").alias("r"), C.prompt(C.chat_roles(F.col("t"), "S")).alias("p")).first()
    assert [(x.role, x.content) for x in r.r] == [("system", "S"), ("user", "q"), ("assistant", "a")] and r.p.startswith("<|system|>\nS\n<|user|>")
    assert one(spark, C.frame_indices(F.col("x"), 4), 10, 3, schema="x int") == [[0, 3, 6, 9], [0, 1, 2]]


def test_filters(spark):
    df = spark.createDataFrame([(1, [" a", "b", "b", " a "]), (2, [])], "id int, resps array<string>")
    f = lambda name, **k: [r[0] for r in df.orderBy("id").select(filters.FILTERS[name](**k)(F.col("resps"))).collect()]
    assert f("whitespace") == [["a", "b", "b", "a "], []] and f("majority_vote") == [["b"], []] and f("take_first") == [[" a"], []]
    assert f("regex", pattern="(b)") == [["[invalid]", "b", "b", "[invalid]"], []]
    assert f("map", table={"b": "B"}, default="?") == [["?", "B", "B", "?"], []]
    assert f("regex_groups", pattern="(a)|(b)", groups=2) == [["a", "b", "b", "a"], []]
    golden = spark.createDataFrame([(["I say (B)", "it is red", "I pick: C", "?"], ["blue", "red", "green"])], "resps array<string>, choices array<string>")
    assert golden.select(filters.choice_regex(r"\(([A-D])\)", F.col("choices"))(F.col("resps"))).first()[0] == ["(B)", "(B)", "(C)", "[invalid]"]


def test_joins_sampling_and_statistics(spark, tmp_path):
    left = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    right = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (None, "c", 3)], "idx int, v string, seq int")
    assert sorted((r.k or 0, r.v) for r in joins.lookup(left, right, "k", "idx", ["seq"]).collect()) == [(0, None), (1, "b"), (2, None)]
    ranks = sampling.ranked(spark.range(100).repartition(7), [F.desc("id")]).collect()
    assert sorted((r["_rank"], r.id) for r in ranks) == [(i + 1, 99 - i) for i in range(100)]
    assert sampling.wanted("end:15%", 10) == ("end", 2)
    with pytest.raises(ValueError):
        sampling.wanted("some:3", 10)
    batches = sampling.length_batches(spark.range(20).withColumn("n", F.col("id") * 3), "id", "n", 2, 2).collect()
    assert len(batches) == 20 and max(sum(1 for b in batches if (b.megabatch, b.worker) == k) for k in {(b.megabatch, b.worker) for b in batches}) == 2
    battles = spark.createDataFrame([("a", "b", "model_a")] * 9 + [("a", "b", "model_b")] + [("b", "c", "tie")] * 4, "model_a string, model_b string, winner string")
    rating = {r.model: r.rating for r in statistics.elo(battles, "b").collect()}
    assert rating["b"] == 1000 and rating["a"] - 1000 == pytest.approx(400 * 0.954, abs=2) and rating["c"] == pytest.approx(1000, abs=1)
    assert statistics.edit_distance("a b c".split(), "a x c d".split()) == 2 and statistics.edit_distance([], ["a"]) == 1
    b = statistics.bootstrap(spark.createDataFrame([("g", float(i % 2)) for i in range(400)], "g string, v double"), ["g"], "v", iterations=400).first()
    assert b.stderr == pytest.approx(0.025, rel=0.2) and b.low < 0.5 < b.high
    docs = spark.createDataFrame([(1, "x one two three four five six seven eight nine y"), (2, "one two")], "doc_id long, text string")
    bench = spark.createDataFrame([(5, "One two, three four five six seven eight")], "item_id long, text string")
    assert [(r.doc_id, r.item_id, r.shared) for r in decontam.contaminated(docs, bench).collect()] == [(1, 5, 1)]
    assert [r.doc_id for r in decontam.decontaminate(docs, bench).collect()] == [2]
    rows = spark.createDataFrame([("t", 1.0, 0.5, 10), ("t", 3.0, 0.5, 10)], "t string, m double, s double, n long")
    xs = aggregates.combined_stderr(rows, ["t"], "m", "s", "n").first().combined_stderr
    assert xs == pytest.approx(((9 * 0.25 + 9 * 0.25) / 19 + 10 * 10 / (20 * 19) * 4) ** 0.5)
    urls = spark.createDataFrame([("u", "a.com"), ("v", "b.com")], "norm_url string, domain string")
    assert [r.domain for r in drop_domains(urls, domain_list(spark, [" A.com ", "", "a.com"])).collect()] == ["b.com"]


def test_sources_and_sinks(spark, tmp_path):
    d = tmp_path / "s"
    d.mkdir()
    (d / "1.json").write_text('{"visual_matches": [{"link": "http://a"}, {"x": 1}]}')
    (d / "2.json").write_text('{"other": 1}')
    (d / "3.json").write_text("{broken")
    assert [r.link for r in readers.search_links(spark, [str(d)]).collect()] == ["http://a"]
    assert readers.braces("d/{a,b}/{c}.json") == ["d/a/c.json", "d/b/c.json"]
    with pytest.raises(ValueError):
        readers.mixture_entry(spark, "x.csv")
    (tmp_path / "q1.json").write_text('{"metadata": 1, "qa_items": [{"question": "a"}]}')
    (tmp_path / "q2.json").write_text('[{"question": "b"}]')
    assert sorted(r.question for p in ("q1", "q2") for r in readers.qa_items(spark, f"{tmp_path}/{p}.json", "struct<question:string>").collect()) == ["a", "b"]
    counts = spark.createDataFrame([("a", 1), ("b", 3)], "domain string, n_urls long")
    sinks.write_domain_stats(counts, f"{tmp_path}/stats")
    assert [(r.domain, r["count"], r.percentage) for r in readers.domain_counts(spark, f"{tmp_path}/stats", 1).collect()] == [("b", 3, "75.00%")]
    sinks.write_lines(counts, "domain", f"{tmp_path}/lines")
    assert sorted(r.value for r in readers.lines(spark, f"{tmp_path}/lines").collect()) == ["a", "b"]
    results = spark.createDataFrame([("t", "none", "acc,none", 0.5, None)], "task string, filter string, metric string, value double, stderr double")
    assert "| t | none | acc,none | 0.5000 | N/A |" in sinks.results_table(results) and sinks.flat_metrics(results).first().key == "t/acc"


def test_streams(spark, tmp_path):
    from minewright.streaming.urls import domain_counts, event_counts, new_links

    d = tmp_path / "in"
    d.mkdir()
    (d / "1.json").write_text('{"visual_matches": [{"link": "http://a.com/x"}, {"link": "http://A.com/x#f"}, {"link": "http://b.com"}]}')
    q = domain_counts(new_links(spark, str(d))).writeStream.outputMode("complete").format("memory").queryName("stream_domains").option("checkpointLocation", f"{tmp_path}/c").start()
    q.processAllAvailable()
    q.stop()
    assert sorted((r.domain, r.n_urls) for r in spark.table("stream_domains").collect()) == [("a.com", 1), ("b.com", 1)]
    batch = spark.createDataFrame([("2024-01-01 00:10:00", "x", 1.0), ("2024-01-01 00:20:00", "x", 2.0)], "ts string, event_type string, value double")
    assert [(r.event_type, r.n, r.total) for r in event_counts(batch).collect()] == [("x", 2, 3.0)]
