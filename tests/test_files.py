"""Writers and readers of keyed files, and the readings of choices and spans, on known cases."""

import json

import pytest
from pyspark.sql import functions as F

from minewright.functions import spans
from minewright.functions import text as T
from minewright.sources import readers, sinks


def one(spark, c):
    return spark.range(1).select(c.alias("x")).first()["x"]


def test_keyed_files(spark, tmp_path):
    pages = spark.createDataFrame([("http://a", "x"), ("http://b", "y")], "url string, html string")
    sinks.write_pages(pages, f"{tmp_path}/pages")
    back = spark.read.json(f"{tmp_path}/pages").withColumns({"a": F.lpad(F.col("p1").cast("string"), 2, "0"), "b": F.lpad(F.col("p2").cast("string"), 2, "0")})
    assert back.where("substring(key, 1, 2) = a AND substring(key, 3, 2) = b AND key = md5(url)").count() == 2
    sinks.write_inline_images(spark.createDataFrame([("p", "b"), ("p", "a"), ("p", "b"), ("q", None)], "page string, uri string"), "page", "uri", f"{tmp_path}/images")
    assert [(r.page, r.images) for r in spark.read.json(f"{tmp_path}/images").collect()] == [("p", ["a", "b"])]
    sinks.write_page_items(spark.createDataFrame([("p", True, "1"), ("p", False, "2"), ("q", False, "3"), ("q", None, "4")], "page string, valid boolean, question string"), "page", "valid", f"{tmp_path}/items")
    assert [(r.page, [i.question for i in r.qa_items]) for r in spark.read.json(f"{tmp_path}/items").collect()] == [("p", ["1"])]
    sinks.write_submission(spark.createDataFrame([("k", "old", 1), ("k", "new", 2)], "k string, v string, n int"), "k", "v", "n", f"{tmp_path}/answers")
    assert [(r.k, r.v) for r in spark.read.json(f"{tmp_path}/answers").collect()] == [("k", "new")]
    sinks.write_dataset(spark.createDataFrame([("train", "1", "x"), ("test", "2", "y")], "split string, n string, extra string"), "split", "n int", f"{tmp_path}/set")
    assert {(r.split, r.n) for r in spark.read.parquet(f"{tmp_path}/set").collect()} == {("train", 1), ("test", 2)}


def test_metrics_apart(spark):
    numbers, texts = sinks.split_metrics(spark.createDataFrame([("t", "acc,none", "0.5"), ("t", "note", "N/A"), ("t", "x", None)], "task string, metric string, value string"))
    assert [tuple(r) for r in numbers.collect()] == [("t/acc", 0.5)] and [tuple(r) for r in texts.collect()] == [("t/note", "N/A")]


def test_lists_of_datasets_and_logs(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([{"id": 1, "x": "p"}]))
    (tmp_path / "b.jsonl").write_text('{"id": 2, "y": "q"}\n')
    got = readers.mixture_entries(spark, [f"{tmp_path}/a.json", f"{tmp_path}/b.jsonl"])
    assert {(r.id, r.x, r.y) for r in got.collect()} == {(1, "p", None), (2, None, "q")}
    with pytest.raises(ValueError):
        readers.mixture_entries(spark, [])
    (tmp_path / "log.jsonl").write_text('{"doc": 1, "seq": 1, "reply": "a"}\n{"doc": 1, "seq": 2, "reply": "b"}\n{"seq": 3}\n')
    assert [tuple(r) for r in readers.logged_replies(spark, f"{tmp_path}/log.jsonl", "doc int, seq int, reply string", "doc", "reply", "seq").collect()] == [(1, "b")]


def test_letters_of_five(spark):
    choices = F.array(F.lit("(A) a red fox"), F.lit("(B) a dog"))
    read = lambda s: one(spark, T.choice_letter(F.lit(s), "ABCDE", T.OPENINGS_APART, choices))
    assert [read(s) for s in ("Best option: E", "red fox", "a", "nothing here", " ".join(["so"] * 11))] == ["E", "A", "A", "", ""]
    assert one(spark, T.choice_letter(F.lit("Best answer: x"))) == "B" and one(spark, T.choice_letter(F.lit("Best answer:Best option: C"))) == "C"


def test_event_spans(spark):
    for s, want in (
        ("from 3.5 to 2 s", [2.0, 3.5]), ("It starts at 4.\nIt ends at 9.5 s!", [4.0, 9.5]), ("starts at 00:00:18 and ends at 00:00:23", None), ("at 3 and 4", None),
        ("A specific example is : 20.8 - 30.0 seconds\n1 - 2", [1.0, 2.0]), ("", None), (None, None),
    ):
        assert one(spark, spans.event_span(F.lit(s).cast("string"))) == want, s
