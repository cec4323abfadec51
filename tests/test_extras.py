"""Prompt forms, named options, box sequences, paired references, summaries, samples and writers."""

import hashlib
import json
import math
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from minewright.functions import boxes as B
from minewright.functions import choices as CH
from minewright.functions import conversations as CV
from minewright.operators import aggregates as A
from minewright.operators import captions as C
from minewright.operators import sampling as S
from minewright.sources import sinks


def one(spark, c):
    return spark.range(1).select(c.alias("x")).first()["x"]


def talk(*turns):
    return F.array(*[F.struct(F.lit(a).alias("from"), F.lit(b).alias("value")) for a, b in turns])


@pytest.mark.parametrize("form, want", [
    ("two_seps", "S USER: q ASSISTANT: a</s>"), ("inst", "[INST] <<SYS>>\nS\n<</SYS>>\n\nq [/INST] a </s>"), ("turns", "<start_of_turn>user\nq<end_of_turn>\n<start_of_turn>model\na<end_of_turn>\n"),
    ("headers", "<|begin_of_text|><|start_header_id|>system<|end_header_id|>\n\nS<|eot_id|><|start_header_id|>user<|end_header_id|>\n\nq<|eot_id|><|start_header_id|>assistant<|end_header_id|>\n\na<|eot_id|>"),
    ("im_tight", "<|im_start|>system\nS<|im_end|><|im_start|>user\nq<|im_end|><|im_start|>assistant\na<|im_end|>"), ("im_lines", "<|im_start|>system\nS<|im_end|>\n<|im_start|>user\nq<|im_end|>\n<|im_start|>assistant\na<|im_end|>\n"), ("plain", "qa\n"),
])
def test_prompt_forms(spark, form, want):
    assert one(spark, CV.chat_prompt(talk(("human", "q"), ("gpt", "a")), form, "S")) == want
    assert one(spark, CV.chat_prompt(talk(("gpt", "early"), ("human", "q"), ("gpt", "a")), form, "S")) == want
    assert one(spark, CV.chat_prompt(talk(("human", "q"), ("human", "q")), form, "S")) is None
    assert one(spark, CV.chat_prompt(talk(("human", "<image>\nlook"), ("gpt", "a")), "plain")) == "<image>a\n"


@pytest.mark.parametrize("reply, want", [
    ("B", "B"), ("it is B", "B"), ("A b c d (C) e", "C"), ("A dog", "A"), ("A dog is here now", None), ("B or C", None), ("B or C so D.", "D"), ("x B: y", "B"), ("x B). y", "B"), ("The GREEN one", "C"), ("red, green", None), ("", None), ("the B.", "B"), ("F", None),
])
def test_named_option(spark, reply, want):
    assert one(spark, CH.named_option(F.lit(reply), F.array(F.lit("red"), F.lit("blue"), F.lit("Green")))) == want


@pytest.mark.parametrize("reply, gold, want", [("(B) x", "B", True), ("B. x", "B", True), ("Bx", "B", True), ("b", "B", False), ("x", "xy", False), ("(B)", "(B)", True), ("12", "1", False)])
def test_letter_or_exact(spark, reply, gold, want):
    assert one(spark, CH.letter_or_exact(F.lit(reply), F.lit(gold))) is want


def test_box_sequences(spark):
    of = lambda s: B.boxes_of(F.lit(s))
    assert one(spark, of("[[1, 2, 3, 4], (5,6,7,8)], [1, x, 2, 3] and [1,2]")) == [[1, 2, 3, 4], [5, 6, 7, 8]]
    assert one(spark, of("<box>1, 2, 3, 4</box> [9, 9, 9, 9]")) == [[1, 2, 3, 4]] and one(spark, of("none")) == [] and one(spark, of("[0.5, -1, 2e1, 3]")) == [[0.5, -1, 20, 3]]
    assert one(spark, B.sequence_iou(of("[0,0,2,2], [0,0,4,4]"), of("[1,0,3,2], [0,0,4,4]"))) == pytest.approx((1 / 3 + 1) / 2)
    assert one(spark, B.sequence_iou(of("[0,0,2,2]"), of("[0,0,2,2], [0,0,2,2]"))) == 0 and one(spark, B.sequence_iou(of(""), of(""))) == 0


def test_paired_references(spark):
    halves = [(i, h, k) for i in range(5) for h in ("pos", "neg") for k in ("text", "video")]
    wrong = {(1, "pos", "text"), (2, "neg", "video"), (3, "pos", "text"), (3, "pos", "video"), (4, "neg", "text")}
    preds = spark.createDataFrame([(*x, "c", None if x == (4, "neg", "text") else "b no" if x in wrong else "A yes") for x in halves], "index int, half string, kind string, category string, pred string")
    golds = spark.createDataFrame([(*x, "a") for x in halves], "index int, half string, kind string, gold string")
    got = {r["index"]: (r.text, r.video, r.group) for r in A.paired_references(preds, golds).collect()}
    assert got == {0: (True, True, True), 1: (False, True, False), 2: (True, False, False), 3: (False, False, False), 4: (False, True, False)}


def test_summaries(spark):
    files = spark.createDataFrame([(3, 1.0), (0, 3.0), (2, None), (None, 2.0)], "n int, s double")
    assert tuple(A.extraction_summary(files, "n", "s").first()) == (4, 2, 5, 2.5, 2.0)
    assert tuple(A.extraction_summary(files.limit(0), "n", "s").first()) == (0, 0, 0, 0.0, 0.0)
    assert tuple(A.route_counts(files, {"some": F.col("n") > 0, "slow": F.col("s") > 1.5}).first()) == (4, 2, 2)


def plain_bleu(p, r):
    logs, halvings = [], 0
    for n in range(1, 5):
        grams = lambda x: Counter(tuple(x[i : i + n]) for i in range(len(x) - n + 1))  # noqa: B023, E731
        a, b = grams(p), grams(r)
        if not a:
            return 0.0
        m = sum(min(c, b[g]) for g, c in a.items())
        halvings += not m
        logs.append(math.log(m / sum(a.values())) if m else math.log(1 / (2**halvings * sum(a.values()))))
    return math.exp(sum(logs) / 4) * min(1.0, math.exp(1 - len(r) / len(p)))


def test_sentence_bleu_column(spark):
    rows = [("a b c d e f", "a b c d x f"), ("a b c d", "a b c d e f g"), ("a b", "a b"), (None, "a"), ("x y z w v", "a b c d e")]
    df = spark.createDataFrame(rows, "p string, r string")
    got = [r.s for r in df.select(C.sentence_bleu_score(F.col("p"), F.col("r")).alias("s")).collect()]
    assert got == pytest.approx([plain_bleu((p or "").split(), (r or "").split()) for p, r in rows])


@pytest.mark.parametrize("few", [S.FEW_ROWS, 3])
def test_samples_of_either_size(spark, monkeypatch, few):
    monkeypatch.setattr(S, "FEW_ROWS", few)
    rows = spark.range(40).repartition(3)
    assert sorted(r.id for r in S.sample(rows, "first:25%", "id").collect()) == list(range(10))
    assert sorted(r.id for r in S.sample(rows, "end:6", "id").collect()) == list(range(34, 40))
    assert {r.id for r in S.sample(rows, "random:7", "id", seed=1).collect()} == set(sorted(range(40), key=lambda i: (hashlib.md5(f"{i}:1".encode()).hexdigest(), i))[:7])


def test_written_samples_and_parts(spark, tmp_path):
    rows = spark.createDataFrame([("t", 2, "b"), ("t", 1, "a"), ("u", 1, "c")], "task string, doc int, reply string")
    sinks.write_samples(rows, "task", "doc", str(tmp_path / "samples"))
    lines = [json.loads(x) for f in sorted(Path(tmp_path / "samples" / "task=t").glob("*.json")) for x in f.read_text().splitlines()]
    assert [x["doc"] for x in lines] == [1, 2] and len({x["sample_hash"] for x in lines}) == 2
    sizes = spark.createDataFrame([(i, 40) for i in range(10)], "id int, size long")
    sinks.write_parts(sizes, "id", "size", 100, str(tmp_path / "parts"))
    parts = {p.name: sorted(json.loads(x)["id"] for f in p.glob("*.json") for x in f.read_text().splitlines()) for p in (tmp_path / "parts").glob("part=*")}
    assert parts == {"part=0": [0, 1, 2], "part=1": [3, 4], "part=2": [5, 6, 7], "part=3": [8, 9]}


@pytest.mark.parametrize("reply, golds, want", [
    ("The answer is 1,234.567.", ["1234.57"], True), ("so 5\nand 6", ["6"], False), ("so 5\nx = 6", ["6"], True), ("x = 6\nso 5", ["6"], False), ("it is Blue", ["blue"], True), ("option b", ["b"], True), ("about", ["b"], False), ("is 2e3", ["2000"], True),
    ("thus :", ["thus"], True), ("", [""], True), ("result 12", ["2"], False), ("final answer is -3.", ["-3"], True), ("no", ["yes", "5"], False), ("could be so is 7", ["7.004"], True), ("nothing here 9", ["9"], False),
])
def test_open_match(spark, reply, golds, want):
    assert one(spark, CH.open_match(F.lit(reply), F.array(*[F.lit(g) for g in golds]))) is want


def test_page_text_scores(spark):
    rows = [("a b b c", "b c d"), (None, "a"), ("", None), ("héllo wörld", "hello world"), ("x " * 400, "x " * 390)]
    got = [tuple(r.s) for r in spark.createDataFrame(rows, "p string, r string").select(C.page_text_scores(F.col("p"), F.col("r")).alias("s")).collect()]
    assert got[0] == pytest.approx((2 / 3, 2 / 3, 2 / 3, 4 / 7)) and got[1] == (0, 0, 0, 1) and got[2] == (0, 0, 0, 0) and got[3] == pytest.approx((0, 0, 0, 2 / 11)) and got[4][3] == pytest.approx(20 / 800)
