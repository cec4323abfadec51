"""Spoken English, constrained generation and late interaction against known cases and plain Python."""

from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from minewright.functions import spoken as W
from minewright.operators import constraints as CO
from minewright.operators import retrieval as R


@pytest.mark.parametrize("said, written", [
    ("twenty one", "21"), ("one hundred and five people", "105 people"), ("two thousand ten", "2010"), ("nineteen ninety nine", "1999"), ("one two three", "123"), ("four oh four", "404"), ("two and a half", "2.5"), ("the twenty first of may", "the 21st of may"),
    ("nineteen eighties", "1980s"), ("minus five", "-5"), ("five percent", "5%"), ("ten per cent", "10%"), ("three hundred dollars", "$300"), ("two dollars and seven cents", "$2.07"), ("point five", "0.5"), ("three point one four", "3.14"), ("double seven five", "775"), ("3 million", "3000000"),
    ("one", "one"), ("a one and two", "a one and 2"), ("three million two hundred thousand and six", "3200006"), ("oh no", "oh no"), ("zero point zero five", "0.05"), ("seventy fifth", "75th"), ("forty-two", "42"), ("", ""), ("nobody and a half", "nobody and a half"), ("one percent", "1%"), ("hundredth", "100th"),
])
def test_number_words(said, written):
    assert W.numbers_written(said) == written


def test_all_numbers_under_a_million_are_read_back():
    def words(n):
        if n < 20:
            return (W.UNITS + W.TEENS)[n]
        if n < 100:
            return W.TENS[n // 10 - 2] + ("" if n % 10 == 0 else " " + W.UNITS[n % 10])
        if n < 1000:
            return W.UNITS[n // 100] + " hundred" + ("" if n % 100 == 0 else " and " + words(n % 100))
        return words(n // 1000) + " thousand" + ("" if n % 1000 == 0 else (" and " if n % 1000 < 100 else " ") + words(n % 1000))

    for n in [*range(2, 2200), *range(2200, 1_000_000, 977)]:
        assert W.numbers_written(words(n) + " ships") == f"{n} ships", words(n)


def test_written_english(spark):
    cases = {
        "[music] Won't you, uh, pay (she laughs) $1,234.50, Mr. Smith?": "will not you pay $1234.50 mister smith", "It's Dr X's café — naïve…": "it is doctor x is cafe naive", "100% of £5; or 5 %": "100% of £5 or 5", None: None, "": "",
        "colour of colours": "color of colours",
    }
    df = spark.createDataFrame([(k,) for k in cases], "t string").select("t", W.written_english(F.col("t"), {"colour": "color"}).alias("w"))
    assert {r.t: r.w for r in df.collect()} == cases


@pytest.mark.parametrize("reply, key, value, want", [
    ("The puppies play. Two puppies sleep.", "contain", "puppy", 1), ("The cats.", "contain1", "dog, cat", 1), ("The cats.", "contain", "dog", 0), ("A b. C d.", "contain##position", "d##2", 1), ("A b. C d.", "contain##position", "d##1", 0),
    ("A b. C b.", "contain##position_only", "b##1", 0), ("A b. C d.", "contain##position_only", "b##1", 1), ("A b. C b.", "contain##times", "b##2", 1), ("A b. C b.", "contain##times3", "b##1", 0), ("sun here", "contain_only", "[[sun, moon], [star]]", 1),
    ("sun and star", "contain_only", "[[sun, moon], [star]]", 0), ("x", "contain##position", "x", 0), ("x", "contain", " ", 1), ("a b c", "length", "<4", 1), ("a b c", "length", "> 3", 0), ("a b c", "length", "4", 0), ("Up\nby", "acrostic", "UB", 1), ("Up\nby", "acrostic", "U", 0),
    ("Up\n\nby", "acrostic", "U B", 1), ("Big bad\nup", "acrostic_alliteration", "bu", 1), ("Big dad\nup", "acrostic_alliteration", "bu", 0), ("x", "syllables", "5", None), (None, "length", "<4", 0), ("**Bold** sun", "contain", "bold sun", 1), ("", "contain", "a", 0),
])
def test_constraints(spark, reply, key, value, want):
    row = spark.createDataFrame([(reply, key, value)], "reply string, key string, value string")
    assert CO.constraint_scores(row, "reply", "key", "value").first().score == want


def test_a_reply_has_its_least_constraint(spark):
    rows = spark.createDataFrame([(1, "a b", "length", "<4"), (1, "a b", "contain", "z"), (2, "a", "metre", "x"), (3, "a", "metre", "x"), (3, "a", "length", "<4")], "k int, reply string, key string, value string")
    assert {r.k: r.score for r in CO.constrained_scores(CO.constraint_scores(rows, "reply", "key", "value"), ["k"]).collect()} == {1: 0, 2: None, 3: 1}


@pytest.mark.parametrize("few", [R.FEW_VECTORS, 0])
def test_late_interaction(spark, monkeypatch, few):
    monkeypatch.setattr(R, "FEW_VECTORS", few)
    passages = [("d", 0, [1.0, 0.0]), ("d", 0, [0.0, 2.0]), ("d", 1, [3.0, 0.0]), ("d", 1, None), ("d", 2, [1.0]), ("e", 0, [1.0, 1.0]), ("f", 0, [1.0, 1.0])]
    queries = [("d", 0, [1.0, 0.0]), ("d", 1, [1.0, 1.0]), ("d", 2, None), ("e", 0, [-1.0, 0.5])]
    p, q = spark.createDataFrame(passages, "doc string, place int, v array<double>"), spark.createDataFrame(queries, "doc string, at int, v array<double>")
    want = defaultdict(list)
    for d, _, w in queries:
        for place in {x[1] for x in passages if x[0] == d}:
            dots = [sum(a * b for a, b in zip(w, v, strict=True)) for e, pl, v in passages if w and v and e == d and pl == place and len(v) == len(w)]
            if dots:
                want[d, place].append(max(dots))
    scores = R.late_interaction(p, q, ["doc"], "place")
    assert {(r.doc, r.place): r.score for r in scores.collect()} == {k: sum(v) / len(v) for k, v in want.items()}
    assert [(r.doc, r.place) for r in R.first_passages(scores, ["doc"], "place", 1).orderBy("doc").collect()] == [("d", 1), ("e", 0)]
