"""Answer functions, caption metrics, structured scores and requests against known cases and brute force."""

import random
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from minewright.functions import answers as A
from minewright.functions import names as N
from minewright.functions import trees
from minewright.operators import captions as C
from minewright.operators import filters as R
from minewright.operators import requests as Q
from minewright.operators import structured as S


def one(spark, c):
    return spark.range(1).select(c.alias("x")).first()["x"]


@pytest.mark.parametrize("answer, want", [
    ("The Two dogs, aren't they?", "2 dogs aren't they"), ("a  man's HAT", "man 's hat"), ("dont", "don't"), ("red/blue", "red blue"), ("red/blue / x", "redblue x"),
    ("3.5 m. tall", "3.5 m tall"), ("", ""), (None, None), ("." * 40, "." * 8), ("none", "0"), ("yes!\nno", "yes no"), ("x\ty", "x y"),
])
def test_vqa_answer(spark, answer, want):
    assert one(spark, A.vqa_answer(F.lit(answer).cast("string"))) == want


def test_choice_regex_reads_the_known_replies(spark):
    replies = F.array(*[F.lit(x) for x in ("The answer is (B)", "I believe it is (A)", "(C) seems correct", "Answer is: B!", "Answer: B")])
    choices = F.array(F.lit("A. Apple"), F.lit("B. Banana"), F.lit("C. Cherry"))
    got = one(spark, R.choice_regex(r"\(([A-D])\)", choices)(replies))
    assert got[:3] == ["(B)", "(A)", "(C)"] and got[4] == "(B)"


def test_choice_text(spark):
    question = F.lit("Pick.\nA. red apple\nB. apple\nC. red apple")
    for reply, want in (("a red, apple", "C"), ("apple", "B"), ("pear!", "pear"), ("", "")):
        assert one(spark, R.choice_text(question, F.array(F.lit(reply)))) == want
    assert one(spark, R.choice_text(F.lit("no options"), F.array(F.lit("A?")))) == "A"
    assert one(spark, R.ignoring(F.lit("A, b! 12"), case=True, punctuation=True, patterns=("[0-9]+",))) == "a b "


def test_small_scores(spark):
    arr = lambda *x: F.array(*[F.lit(v) for v in x]) if x else F.array().cast("array<string>")
    assert one(spark, A.multiset_f1(arr("a", "a", "b"), arr("a", "c"))) == pytest.approx(2 / 5)
    assert one(spark, A.multiset_f1(arr(), arr())) == 1 and one(spark, A.multiset_f1(arr(), arr("a"))) == 0
    assert one(spark, A.best_of(lambda p, r: F.length(r) - F.length(p), F.lit("a"), arr("ab", "abc"))) == 2
    assert [one(spark, A.positive_int_match(F.lit(p), F.lit(g))) for p, g in (("3", "3"), ("-1", "0"), ("x", "1"), ("2", "3"))] == [1, -1, 0, 0]
    assert one(spark, A.angle_rmse(F.array(F.lit(359.0)), F.array(F.lit(1.0)))) == pytest.approx(0.8)
    assert one(spark, A.detokenize(F.lit('do n\'t ( x ) " y " .'))) == 'don\'t (x)"y".'
    p, g = F.create_map(F.lit("a"), F.lit(1), F.lit("b"), F.lit(2)), F.create_map(F.lit("a"), F.lit(1), F.lit("c"), F.lit(3))
    assert one(spark, A.key_recall(p, g)) == 0.5
    lists = lambda *kv: F.create_map(*[F.lit(x) if isinstance(x, str) else arr(*x) for x in kv])
    assert one(spark, A.key_jaccard(lists("a", ["x", "y"]), lists("a", ["x"], "b", ["z"]))) == pytest.approx(0.25)
    assert one(spark, A.contains_answer(F.lit("A b c"), arr("x", "B C"))) == 1 and one(spark, A.contains_answer(F.lit("x + 1"), arr("x+1"), squeeze=True)) == 1


@pytest.mark.parametrize("reply, kind, places, want", [
    ("1.115", "float", 2, "1.11"), ("2.5", "float", 0, "2.0"), ("12345678901.5", "float", 1, "12345678901.5"), ("1e22", "integer", 0, str(10**22)), ("-7.9", "integer", 0, "-7"), ("many", "integer", 0, None), ("inf", "integer", 0, None), (None, "float", 1, None), (" 3 ", "float", 1, "3.0"), ("x", "list", 0, "x"),
])
def test_typed_numbers(spark, reply, kind, places, want):
    row = spark.createDataFrame([(reply, kind, places)], "r string, k string, p int")
    assert row.select(A.typed_answer(F.col("r"), F.array(F.lit("a")), F.col("k"), F.col("p")).alias("x")).first().x == want


def test_thin_spaces_and_semicolons_in_latex(spark):
    assert one(spark, A.latex_plain(F.lit("a\\;b"))) == "ab" and one(spark, A.latex_plain(F.lit("1;2"))) == "1;2"
    assert not one(spark, A.latex_equal(F.lit("1;2"), F.lit("12")))


def test_latex(spark):
    for a, b, same in ((r"\dfrac12", "0.5", True), (r"x = .50", "1/2", True), (r"\frac{1}{3}", "0.333", False), (r"90^\circ", "90", True), (r"\text{yes}", "yes", True), ("1,000", "1000", True), (r"-\frac{3}{4}", "-0.75", True)):
        assert one(spark, A.latex_equal(F.lit(a), F.lit(b))) is same, (a, b)
    for a, b, same in (("(1, 2)", "2,1", True), ("[1,2]", "1", False), ("a,b", "1,2", False)):
        assert one(spark, A.number_sets_equal(F.lit(a), F.lit(b))) is same, (a, b)


def subsequence(a, b):
    return max(k for k in range(len(a) + 1) for c in combinations(a, k) if any(list(c) == list(d) for d in combinations(b, k)))


def test_longest_common_subsequence_equals_brute_force():
    rng = random.Random(1)
    for _ in range(80):
        a, b = ([rng.choice("xyz") for _ in range(rng.randint(0, 7))] for _ in range(2))
        assert C.longest_common(a, b) == subsequence(a, b)


def distance(a, b):
    if not a or not b:
        return len(a) + len(b)
    return min(distance(a[1:], b) + 1, distance(a, b[1:]) + 1, distance(a[1:], b[1:]) + (a[0] != b[0]))


def test_rouge_and_character_errors(spark):
    rng = random.Random(2)
    rows = [(i, "g%d" % (i % 2), "".join(rng.choice("aé ") for _ in range(rng.randint(0, 6))), "".join(rng.choice("aé ") for _ in range(rng.randint(1, 6)))) for i in range(20)]
    got = {r.g: r.cer for r in C.character_error_rate(spark.createDataFrame(rows, "i int, g string, p string, r string"), ["g"], "p", "r").collect()}
    for g in got:
        own = [(p.replace(" ", ""), r.replace(" ", "")) for _, k, p, r in rows if k == g]
        assert got[g] == pytest.approx(100 * sum(distance(p, r) for p, r in own) / sum(len(r) for _, r in own))
    cases = spark.createDataFrame([("the cat sat", "the cat ran"), ("", "x"), (None, "x"), ("a", "a")], "p string, r string")
    scores = [r.x for r in cases.select(C.rouge_l(F.col("p"), F.col("r")).alias("x")).collect()]
    assert scores == pytest.approx([2 / 3, 0, 0, 1])


def test_sentence_bleu():
    assert C.sentence_bleu("a b c d".split(), "a b c d".split()) == 1 and C.sentence_bleu([], ["a"]) == 0 and 0 < C.sentence_bleu("a b c d e".split(), "a x c y e".split()) < 0.2


def test_tree_distance():
    t = lambda x: trees.tree_of(x)
    assert trees.tree_distance(t({"a": 1, "b": [1, 2]}), t({"a": 1, "b": [1, 2]})) == 0
    assert trees.tree_distance(t({"a": 1}), t({"a": 2})) == 1 and trees.tree_distance(t({"a": 1}), t({"b": 1})) == 1
    assert trees.tree_distance(t({"a": 1}), t({"a": 1, "b": 2})) == 2 and trees.tree_distance(t({}), t({"a": 1})) == 2
    assert trees.record_similarity("no json", '{"a": 1}') == 0 and trees.record_similarity("{}", None) is None and trees.record_similarity('{"a": 1}', '{"a": 1}') == 1
    assert trees.leaves({"a": [1, 2], "b": {"c": "x"}}) == [".a=1", ".a=2", ".b.c=x"]


def test_best_ngram():
    assert trees.best_ngram("so the red fox ran", "red fox")[:2] == (1.0, "red fox") and trees.best_ngram("x", "red fox")[0] == 0 and trees.best_ngram(None, None)[1] == ""


def test_names(spark):
    for url, want in (("http://a.b/x/p%20q.png?s", "p q.png"), ("http://a.b/img.png/view", "img.png"), ("http://a.b/view", "view.jpg"), ("http://a.b/", "image.jpg"), ("a:b/c*d.gif", "c_d.gif"), (None, None)):
        assert one(spark, N.file_name_of_url(F.lit(url).cast("string"))) == want, url
    assert one(spark, N.rendered("{{ a }}-{{b}}", a=F.lit(1), b=F.lit(None).cast("string"))) == "1-"
    with pytest.raises(KeyError):
        N.rendered("{{ c }}", a=F.lit(1))
    assert one(spark, N.sentence_context(F.lit("Run"), F.lit("He ran."), F.lit("then he"))) == "Run: He ran. Then he"


def test_structured_scores(spark):
    rows = [("t", 1, "mean", "exact", "a", "a ", 1.0), ("t", 1, "mean", "positive_int", "-1", "0", 9.0), ("t", 2, "min", "list_jaccard", "x, y", "y", 1.0), ("t", 2, "min", "order", "x,y", "x , y", 1.0), ("t", 3, "mean", "exact", None, "a", 1.0), ("u", 1, "mean", "positive_int", "-3", "0", 1.0)]
    fields = S.field_scores(spark.createDataFrame(rows, "task string, item int, combine string, metric string, response string, target string, weight double"))
    items = S.item_scores(fields)
    assert {(r.task, r.item): r.score for r in items.collect()} == {("t", 1): 1.0, ("t", 2): 0.5, ("t", 3): 0.0, ("u", 1): -1.0}
    whole = S.summary(S.task_scores(items)).first()
    assert (whole.n_tasks, whole.n_items, whole.macro, whole.micro) == (2, 4, 0.25, 0.375)
    with pytest.raises(Exception, match="unknown metric"):
        S.field_scores(spark.createDataFrame([("t", 1, "mean", "none", "a", "a", 1.0)], "task string, item int, combine string, metric string, response string, target string, weight double")).collect()


def test_requests_without_the_document_itself(spark):
    docs = spark.createDataFrame([(i, f"t{i}") for i in range(6)], "id long, t string")
    got = Q.few_shot(docs, docs, "id", "t", 3).collect()
    assert all(r.example != f"t{r.id}" for r in got) and {sum(r.id == i for r in got) for i in range(6)} == {3}
    alone = Q.few_shot(docs.limit(1), docs.limit(1), "id", "t", 2)
    assert alone.count() == 0
    dropped = Q.modality_batches(docs.withColumn("n", F.when(F.col("id") < 3, 1).otherwise(-1)), "id", "n", 2, 1, merge=False)
    assert dropped.count() == 4
