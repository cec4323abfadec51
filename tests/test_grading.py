"""Spotting, table similarity, edit rates, per-row instructions and scored tasks against plain Python."""

import functools
import json
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from minewright.functions import edits as E
from minewright.functions import tables as T
from minewright.functions.instructions import ROW_CHECKS
from minewright.functions.trees import tree_distance
from minewright.operators import instructions as I
from minewright.operators import spotting as SP
from minewright.operators import structured as S


def iou(a, b):
    w, h = min(a[2], b[2]) - max(a[0], b[0]), min(a[3], b[3]) - max(a[1], b[1])
    both = max(w, 0) * max(h, 0)
    area = lambda r: (r[2] - r[0]) * (r[3] - r[1])
    return (Fraction(both, area(a) + area(b) - both) if both else 0), (Fraction(both, area(b)) if area(b) else 0)


def same_text(g, f):
    g, f = g.upper(), f.upper()
    cuts = [g]
    if g and g[0] in SP.MARKS:
        cuts.append(g[1:])
    if g and g[-1] in SP.MARKS:
        cuts.append(g[:-1])
    if g and g[0] in SP.MARKS and g[-1] in SP.MARKS:
        cuts.append(g[1:-1])
    return f in cuts


def plain_counts(gold, found):
    out = {}
    for image in {r[0] for r in gold + found}:
        g = sorted(r for r in gold if r[0] == image)
        f = sorted(r for r in found if r[0] == image and r[4] > r[2] and r[5] > r[3])
        off = {x[1] for x in f if any(y[6] == "###" and iou(y[2:6], x[2:6])[1] > Fraction(1, 2) for y in g)}
        taken, right = set(), 0
        for y in g:
            if y[6] == "###":
                continue
            for x in f:
                if x[1] not in off and x[1] not in taken and iou(y[2:6], x[2:6])[0] > Fraction(1, 2):
                    taken.add(x[1])
                    right += same_text(y[6], x[6])
                    break
        out[image] = right, sum(y[6] != "###" for y in g), len(f) - len(off)
    return out


BOX = "image long, box long, x1 int, y1 int, x2 int, y2 int, text string"


def test_spotting_equals_a_greedy_matcher(spark):
    rnd = random.Random(4)
    texts = ["ab", "(AB)", "ab.", "x", "###", "", "·", "a#"]

    def some(n, image):
        rows = []
        for i in range(n):
            x, y = rnd.randint(0, 12), rnd.randint(-6, 12)
            rows.append((image, i, x, y, x + rnd.randint(0, 14), y + rnd.randint(1, 14), rnd.choice(texts)))
        return rows

    gold = [r for i in range(12) for r in some(14, i)] + [(20, 0, 0, 0, 4, 4, "only gold")] + [(22, i, 5, 5, 15, 15, "twin") for i in range(4)] + [(23, 0, 0, 0, 1000, 700, "###")]
    found = [r for i in range(12) for r in some(14, i)] + [(21, 0, 0, 0, 4, 4, "only found")] + [(22, i, 5, 5, 15, 16, "TWIN") for i in range(3)] + [(23, i, 50 * i, 3, 50 * i + 9, 9, "in the region") for i in range(21)]
    counts = SP.spotting_counts(spark.createDataFrame(gold, BOX), spark.createDataFrame(found, BOX))
    got = {r.image: (r.n_right, r.n_gold, r.n_found) for r in counts.collect()}
    want = plain_counts(gold, found)
    assert got == want and got[22][0] == 3 and got[23] == (0, 0, 1)
    whole = SP.spotting_whole(counts).first()
    r, g, f = (sum(x[i] for x in want.values()) for i in range(3))
    assert (whole.n_right, whole.n_gold, whole.n_found) == (r, g, f) and whole.f_mean == pytest.approx(2 * r / (g + f))
    by = {r.image: r for r in SP.spotting_by_image(counts).collect()}
    assert (by[21].precision, by[21].recall, by[21].f_mean) == (0, 1, 0) and (by[20].precision, by[20].recall) == (0, 0)
    empty = spark.createDataFrame([], BOX)
    assert SP.spotting_whole(SP.spotting_counts(empty, empty)).first().f_mean == 0
    with pytest.raises(ValueError, match="half"):
        SP.spotting_counts(empty, empty, iou=0.3)


def plain_tree_distance(a, b, rename):
    """By the recursion over forests."""

    @functools.cache
    def size(f):
        return sum(1 + size(c) for _, c in f)

    @functools.cache
    def dist(f, g):
        if not f or not g:
            return size(f) + size(g)
        (x, xs), (y, ys) = f[-1], g[-1]
        return min(dist(f[:-1] + xs, g) + 1, dist(f, g[:-1] + ys) + 1, dist(xs, ys) + dist(f[:-1], g[:-1]) + rename(x, y))

    freeze = lambda t: (t[0], tuple(freeze(c) for c in t[1]))
    return dist((freeze(a),), (freeze(b),))


def test_tree_distance_with_rename_costs():
    rnd = random.Random(2)

    def tree(n):
        kids = []
        while n > 1:
            k = rnd.randint(1, n - 1)
            kids.append(tree(k))
            n -= k
        return rnd.choice("abc"), kids

    cost = lambda x, y: abs(ord(x) - ord(y)) / 2
    for _ in range(150):
        a, b = tree(rnd.randint(1, 7)), tree(rnd.randint(1, 7))
        assert tree_distance(a, b, rename=cost) == pytest.approx(plain_tree_distance(a, b, cost))
    for _ in range(30):
        a, b = tree(rnd.randint(9, 13)), tree(rnd.randint(9, 13))
        assert tree_distance(a, b, rename=cost) == pytest.approx(plain_tree_distance(a, b, cost))
    wide = lambda n: ("t", [("r", [(f"{i} {j}", []) for j in range(3)]) for i in range(n)])
    assert tree_distance(wide(700), wide(698)) == 8


PAGE = "<html><body>{}</body></html>"


@pytest.mark.parametrize(
    "pred, gold, want",
    [
        (PAGE.format("<table><tr><td>ab</td></tr></table>"), PAGE.format("<table><tr><td>ab</td></tr></table>"), 1.0),
        (PAGE.format("<table><tr><td>ab</td></tr></table>"), PAGE.format("<table><tr><td>ac</td></tr></table>"), 1 - 0.5 / 2),
        (PAGE.format("<table><tr><td>ab</td><td>x</td></tr></table>"), PAGE.format("<table><tr><td colspan=2>ab</td></tr></table>"), 1 - 2 / 3),
        (PAGE.format("<table><tr><td>ab<td><b>x</b><tr><td><!-- no -->"), PAGE.format("<table><tr><td>ab</td><td><b>y</b></td></tr><tr><td></td></tr></table>"), 1 - (1 / 3) / 6),
        (PAGE.format("<table><thead><tr><td>a</td></tr></thead></table>"), PAGE.format("<table><tr><td>a</td></tr></table>"), 1 - 1 / 3),
        (PAGE.format("<div><table></table></div>"), PAGE.format("<table><tr></tr></table>"), 0.0),
        (None, PAGE.format("<table></table>"), 0.0),
        ("no markup < & at all", "", 0.0),
        (PAGE.format("<table></table>"), PAGE.format("<table></table>"), 1.0),
        (PAGE.format("<table><tr><td colspan='x'>a &amp; b</td></tr></table>"), PAGE.format("<table><tr><td>a & b</td></tr></table>"), 1.0),
    ],
)
def test_table_similarity(pred, gold, want):
    assert T.table_similarity(pred, gold) == pytest.approx(want)


def test_markdown_tables(spark):
    text = "```markdown\n| a | |\n|--|--|\n|  b  |   |\nc|d|e\n```"
    got = spark.range(1).select(T.markdown_table_markup(F.lit(text)).alias("m")).first().m
    assert got == "<html><body><table><tr><td>a</td><td> </td></tr><tr><td>b</td><td> </td></tr><tr><td>d</td></tr></table></body></html>"
    assert spark.range(1).select(T.table_scores(F.lit(got), F.lit(got.replace(">b<", ">c<"))).alias("s")).first().s == pytest.approx(1 - 1 / 8)


def lev(a, b):
    p = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        q = [i]
        for j, y in enumerate(b, 1):
            q.append(min(p[j] + 1, q[-1] + 1, p[j - 1] + (x != y)))
        p = q
    return p[-1]


def plain_shift_edits(hyp, ref):
    """Shifts tried one by one over whole word lists, with distances from the full table."""
    hyp, shifts = list(hyp), 0
    while True:
        at, h_err, r_err = E._alignment(hyp, ref)
        tried = []
        for i in range(len(hyp)):
            for j in range(len(ref)):
                for n in range(1, 11):
                    if hyp[i : i + n] != ref[j : j + n] or i + n > len(hyp) or j + n > len(ref) or abs(i - j) > 50:
                        break
                    if not any(h_err[i : i + n]) or not any(r_err[j : j + n]) or i <= at[j] < i + n:
                        continue
                    for to in {at[k] + 1 if k >= 0 else 0 for k in range(j - 1, j + n)}:
                        moved = [(p, w) for p, w in enumerate(hyp)]
                        block, rest = moved[i : i + n], moved[:i] + moved[i + n :]
                        new = [w for p, w in rest if p < to] + [w for _, w in block] + [w for p, w in rest if p >= to]
                        if i <= to <= i + n:
                            new = hyp
                        tried.append((lev(hyp, ref) - lev(new, ref), n, -i, -to, new))
        if not tried or max(tried)[0] <= 0:
            return shifts + lev(hyp, ref)
        hyp, shifts = max(tried)[4], shifts + 1


def test_edit_distance_and_shifts():
    rnd = random.Random(8)
    for _ in range(300):
        a, b = ([rnd.choice("abcd") for _ in range(rnd.randint(0, 9))] for _ in range(2))
        assert E.edit_distance(a, b) == lev(a, b)
    for _ in range(200):
        a, b = ([rnd.choice("abcdefgh") for _ in range(rnd.randint(1, 9))] for _ in range(2))
        assert E.shift_edits(a, b) == plain_shift_edits(a, b)
    assert E.edit_distance(range(300), range(5, 300)) == 5 and E.shift_edits("c d e a b".split(), "a b c d e".split()) == 1


def test_edit_rate_counts(spark):
    rows = [("a b c d", ["b c d a", "x"]), (None, ["a b"]), ("a b", []), ("A", ["a", "a b c"]), ("", None)]
    got = spark.createDataFrame(rows, "p string, r array<string>").select(E.edit_rate_counts(F.col("p"), F.col("r")).alias("c")).select("c.*").collect()
    assert [tuple(r) for r in got] == [(1, 2.5), (2, 2.0), (2, 0.0), (0, 2.0), (0, 0.0)]


CASES = [
    ("keywords:existence", {"keywords": ["Dog", "c.t"]}, {"a dog, a CAT": True, "a dog": False}),
    ("keywords:frequency", {"keyword": "ab", "frequency": 2, "relation": "at least"}, {"Ab aB": True, "ab": False}),
    ("keywords:frequency", {"keyword": "ab", "frequency": 2, "relation": "less than"}, {"Ab aB": False, "ab": True}),
    ("keywords:forbidden_words", {"forbidden_words": ["no", "é"]}, {"None": True, "say NO!": False, "un é": False, "été": True}),
    ("keywords:letter_frequency", {"letter": "X", "let_frequency": 2, "let_relation": "at least"}, {"xX": True, "x": False}),
    ("language:response_language", {"language": "en"}, {"anything": True}),
    ("length_constraints:number_words", {"num_words": 3, "relation": "at least"}, {"un deux, été": True, "a b": False, "a-b c": True}),
    ("length_constraints:number_sentences", {"num_sentences": 2, "relation": "less than"}, {"One.": True, "One. Two!": False}),
    ("length_constraints:number_paragraphs", {"num_paragraphs": 2}, {"a\n***\nb": True, "***\na\n***\nb": True, "a\n***\n \n***\nb": False, "a": False}),
    ("length_constraints:nth_paragraph_first_word", {"num_paragraphs": 2, "nth_paragraph": 2, "first_word": "hello"}, {"x\n\n'Hello, you": True, "x\n\nHi": False, "x\n\n\n\nhello": False, "hello": False}),
    ("detectable_content:number_placeholders", {"num_placeholders": 2}, {"[a] [b]": True, "[a b]": False}),
    ("detectable_content:postscript", {"postscript_marker": "P.S."}, {"x\np. s. y": True, "ps y": False}),
    ("detectable_content:postscript", {"postscript_marker": "P.P.S"}, {"x P.P.S y": True, "p.s. y": False}),
    ("detectable_format:number_bullet_lists", {"num_bullets": 2}, {"* a\n- b": True, "** a\n- b": False, "* a\n* b\n- c": False}),
    ("detectable_format:constrained_response", {}, {"Well. My answer is no. So.": True, "no": False}),
    ("detectable_format:number_highlighted_sections", {"num_highlights": 2}, {"*a* and *b*": True, "**ab**": False, "*a*": False}),
    ("detectable_format:multiple_sections", {"section_spliter": "Part", "num_sections": 2}, {"Part 1 a\nPart 2 b": True, "Part one, Part 2": False}),
    ("detectable_format:json_format", {}, {'```json\n{"a": [1]}\n```': True, "{'a'}": False, "12": True}),
    ("detectable_format:title", {}, {"<<ab>> x": True, "<< >>": False, "<<a\nb>>": False}),
    ("combination:two_responses", {}, {"a ****** b": True, "a****** a": False, "a******b******c": False, "a************b": False}),
    ("combination:repeat_prompt", {"prompt_to_repeat": "Say it"}, {" say IT. Yes": True, "yes, say it": False}),
    ("startend:end_checker", {"end_phrase": "The End. "}, {'so "the end."': True, "the end": False}),
    ("startend:quotation", {}, {' "a\nb" ': True, '"': False, "a": False}),
    ("change_case:capital_word_frequency", {"capital_frequency": 2, "capital_relation": "at least"}, {"ABC-D x EF": True, "ABC x 12": False}),
    ("change_case:english_capital", {}, {"ABC 1!": True, "ABc": False, "12": False}),
    ("change_case:english_lowercase", {}, {"abc 1!": True, "ABc": False, "12": False}),
    ("punctuation:no_comma", {}, {"a b": True, "a, b": False}),
]


def test_every_row_brings_its_own_checks(spark):
    assert {name for name, _, _ in CASES} == set(ROW_CHECKS)
    rows = [(i, reply, name, json.dumps(args), ok) for i, (name, args, reply, ok) in enumerate((n, a, r, ok) for n, a, cases in CASES for r, ok in cases.items())]
    rows += [(900, "x", "keywords:existence", "{}", False), (901, "x", "length_constraints:number_words", '{"num_words": 0, "relation": "at least"}', False), (902, " \n", "punctuation:no_comma", "{}", False), (903, None, "punctuation:no_comma", None, False)]
    df = spark.createDataFrame(rows, "k long, reply string, name string, args string, ok boolean").selectExpr("k", "reply", "array(name) AS names", "array(args) AS args", "ok")
    got = {r.k: r.strict for r in I.row_instructions(df, ["k"], "reply", "names", "args").collect()}
    assert [(rows[i] if i < 900 else i) for i in got if got[i] != next(r[4] for r in rows if r[0] == i)] == []


def test_loose_readings_and_accuracy(spark):
    rows = [
        (1, "Sure, yes\nno commas *here*\nbye, now", ["punctuation:no_comma", "startend:end_checker"], ["{}", '{"end_phrase": "here"}']),
        (2, "one line", ["punctuation:no_comma"], ['{"unused": null}']),
        (3, "*,*", ["punctuation:no_comma", "combination:repeat_prompt"], ["{}", "{}"]),
    ]
    df = spark.createDataFrame(rows, "k long, reply string, names array<string>, args array<string>").selectExpr("*", "'one' AS prompt", "'fr' AS told")
    judged = I.row_instructions(df, ["k"], "reply", "names", "args", prompt="prompt", detected="told")
    assert {(r.k, r.at): (r.strict, r.loose) for r in judged.collect()} == {(1, 0): (False, True), (1, 1): (False, True), (2, 0): (True, True), (3, 0): (False, False), (3, 1): (False, False)}
    assert tuple(I.instruction_accuracy(judged, ["k"]).first()) == pytest.approx((1 / 3, 2 / 3, 1 / 5, 3 / 5))
    with pytest.raises(Exception, match="unknown instruction"):
        I.row_instructions(df.withColumn("names", F.array(F.lit("no:such"))), ["k"], "reply", "names", "args").collect()


def test_metrics_by_table(spark):
    cases = [
        ("exact", " a ", "a", 1), ("exact_any_case", "A", "a", 1), ("set", "[b, 'a', b]", "(a, b)", 1), ("set", "a", "a,b", 0), ("set_any_case", "A", "{a}", 1), ("order", "a,b", "[b, a]", 0), ("order_any_case", "A,b", "a,B", 1),
        ("places_any_case", "A,x", "a,b", 0.5), ("places_any_case", "a", "a,b", 0), ("common_beginning", "a,b,x", "a,b,c,d", 0.5), ("common_beginning", "a,b,c", "a,b", 1), ("any_reference", "ice cream", "[sorbet, 'Ice-Cream']", 1), ("any_reference", "x", "y", 0),
        ("chess_moves", "Qh5!, Nf3#, e4", "[Qh5, Nf3, d4]", 0.5), ("map_recall", '{"a": 1, "b": 2}', '{"a": 1, "c": 3}', 0.5), ("map_recall", "none", '{"a": 1}', 0), ("mean_error", "1, 2", "[1, 2]", 1), ("mean_error", "1", "1, 2", 0),
        ("number", "3.01", "3", 1), ("expression", "\\frac{1}{2}", "0.5", 1), ("near", "The colour", "colour", 1), ("edit_similarity", "abc", "acb", 1 - 1 / 3), ("edit_similarity", None, "a", 0), ("list_jaccard", "a,b", "b,c", 1 / 3), ("list_precision", "a,b", "a", 0.5), ("number_ratio", "3", "4", 0.75), ("simple", "A-b", "ab", 1), ("positive_int", "-1", "0", -1),
    ]
    df = spark.createDataFrame([(i, m, p, g) for i, (m, p, g, _) in enumerate(cases)], "i int, metric string, response string, target string")
    got = {r.i: r.score for r in S.field_scores(df).collect()}
    assert {cases[i][:3]: got[i] for i in got} == {c[:3]: pytest.approx(c[3]) for c in cases}
    assert {c[0] for c in cases} == set(S.METRICS) | set(S.PYTHON_METRICS)


def test_tasks_are_read_scored_and_skipped_by_tables(spark):
    replies = spark.createDataFrame(
        [("t", 1, 'so {"x": "\'A\'", "y": "2"}', '{"x": "a", "y": "2", "##z": "1"}'), ("t", 2, "nothing", '{"x": "a", "y": "2"}'), ("u", 1, "Answer: b", '{"only": "b"}'), ("u", 2, None, '{"only": "b"}'), ("v", 1, "whole", '{"w": "whole"}'), ("free", 1, "x", "{}")],
        "task string, item long, reply string, answer string")
    tasks = spark.createDataFrame([("t", "json", "mean"), ("u", "answer", "mean"), ("v", "whole", "min")], "task string, parser string, combine string")
    fields = spark.createDataFrame([("t", "x", "exact_any_case", 3.0), ("t", "y", "exact", 1.0), ("u", "only", "exact", 1.0), ("v", "w", "exact", 1.0)], "task string, field string, metric string, weight double")
    whole = S.evaluate_tasks(replies, tasks, fields)
    assert {(r.task, r.item): r.score for r in whole.collect()} == {("t", 1): 1, ("t", 2): 0, ("u", 1): 1, ("u", 2): 0, ("v", 1): 1, ("free", 1): -1}
    before = [("t", 1, 'so {"x": "\'A\'", "y": "2"}', '{"x": "a", "y": "2", "##z": "1"}', 0.25), ("t", 2, "nothing", '{"x": "a", "y": "2"}', 0.25), ("u", 1, "Answer: c", '{"only": "b"}', 0.25), ("u", 2, None, '{"only": "b"}', 0.25), ("v", 1, "whole", '{"w": "whole"}', None), ("old", 1, "x", "{}", 0.25)]
    old = spark.createDataFrame(before, "task string, item long, reply string, answer string, score double")
    assert {r.task for r in S.changed_tasks(replies, old).collect()} == {"u", "v", "free"}
    again = {(r.task, r.item): r.score for r in S.evaluate_tasks(replies, tasks, fields, old).collect()}
    assert again == {("t", 1): 0.25, ("t", 2): 0.25, ("u", 1): 1, ("u", 2): 0, ("v", 1): 1, ("free", 1): -1}
    assert S.evaluate_tasks(replies.limit(0), tasks, fields, old).count() == 0
    with pytest.raises(Exception, match="unknown parser"):
        S.evaluate_tasks(replies, tasks.withColumn("parser", F.lit("?")), fields).collect()
