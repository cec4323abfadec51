"""Classifiers by held-out accuracy and by their cases."""

import random

import os

import numpy as np
import plain
import pytest

from minewright.llm import language_id, toxicity


def sentence(rng, words, n=12):
    return " ".join(rng.choice(words) for _ in range(n))


NEUTRAL = "walk house tree river stone cloud table paper music bread".split()
RUDE = "moronic scummy trashy".split()


def corpus(rng, n):
    rows, labels = [], []
    for i in range(n):
        bad = i % 4 == 0
        text = sentence(rng, NEUTRAL) + (" " + rng.choice(RUDE) if bad else "")
        if rng.random() < (0.8 if bad else 0.05):  # the mention goes with the label, and must not matter
            text += " women"
        rows.append((i, text))
        labels.append((i, int(bad)))
    return rows, labels


def test_toxicity_learns_the_words_and_not_the_group(make_docs, spark):
    rng = random.Random(1)
    rows, labels = corpus(rng, 800)
    label_rows = spark.createDataFrame(labels, "doc_id long, toxic int")
    docs = make_docs(rows)
    fair = toxicity.fit_toxicity(docs, label_rows, penalty=5.0)
    plain = toxicity.fit_toxicity(docs, label_rows, penalty=0.0)
    probe = make_docs([(1, "walk house women"), (2, "walk house men"), (3, "walk moronic house"), (4, None), (5, "")])
    score = {r.doc_id: r.score for r in toxicity.score_toxicity(probe, fair).collect()}
    before = {r.doc_id: r.score for r in toxicity.score_toxicity(probe, plain).collect()}
    assert score[3] > 0.9 and score[1] < 0.3
    assert score[4] == score[5]
    logit = lambda p: np.log(p / (1 - p))
    assert abs(logit(score[1]) - logit(score[2])) < 0.2 * abs(logit(before[1]) - logit(before[2]))


def test_toxicity_without_labels_or_with_one_class(make_docs, spark):
    docs = make_docs([(1, "a b"), (2, "c"), (None, "d")])
    none = toxicity.fit_toxicity(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    one = toxicity.fit_toxicity(docs, spark.createDataFrame([(1, 0), (2, 0), (2, None), (None, 1)], "doc_id long, toxic int"))
    for model in (none, one):
        assert all(0 <= r.score < 0.01 for r in toxicity.score_toxicity(docs, model).collect())


def languages(rng, n):
    words = {"xx": "aba abo eba ibo".split(), "yy": "rok trok krok rokt".split(), "zz": "mimu numi munu nimu".split()}
    return [(i, sentence(rng, w, 6), k) for i in range(n) for k, w in [list(words.items())[i % 3]]]


def test_language_is_found_on_held_out_texts(make_docs, spark):
    rng = random.Random(2)
    rows = languages(rng, 300)
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    coder = language_id.fit_language_id(frame.where("doc_id % 3 <> 1 OR lang = 'yy'"))
    new = spark.createDataFrame(languages(random.Random(9), 90), "doc_id long, text string, lang string")
    got = language_id.identify_languages(new, coder).collect()
    assert np.mean([r.lang == r.lang_pred for r in got]) > 0.98
    odd = language_id.identify_languages(make_docs([(1, None), (2, ""), (3, "12 ½ ²!"), (4, "krok trok")]), coder).collect()
    assert {r.doc_id: r.lang_pred for r in odd} == {1: "und", 2: "und", 3: "und", 4: "yy"}
    assert all(0 <= r.score <= 1 for r in got + odd) and all(r.ambiguous for r in odd if r.lang_pred == "und")


def test_language_with_nothing_or_one_language_to_learn(make_docs, spark):
    docs = make_docs([(1, "krok"), (2, None)])
    none = language_id.fit_language_id(docs.where("false"))
    assert {r.lang_pred for r in language_id.identify_languages(docs, none).collect()} == {"und"}
    one = language_id.fit_language_id(docs)
    assert {r.doc_id: r.lang_pred for r in language_id.identify_languages(docs, one).collect()} == {1: "en", 2: "und"}


def test_codewords_differ_in_many_bits():
    for n in (2, 3, 4, 6, 9, 20):
        m = language_id.code_matrix(n)
        apart = [(m[i] != m[j]).sum() for i in range(n) for j in range(i)]
        assert min(apart) >= max(1, m.shape[1] // 4), n


LONG = "moronic " * 40_000 + "x" * 300_000 + " women " + "é½ ١٢ " * 1000


def test_toxicity_scores_equal_a_plain_sum(make_docs, spark, odd_rows):
    rows, labels = corpus(random.Random(3), 800)
    model = toxicity.fit_toxicity(make_docs(rows), spark.createDataFrame(labels, "doc_id long, toxic int"))
    probe = rows[:40] + odd_rows + [(99, LONG[:500_000]), (98, "Walk MORONIC trashyscummy " * 3), (97, "İstanbul ﬁne ẞ")]
    got = [(r.doc_id, r.score) for r in toxicity.score_toxicity(make_docs(probe), model).collect()]
    want = [(i, plain.toxic_score(t, model) if i != 99 else None) for i, t in probe]
    key = lambda x: (repr(x[0]), round(x[1], 9))
    assert len(got) == len(want)
    mine, theirs = sorted((x for x in got if x[0] != 99), key=key), sorted((x for x in want if x[0] != 99), key=key)
    assert [i for i, _ in mine] == [i for i, _ in theirs] and np.allclose([s for _, s in mine], [s for _, s in theirs], atol=1e-12)
    assert dict(got)[99] > 0.9  # a very long text is read whole


def test_toxicity_of_no_rows(make_docs, spark):
    assert toxicity.score_toxicity(make_docs([]).limit(0), toxicity.ToxicityModel()).count() == 0
    assert language_id.identify_languages(make_docs([]).limit(0), None).count() == 0


def test_terms_come_as_a_table_and_pairs_are_reported(make_docs, spark):
    rows, labels = corpus(random.Random(1), 400)
    label_rows = spark.createDataFrame(labels, "doc_id long, toxic int")
    terms = spark.createDataFrame([("sex", "women"), ("sex", "men"), ("none", "nowhere"), (None, "x"), ("x", None)], "kind string, term string")
    with_terms = toxicity.fit_toxicity(make_docs(rows), label_rows, terms=terms)
    mentions = sum("women" in t for _, t in rows)
    assert (with_terms.texts, with_terms.pairs, with_terms.pairs_used) == (400, 2 * mentions - mentions, mentions)  # two steps on from one of two is itself
    assert toxicity.fit_toxicity(make_docs(rows), label_rows, terms=[]).pairs == 0


SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="the tables are not here")
def test_swaps_of_terms_that_the_tables_hold(spark):
    documents, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    fair = toxicity.fit_toxicity(documents, labels, penalty=20.0)
    plainly = toxicity.fit_toxicity(documents, labels, penalty=0.0)
    assert fair.pairs_used > 0 and fair.pairs >= fair.pairs_used
    he, she = plain.feature("he", 0), plain.feature("she", 0)
    assert abs(fair.weights[he] - fair.weights[she]) <= abs(plainly.weights[he] - plainly.weights[she])


def test_languages_equal_a_plain_loop(make_docs, spark, odd_rows):
    frame = spark.createDataFrame(languages(random.Random(2), 150), "doc_id long, text string, lang string")
    coder = language_id.fit_language_id(frame)
    probe = [(i, t) for i, t, _ in languages(random.Random(7), 30)] + odd_rows + [(50, "aba krok mimu rok"), (51, "aba " * 50_000 + "krok")]
    got = sorted((repr(r.doc_id), r.lang_pred, r.ambiguous, round(r.score, 9)) for r in language_id.identify_languages(make_docs(probe), coder).collect())
    want = sorted((repr(i), a, c, round(b, 9)) for i, t in probe for a, b, c in [plain.language(t, coder, 0.1)])
    assert got == want
