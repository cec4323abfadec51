"""Queries do the whole job: whole texts, every row, no group in one piece."""

import math
import random

import pytest

from minewright.operators import sampling
from minewright.operators.statistics import edit_distance
from minewright.plans.catalog import CATALOG

TALK = "conv_id long, turn long, role string, text string"


def talk(spark, tmp_path):
    """Turns that agree far beyond 200 characters, and differ after that; their order is not that of the rows."""
    rng = random.Random(5)
    head, words = " ".join(["same"] * 80), "ba ke li mo nu".split()
    rows = [(c, t, "user" if t % 2 else "assistant", head + " " + " ".join(rng.choice(words) for _ in range(60))) for c in range(6) for t in range(1, 5)]
    rng.shuffle(rows)
    spark.createDataFrame(rows, TALK).repartition(3).write.parquet(f"{tmp_path}/conversations.parquet")
    order = sorted(rows)
    return str(tmp_path), [(a[2], a[3], b[3]) for a, b in zip(order, order[1:]) if a[0] == b[0]]


def test_word_error_rate_scores_whole_turns(spark, tmp_path):
    sf_dir, pairs = talk(spark, tmp_path)
    got = {r.role: r.wer for r in CATALOG["word_error_rate"].run(spark, sf_dir).collect()}
    for role in ("user", "assistant"):
        mine = [(p.split(), r.split()) for x, p, r in pairs if x == role]
        assert math.isclose(got[role], 100 * sum(edit_distance(*m) for m in mine) / sum(len(r) for _, r in mine))


def test_corpus_bleu_scores_whole_turns(spark, tmp_path):
    sf_dir, pairs = talk(spark, tmp_path)
    got = {r.role: r.bleu for r in CATALOG["corpus_bleu"].run(spark, sf_dir).collect()}
    for role in ("user", "assistant"):
        logs = 0.0
        for n in range(1, 5):
            match = total = 0
            for _, p, r in [x for x in pairs if x[0] == role]:
                grams = [[tuple(t[i : i + n]) for i in range(len(t) - n + 1)] for t in (p.split(), r.split())]
                match += sum(min(grams[0].count(g), grams[1].count(g)) for g in set(grams[0]))
                total += len(grams[0])
            logs += math.log(match / total) / 4
        assert math.isclose(got[role], 100 * math.exp(logs))  # all turns are of one length


def test_turn_scores_see_the_end_of_a_turn(spark, tmp_path):
    sf_dir, pairs = talk(spark, tmp_path)
    assert {r.exact_match for r in CATALOG["exact_match_turns"].run(spark, sf_dir).collect()} == {0.0}
    assert CATALOG["token_f1_turns"].run(spark, sf_dir).count() == len(pairs) == CATALOG["jaccard_turns"].run(spark, sf_dir).count()
    assert min(len(r.marked) for r in CATALOG["image_mark_whole"].run(spark, sf_dir).collect()) > 400


def test_response_queries_take_all_events(spark, tmp_path):
    rows = [(i, i % 3, "click" if i % 5 else "view", f'{{"k": {i}}}') for i in range(60)]
    spark.createDataFrame(rows, "event_id long, user_id long, event_type string, props string").write.parquet(f"{tmp_path}/events.parquet")
    numbers = {r.user_id: r.numbers for r in CATALOG["filter_regex_all"].run(spark, str(tmp_path)).collect()}
    assert numbers == {u: [str(i) for i in range(60) if i % 3 == u] for u in range(3)}
    assert {r.vote for r in CATALOG["majority_vote_all"].run(spark, str(tmp_path)).collect()} == {"click"}
    assert all(r.accuracy == 1.0 for r in CATALOG["consensus_accuracy_all"].run(spark, str(tmp_path)).collect())
    kept = {r.user_id: r.kept for r in CATALOG["filter_chain_all"].run(spark, str(tmp_path)).collect()}
    assert kept == {0: ["B", "A"], 1: ["A", "A"], 2: ["A", "B"]}


def test_names_match_by_whole_stems_without_pairs(spark, tmp_path):
    names = ["Red Lamp", "red-lamp 2", "lamp", "", "green lamb", "greenlambs", "Old Lamp", "x", "old"] + ["Same Name"] * 40
    rows = [(i + 1, n, f"b{i % 2}") for i, n in enumerate(names)]
    spark.createDataFrame(rows, "p_partkey long, p_name string, p_brand string").write.parquet(f"{tmp_path}/part.parquet")
    got = {r.image: r.file for r in CATALOG["fuzzy_name_match_all"].run(spark, str(tmp_path)).collect()}
    stem = {k: "".join(c for c in n.lower() if c.isascii() and c.isalnum()) for k, n, _ in rows}
    brand = {k: b for k, _, b in rows}
    assert got == {k: min(j for j in stem if brand[j] == brand[k] and (stem[j] in stem[k] or stem[k] in stem[j])) for k in stem}
    plan = CATALOG["fuzzy_name_match"].run(spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
    assert "Contains" not in plan and "contains" not in plan


def test_a_hot_group_is_ranked_in_ranges(spark):
    rows = [("hot", i, i % 7) for i in range(500)] + [("b", i, 1) for i in range(9)] + [(None, i, 2) for i in range(3)]
    random.Random(2).shuffle(rows)
    df = spark.createDataFrame(rows, "g string, k long, s long").repartition(3)
    got = sampling.ranked_within(df, ["g"], ["k"], "s").collect()
    assert sorted((str(r.g), r.k, r["_rank"], r["_count"], r["_run"]) for r in got) == sorted(
        (str(g), k, k + 1, sum(x[0] == g for x in rows), sum(x[2] for x in rows if x[0] == g and x[1] <= k)) for g, k, _ in rows)
    tiles = {(r.g, r.k): r.t for r in sampling.ntile(df, ["g"], ["k"], 4, "t").collect()}
    assert [tiles["b", k] for k in range(9)] == [1, 1, 1, 2, 2, 3, 3, 4, 4] and [tiles[None, k] for k in range(3)] == [1, 2, 3]


@pytest.mark.parametrize("name", ["hash_chain", "size_buckets", "ntile_split", "median_unsorted"])
def test_no_group_is_gathered_or_ranked_whole(spark, name):
    plan = CATALOG[name].run(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in plan
    for line in plan.splitlines():
        assert "Window [" not in line or "_p#" in line or "_size" in line
