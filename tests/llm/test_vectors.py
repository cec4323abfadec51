"""Top-k search, vector near-duplicates, components and URL rules against brute force."""

import random
from collections import Counter

import numpy as np
import pytest

from pyspark.sql import functions as F

from minewright.llm import topk
from minewright.llm.components import connected_components, with_least
from minewright.llm.topk import topk_search
from minewright.llm.url_rules import OP5_RULES, judge_urls, make_rules
from minewright.llm.vector_dedup import plan_tables, same_cell, vector_links
from minewright.staging import stage

VECTORS = "id long, v array<double>, label int, n long, score double"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, 1, 0.0) for i, v in rows], VECTORS).repartition(3)


BAD = [(900, None), (901, []), (902, [1.0, None, 2.0, 3.0, 1.0]), (903, [float("nan")] * 5), (904, [float("inf")] * 5), (None, [1.0] * 5)]


@pytest.mark.parametrize("blocks", [(2048, 4096), (3, 7)])
def test_topk_equals_brute_force(spark, blocks):
    rng = np.random.default_rng(0)
    rows = [(i, rng.integers(-9, 10, 5).astype(float).tolist()) for i in range(120)] + [(200, [1.0] * 5), (201, [1.0] * 5), (202, [0.0] * 3)]
    got = Counter((r.query_id, r["rank"], r.vec_id, r.score) for r in topk_search(frame(spark, rows + BAD + rows[5:8]), frame(spark, [r for r in rows + BAD if r[0] is not None and r[0] % 10 == 0]), k=4, query_block=blocks[0], candidate_block=blocks[1]).collect())
    want = Counter()
    for q, x in rows:
        if q % 10 == 0:
            best = sorted((-int(np.dot(x, y)), c) for c, y in rows + rows[5:8] if c != q and len(y) == len(x))[:4]
            want.update((q, k + 1, c, -s) for k, (s, c) in enumerate(best))
    assert got == want


@pytest.mark.parametrize("blocks", [(2048, 4096), (3, 7)])
def test_topk_keeps_other_vectors_of_a_repeated_id(spark, blocks):
    rng = np.random.default_rng(4)
    rows = [(i % 30, rng.integers(-9, 10, 5).astype(float).tolist()) for i in range(60)]
    got = topk_search(frame(spark, rows), frame(spark, [r for r in rows if r[0] % 10 == 0]), k=6, query_block=blocks[0], candidate_block=blocks[1]).collect()
    for q in (0, 10, 20):
        best = sorted((-int(np.dot(x, y)), c) for i, x in rows if i == q for c, y in rows if c != q)[:6]
        assert sorted((-r.score, r.vec_id) for r in got if r.query_id == q) == best


@pytest.mark.parametrize("options", [{}, {"query_block": 3, "candidate_block": 7, "group_bytes": 500}])
def test_topk_of_rows_among_themselves_keeps_every_row(spark, options):
    """Against the registered SQL, with repeated rows, repeated ids of other vectors, and rows that take no part."""
    import duckdb

    rng = np.random.default_rng(7)
    rows = [(i % 70, (rng.integers(-9, 10, 6) / 256).tolist()) for i in range(110)]
    rows += [rows[0], rows[0], rows[50], rows[3], (1, [0.25] * 6), (1, [0.25] * 6), (900, None), (901, [float("nan")] * 6), (None, [0.5] * 6)]
    got = topk_search(frame(spark, [(i, None if v is None else [float(np.floor(256 * x)) if x == x else x for x in v]) for i, v in rows]), F.col("id") % 50 == 0, k=5, **options)
    con = duckdb.connect()
    con.execute("CREATE TABLE embeddings (vec_id BIGINT, embedding DOUBLE[])")
    con.executemany("INSERT INTO embeddings VALUES (?, ?)", rows)
    want = Counter(con.execute(topk.OP2_SQL).fetchall())
    assert Counter(tuple(r) for r in got.collect()) == want and want[(0, 1, *next((v, s) for q, n, v, s in want if (q, n) == (0, 1)))] >= 1
    assert sum(n for (q, _, _, _), n in want.items() if q == 0) == 5 * 4


def test_entries_under_the_threshold_stay_in_their_lists(spark):
    rng = np.random.default_rng(8)
    rows = [(i, rng.integers(-50, 51, 16).astype(float).tolist()) for i in range(600)]
    c = topk.pack_blocks(frame(spark, rows), 100, 2, len(rows))
    q = topk.pack_blocks(frame(spark, rows[:20]), 8, 2, 20).select("dim", "list", F.col("block").alias("q_block"), F.col("ids").alias("q_ids"), F.col("rows").alias("q_rows"), F.col("data").alias("q_data"))
    c, q = stage(c, "test-c"), stage(q, "test-q")
    known = stage(topk.cutoffs(c, q, 5), "test-cutoffs")
    least = {r.q: r.cutoff for r in known.collect()}
    entries = topk.collect_entries(c, q, known).collect()
    v = dict(rows)
    half = [slice(0, 8), slice(8, 16)]
    assert len(least) == 20 and all(2 * r.local >= least[r.q] and r.local == np.dot(v[r.query_id][half[r.list]], v[r.vec_id][half[r.list]]) for r in entries)
    of = {r.query_id: least[r.q] for r in entries}
    want = {(i, j, k) for i in of for j in v if i != j for k in (0, 1) if 2 * np.dot(v[i][half[k]], v[j][half[k]]) >= of[i]}
    assert {(r.query_id, r.vec_id, r.list) for r in entries} == want and len(want) < 0.1 * 2 * 20 * 600


@pytest.mark.parametrize("lists", [1, 3, 7])
def test_topk_in_groups_of_queries(spark, lists):
    rng = np.random.default_rng(9)
    rows = [(i % 80, rng.integers(-9, 10, 5).astype(float).tolist()) for i in range(100)]
    got = topk_search(frame(spark, rows), frame(spark, [r for r in rows if r[0] % 4 == 0]), k=3, lists=lists, query_block=4, candidate_block=9, group_bytes=400).collect()
    for q in range(0, 80, 4):
        best = sorted((-int(np.dot(x, y)), c) for i, x in rows if i == q for c, y in rows if c != q)[:3]
        assert sorted((-r.score, r.vec_id) for r in got if r.query_id == q) == best


def test_topk_is_exact_beyond_floats_and_refuses_overflow(spark):
    big = 2.0**27
    rows = [(0, [big, big, 1.0]), (1, [big, big, 0.0]), (2, [big, big, 1.0])]
    got = topk_search(frame(spark, rows), frame(spark, rows[:1]), k=2).collect()
    assert [(r.vec_id, r.score) for r in sorted(got, key=lambda r: r["rank"])] == [(2, 2**55 + 1), (1, 2**55)]
    huge = [(0, [2.0**40]), (1, [2.0**40])]
    with pytest.raises(Exception, match="64 bits"):
        topk_search(frame(spark, huge), frame(spark, huge), k=1).collect()


def links(rows, cosine):
    def unit(v):
        ok = v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)
        return np.array(v) / np.linalg.norm(v) if ok else None

    units = [unit(v) for _, v in rows]
    near = [[j for j in range(len(rows)) if j != i and units[i] is not None and units[j] is not None and len(units[i]) == len(units[j]) and units[i] @ units[j] >= cosine] for i in range(len(rows))]
    out = Counter()
    for i, (d, _) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        least = min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)
        out[d, len(near[i]), least, d is not None and d == least] += 1
    return out


@pytest.mark.parametrize("options", [{}, {"family_rows": 3, "chunk": 4}])
def test_vector_links_equal_brute_force(spark, options):
    rng = np.random.default_rng(1)
    rows = [(i, rng.standard_normal(16).tolist()) for i in range(150)]
    for g in range(5):
        centre = rng.standard_normal(16)
        rows += [(200 + 20 * g + k, (centre + 0.08 * rng.standard_normal(16)).tolist()) for k in range(20)]
    rows += [(400 + k, rows[0][1]) for k in range(3)] + [(400, rows[0][1])] + BAD + [(905, [0.0] * 16)]
    got = Counter((r.id, r.n_links, r.component_id, r.kept) for r in vector_links(frame(spark, rows), miss=1e-4, **options).collect())
    assert got == links(rows, 0.95)


def test_least_of_components_with_hot_ones(spark):
    rows = [(i, 7 if i % 2 else i % 5 if i % 3 else None) for i in range(200)] + [(None, 7), (None, 99)]
    frame = spark.createDataFrame(rows, "id long, c long")
    want = Counter((i, min((j for j, d in rows if d == c and j is not None), default=None) if c is not None else None) for i, c in rows)
    for hot in (1000, 20, 1):
        assert Counter((r.id, r.least) for r in with_least(frame, "c", "id", hot).collect()) == want


def test_vectors_of_an_empty_table(spark):
    empty = frame(spark, []).limit(0)
    assert vector_links(empty).count() == 0 and topk_search(empty, empty).count() == 0


def test_planned_tables_reach_their_recall():
    for n in (100, 50_000, 10_000_000):
        hashes, tables = plan_tables(n, 0.95)
        assert (1 - same_cell((2 - 2 * 0.95) ** 0.5) ** hashes) ** tables <= 0.005


def test_components_equal_union_find(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(k, k + 1) for k in range(1000, 1060)] + [(5000, 5000), (7, 7)]
    root = {x: x for e in edges for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        p, q = find(a), find(b)
        root[max(p, q)] = min(p, q)
    got = {r.node: r.component for r in connected_components(spark.createDataFrame([*edges, (None, 3)], "u long, v long")).collect()}
    assert got == {x: find(x) for x in root}
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_url_rules(spark):
    urls = {
        1: "http://A.Example.com/en/75", 2: "https://x.com/en/", 3: "http://example.net/de/81#x", 4: "http://b.net/de/8", 5: "http://org/es/1?q", 6: "nothing", 7: None,
        8: "http://notexample.com/en/7", 9: "http://c.org", 10: "http://com/en/", 11: "a://b://c.org/es/", 12: "http://example.com/en/7/" + "y" * 5000, 13: "",
    }
    pages = spark.createDataFrame([(i, u, "h", "r") for i, u in urls.items()] + [(1, urls[1], "h", "r"), (None, urls[2], "h", "r")], "page_id long, url string, host string, rule string")
    got = judge_urls(pages, make_rules(spark, OP5_RULES)).collect()
    assert len(got) == 15 and sum(r.page_id == 1 for r in got) == 2
    rule = {r.page_id: (r.rule, r.verdict) for r in got}
    assert rule == {
        1: ("example.com/en/7", "allow"), 2: ("com/en/", "block"), 3: ("example.net/de/8", "block"), 4: ("net/de/", "allow"), 5: ("org/es/", "block"), 6: (None, "allow"), 7: (None, "allow"),
        8: ("com/en/", "block"), 9: (None, "allow"), 10: ("com/en/", "block"), 11: (None, "allow"), 12: ("example.com/en/7", "allow"), 13: (None, "allow"), None: ("com/en/", "block"),
    }
    assert judge_urls(pages.limit(0), make_rules(spark, OP5_RULES)).count() == 0
    assert {r.verdict for r in judge_urls(pages, make_rules(spark, [])).collect()} == {"allow"}
    shuffled = judge_urls(pages, make_rules(spark, OP5_RULES), max_broadcast_rules=0).collect()
    assert Counter(map(tuple, shuffled)) == Counter(map(tuple, got))


def test_host_and_path_of_a_rule_stay_apart(spark):
    pages = spark.createDataFrame([(1, "http://x.comen/a"), (2, "http://x.com/en"), (3, "http://com/x")], "page_id long, url string")
    rules = make_rules(spark, [("com", "en", "block"), ("comen", "", "allow"), ("com", "", "block")])
    assert {r.page_id: (r.rule, r.verdict) for r in judge_urls(pages, rules).collect()} == {1: ("comen", "allow"), 2: ("com", "block"), 3: ("com", "block")}


def test_recall_of_the_buckets_alone(spark):
    rng = np.random.default_rng(21)
    base = rng.standard_normal((150, 64))
    x = np.concatenate([base + rng.standard_normal(base.shape) * s for s in (0.0, 0.2, 0.3, 0.22)])  # cosines about the threshold
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = int((x @ x.T >= 0.95).sum()) - len(rows)
    alone = vector_links(spark.createDataFrame(rows, "id long, v array<double>"), family_rows=1)
    found = sum(r.n_links for r in alone.collect())
    assert near > 500 and 0.99 * near <= found <= near
