"""Queries that SQL cannot say, against plain Python on small inputs."""

import hashlib
import html as entities
import math
import os
import random
import re

import numpy as np
import pytest

from minewright.functions import choices
from minewright.functions.html import NOISE_WORDS, SKIPPED_TAGS
from minewright.operators import sampling, statistics
from minewright.plans.catalog import CATALOG

SF = "/root/testdata/sf0.001"
tables = pytest.mark.skipif(not os.path.isdir(SF), reason="the tables are not here")


def farthest_first(rows, k):
    rows = sorted(rows)
    chosen, d = [rows[0][0]], {i: math.inf for i, _ in rows}
    at = dict(rows)
    while len(chosen) < min(k, len(rows)):
        c = np.array(at[chosen[-1]])
        for i in d:
            d[i] = min(d[i], float(((np.array(at[i]) - c) ** 2).sum()))
        chosen.append(min((i for i in d if i not in chosen), key=lambda i: (-d[i], i)))
    return chosen


@pytest.mark.parametrize("ahead", [512, 5, 1])
def test_kcenter_equals_plain_greedy(spark, ahead):
    rng = np.random.default_rng(3)
    rows = [(i * 7 % 101, rng.integers(0, 4, 3).astype(float).tolist()) for i in range(60)]  # many ties and equal rows
    frame = spark.createDataFrame([*rows, (999, None)], "vec_id long, embedding array<double>").repartition(3)
    got = [r.id for r in sorted(sampling.kcenter(frame, 15, ahead=ahead).collect())]
    assert got == farthest_first(rows, 15)
    assert sampling.kcenter(frame.limit(0), 3).count() == 0 and sampling.kcenter(frame, 0).count() == 0
    assert sampling.kcenter(frame, 100).count() == 60


def test_length_batches_equal_plain_dealing(spark):
    rng = random.Random(4)
    rows = [(i, rng.randint(1, 50)) for i in range(45)]
    got = {r.k: (r.megabatch, r.worker) for r in sampling.length_batches(spark.createDataFrame(rows, "k long, n int"), "k", "n", batch=3, world=4, seed=2).collect()}
    mixed = sorted(rows, key=lambda r: (hashlib.md5(f"{r[0]}:2".encode()).hexdigest(), r[0]))
    for m in range(0, len(mixed), 12):
        part = sorted(mixed[m : m + 12], key=lambda r: (-r[1], r[0]))
        load, held, room = [0] * 4, [0] * 4, -(-len(part) // 4)
        for k, n in part:
            w = min((x for x in range(4) if held[x] < room), key=lambda x: (load[x], x))
            load[w] += n
            held[w] += 1
            assert got[k] == (m // 12, w)


def test_ratings_are_the_most_likely(spark):
    rng = random.Random(5)
    strength = {"a": 0.0, "b": 1.0, "c": -0.5}
    battles = []
    for _ in range(600):
        x, y = rng.sample("abc", 2)
        p = 1 / (1 + math.exp(strength[y] - strength[x]))
        battles.append((x, y, rng.choices(["model_a", "model_b", "tie"], [p, 1 - p, 0.2])[0]))
    got = {r.model: (r.rating - 1000) * math.log(10) / 400 for r in statistics.elo(spark.createDataFrame(battles, "model_a string, model_b string, winner string"), "a").collect()}
    for m in strength:  # at the best ratings, the expected wins are the wins
        won = sum({"model_a": 1.0, "model_b": 0.0}.get(w, 0.5) * 2 for x, y, w in battles if x == m) + sum({"model_a": 0.0, "model_b": 1.0}.get(w, 0.5) * 2 for x, y, w in battles if y == m)
        hoped = sum(2 / (1 + math.exp(got[y if x == m else x] - got[m])) for x, y, _ in battles if m in (x, y))
        assert abs(won - hoped) < 0.05, m


def test_resampled_errors_agree_with_theory(spark):
    rng = random.Random(6)
    rows = [("g", rng.gauss(5, 2)) for _ in range(400)]
    r = statistics.bootstrap(spark.createDataFrame(rows, "g string, v double"), ["g"], "v", iterations=600).first()
    x = np.array([v for _, v in rows])
    error = x.std(ddof=1) / math.sqrt(len(x))
    assert abs(r.stderr - error) < 0.15 * error and abs((r.high - r.low) - 3.92 * error) < 0.25 * 3.92 * error and r.low < x.mean() < r.high


def plain_nodes(html):
    """Texts of a page by cutting at tags, with a stack of what is open."""
    found, stack, skip = [], [], 0
    for token in re.findall(r"(?s)<!--.*?-->|<(?:script|style)\b[^>]*>.*?</(?:script|style)>|<[^>]*>|[^<]+", html):
        if token.startswith("<!--"):
            found += [token[4:-3].strip()] if not skip and token[4:-3].strip() else []
        elif re.match(r"<(script|style)\b", token) or token.startswith("<!"):
            continue
        elif token.startswith("</"):
            name = token[2:-1].strip().lower()
            if name in stack:
                while stack.pop() != name:
                    pass
                skip = 0 if len(stack) < skip else skip
        elif token.startswith("<"):
            name = re.match(r"<([a-z0-9]+)", token.lower())[1]
            if name == "body":
                found = []
            if name in ("br", "hr", "img", "input", "link", "meta", "base"):
                continue
            stack.append(name)
            given = {k.lower(): v for k, v in re.findall(r'([\w-]+)="([^"]*)"', token)}
            noise = name in SKIPPED_TAGS or any(c in NOISE_WORDS for c in given.get("class", "").lower().split()) or any(w in given.get("id", "").lower() for w in NOISE_WORDS)
            skip = skip or (len(stack) if noise else 0)
        elif not skip and (text := entities.unescape(token).strip()):
            found.append(text)
    return " ".join(found)


@tables
def test_page_texts_equal_a_plain_parser(spark):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    nodes = {}
    for r in sorted(CATALOG["page_nodes"].run(spark, SF).collect()):
        nodes.setdefault(r.page_id, []).append(r)
    assert {i: " ".join(n.content for n in ns) for i, ns in nodes.items()} == {i: t for i, h in pages.items() if (t := plain_nodes(h))}
    assert all(n.type == "text" and n.pos == k for ns in nodes.values() for k, n in enumerate(ns))
    assert all(r.links == [] and r.inline == [] for r in CATALOG["page_image_links"].run(spark, SF).collect())  # the tables have no image
    documents = {r.page_id: r.document for r in CATALOG["page_llm_doc"].run(spark, SF).collect()}
    assert documents == {i: "<document>\n" + "\n\n".join(n.content for n in nodes.get(i, [])) + "\n</document>" for i in pages}


@tables
def test_choices_and_names_equal_plain_rules(spark):
    customers = {r.c_custkey: r.c_mktsegment for r in spark.read.parquet(f"{SF}/customer.parquet").collect()}
    for r in CATALOG["choice_parse"].run(spark, SF).collect():
        k = r.c_custkey
        want = "B" if k % 3 == 0 else "A" if k % 3 == 1 else "ABC"[int(hashlib.md5(str(k).encode()).hexdigest(), 16) % 3]
        assert r.choice == want and k in customers
    names = {r.page_id: r.name for r in CATALOG["image_names"].run(spark, SF).collect()}
    for r in spark.read.parquet(f"{SF}/pages.parquet").collect():
        base = re.sub(r"[?#].*", "", r.url).rsplit("/", 1)[-1]
        base = "" if base == re.sub(r"[?#].*", "", r.url).split("//", 1)[-1] else base
        stem = re.sub(r"\.[^.]*$", "", base) if "." in base[1:] else base
        assert names[r.page_id] == (base if stem.strip("._-") else f"img_{hashlib.md5(r.url.encode()).hexdigest()[:16]}.unknown")


def test_numbers_in_replies():
    assert choices.numeric_match("so 1,000", "1000") and choices.numeric_match(r"\frac{1}{2}", "0.5") and not choices.numeric_match("none", "1")
