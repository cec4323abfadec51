"""N-grams counted in tasks, against counters of plain Python."""

from collections import Counter, defaultdict

import numpy as np
import pytest

from minewright.operators import captions as C
from minewright.operators import grams as G


def letters(texts, n):
    bare = ["".join(c for c in t or "" if c not in " \t\n\x0b\x0c\r") for t in texts]
    return sum((Counter(t[i : i + n] for i in range(len(t) - n + 1)) for t in bare), Counter())


MANY = "".join(map(chr, range(0x4E00, 0x4E00 + 1500)))
PAIRS = [("a b\tab", "abab"), (None, "abc"), ("", ""), ("aaaaaaa", "aaa"), ("né \U0001f642é", "é\U0001f642 né"), (MANY + MANY[:300], MANY[200:] + MANY), ("x", "xyzzyxyzzy"), ("xyzzy", "zzyx")]


@pytest.mark.parametrize("of", [list(range(8)), [0, 0, 1, 1, 1, 2, 3, 3]])
def test_letter_matches_equal_counters(of):
    got = G.letter_matches([p for p, _ in PAIRS], [r for _, r in PAIRS], np.array(of), 6)
    for k in range(max(of) + 1):
        for n in range(1, 7):
            p, r = (letters([PAIRS[i][s] for i in range(8) if of[i] == k], n) for s in (0, 1))
            assert got[k, :, n - 1].tolist() == [(p & r).total(), p.total(), r.total()]
    assert G.letter_matches([], [], np.array([], int), 6).shape == (0, 3, 6)


def keyed_rows(spark):
    rows = [("u" if i % 3 else None, i // 2 if i < 6 else i, p, r) for i, (p, r) in enumerate(PAIRS)]
    return rows, spark.createDataFrame(rows, "role string, k long, text string, ref string").repartition(3)


def test_chrf_sums_in_tasks(spark):
    """Texts of one key are counted together, a key with a null shares nothing, and no n-gram is a row."""
    rows, df = keyed_rows(spark)
    got = {r.role: r.chrf for r in C.chrf(df, ["role"], ["k"], "text", "ref").collect()}
    sums = defaultdict(lambda: np.zeros((6, 3)))
    for role, k in {x[:2] for x in rows}:
        for n in range(1, 7):
            p, r = (letters([x[s] for x in rows if x[:2] == (role, k)], n) for s in (2, 3))
            sums[role][n - 1] += [(p & r).total() if role else 0, p.total(), r.total()]
    for role, x in sums.items():
        p, r = (np.mean(x[:, 0] / x[:, i]) for i in (1, 2))
        assert got[role] == pytest.approx(100 * 5 * p * r / (4 * p + r) if p + r else 0)
    plan = C.chrf(df, ["role"], ["k"], "text", "ref")._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" in plan and "Generate" not in plan.partition("MapInArrow")[2]


def test_rows_of_one_key_stay_together():
    import pyarrow as pa

    keys = [1, 1, 1, 2, None, None, 3]
    batches = [pa.record_batch([pa.array([k], pa.int64()), pa.array(["word"])], names=["k", "t"]) for k in keys]
    got = [(t["k"].to_pylist(), of.tolist(), known.tolist()) for t, of, known in G.keyed(iter(batches), ["k"], ["t"], 1)]
    assert got == [([1, 1, 1], [0, 0, 0], [True] * 3), ([2], [0], [True]), ([None, None], [0, 0], [False] * 2), ([3], [0], [True])]


def test_consensus_by_batches(spark):
    """Document frequencies come from all batches; texts of one key are counted together and a key with a null scores 0."""
    import math
    import re

    rows, df = keyed_rows(spark)
    rows += [("u", 20 + i, f"the cat {i % 3} sat on a mat", f"The cat {i % 2} sat, on the mat") for i in range(12)]
    df = df.union(spark.createDataFrame(rows[len(PAIRS) :], df.schema))
    words = lambda t: re.findall("[a-z0-9]+", (t or "").lower())
    count = lambda texts: Counter((n, tuple(w[i : i + n])) for w in map(words, texts) for n in range(1, 5) for i in range(len(w) - n + 1))
    keys = {x[:2] for x in rows}
    p, r = ({k: count([x[s] for x in rows if x[:2] == k]) for k in keys} for s in (2, 3))
    found = Counter(g for k in keys for g in r[k])
    want = []
    for role, k, a, b in rows:
        w = lambda c: {g: x * (math.log(len(rows)) - math.log(max(found[g], 1))) for g, x in c[role, k].items()}  # noqa: E731, B023
        x, y, s = w(p), w(r), 0.0
        for n in range(1, 5):
            dot = sum(min(x[g], y[g]) * y[g] for g in x if g in y and g[0] == n)
            both = math.prod(math.sqrt(sum(v * v for g, v in z.items() if g[0] == n)) for z in (x, y))
            s += dot / both if both else dot
        d = max(len(words(a)) - 1, 0) - max(len(words(b)) - 1, 0)
        want.append((role, k, pytest.approx(10 * (s if role else 0) / 4 * math.exp(-d * d / 72))))
    for size, grams in ((1 << 20, 2_000_000), (1, 3)):  # all rows in a batch, a key in each
        own = df.select("role", "k", *[C.F.regexp_replace(C.F.lower(c), "[^a-z0-9]+", " ").alias(c) for c in ("text", "ref")])
        got = G.consensus(own, ["role", "k"], "text", "ref", C.SIGMA, size, grams)
        assert sorted(map(tuple, got.collect()), key=lambda t: (repr(t[:2]), t[2])) == sorted(want, key=lambda t: (repr(t[:2]), t[2].expected))
    assert sorted(map(tuple, C.consensus_scores(df, ["role", "k"], "text", "ref").collect()), key=lambda t: (repr(t[:2]), t[2])) == sorted(want, key=lambda t: (repr(t[:2]), t[2].expected))
    assert C.consensus_scores(df.limit(0), ["role", "k"], "text", "ref").count() == 0
