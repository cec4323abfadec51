"""Toxicity by a linear classifier with a counterfactual penalty.

A text's features are its distinct words and their beginnings of four to
eight letters.  The model is a logistic regression on the features that tell the
classes apart in a bounded sample of labelled texts.  Sampled texts that name a
group of people are read again with the name swapped for the next names of its
kind, and the fit penalises the square of the change of their score, so that the
mention itself carries no weight.  Features of the names always belong to the
model, so that the penalty has something to hold.

The sample (``max_train`` texts, chosen by a hash of the id) is written once.
Its features are counted by class in blocks of features, the best of each block
are candidates, and only the chosen ones of each text (``max_features`` at most)
reach the one task that fits.  Every text is then scored whole, by an Arrow
function of the text alone.

Defined cases: null and empty texts have no feature and get the score of the
intercept; repeated labels of a document count once, as toxic if any says so;
null labels and null ids teach nothing; without any labelled text, or with
labels of one kind only, the score is that share (0 without labels); extra
columns are not read; a run of letters over 130,000 characters is read in
parts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from minewright.llm.words import Runs, fold, hash_sample, letter_runs, letter_words
from minewright.staging import drop_staged, shuffle_width, stage

#: Names of groups, by kind; a name is swapped for others of its kind and language.
IDENTITY_TERMS = [
    ["women", "men"], ["woman", "man"], ["girls", "boys"], ["muslims", "christians", "jews", "hindus", "buddhists", "atheists"],
    ["muslim", "christian", "jewish", "hindu", "buddhist", "atheist"], ["gay", "lesbian", "straight", "bisexual", "transgender"],
    ["black", "white", "asian", "latino", "african", "european"], ["immigrants", "refugees", "natives"], ["deaf", "blind", "disabled"],
    ["he", "she"], ["him", "her"],
    ["femmes", "hommes"], ["musulmans", "chrétiens", "juifs"], ["immigrés", "réfugiés"], ["elle", "il"], ["elles", "ils"],
    ["frauen", "männer"], ["muslime", "christen", "juden"], ["ausländer", "flüchtlinge"], ["er", "sie"],
    ["mujeres", "hombres"], ["musulmanes", "cristianos", "judíos"], ["inmigrantes", "refugiados"], ["él", "ella"],
]
PREFIXES = (4, 5, 6, 7, 8)
_BASE = 0x9E3779B97F4A7C15
#: The most terms that a caller's table may have; they are held by every task.
MAX_TERMS = 10_000


def _mix(h: np.ndarray, kind: int) -> np.ndarray:
    h = (h ^ np.uint64(kind)) * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return (h >> np.uint64(33)).astype(np.int64)


def run_features(r: Runs) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers of all runs, with the number of the text each comes from; a run gives itself and its beginnings."""
    longest = int(r.size.max(initial=0))
    power = np.full(longest + 1, _BASE, np.uint64)
    power[0] = 1
    np.multiply.accumulate(power, out=power)
    at = np.arange(r.size.sum()) - np.repeat(np.cumsum(r.size) - r.size, r.size)  # place in the run
    code = r.codes[np.repeat(r.start, r.size) + at].astype(np.uint64) + np.uint64(0x51ED2701)
    sums = np.zeros(len(at) + 1, np.uint64)
    np.cumsum((code * code) * power[at], out=sums[1:])
    begin = np.cumsum(r.size) - r.size
    features, owners = [_mix(sums[begin + r.size] - sums[begin], 0)], [r.owner]
    for n in PREFIXES:
        has = r.size >= n
        features.append(_mix(sums[begin[has] + n] - sums[begin[has]], n))
        owners.append(r.owner[has])
    return np.concatenate(features), np.concatenate(owners)


def distinct_features(texts: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """Number of each text that has letters, and its distinct features in order."""
    held: list[np.ndarray] = []
    last = -1
    for r in letter_runs(texts):
        f, who = run_features(r)
        order = np.argsort(who, kind="stable")
        f, who = f[order], who[order]
        cuts = np.flatnonzero(np.diff(who)) + 1
        for a, b in zip(np.append(0, cuts), np.append(cuts, len(who)), strict=True):
            if a < b:
                if who[a] != last and held:
                    yield last, np.unique(np.concatenate(held))
                    held = []
                last = int(who[a])
                held.append(np.unique(f[a:b]))
    if held:
        yield last, np.unique(np.concatenate(held))


def swapped(words: list[str], step: int, kinds: dict[str, list[str]]) -> list[str] | None:
    """The words with each group's name replaced by the ``step``-th next of its kind; None if nothing changes."""
    if kinds.keys().isdisjoint(words):
        return None
    other = [k[(k.index(w) + step) % len(k)] if (k := kinds.get(w)) else w for w in words]
    return None if other == words else other


@dataclass
class ToxicityModel:
    """``weights`` by feature, the intercept, and what the fit saw: labelled texts, counterfactual pairs, and those pairs that move a weight."""

    weights: dict[int, float] = field(default_factory=dict)
    intercept: float = -30.0
    texts: int = 0
    pairs: int = 0
    pairs_used: int = 0


def _count_blocks(blocks: int):
    """Counts of features by class, dealt to blocks of features."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label = batch.column(1).to_numpy()
            seen: list[list[np.ndarray]] = [[], []]
            for i, f in distinct_features(batch.column(0)):
                seen[int(label[i] > 0)].append(f)
            names = np.unique(np.concatenate([np.zeros(0, np.int64), *seen[0], *seen[1]]))
            count = [np.bincount(np.searchsorted(names, np.concatenate([np.zeros(0, np.int64), *s])), None, len(names)) for s in seen]
            block = (names % blocks).astype(np.int32)
            order = np.argsort(block, kind="stable")
            parts = [i for i in np.split(order, np.flatnonzero(np.diff(block[order])) + 1) if len(i)]
            yield pa.record_batch([pa.array([int(block[i[0]]) for i in parts], pa.int32()), *(pa.array([x[i].astype("<i8").tobytes() for i in parts], pa.binary()) for x in (names, count[1], count[0]))], names=["block", "f", "yes", "no"])

    return run


def _best_features(pos: int, neg: int, keep: int):
    """The features of a block that tell the classes apart, the surest ``keep`` of them."""

    def run(key: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
        f, yes, no = (np.frombuffer(b"".join(t[c].to_pylist()), "<i8") for c in ("f", "yes", "no"))
        names, at = np.unique(f, return_inverse=True)
        yes, no = np.bincount(at, yes), np.bincount(at, no)
        odds = np.log((yes + 0.5) / (pos + 1)) - np.log((no + 0.5) / (neg + 1))
        sure = np.abs(odds) / np.sqrt(1 / (yes + 0.5) + 1 / (no + 0.5))
        best = np.lexsort((names, -sure))[:keep]
        best = best[(sure[best] > 3) & (yes + no > 2)[best]]
        return pa.table({"f": pa.array(names[best], pa.int64()), "sure": pa.array(sure[best], pa.float64())})

    return run


_ROWS = "label int, step int, cells array<int>"


def _design(kept: np.ndarray, kinds: dict[str, list[str]]):
    """The chosen features of sampled texts as columns of the design; a swapped text as the difference to its original.

    A column c that only the original has is ``c``, one that only the swapped text has is ``-c - 1``.
    """

    def columns(f: np.ndarray) -> np.ndarray:
        slot = np.minimum(np.searchsorted(kept, f), max(len(kept) - 1, 0))
        return slot[kept[slot] == f] if len(kept) else slot[:0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, label = batch.column(0), batch.column(1).to_pylist()
            own = {i: columns(f) for i, f in distinct_features(texts)}
            rows = [(label[i], 0, own.get(i, kept[:0]).astype(np.int32)) for i in range(len(texts))]
            for i in own:
                words = letter_words(texts[i].as_py())
                for step in (1, 2):
                    if (other := swapped(words, step, kinds)) is not None:
                        new = next((columns(f) for _, f in distinct_features(pa.array([" ".join(other)]))), kept[:0])
                        gone, come = np.setdiff1d(own[i], new), np.setdiff1d(new, own[i])
                        rows.append((label[i], step, np.concatenate([gone, -come - 1]).astype(np.int32)))
            yield pa.record_batch([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.list_(pa.int32()))], names=["label", "step", "cells"])

    return run


def fit_logistic(offsets: np.ndarray, cols: np.ndarray, y: np.ndarray, pairs: list[tuple[np.ndarray, np.ndarray]], n: int, penalty: float, l2: float, rounds: int) -> np.ndarray:
    """Weights (the intercept last) by Adam on the full sample: log loss, ridge, and squared changes over ``pairs``."""
    rows = np.repeat(np.arange(len(y)), np.diff(offsets))
    w, m, v = np.zeros(n + 1), np.zeros(n + 1), np.zeros(n + 1)
    w[-1] = np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5))
    p_row = np.concatenate([np.full(len(c), i) for i, (c, _) in enumerate(pairs)]) if pairs else np.zeros(0, int)
    p_col = np.concatenate([c for c, _ in pairs]) if pairs else np.zeros(0, int)
    p_sign = np.concatenate([s for _, s in pairs]) if pairs else np.zeros(0)
    for t in range(1, rounds + 1):
        z = np.bincount(rows, w[cols], len(y)) + w[-1]
        e = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - y
        g = np.bincount(cols, e[rows], n + 1) / len(y)
        g[-1] = e.mean()
        if pairs:
            change = np.bincount(p_row, w[p_col] * p_sign, len(pairs))
            g += 2 * penalty * np.bincount(p_col, change[p_row] * p_sign, n + 1) / len(pairs)
        g[:-1] += l2 * w[:-1]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-9)
    return w


def _fit(n: int, penalty: float, l2: float, rounds: int):
    def run(key: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
        step, label = t["step"].to_numpy(), t["label"].to_numpy()
        lists = t["cells"].combine_chunks()
        flat, at = lists.values.to_numpy(), lists.offsets.to_numpy().astype(np.int64)
        cells = [flat[at[i] : at[i + 1]] for i in range(len(step))]
        # Any fixed order of the rows: by label, then by cells.
        order = sorted(np.flatnonzero(step == 0).tolist(), key=lambda i: (label[i], cells[i].astype(">i4").tobytes()))
        y = label[order].astype(float)
        offsets = np.append(0, np.cumsum([len(cells[i]) for i in order]))
        swaps = sorted((cells[i] for i in np.flatnonzero(step > 0)), key=lambda c: c.astype(">i4").tobytes())
        pairs = [(np.where(c < 0, -c - 1, c), np.where(c < 0, -1.0, 1.0)) for c in swaps if len(c)]
        w = fit_logistic(offsets, np.concatenate([cells[i] for i in order]).astype(np.int64), y, pairs, n, penalty, l2, rounds)
        return pa.table({"weights": [w.tolist()], "pairs": pa.array([len(swaps)], pa.int64()), "used": pa.array([len(pairs)], pa.int64())})

    return run


def term_kinds(terms: DataFrame | list[list[str]]) -> dict[str, list[str]]:
    """Each term with all terms of its kind, from lists or from a table of ``kind, term`` with ``MAX_TERMS`` rows at most; lower-cased single words."""
    if isinstance(terms, DataFrame):
        rows = terms.select(F.col("kind").cast("string"), F.lower("term").alias("term")).where("kind IS NOT NULL AND term IS NOT NULL").distinct().limit(MAX_TERMS + 1).collect()
        if len(rows) > MAX_TERMS:
            raise ValueError(f"more than {MAX_TERMS} identity terms")
        by: dict[str, list[str]] = {}
        for r in sorted(rows):
            by.setdefault(r.kind, []).append(r.term)
        terms = list(by.values())
    return {w: k for k in terms for w in k}


def fit_toxicity(
    documents: DataFrame, labels: DataFrame, max_train: int = 16_000, max_features: int = 4096,
    penalty: float = 1.0, l2: float = 2e-5, rounds: int = 300, terms: DataFrame | list[list[str]] = IDENTITY_TERMS,
) -> ToxicityModel:
    """Fit on ``labels`` (``doc_id, toxic``: those that may be learnt from); ``terms`` are lists of names, or a table of ``kind, term``."""
    spark = documents.sparkSession
    kinds = term_kinds(terms)
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = known.where(hash_sample(F.col("doc_id"), max_train, known.count()))  # the bound is what allows the broadcast
    sample = stage(documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", F.col("toxic").cast("int").alias("label")), "toxicity-sample")
    texts, pos = sample.agg(F.count(F.lit(1)), F.coalesce(F.sum((F.col("label") > 0).cast("int")), F.lit(0))).first()
    neg = texts - pos
    if not pos or not neg:
        drop_staged(sample)
        return ToxicityModel(intercept=float(np.log(pos / max(neg, 1e-6) + 1e-9)) if texts else -30.0, texts=texts)
    blocks = shuffle_width(spark)
    ranked = sample.mapInArrow(_count_blocks(blocks), "block int, f binary, yes binary, no binary").groupBy("block").applyInArrow(_best_features(pos, neg, max_features), "f long, sure double")
    best = [r.f for r in ranked.orderBy(F.desc("sure"), "f").limit(max_features).collect()]
    names = [run_features(r)[0] for r in letter_runs(pa.array(sorted(kinds)))]
    kept = np.unique(np.concatenate([np.array(best, np.int64), *names]))
    rows = sample.mapInArrow(_design(kept, kinds), _ROWS)
    fitted = rows.groupBy(F.lit(0).alias("all")).applyInArrow(_fit(len(kept), penalty, l2, rounds), "weights array<double>, pairs long, used long").first()
    drop_staged(sample)
    return ToxicityModel(dict(zip(kept.tolist(), fitted.weights[:-1], strict=True)), fitted.weights[-1], texts, fitted.pairs, fitted.used)


def toxicity_score(text: Column, model: ToxicityModel) -> Column:
    """Score of a text, 0 to 1, as an Arrow function; only the text travels to Python and only the score back."""
    names = np.array(sorted(model.weights), np.int64)
    weight = np.array([model.weights[f] for f in names.tolist()], np.float64)
    intercept = model.intercept

    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        near = np.zeros(1 << 22, bool)  # features that may be in the model, by their last bits
        near[names & (len(near) - 1)] = True
        for texts in batches:
            hits: list[np.ndarray] = []
            if len(names):
                for r in letter_runs(texts):
                    f, who = run_features(r)
                    may = np.flatnonzero(near[f & (len(near) - 1)])
                    f, who = f[may], who[may]
                    slot = np.minimum(np.searchsorted(names, f), len(names) - 1)
                    ok = names[slot] == f
                    hits.append(np.unique(who[ok] * len(names) + slot[ok]))  # a text's distinct features
            hit = np.unique(np.concatenate([np.zeros(0, np.int64), *hits]))
            z = np.bincount(hit // max(len(names), 1), weight[hit % max(len(names), 1)] if len(hit) else None, len(texts)) + intercept
            yield pa.array(1 / (1 + np.exp(-np.clip(z, -30.0, 30.0))), pa.float64())

    return score(text)


def score_toxicity(documents: DataFrame, model: ToxicityModel) -> DataFrame:
    """``documents`` with a column ``score``, which replaces one of that name."""
    return documents.drop("score").withColumn("score", toxicity_score(F.col("text"), model))


THRESHOLD = 0.3


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    model = fit_toxicity(documents, labels.where(fold(F.col("doc_id"), 4) != 2))
    return score_toxicity(documents, model).select(
        "doc_id", (F.coalesce(fold(F.col("doc_id"), 4), F.lit(2)) == 2).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
