"""Language identification by error-correcting output codes.

Each language has a codeword of +1 and -1.  One binary classifier per bit, a
logistic regression on hashed letter n-grams (one to three letters of words with
their ends marked), predicts that bit.  A text is given the language whose
codeword has the smallest loss over the bits, each bit weighted by how well its
classifier separates the sample; a text whose two best codewords lie close is
flagged as ambiguous.

The classifiers are fitted in one task on a bounded sample of labelled texts
(``max_train``, chosen by a hash of the id).  A whole text is read as counts of
n-grams by bucket, in windows of bounded size, whose product with the weights
gives its bit scores; only the text travels to Python and only the result back.

Defined cases: null texts and texts without a letter are ``und`` with score 0;
null languages and null ids teach nothing; with no labelled text everything is
``und``; with one language every text with letters is that language; ties go to
the first language by name; extra columns are not read; a run of letters over
130,000 characters is read in parts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from minewright.llm.words import Runs, fold, hash_sample, letter_runs, unused

BUCKETS, ORDERS = 1 << 14, (1, 2, 3)
#: Features are shares of a text's n-grams times this.
SCALE = 50.0


def code_matrix(n: int, seed: int = 5) -> np.ndarray:
    """``n`` codewords as rows of +1 and -1: all splits into two sides up to six languages, beyond the best of many random codes."""
    if n <= 6:
        splits = range(1, 1 << (n - 1)) if n > 1 else [0]
        return np.array([[1 if s >> i & 1 else -1 for s in splits] for i in range(n)])
    rng, bits = np.random.default_rng(seed), 8 * int(np.ceil(np.log2(n)))
    tries = rng.choice([-1, 1], (200, n, bits))
    apart = [min((bits - np.delete(m @ m[i], i).max()) / 2 for i in range(n)) if (np.abs(m.sum(0)) < n).all() else -1 for m in tries]
    return tries[int(np.argmax(apart))]


def ngram_buckets(r: Runs) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the n-grams of all runs, each as ``<run>``, and the number of the text each comes from."""
    size = r.size + 2
    begin = np.cumsum(size) - size
    c = np.full(size.sum(), ord(">"), np.uint64)
    c[begin] = ord("<")
    at = np.arange(r.size.sum()) - np.repeat(np.cumsum(r.size) - r.size, r.size)  # place in the run
    c[np.repeat(begin + 1, r.size) + at] = r.codes[np.repeat(r.start, r.size) + at]
    left = np.repeat(begin + size, size) - np.arange(len(c))  # letters from here to the word's end
    owner = np.repeat(r.owner, size)
    grams, owners = [], []
    for n in ORDERS:
        m = max(len(c) - n + 1, 0)
        h = np.full(m, n, np.uint64)
        for i in range(n):
            h ^= c[i : i + m]
            h *= np.uint64(0x100000001B3)
            h ^= h >> np.uint64(29)
        whole = left[:m] >= n  # not over the end of a word
        grams.append((h & np.uint64(BUCKETS - 1)).astype(np.int64)[whole])
        owners.append(owner[:m][whole])
    return np.concatenate(grams), np.concatenate(owners)


def text_counts(texts: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """Number of each text that has letters, and how often it has the n-grams of each bucket; a long text comes in parts."""
    for r in letter_runs(texts):
        bucket, owner = ngram_buckets(r)
        order = np.argsort(owner, kind="stable")
        bucket, owner = bucket[order], owner[order]
        cuts = np.flatnonzero(np.diff(owner)) + 1
        for a, b in zip(np.append(0, cuts), np.append(cuts, len(owner)), strict=True):
            if a < b:
                yield int(owner[a]), np.bincount(bucket[a:b], None, BUCKETS)


def _sample_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        langs, at, share, last, total = [], [], [], -1, np.zeros(0)
        of = batch.column(1).to_pylist()
        for i, n in text_counts(batch.column(0)):
            total = total + n if i == last else n
            if i == last:
                langs.pop(), at.pop(), share.pop()
            last = i
            langs.append(of[i])
            at.append(np.flatnonzero(total).astype(np.int32))
            share.append((SCALE * total[at[-1]] / total.sum()).astype(np.float32))
        yield pa.record_batch([pa.array(langs, pa.string()), pa.array(at, pa.list_(pa.int32())), pa.array(share, pa.list_(pa.float32()))], names=["lang", "at", "share"])


def _fit(rounds: int, l2: float):
    def run(key: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
        langs = sorted(set(t["lang"].to_pylist()))
        code = code_matrix(len(langs))
        target = code[np.searchsorted(langs, t["lang"].to_pylist())].T  # bits x texts
        at, share = t["at"].combine_chunks(), t["share"].combine_chunks()
        row = np.repeat(np.arange(t.num_rows), np.diff(at.offsets.to_numpy()))
        there, cell = np.unique(at.values.to_numpy(), return_inverse=True)  # buckets that no text has keep the weight 0
        x = np.zeros((t.num_rows, len(there) + 1), np.float32)  # max_train rows of 64 KiB at most
        x[row, cell] = share.values.to_numpy()
        x[:, -1] = 1
        y = (target.T > 0).astype(np.float32)
        w, m, v = (np.zeros((len(there) + 1, y.shape[1]), np.float32) for _ in range(3))
        for i in range(1, rounds + 1):
            e = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30))) - y
            g = x.T @ e / len(y) + l2 * w
            m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
            w -= 0.2 * (m / (1 - 0.9**i)) / (np.sqrt(v / (1 - 0.999**i)) + 1e-9)
        right = ((x @ w > 0) == (y > 0)).mean(axis=0)
        spread = np.zeros((BUCKETS, y.shape[1]), "<f4")
        spread[there] = w[:-1]
        out = [{"weights": np.ascontiguousarray(spread[:, j]).tobytes(), "bias": float(w[-1, j]), "trust": float(max(right[j] - 0.5, 0.01) * 2)} for j in range(y.shape[1])]
        return pa.table({"bit": list(range(len(out))), "langs": [langs] * len(out), **{k: [x[k] for x in out] for k in out[0]}})

    return run


class Coder:
    """Fitted bit classifiers with their languages: 2**14 weights for each of a few dozen bits."""

    def __init__(self, langs: list[str], weights: np.ndarray, bias: np.ndarray, trust: np.ndarray):
        self.langs, self.weights, self.bias, self.trust = langs, weights, bias, trust
        self.code = code_matrix(len(langs))

    def decode(self, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Best language, its share of the soft assignment, and its lead over the second, for rows of bit scores."""
        loss = (np.log1p(np.exp(-np.clip(bits[:, None, :] * self.code[None], -30, 30))) * self.trust).sum(axis=2)
        odds = np.exp(loss.min(axis=1, keepdims=True) - loss)
        share = odds / odds.sum(axis=1, keepdims=True)
        ranked = np.sort(share, axis=1)
        lead = ranked[:, -1] - ranked[:, -2] if len(self.langs) > 1 else np.ones(len(bits))
        return loss.argmin(axis=1), ranked[:, -1], lead


def fit_language_id(labelled: DataFrame, max_train: int = 2_000, rounds: int = 80, l2: float = 1e-6) -> Coder | None:
    """Fit on ``text, lang`` rows (``doc_id`` picks the sample); None if there is nothing to learn from."""
    known = labelled.where("doc_id IS NOT NULL AND lang IS NOT NULL")
    sample = known.where(hash_sample(F.col("doc_id"), max_train, known.count())).select("text", "lang")
    rows = sample.mapInArrow(_sample_counts, "lang string, at array<int>, share array<float>")
    fitted = rows.groupBy(F.lit(0).alias("all")).applyInArrow(_fit(rounds, l2), "bit long, langs array<string>, weights binary, bias double, trust double")
    bits = sorted(fitted.collect(), key=lambda r: r.bit)  # a few dozen rows of 64 KiB
    if not bits:
        return None
    return Coder(list(bits[0].langs), np.stack([np.frombuffer(r.weights, "<f4") for r in bits], axis=1), np.array([r.bias for r in bits]), np.array([r.trust for r in bits]))


def text_bits(texts: pa.Array, coder: Coder) -> tuple[np.ndarray, np.ndarray]:
    """Bit scores of texts, and which of them have letters at all."""
    weights = coder.weights.astype(np.float64)
    total, grams = np.zeros((len(texts), weights.shape[1])), np.zeros(len(texts), np.int64)
    for i, n in text_counts(texts):
        total[i] += n @ weights
        grams[i] += n.sum()
    return SCALE * total / np.maximum(grams, 1)[:, None] + coder.bias, grams > 0


def language_of(text: Column, coder: Coder | None, unsure: float = 0.1) -> Column:
    """``struct<lang_pred, score, ambiguous>`` of a text, as an Arrow function; only the text travels to Python."""
    kinds = pa.struct([("lang_pred", pa.string()), ("score", pa.float64()), ("ambiguous", pa.bool_())])

    @F.arrow_udf("lang_pred string, score double, ambiguous boolean")
    def identify(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            langs, scores, flags = np.full(len(texts), "und", object), np.zeros(len(texts)), np.ones(len(texts), bool)
            if coder and len(texts):
                bits, there = text_bits(texts, coder)
                if there.any():
                    best, scores[there], lead = coder.decode(bits[there])
                    flags[there] = lead < unsure
                    langs[there] = np.array(coder.langs, object)[best]
            yield pa.StructArray.from_arrays([pa.array(langs.tolist(), pa.string()), pa.array(scores, pa.float64()), pa.array(flags, pa.bool_())], fields=list(kinds))

    return identify(text)


def identify_languages(documents: DataFrame, coder: Coder | None, unsure: float = 0.1) -> DataFrame:
    """``documents`` with ``lang_pred``, ``score`` (0 to 1) and ``ambiguous`` (lead under ``unsure``, or no letters), which replace columns of those names."""
    kept = documents.drop("lang_pred", "score", "ambiguous")
    columns = [F.col(f"`{c}`") for c in kept.columns]
    (name,) = unused(kept, "_found")
    found = kept.select(*columns, language_of(F.col("text"), coder, unsure).alias(name))
    return found.select(*columns, *[F.col(name)[c].alias(c) for c in ("lang_pred", "score", "ambiguous")])


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    coder = fit_language_id(documents.where(fold(F.col("doc_id"), 3) != 1))
    return identify_languages(documents.select("doc_id", "text"), coder).select(
        "doc_id", (F.coalesce(fold(F.col("doc_id"), 3), F.lit(1)) == 1).alias("held_out"), "lang_pred", "score", "ambiguous")
