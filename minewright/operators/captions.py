"""Corpus metrics of captions against references, from n-gram rows and summable counts.

Tokens are lower-cased runs of letters and digits.  BLEU explodes n-grams and counts them by key, chrF and consensus count
them in tasks that hold some rows at a time (``grams``), so that no caption's partners and no corpus table is gathered in
a task; document frequencies are counted by ranges of 64-bit hashes.
"""

from __future__ import annotations

import math
from collections import Counter

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from minewright.functions.edits import edit_distance
from minewright.operators.grams import consensus, letter_sums, together

SIGMA = 6.0


def tokens(s: Column) -> Column:
    return F.regexp_extract_all(F.lower(s), F.lit("[a-z0-9]+"), 0)


def grams(tokens: Column, n: int) -> Column:
    """All n-grams of a token array, as texts."""
    starts = F.when(F.size(tokens) >= n, F.sequence(F.lit(1), F.size(tokens) - n + 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.array_join(F.slice(tokens, i, F.lit(n)), " "))


def _marked(grams: Column, n: int) -> Column:
    return F.transform(grams, lambda g: F.struct(F.lit(n).alias("n"), g.alias("gram")))


def _counted(rows: DataFrame, key: list[str], text: str, orders: tuple[int, ...]) -> DataFrame:
    """``*key, n, gram, c``: how often each n-gram stands in each text."""
    spelled = F.flatten(F.array(*[_marked(grams(F.col("_t"), n), n) for n in orders]))
    each = rows.select(*key, tokens(F.col(text)).alias("_t")).select(*key, F.inline(spelled))
    return each.groupBy(*key, "n", "gram").agg(F.count(F.lit(1)).alias("c"))


def bleu_scores(rows: DataFrame, key: list[str], pred: str, ref: str) -> DataFrame:
    """One row ``bleu_1 .. bleu_4``: corpus BLEU of each order, with the brevity penalty and clipped counts summed over all rows."""
    orders = (1, 2, 3, 4)
    p, r = _counted(rows, key, pred, orders), _counted(rows, key, ref, orders).withColumnRenamed("c", "r")
    clipped = p.join(r, [*key, "n", "gram"], "left").groupBy("n").agg(F.sum(F.least("c", F.coalesce("r", F.lit(0)))).alias("match"), F.sum("c").alias("total"))
    by_order = clipped.agg(*[F.max(F.when(F.col("n") == n, F.col(c))).alias(f"{c}{n}") for n in orders for c in ("match", "total")])
    sizes = rows.agg(F.sum(F.size(tokens(F.col(pred)))).alias("hyp"), F.sum(F.size(tokens(F.col(ref)))).alias("len"))
    both = by_order.withColumn("_k", F.lit(1)).join(F.broadcast(sizes.withColumn("_k", F.lit(1))), "_k")  # one row each
    brief = F.when(F.col("hyp") >= F.col("len"), 0.0).otherwise(1 - F.col("len") / F.col("hyp"))
    out = []
    for k in orders:
        logs = sum((F.log(F.col(f"match{n}") / F.col(f"total{n}")) for n in range(1, k + 1)), F.lit(0.0)) / k
        ok = F.least(*[F.coalesce(F.col(f"match{n}"), F.lit(0)) for n in range(1, k + 1)], F.lit(1)) > 0
        out.append(F.when(ok, F.exp(logs + brief)).otherwise(0.0).alias(f"bleu_{k}"))
    return both.select(*out)


def consensus_scores(rows: DataFrame, key: list[str], pred: str, ref: str) -> DataFrame:
    """``*key, score``: consensus of a caption with its reference, ten times the mean over n of clipped tf-idf cosines, damped by the difference of lengths.

    The document frequency of an n-gram counts the references that have it; one row is one caption with one reference.
    N-grams are told apart by hashes of 64 bits.
    """
    spaced = lambda c: F.regexp_replace(F.lower(F.col(c)), "[^a-z0-9]+", " ")
    return consensus(rows.select(*key, spaced(pred).alias("_pred"), spaced(ref).alias("_ref")), key, "_pred", "_ref", SIGMA)


def longest_common(a: list[str], b: list[str]) -> int:
    """Length of the longest common subsequence, a bit for each word of ``b`` at a time."""
    where: dict[str, int] = {}
    for j, y in enumerate(b):
        where[y] = where.get(y, 0) | 1 << j
    full = (1 << len(b)) - 1
    row = full  # a zero where the length grows
    for x in a:
        hit = row & where.get(x, 0)
        row = (row + hit | row - hit) & full
    return len(b) - row.bit_count()


def rouge_l(pred: Column, ref: Column, beta: float = 1.2) -> Column:
    """F-measure of the longest common subsequence of two texts' tokens; 0 if either has none."""

    @F.pandas_udf("long")
    def lcs(p: pd.Series, r: pd.Series) -> pd.Series:
        return pd.Series([longest_common(list(x), list(y)) for x, y in zip(p, r, strict=True)], dtype="int64")

    a, b = F.coalesce(tokens(pred), F.array().cast("array<string>")), F.coalesce(tokens(ref), F.array().cast("array<string>"))
    n = lcs(a, b)
    precision, recall = F.try_divide(n, F.size(a)), F.try_divide(n, F.size(b))
    return F.coalesce(F.try_divide((1 + beta**2) * precision * recall, recall + beta**2 * precision), F.lit(0.0))


def chrf(rows: DataFrame, by: list[str], key: list[str], pred: str, ref: str, order: int = 6, beta: float = 2.0) -> DataFrame:
    """``*by, chrf``: corpus F-score of character n-grams without white space, in percent, from counts summed per order."""

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    own = together(rows.select(*by, *key, pred, ref), [*by, *key])
    each = own.mapInArrow(letter_sums(by, key, pred, ref, order), ", ".join([f"`{b}` {kinds[b]}" for b in by] + [f"{c} array<long>" for c in ("m", "p", "r")]))
    total = lambda c, n: F.sum(F.col(c)[n - 1])
    counts = each.groupBy(*by).agg(F.array(*[F.struct(*[total(c, n).alias(c) for c in ("m", "p", "r")]) for n in range(1, order + 1)]).alias("_n"))
    sums = counts.select(*by, F.inline("_n"))
    whole = sums.where("p > 0 AND r > 0").groupBy(*by).agg(F.avg(F.col("m") / F.col("p")).alias("precision"), F.avg(F.col("m") / F.col("r")).alias("recall"))
    score = F.try_divide((1 + beta**2) * F.col("precision") * F.col("recall"), beta**2 * F.col("precision") + F.col("recall"))
    return whole.select(*by, (100 * F.coalesce(score, F.lit(0.0))).alias("chrf"))


def character_error_rate(rows: DataFrame, by: list[str], pred: str, ref: str) -> DataFrame:
    """Summed character edit distances over summed reference lengths, in percent; white space does not count."""
    bare = lambda c: F.regexp_replace(F.coalesce(F.col(c), F.lit("")), r"\s+", "")
    each = rows.select(*by, F.levenshtein(bare(pred), bare(ref)).alias("d"), F.length(bare(ref)).alias("n"))
    return each.groupBy(*by).agg((F.try_divide(F.sum("d"), F.sum("n")) * 100).alias("cer"))


def sentence_bleu(pred: list[str], ref: list[str]) -> float:
    """BLEU of one sentence, 0 to 1, with the counts of missing orders halved again and again (exponential smoothing)."""
    if not pred or not ref:
        return 0.0
    logs, smooth, orders = 0.0, 1.0, 0
    for n in range(1, 5):
        a, b = (Counter(tuple(x[i : i + n]) for i in range(len(x) - n + 1)) for x in (pred, ref))
        total = sum(a.values())
        if not total:
            break
        orders += 1
        match = sum((a & b).values())
        if not match:
            smooth *= 2
        logs += math.log(match / total if match else 1 / (smooth * total))
    return math.exp(logs / orders + min(0.0, 1 - len(ref) / len(pred))) if orders == 4 else 0.0


def sentence_bleu_score(pred: Column, ref: Column) -> Column:
    """``sentence_bleu`` of two texts' words as a batched column."""
    def score(p: pd.Series, r: pd.Series) -> pd.Series:
        return pd.Series([sentence_bleu((a or "").split(), (b or "").split()) for a, b in zip(p, r, strict=True)], dtype="float64")

    return F.pandas_udf(score, "double")(pred, ref)


def page_text_scores(pred: Column, ref: Column) -> Column:
    """``precision, recall, f_measure`` of the sets of words of a read page, and ``edits``: character edits over the longer text's length; 0 where nothing is shared or there is nothing."""
    words = lambda s: F.array_distinct(F.filter(F.split(F.coalesce(s, F.lit("")), r"\s+"), lambda w: w != ""))
    a, b = words(pred), words(ref)
    both = F.size(F.array_intersect(a, b)).cast("double")
    share = lambda n: F.coalesce(F.try_divide(both, F.size(n)), F.lit(0.0))
    longest = F.greatest(F.length(F.coalesce(pred, F.lit(""))), F.length(F.coalesce(ref, F.lit(""))))

    def edits(p: pd.Series, r: pd.Series) -> pd.Series:
        return pd.Series([edit_distance(x or "", y or "") for x, y in zip(p, r, strict=True)], dtype="int64")

    return F.struct(
        share(a).alias("precision"), share(b).alias("recall"), F.coalesce(F.try_divide(2 * both, F.size(a) + F.size(b)), F.lit(0.0)).alias("f_measure"),
        F.coalesce(F.try_divide(F.pandas_udf(edits, "long")(pred, ref), longest), F.lit(0.0)).alias("edits"))
