"""Phrase collocations: weighted n-grams of distinct pieces, counted out of core by bucket.

1. Texts are cut into pieces, and equal pieces of a language become one row with
   their number, so that copies cost nothing further on.
2. N-grams are counted in three passes over the distinct pieces: words, pairs of
   frequent words, and phrases all of whose pairs are frequent.  A phrase is never
   more frequent than its parts, so the passes lose none.  A task adds up the n-grams
   of its windows, they are shuffled into hash buckets, and an embedded DuckDB counts
   a bucket in bounded memory.  What is frequent reaches the next pass as a bit filter
   of bounded size; where that gets crowded, more is counted and nothing is lost.
3. Every cut of a candidate asks for the counts of its two parts.  The requests are
   shuffled to the counts and come back; parts that very many ask for, ten thousand at
   most, are broadcast instead.

DuckDB's overflow goes where Spark puts its own (``SPARK_LOCAL_DIRS`` of the worker)
and is gone with the task; no other task reads it.

Defined cases: null text is empty, null language is ``und``; pieces without words count
nothing; columns other than ``text`` and ``lang`` are not read, whatever their names;
an empty table gives no rows; repeated rows count as often as they are there.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from minewright.staging import drop_staged, stage, table

#: Bytes of text that a task works on at a time; a longer text or piece is a window of its own.
WINDOW = 6 << 20
#: Rows of an Arrow batch that goes back to Spark.
SLICE = 1 << 16
#: What DuckDB may hold of a bucket in memory.
BUCKET_MEMORY = "160MB"
#: Filters have sixteen bits for each entry, up to so many in all.
MOST_BITS = 1 << 27

_BREAKS = np.zeros(256, bool)
_BREAKS[[ord(c) for c in ".,;:!?\n\v\f\r"]] = True
_GAPS = np.zeros(256, bool)
_GAPS[[0x20, 0x09]] = True


def _held(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.Table]:
    """Batches put together to tables of about ``WINDOW`` bytes of ``column``."""
    held, size = [], 0
    for batch in batches:
        at = 0
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).cumsum()
        while at < batch.num_rows:
            before = lengths[at - 1] if at else 0
            n = max(1, int(np.searchsorted(lengths, before + WINDOW - size, "right")) - at)
            held.append(batch.slice(at, n))
            at += n
            size += int(lengths[at - 1] - before)
            if size >= WINDOW or at < batch.num_rows:
                yield pa.Table.from_batches(held)
                held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


def _bytes(strings: pa.ChunkedArray, between: bytes) -> np.ndarray:
    """All strings' bytes with ``between`` between them."""
    whole = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(strings)], pa.int32()), strings.combine_chunks().cast(pa.binary())), between)
    return np.frombuffer(whole[0].as_buffer(), np.uint8)


def _strings(data: np.ndarray, sizes: np.ndarray) -> pa.Array:
    offsets = np.zeros(len(sizes) + 1, np.int32)
    np.cumsum(sizes, out=offsets[1:])
    return pa.StringArray.from_buffers(len(sizes), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data)))


def _added(key: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each distinct key its first place and its sum of weights."""
    order = np.argsort(key, kind="stable")
    first = np.flatnonzero(np.diff(key[order], prepend=-1))
    return order[first], np.add.reduceat(weight[order], first) if len(first) else weight[:0]


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``lang, piece, n`` of ``lang, text``: lower-cased pieces, their words one space apart, with their number in the window."""
    for rows in _held(batches, "text"):
        lang = rows["lang"].combine_chunks().dictionary_encode()
        b = _bytes(pc.fill_null(rows["text"], ""), b"\n")
        sizes = pc.fill_null(pc.binary_length(rows["text"]), 0).to_numpy().astype(np.int64) + 1
        b = np.where((b >= 65) & (b <= 90), b + 32, b).astype(np.uint8)
        ends = _BREAKS[b]
        word = ~ends & ~_GAPS[b]
        starts = word & ~np.concatenate([[False], word[:-1]])  # of words
        piece_of = np.cumsum(ends) - ends  # the piece that a byte lies in
        at = np.flatnonzero(starts)
        if not len(at):
            continue
        new = np.concatenate([[True], piece_of[at[1:]] != piece_of[at[:-1]]])  # first word of a piece
        # A space goes before each further word of a piece.
        kept = np.flatnonzero(word)
        before = np.zeros(len(b), np.uint8)
        before[at[~new]] = 1
        place = np.arange(len(kept)) + np.cumsum(before[kept], dtype=np.int64)
        out = np.full(len(kept) + int(before.sum()), 32, np.uint8)
        out[place] = b[kept]
        begin = place[starts[kept]][new]
        pieces = _strings(out, np.diff(np.append(begin, len(out)))).dictionary_encode()
        owner = np.searchsorted(np.cumsum(sizes), at[new], "right")
        l_code = lang.indices.to_numpy()[owner].astype(np.int64)
        first, n = _added(l_code * len(pieces.dictionary) + pieces.indices.to_numpy(), np.ones(len(begin), np.int64))
        found = pa.table({"lang": lang.dictionary.take(pa.array(l_code[first])), "piece": pieces.dictionary.take(pieces.indices.take(pa.array(first))), "n": n})
        yield from found.to_batches(SLICE)


def distinct_pieces(docs: DataFrame) -> DataFrame:
    """``lang, piece, n``: the pieces of all ``docs`` (``text``, ``lang``) with how often they occur."""
    rows = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    return rows.mapInArrow(_pieces, "lang string, piece string, n long").groupBy("lang", "piece").agg(F.sum("n").alias("n"))


_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)


def _powers(n: int) -> np.ndarray:
    out = np.full(n + 1, _BASE, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def _hashes(strings: pa.Array) -> np.ndarray:
    """A hash of each string, none of them empty, by which that of joined strings can be had: sum of byte times base to the place."""
    strings = strings.cast(pa.large_string())  # offsets of one width
    offsets = np.frombuffer(strings.buffers()[1], np.int64)[strings.offset : strings.offset + len(strings) + 1]
    data = np.frombuffer(strings.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    start, size = offsets[:-1] - offsets[0], np.diff(offsets)
    if not len(size):
        return np.zeros(0, np.uint64)
    powers = _powers(int(size.max()))
    return np.add.reduceat(data * powers[np.arange(len(data)) - np.repeat(start, size)], start)


def _slots(hashes: np.ndarray, lang: np.ndarray, bits: int) -> np.ndarray:
    x = hashes ^ (lang * np.uint64(0xBF58476D1CE4E5B9))
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
    return (x ^ (x >> np.uint64(29))) & np.uint64(bits - 1)


class _Filter:
    """Bits of the frequent phrases' slots; ``bits`` is a power of two."""

    def __init__(self, bits: int, data: np.ndarray):
        self.bits, self.data = bits, data

    def has(self, hashes: np.ndarray, lang: np.ndarray) -> np.ndarray:
        slot = _slots(hashes, lang, self.bits)
        return (self.data[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _filter(found: DataFrame) -> _Filter:
    """The filter of ``found`` (``lang, phrase``), gathered as bitmaps of fixed size."""
    bits = 1 << min(max(found.count() * 16 - 1, 32768).bit_length(), MOST_BITS.bit_length() - 1)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                slot = _slots(_hashes(b.column("phrase")), _hashes(b.column("lang")), bits)
                yield pa.record_batch({"slot": slot.astype(np.int64)})

    slots = found.where("lang <> '' AND phrase <> ''").mapInArrow(place, "slot long")
    maps = slots.groupBy(F.shiftright("slot", 15).alias("part")).agg(F.bitmap_construct_agg(F.col("slot") % 32768).alias("bits")).collect()  # of 4 KB each
    data = np.zeros(bits // 8, np.uint8)
    for m in maps:
        data[m.part * 4096 : m.part * 4096 + 4096] = np.frombuffer(m.bits, np.uint8)
    return _Filter(bits, data)


def _lang_hashes(names: pa.Array) -> np.ndarray:
    """Hashes of the languages; an empty name has none of its own and is let through by ``_kept``."""
    return np.array([_hashes(pa.array([x]))[0] if x else 0 for x in names.to_pylist()], np.uint64)


def _grams(sizes: range, words=None, pairs=None):
    """``lang, phrase, f`` of the n-grams of ``sizes`` words, added up by windows; with size 1 also the number of all words, its phrase empty.

    ``words`` and ``pairs`` are broadcast filters that all words and pairs of a phrase have to be in.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _held(batches, "piece"):
            lang = rows["lang"].combine_chunks().dictionary_encode()
            b = _bytes(rows["piece"], b"\n")
            gaps = np.flatnonzero((b == 32) | (b == 10))
            start, end = np.concatenate([[0], gaps + 1]), np.append(gaps, len(b))
            piece = np.concatenate([[0], np.cumsum(b[gaps] == 10)])
            mask = np.ones(len(b), bool)
            mask[gaps] = False
            coded = _strings(b[mask], end - start).dictionary_encode()
            code, d = coded.indices.to_numpy().astype(np.int64), len(coded.dictionary)
            weight = rows["n"].to_numpy()[piece]
            of = lang.indices.to_numpy()[piece].astype(np.int64)
            fits = np.ones(len(code), bool)
            if words is not None or pairs is not None:
                l_hash = _lang_hashes(lang.dictionary)[of]
                w_hash = _hashes(coded.dictionary)
            if words is not None:
                fits = words.value.has(w_hash[code], l_hash) | (l_hash == 0)
            joined = piece[1:] == piece[:-1]
            two = joined & fits[:-1] & fits[1:]
            if pairs is not None:
                size = (end - start)[:-1]
                powers = _powers(int((end - start).max()) + 1)
                at = np.flatnonzero(two)
                both = w_hash[code[at]] + powers[size[at]] * np.uint64(32) + powers[size[at] + 1] * w_hash[code[at + 1]]
                two[at] = pairs.value.has(both, l_hash[at]) | (l_hash[at] == 0)
            for n in sizes:
                if n == 1:
                    at = np.flatnonzero(fits)
                    all_of = np.unique(of)
                    total = np.zeros(int(of.max()) + 1, np.int64)
                    np.add.at(total, of, weight)
                    yield pa.record_batch({"lang": lang.dictionary.take(pa.array(all_of)), "phrase": [""] * len(all_of), "f": total[all_of]})
                else:
                    runs = two[: len(code) - n + 1].copy() if len(code) >= n else two[:0]
                    for j in range(1, n - 1):
                        runs &= two[j : j + len(runs)]
                    at = np.flatnonzero(runs)
                if not len(at):
                    continue
                key = of[at]
                for j in range(n):
                    if int(key.max()) >= (2**62) // d:
                        key = np.unique(key, return_inverse=True)[1].astype(np.int64)
                    key = key * d + code[at + j]
                first, f = _added(key, weight[at])
                at = at[first]
                phrase = coded.dictionary.take(pa.array(code[at]))
                for j in range(1, n):
                    phrase = pc.binary_join_element_wise(phrase, coded.dictionary.take(pa.array(code[at + j])), " ")
                found = pa.table({"lang": lang.dictionary.take(pa.array(of[at])), "phrase": phrase, "f": f})
                yield from found.to_batches(SLICE)

    return run


def _bucket(least: int):
    """Counts of a bucket's n-grams by DuckDB, which spills beyond its memory; rarer ones than ``least`` go, totals stay."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import duckdb

        spill = os.environ.get("SPARK_LOCAL_DIRS", tempfile.gettempdir()).split(",")[0]
        with tempfile.TemporaryDirectory(dir=spill) as scratch, duckdb.connect(os.path.join(scratch, "bucket.db"), config={"threads": 1, "memory_limit": BUCKET_MEMORY, "temp_directory": scratch}) as con:
            con.execute("CREATE TABLE grams (lang VARCHAR, phrase VARCHAR, f BIGINT)")
            for rows in _held(batches, "phrase"):
                con.register("held_rows", rows)
                con.execute("INSERT INTO grams SELECT lang, phrase, f FROM held_rows")
                con.unregister("held_rows")
            counts = con.sql(f"SELECT lang, phrase, CAST(sum(f) AS BIGINT) AS f FROM grams GROUP BY lang, phrase HAVING sum(f) >= {least} OR phrase = ''")
            yield from counts.to_arrow_table().to_batches(SLICE)

    return run


def count_grams(pieces: DataFrame, sizes: range, least: int, words=None, pairs=None) -> DataFrame:
    """``lang, phrase, f`` of the n-grams of ``pieces`` that occur ``least`` times or more."""
    grams = pieces.mapInArrow(_grams(sizes, words, pairs), "lang string, phrase string, f long")
    return grams.repartition("lang", "phrase").mapInArrow(_bucket(least), "lang string, phrase string, f long")


#: A part that more ask for than this and than the ten-thousandth of all requests is answered by broadcast.
HOT, SHARE = 1000, 10_000


def answered(requests: DataFrame, counts: DataFrame) -> DataFrame:
    """``requests``, a staged table with ``lang, part``, each with ``f`` of its part."""
    bound = max(HOT, requests.count() // SHARE)
    known = counts.select("lang", F.col("phrase").alias("part"), "f")
    hot = requests.groupBy("lang", "part").count().where(F.col("count") > bound).join(known, ["lang", "part"]).select("lang", "part", "f").collect()
    if not hot:
        return requests.join(known, ["lang", "part"])
    often = F.broadcast(requests.sparkSession.createDataFrame(hot, "lang string, part string, f long"))
    rest = requests.join(often.select("lang", "part"), ["lang", "part"], "left_anti").join(known, ["lang", "part"])
    return requests.join(often, ["lang", "part"]).unionByName(rest)


def _first(rows: DataFrame, by: str, order: list[Column], k: int) -> DataFrame:
    """``rank`` of each group's first ``k`` rows; slices of the rows, as many as partitions, send no more than that each."""
    width = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    part = rows.withColumn("_slice", F.pmod(F.xxhash64(*rows.columns), F.lit(width)))
    near = part.withColumn("_n", F.row_number().over(Window.partitionBy(by, "_slice").orderBy(*order))).where(F.col("_n") <= k).drop("_n", "_slice")
    return near.withColumn("rank", F.row_number().over(Window.partitionBy(by).orderBy(*order)).cast("long")).where(F.col("rank") <= k)


def collocations(docs: DataFrame, least: int = 100, longest: int = 5, top: int | None = 2000, inside_percent: int = 100) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score`` of phrases of 2 to ``longest`` words that occur ``least`` times or more.

    ``score`` is the least over a phrase's cuts of ``floor(1000 a n / (l r))``; phrases inside a longer candidate with
    ``inside_percent`` of their count are left out.  ``top`` rows of each language, or all.
    """
    spark = docs.sparkSession
    pieces = stage(distinct_pieces(docs), "collocation-pieces")
    share = spark.sparkContext.broadcast
    words = stage(count_grams(pieces, range(1, 2), least), "collocation-words")
    frequent = share(_filter(words))
    pairs = stage(count_grams(pieces, range(2, 3), least, words=frequent), "collocation-pairs")
    coupled = share(_filter(pairs))
    longer = stage(count_grams(pieces, range(3, longest + 1), least, words=frequent, pairs=coupled), "collocation-phrases")
    drop_staged(pieces)
    candidates = pairs.union(longer)
    split = candidates.select("lang", "phrase", F.col("f").alias("a"), F.split("phrase", " ").alias("w"))
    joined = lambda at, size: F.array_join(F.slice("w", at, size), " ")
    cut = split.select("lang", "phrase", "a", "w", F.explode(F.sequence(F.lit(1), F.size("w") - 1)).alias("k"))
    parts = F.array(joined(F.lit(1), F.col("k")), joined(F.col("k") + 1, F.size("w")), F.lit(""))  # the language's words are asked for as the empty phrase
    replies = answered(stage(cut.select("lang", "phrase", "a", "k", F.posexplode(parts).alias("side", "part")), "collocation-requests"), words.union(candidates))
    side = lambda i, name: F.max(F.when(F.col("side") == i, F.col("f"))).alias(name)
    scored = replies.groupBy("lang", "phrase", "a", "k").agg(side(0, "l"), side(1, "r"), side(2, "n"))
    exact = scored.withColumn("score", F.expr(
        "CAST(CAST(CAST(1000 AS DECIMAL(4,0)) * CAST(a AS DECIMAL(15,0)) AS DECIMAL(19,0)) * CAST(n AS DECIMAL(19,0)) AS DECIMAL(38,0))"
        " div CAST(CAST(l AS DECIMAL(19,0)) * CAST(r AS DECIMAL(19,0)) AS DECIMAL(38,0))"))
    best = exact.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut")).select("lang", "phrase", "a", "n", "cut.score", "cut.l", "cut.r")
    spans = F.expr("flatten(transform(sequence(2, size(w) - 1), m -> transform(sequence(1, size(w) - m + 1), i -> array_join(slice(w, i, m), ' '))))")
    inner = split.where(F.size("w") > 2).select("lang", F.explode(F.array_distinct(spans)).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("outer"))
    kept = best.join(inner, ["lang", "phrase"], "left").where(F.col("outer").isNull() | (F.col("outer") * 100 < F.col("a") * inside_percent)).drop("outer")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    ranked = _first(kept, "lang", order, top) if top else kept.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


OP11_SQL = r"""
WITH p AS MATERIALIZED (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents) x),
t AS (SELECT lang, sum(len(w)) AS n FROM p GROUP BY lang),
g AS (SELECT lang, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]), list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]),
    list_transform(range(1, len(w) - 2), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3]),
    list_transform(range(1, len(w) - 3), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3] || ' ' || w[i + 4]))) AS phrase FROM p),
f AS MATERIALIZED (SELECT lang, phrase, count(*) AS a FROM g GROUP BY ALL HAVING count(*) >= 100),
c AS MATERIALIZED (SELECT *, string_split(phrase, ' ') AS w FROM f WHERE contains(phrase, ' ')),
u AS (SELECT lang, phrase, a, unnest(range(1, len(w))) AS j, w FROM c),
v AS MATERIALIZED (SELECT lang, phrase, a, j, array_to_string(w[:j], ' ') AS x, array_to_string(w[j + 1:], ' ') AS y FROM u),
s AS (
  SELECT v.lang, v.phrase, v.a, j, l.a AS l, r.a AS r, n, (1000 * v.a::HUGEINT * n::HUGEINT) // (l.a::HUGEINT * r.a::HUGEINT) AS score
  FROM v JOIN f l ON l.lang = v.lang AND l.phrase = v.x JOIN f r ON r.lang = v.lang AND r.phrase = v.y JOIN t ON t.lang = v.lang),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
i AS (SELECT lang, a, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM c, (VALUES (2), (3), (4)) z(m) WHERE m < len(w)),
o AS MATERIALIZED (SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, max(a) AS outermost FROM i GROUP BY ALL),
d AS (SELECT b.* FROM b LEFT JOIN o USING (lang, phrase) WHERE outermost IS NULL OR 100 * outermost < 100 * a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM d QUALIFY rank <= 2000"""


def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))
