"""N-gram Jaccard self-join as a blocked sparse matrix product.

The matrix has a row for each distinct set of word shingles and a column for
each shingle.  Its columns are cut into blocks by a hash; a block's task finds
how many rows have each column and sends on the entries of columns with two
rows or more.  A row whose sent entries are fewer than 75 % of its size can
have no partner and is gone here, as almost all are.

The rows left are multiplied.  In the order rarest column first, two linked
rows share one of their first ``size - ceil(0.75 size) + 1`` columns, so rows
meet only in such columns.  Rows that are joined by chains of such columns form
a family; its rows are compared in pairs of chunks by a product of their sparse
rows, and pairs below the bound of their sizes are discarded.  A family over
``family_rows`` is multiplied column by column instead, in pairs of chunks too,
so that nothing grows into one task and no pair is left out.  A task gives a
spanning forest of its links, never its pairs.

Columns that a hundredth of the documents or more have are found first, over all
documents: each has its half of that share in windows that have it so often.
There are at most two hundred times the average size of them, so they may be
broadcast.  They count as the most frequent and are not dealt to blocks.

Defined cases: null, empty and blank texts have no shingle, link with nothing
and are their own component; fewer than five words make one shingle; equal sets
are one row with any number of copies; null ids name no component; extra
columns are not read.  Shingles are compared by 64-bit hashes and sets by 128.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from minewright.llm.anchors import mix
from minewright.llm.components import connected_components, with_least
from minewright.staging import shuffle_width, stage

#: Fixed values of the contract: words of a shingle, and the threshold as a fraction.
WORDS, PART, WHOLE = 5, 75, 100
_MIX = np.uint64(0x9E3779B97F4A7C15)


_SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
_GAP = re.compile(rb"[\x20\x09-\x0d]")
#: Bytes of text worked on at a time.
WINDOW = 1 << 18


class Shingler:
    """Distinct shingle hashes of texts; ASCII letters lower-cased, words parted by ASCII white space.

    Words are hashed all at once as polynomials of their bytes.  A text over ``window`` bytes is read in parts
    that begin with the last four words of the part before.
    """

    def __init__(self, seed: int = 0, window: int = WINDOW):
        self.window = window
        self.table = np.random.default_rng([seed, 3]).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def _parts(self, raw: bytes) -> Iterator[bytes]:
        carry, at = b"", 0
        while at < len(raw):
            gap = _GAP.search(raw, at + self.window)
            end = gap.start() if gap else len(raw)
            carry, at = carry + b" " + raw[at:end], end
            words = carry.split()
            if len(words) >= WORDS or at == len(raw):
                yield carry
                carry = b" ".join(words[1 - WORDS :])

    def _hash(self, parts: list[bytes]) -> list[np.ndarray]:
        """The distinct shingles of each part."""
        data = np.frombuffer(b" ".join([*parts, b""]), np.uint8)
        mask = np.zeros(len(data) + 2, np.int8)
        mask[1:-1] = ~_SPACE[data]
        edge = np.diff(mask)
        start, end = np.flatnonzero(edge > 0), np.flatnonzero(edge < 0)
        size = end - start
        first = np.cumsum(size) - size
        at = np.arange(size.sum()) - np.repeat(first, size)  # place in the word
        power = np.full(int(size.max(initial=0)) + 1, _MIX, np.uint64)
        power[0] = 1
        np.multiply.accumulate(power, out=power)
        sums = np.zeros(len(at) + 1, np.uint64)
        np.cumsum(self.table[data[np.flatnonzero(mask[1:-1])]] * power[at], out=sums[1:])
        h = mix((sums[first + size] - sums[first]) ^ size.astype(np.uint64))
        begin = np.cumsum([0, *(len(p) + 1 for p in parts)])
        upto = np.searchsorted(start, begin)  # words before each part
        n = np.diff(upto)

        def shingle(at: np.ndarray, k: int) -> np.ndarray:
            g = np.full(len(at), k, np.uint64)
            for i in range(k):
                g = (g ^ h[at + i]) * _MIX
                g ^= g >> np.uint64(29)
            return g

        whole = shingle(np.arange(max(len(h) - WORDS + 1, 0)), WORDS)
        few = {k: shingle(upto[:-1][n == k], k) for k in range(1, WORDS)}
        place = np.zeros(len(parts), np.int64)
        for k in few:
            place[n == k] = np.arange((n == k).sum())
        return [np.unique(whole[a : a + k - WORDS + 1]) if k >= WORDS else few[k][i : i + 1] if k else h[:0] for a, k, i in zip(upto.tolist(), n.tolist(), place.tolist(), strict=False)]

    def __call__(self, texts: Iterable[str | None]) -> Iterator[np.ndarray]:
        """The set of each text, in order."""
        held: list[bytes] = []
        size = 0
        for text in texts:
            raw = (text or "").encode("utf-8").lower()  # of bytes: ASCII rules
            if size + len(raw) > self.window and held:
                yield from self._hash(held)
                held, size = [], 0
            if len(raw) > self.window:
                yield np.unique(np.concatenate([s for p in self._parts(raw) for s in self._hash([p])]))
            else:
                held.append(raw)
                size += len(raw) + 1
        if held:
            yield from self._hash(held)


def _node(shingles: np.ndarray) -> tuple[int, int]:
    d = hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)


def least_overlap(n: np.ndarray | int) -> np.ndarray | int:
    """The smallest overlap that a set of ``n`` can have with a linked one: ceil(0.75 n)."""
    return -(-PART * n // WHOLE)


def _frequent(seed: int, window: int = 4096, entries: int = 1_000_000):
    """Shingles that half a hundredth or more of a window of documents have, with their count there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, held, size = Shingler(seed), [], 0

        def counted() -> pa.RecordBatch:
            s, n = np.unique(np.concatenate(held), return_counts=True)
            many = n >= max(2, -(-len(held) // (2 * WHOLE)))
            held.clear()
            return pa.record_batch([pa.array(s[many].view(np.int64)), pa.array(n[many])], names=["s", "n"])

        for batch in batches:
            for s in shingler(x.as_py() for x in batch.column(0)):
                held.append(s)
                size += len(s)
                if len(held) >= window or size >= entries:
                    yield counted()
                    size = 0
        if held:
            yield counted()

    return run


def _documents(seed: int, frequent: np.ndarray):
    """Each document's set: its size, its two hashes, and the frequent shingles in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(seed)
        for batch in batches:
            n, one, two, often = [], [], [], []
            for s in shingler(x.as_py() for x in batch.column(1)):
                a, b = _node(s) if len(s) else (None, None)
                n.append(len(s)), one.append(a), two.append(b), often.append(s[_isin(s, frequent)].tobytes())
            yield pa.record_batch([batch.column(0), pa.array(n, pa.int64()), pa.array(one, pa.int64()), pa.array(two, pa.int64()), pa.array(often, pa.binary())], names=["doc_id", "n", "node", "node2", "often"])

    return run


def _isin(s: np.ndarray, table: np.ndarray) -> np.ndarray:
    if not len(table):
        return np.zeros(len(s), bool)
    return table[np.minimum(np.searchsorted(table, s), len(table) - 1)] == s


_BLOCK = pa.schema([("block", pa.int32()), ("node", pa.binary()), ("count", pa.binary()), ("s", pa.binary())])
_BLOCK_DDL = "block int, node binary, count binary, s binary"
_RUN = 60_000


def _cut(block: np.ndarray, doc: np.ndarray, s: np.ndarray, node: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Entries of the matrix by block: runs of a document's entries, the document once for each run."""
    order = np.lexsort((doc, block))
    block, doc, s = block[order], doc[order], s[order]
    edges = np.flatnonzero(np.diff(block)) + 1
    rows = []
    for a, b in zip(np.append(0, edges), np.append(edges, len(block)), strict=True):
        if a < b:
            start = np.append(0, np.flatnonzero(np.diff(doc[a:b])) + 1)
            if (np.diff(np.append(start, b - a)) > _RUN).any():  # counts have two bytes
                start = np.unique(np.concatenate([start, np.arange(0, b - a, _RUN)]))
            rows.append((int(block[a]), node[doc[a:b][start]].tobytes(), np.diff(np.append(start, b - a)).astype("<u2").tobytes(), s[a:b].tobytes()))
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _BLOCK.types, strict=True)], schema=_BLOCK)


def _entries(seed: int, frequent: np.ndarray, blocks: int, flush: int = 300_000, seen_nodes: int = 100_000):
    """Entries of the rows by block; of copies that a task meets the first goes on (a task remembers ``seen_nodes`` rows at a time)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, seen = Shingler(seed), set()
        held: list[np.ndarray] = []
        nodes: list[int] = []

        def cut() -> Iterator[pa.RecordBatch]:
            n = np.array(list(map(len, held)), np.int64)
            s, doc = np.concatenate(held), np.repeat(np.arange(len(held)), n)
            keep = ~_isin(s, frequent)
            s, doc = s[keep], doc[keep]
            yield from _cut(((s >> np.uint64(17)) % np.uint64(blocks)).astype(np.int32), doc, s, np.array(nodes, np.int64))

        size = 0
        for batch in batches:
            for s in shingler(x.as_py() for x in batch.column(0)):
                if not len(s) or (node := _node(s)[0]) in seen:
                    continue
                if len(seen) >= seen_nodes:
                    seen.clear()
                seen.add(node)
                held.append(s), nodes.append(node)
                size += len(s)
                if size >= flush:
                    yield from cut()
                    held.clear(), nodes.clear()
                    size = 0
        if held:
            yield from cut()

    return run


_SHARED_DDL = "part int, node binary, n binary, s binary, df binary"
_SHARED = (("part", pa.int32()), ("node", pa.binary()), ("n", pa.binary()), ("s", pa.binary()), ("df", pa.binary()))


def _shared(parts: int):
    """Entries of the block's columns that two rows or more have, dealt by row."""

    def run(key: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
        col = lambda name, kind: np.frombuffer(b"".join(t[name].to_pylist()), kind)
        node, s = np.repeat(col("node", "<i8"), col("count", "<u2")), col("s", "<u8")
        order = np.lexsort((node, s))
        node, s = node[order], s[order]
        new = np.append(True, (s[1:] != s[:-1]) | (node[1:] != node[:-1]))[: len(s)]  # copies are one row
        node, s = node[new], s[new]
        start = np.flatnonzero(np.append(True, s[1:] != s[:-1])[: len(s)])
        df = np.diff(np.append(start, len(s)))
        df = np.repeat(df, df)
        many = df > 1
        node, s, df = node[many], s[many], df[many]
        part = (node.view(np.uint64) % np.uint64(parts)).astype(np.int32)
        order = np.argsort(part, kind="stable")
        cuts = np.flatnonzero(np.diff(part[order])) + 1
        rows = [(int(part[i[0]]), node[i].tobytes(), b"", s[i].tobytes(), df[i].astype("<u4").tobytes()) for i in np.split(order, cuts) if len(i)]
        return pa.table({c: pa.array([r[k] for r in rows], t) for k, (c, t) in enumerate(_SHARED)})

    return run


def _often(parts: int):
    """Every row's size, and its entries of frequent columns, dealt by row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node, n = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            part = (node.view(np.uint64) % np.uint64(parts)).astype(np.int32)
            often = [np.frombuffer(x.as_py(), "<u8") for x in batch.column(2)]
            rows = []
            for i in np.split(np.argsort(part, kind="stable"), np.flatnonzero(np.diff(np.sort(part))) + 1):
                if len(i):
                    has = [j for j in i.tolist() if len(often[j])]
                    size = [len(often[j]) for j in has]
                    rows.append((int(part[i[0]]), node[i].tobytes(), n[i].astype("<u4").tobytes(), b"", b""))
                    rows.append((int(part[i[0]]), np.repeat(node[has], size).tobytes(), b"", b"".join(often[j].tobytes() for j in has), np.full(sum(size), 2**32 - 1, "<u4").tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, (_, t) in enumerate(_SHARED)], names=[c for c, _ in _SHARED])

    return run


def _nodes(docs: DataFrame) -> DataFrame:
    """A row for each distinct set; copies go before and after the shuffle, not into a group of ``_rows``."""
    return docs.where("node IS NOT NULL").groupBy("node").agg(F.first("n").alias("n"), F.first("often").alias("often"))


def _rows(key: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
    """Rows that can have a partner, with their leading columns and all shared ones."""
    col = lambda x, name, kind: np.frombuffer(b"".join(x[name].to_pylist()), kind)
    is_size = pc.greater(pc.binary_length(t["n"]), 0)
    sizes, t = t.filter(is_size), t.filter(pc.invert(is_size))
    known, size_of = col(sizes, "node", "<i8"), col(sizes, "n", "<u4").astype(np.int64)
    order = np.argsort(known)
    known, size_of = known[order], size_of[order]
    node, s, df = col(t, "node", "<i8"), col(t, "s", "<u8"), col(t, "df", "<u4")
    order = np.lexsort((s, df, node))
    node, s = node[order], s[order]
    new = np.append(True, (s[1:] != s[:-1]) | (node[1:] != node[:-1]))[: len(s)]
    node, s = node[new], s[new]
    start = np.flatnonzero(np.append(True, node[1:] != node[:-1])[: len(node)])
    have = np.diff(np.append(start, len(node)))
    size = size_of[np.searchsorted(known, node[start])] if len(start) else have
    out: list[list] = [[], [], [], []]
    for i in np.flatnonzero(have >= least_overlap(size)):
        own = s[start[i] : start[i] + have[i]]
        lead = own[: have[i] - least_overlap(int(size[i])) + 1]
        for c, x in zip(out, (int(node[start[i]]), int(size[i]), lead.view(np.int64), np.sort(own).tobytes()), strict=True):
            c.append(x)
    return pa.table({"node": pa.array(out[0], pa.int64()), "n": pa.array(out[1], pa.int64()), "lead": pa.array(out[2], pa.list_(pa.int64())), "shared": pa.array(out[3], pa.binary())})


def overlaps(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Counts of common columns of all rows of ``a`` and ``b``: the product of two sparse matrices, column by column."""
    (ca, ra), (cb, rb) = ((np.concatenate(x), np.repeat(np.arange(len(x)), list(map(len, x)))) for x in (a, b))
    oa, ob = np.argsort(ca, kind="stable"), np.argsort(cb, kind="stable")
    ca, ra, cb, rb = ca[oa], ra[oa], cb[ob], rb[ob]
    lo, hi = np.searchsorted(cb, ca, "left"), np.searchsorted(cb, ca, "right")
    out = np.zeros(len(a) * len(b), np.int64)
    width = hi - lo
    ends = np.cumsum(width)
    begin = 0
    while begin < len(ca):  # some millions of products at a time
        end = max(begin + 1, int(np.searchsorted(ends, (ends[begin - 1] if begin else 0) + 4_000_000)))
        w = width[begin:end]
        at = np.repeat(lo[begin:end] - (np.cumsum(w) - w), w) + np.arange(w.sum())
        out += np.bincount(np.repeat(ra[begin:end], w) * len(b) + rb[at], None, len(out))
        begin = end
    return out.reshape(len(a), len(b))


def _multiply(key: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
    """Links within one chunk, or between two, as a spanning forest."""
    i, j = key[1].as_py(), key[2].as_py()
    t = t.sort_by("node")
    node, n, chunk = (t[c].to_numpy() for c in ("node", "n", "chunk"))
    sets = [np.frombuffer(x, "<u8") for x in t["shared"].to_pylist()]
    a, b = np.flatnonzero(chunk == i), np.flatnonzero(chunk == j)
    u, v = [], []
    if len(a) and len(b):
        both = overlaps([sets[x] for x in a], [sets[x] for x in b])
        linked = WHOLE * both >= PART * (n[a][:, None] + n[b][None, :] - both)
        root = list(range(len(node)))

        def find(x: int) -> int:
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        for x, y in zip(*np.nonzero(linked), strict=True):
            p, q = find(a[x]), find(b[y])
            if p != q:
                root[max(p, q)] = min(p, q)
                u.append(int(node[a[x]])), v.append(int(node[b[y]]))
    return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})


def link_rows(rows: DataFrame, family_rows: int = 4096, chunk: int = 512) -> DataFrame:
    """``u, v`` links that connect all linked rows of ``node, n, lead, shared``."""
    met = rows.select("node", F.explode("lead").alias("s"))
    # Columns in which the same rows meet say nothing new: one of each set of rows is enough.
    columns = (
        met.groupBy("s").agg(F.count(F.lit(1)).alias("size"), F.min("node").alias("first"), F.max("node").alias("last"), F.bit_xor(F.xxhash64("node")).alias("x1"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("x2"))
        .where("size > 1").groupBy("size", "first", "last", "x1", "x2").agg(F.min("s").alias("s"))
    )
    kept = stage(met.join(columns.select("s", "first"), "s"), "ngram-columns")
    families = stage(connected_components(kept.select(F.col("node").alias("u"), F.col("first").alias("v"))), "ngram-families")
    large = families.groupBy("component").agg(F.count(F.lit(1)).alias("rows"))
    placed = (
        kept.join(families, "node").join(large, "component")
        .select("node", F.when(F.col("rows") <= family_rows, F.col("component")).otherwise(F.col("s")).alias("meet"), (F.col("rows") <= family_rows).alias("family"))
        .distinct()
    )
    sizes = placed.groupBy("meet", "family").agg(F.expr(f"CAST(ceil(count(1) / {chunk}) AS INT)").alias("chunks"))
    dealt = (
        placed.join(sizes, ["meet", "family"])
        .withColumn("chunk", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int"))
        .withColumn("other", F.explode(F.expr("sequence(0, chunks - 1)")))
        .select("meet", "family", "node", "chunk", F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j"))
    )
    full = dealt.join(rows.select("node", "n", "shared"), "node").withColumn("meet", F.concat_ws("/", "meet", "family"))
    return full.groupBy("meet", "i", "j").applyInArrow(_multiply, "u long, v long")


def ngram_components(documents: DataFrame, block_entries: int = 2_000_000) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row of ``documents``."""
    spark = documents.sparkSession
    texts = documents.select("doc_id", "text")
    kind = documents.schema["doc_id"].dataType.simpleString()
    for seed in range(4):
        total = texts.count()
        many = texts.select("text").mapInArrow(_frequent(seed), "s long, n long").groupBy("s").agg(F.sum("n").alias("n")).where(F.col("n") >= max(32, total // (2 * WHOLE)))
        frequent = np.sort(np.array([r.s for r in many.select("s").collect()], np.int64).view(np.uint64))  # two hundred average sets at most
        docs = stage(texts.mapInArrow(_documents(seed, frequent), f"doc_id {kind}, n long, node long, node2 long, often binary"), "ngram-documents")
        clash = docs.where("node IS NOT NULL").groupBy("node").agg((F.min("node2") != F.max("node2")).alias("c")).agg(F.max("c")).first()[0]
        if not clash:
            break
    else:
        raise RuntimeError("two sets have one 64-bit name with every seed")
    entries = docs.agg(F.sum("n")).first()[0] or 0
    blocks = max(shuffle_width(spark), -(-entries // block_entries))
    shared = (
        texts.select("text").mapInArrow(_entries(seed, frequent, blocks), _BLOCK_DDL).groupBy("block").applyInArrow(_shared(blocks), _SHARED_DDL)
        .union(_nodes(docs).mapInArrow(_often(blocks), _SHARED_DDL))
    )
    rows = stage(shared.groupBy("part").applyInArrow(_rows, "node long, n long, lead array<long>, shared binary"), "ngram-rows")
    comps = connected_components(stage(link_rows(rows), "ngram-links"))
    grouped = stage(docs.select("doc_id", "n", "node").join(comps, "node", "left").select("doc_id", "n", F.coalesce("component", "node").alias("component")), "ngram-grouped")
    return with_least(grouped, "component", "doc_id").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("least", "doc_id").alias("component_id"))


OP10_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents),
sh AS (
  SELECT doc_id, unnest(CASE WHEN len(words) = 0 THEN []
                             WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
                             ELSE list_distinct(list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' '))) END) AS s FROM w),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS o FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM o JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * o >= 75 * (x.n + y.n - o)),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
reach(a, b) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.a, e.b FROM reach r JOIN e ON r.b = e.a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, (SELECT min(b) FROM reach r WHERE r.a = d.doc_id) AS component_id
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id"""


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_components(spark.read.parquet(f"{sf_dir}/documents.parquet"))
