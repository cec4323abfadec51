"""Packing, tokenization, n-gram and suffix operators against brute force."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from minewright.llm import bwt, ngram_join, packing, pieces, suffix_dedup, token_counts, units
from minewright.llm.anchors import SPAN, RollingHash, anchors, sliding_least

WORDS = "the of thing ing tion shall er and nd re Éire ou über 12 x1 don't".split()


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice(WORDS) + rng.choice(["", ".", ","]) for _ in range(n))


@pytest.fixture(scope="module")
def rows(odd_rows):
    rng = random.Random(3)
    out = list(odd_rows)
    base = prose(rng, 300)
    for i in range(20, 60):
        out.append((i, prose(rng, rng.randint(1, 200))))
    for i in range(60, 72):  # near copies
        w = base.split()
        for _ in range(i - 60):
            w[rng.randrange(len(w))] = "zz%d" % rng.randrange(999)
        out.append((i, " ".join(w)))
    passage = prose(rng, 80)
    for i in range(72, 80):  # a passage in other surroundings
        out.append((i, prose(rng, 60) + " " + passage + " " + prose(rng, 60)))
    out.append((80, "ab" * 600))  # overlaps itself
    out.append((81, base)), out.append((82, base))
    return out


def test_packing_places_every_piece_without_gaps(make_docs, rows):
    docs = make_docs(rows)
    got = packing.pack_documents(docs, with_ids=True).collect()
    tokenizer = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    want = Counter()
    for i, t in rows:
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1]
        for piece, start in enumerate(range(0, len(ids), 4096)):
            part = np.array(ids[start : start + 4096], "<u4")
            want[i, piece, start, len(part), zlib.crc32(part.tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    by = defaultdict(list)
    for r in got:
        by[r.sequence_id].append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096
    total = sum(r.length for r in got)
    assert len(by) <= -(-total // 4096) + 1
    whole = {r.sequence_id: r.ids for r in packing.sequences(packing.pack_documents(docs, with_ids=True)).collect()}
    assert sum(map(len, whole.values())) == total


def test_words_of_packing_are_the_librarys_and_pre_tokens_are_encoded_once(monkeypatch):
    path = P.path("word_bpe_49k.json")
    tokenizer, memory = Tokenizer.from_file(path), packing.library_units(path)
    seen: list[str] = []
    memory.forget()
    monkeypatch.setattr(memory, "pairs", lambda parts, inner=memory.pairs: (seen.extend(parts), inner(parts))[1])
    monkeypatch.setattr(memory, "work", lambda units, inner=memory.work: (seen.extend(units), inner(units))[1])
    variants = [f"{w}{mark}" for w in ("river", "River", "RIVER", "fluß", "Fluß") for mark in ("", ".", ",", "!!", "'s")]
    for words in (variants[:9], variants[9:], variants):
        flat, ends = memory.encode_array(pa.array([words, [], words[:2]]))
        assert [x.tolist() for x in np.split(flat, ends[:-1])] == [[i for w in part for i in tokenizer.encode(w, add_special_tokens=False).ids] for part in (words, [], words[:2])]
    assert sorted(seen) == sorted(["river", "fluß", ".", ",", "!!", "'s"])


def test_words_of_all_plain_characters_and_others_are_encoded_as_by_the_library():
    path = P.path("word_bpe_49k.json")
    tokenizer, memory = Tokenizer.from_file(path), packing.library_units(path)
    rng = random.Random(5)
    plain = [c for c in map(chr, range(0x21, 0x2200)) if packing._PLAIN.fullmatch(c)]
    words = [w for c in plain for w in (c, f"a{c}1", f"'{c}", f"A{c}{c}Z")]
    words += ["".join(rng.choices(plain, k=rng.randint(2, 9))) for _ in range(2000)]
    words += ["".join(rng.choices("'strvemlldDN1.é", k=rng.randint(2, 9))) for _ in range(2000)]
    words += ["a<|endoftext|>b", "<|startoftext|>", "<|ENDOFTEXT|>", "ΣΑΣ", "İs", "e\u0301", "x²", "١٢", "漢字かな", "a\x1cb", "\x1f", "😀's", "n" * 5000]
    words = list(dict.fromkeys(words))
    flat, ends = memory.encode_array(pa.array([[w] for w in words]))
    assert [x.tolist() for x in np.split(flat, ends[:-1])] == [e.ids for e in tokenizer.encode_batch_fast(words, add_special_tokens=False)]


def test_words_of_arrays_end_at_the_same_white_space():
    texts = [f"a{chr(c)}b {chr(c)}" for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    odd = [t for t in texts if t[1] in "\x1c\x1d\x1e\x1f"]
    for some in ([t for t in texts if t not in odd], odd):
        assert [[w for w in ws if w] for ws in units.white_split_array(pa.array(some)).to_pylist()] == [units.white_split(t) for t in some]
    assert [[w for w in ws if w] for ws in units.white_split_array(pa.array([None, "", " x  y "])).to_pylist()] == [[], [], ["x", "y"]]


def test_sum_of_squares_follows_its_rule():
    rng = np.random.default_rng(0)
    lengths = np.sort(rng.integers(1, 60, 300))[::-1]
    where, _ = packing.sum_of_squares(lengths, 64)
    fill: list[int] = []
    for s, b in zip(lengths.tolist(), where.tolist(), strict=True):
        gaps = Counter(64 - f for f in fill if f < 64)
        square = lambda c: sum(n * n for n in c.values())

        def after(gap):
            c = gaps.copy()
            if gap < 64:
                c[gap] -= 1
            if gap > s:
                c[gap - s] += 1
            return square(c)

        options = {g: after(g) for g in [*(g for g, n in gaps.items() if n and g >= s), 64]}
        used = 64 - fill[b] if b < len(fill) else 64
        assert options[used] == min(options.values())
        if b == len(fill):
            fill.append(0)
        fill[b] += s


def test_token_counts_equal_the_library(make_docs, rows):
    tokenizer = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    want = Counter((i, len((t or "").encode()), len(tokenizer.encode(t or "", add_special_tokens=False).ids)) for i, t in rows)
    got = token_counts.count_tokens(make_docs(rows)).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_tokens) for r in got) == want
    assert all(r.over_limit == (r.n_tokens > 1024) for r in got)


def odd_text(rng, n):
    return "".join(rng.choice(["a", "b", " ", "  ", "'s", "'", "'ll", "r", "\n", "é", "漢", "1", ".", "<|endoftext|>", "the", "\u3000"]) for _ in range(rng.randint(0, n)))


@pytest.mark.parametrize("long", [1024, 4])
def test_counts_are_the_same_at_any_cut(monkeypatch, long):
    monkeypatch.setattr(token_counts, "LONG", long)
    machine = token_counts.Transducer(P.path("byte_bpe_50k.json"), bound=500)
    tokenizer = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    rng = random.Random(5)
    texts = [odd_text(rng, 40) for _ in range(300)] + ["a" * 3000, " " * 300 + "b", "ab" * 700, "1" * 90, "'" * 50 + "s", " \n" * 40, "\u00e9" * 1200]
    want = [len(tokenizer.encode(t, add_special_tokens=False).ids) for t in texts]
    for window in (8, 16, 33, 1000, 1 << 18):
        assert machine.count_all(texts, window).tolist() == want, window
        assert [machine.count(t, window) for t in texts] == want, window


def test_long_texts_are_dealt_in_segments(make_docs, monkeypatch):
    tokenizer = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    rng = random.Random(6)
    # Words, one run of letters, one run whose reading depends on where it begins, special tokens, white space.
    texts = ["x " * 2000, "".join(rng.choice("abcdefgh") for _ in range(5000)), "a" * 5001, "b <|endoftext|>" * 300, " " * 4000 + "z", None, "", "short"]
    rows = list(enumerate(texts)) + [(0, texts[1]), (None, texts[0])]
    want = Counter((i, len(tokenizer.encode(t or "", add_special_tokens=False).ids)) for i, t in rows)
    got = token_counts.count_tokens(make_docs(rows), split=1500, window=400).collect()
    assert Counter((r.doc_id, r.n_tokens) for r in got) == want


def test_pieces_equal_the_library_and_decode_back(make_docs, rows):
    sp = sentencepiece.SentencePieceProcessor(model_file=pieces.default_path())
    docs = make_docs(rows)
    encoded = pieces.encode_texts(docs)
    got = Counter((r.doc_id, tuple(r.ids)) for r in encoded.collect())
    assert got == Counter((i, tuple(sp.encode(t or ""))) for i, t in rows)
    assert Counter((r.doc_id, r.text) for r in pieces.decode_ids(encoded).collect()) == Counter((i, t or "") for i, t in rows)
    assert all(r.round_trip for r in pieces.encode_texts(docs, digest=True).collect())


def test_suffix_order_and_ranges():
    rng = np.random.default_rng(1)
    codes = np.append(rng.integers(0, 3, 300), 0)
    order = pieces.suffix_order(codes, 8)
    key = lambda i: [*codes[i : i + 8].tolist(), *[0] * 8][:8]
    assert [key(i) for i in order] == sorted(key(i) for i in range(len(codes)))


def jaccard_components(rows):
    sets = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        sets.append(frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) > 4 else frozenset([tuple(w)] if w else []))
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    least = {}
    for i, (d, _) in enumerate(rows):
        if sets[i] and d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return Counter((d, len(s), least.get(find(i), d) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True)))


def test_frequent_columns_are_dealt_once_for_all_copies(make_docs, monkeypatch, tmp_path):
    often = ngram_join._often

    def counting(parts):
        inner = often(parts)

        def run(batches):
            for batch in inner(batches):
                with open(f"{tmp_path}/rows", "a") as f:
                    f.write("x" * (sum(map(len, batch.column(3).to_pylist())) // 8))
                yield batch

        return run

    monkeypatch.setattr(ngram_join, "_often", counting)
    copied, other = prose(random.Random(1), 50), prose(random.Random(2), 50)
    rows = [(i, copied) for i in range(200)] + [(200, other)]
    got = {r.doc_id: r.component_id for r in ngram_join.ngram_components(make_docs(rows)).collect()}
    assert got == {i: 0 for i in range(200)} | {200: 200}
    assert (tmp_path / "rows").read_text() == "x" * 46  # the shingles of one copy


def test_ngram_components_equal_brute_force(make_docs, rows):
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.ngram_components(make_docs(rows)).collect())
    assert got == jaccard_components(rows)


def test_large_families_are_multiplied_column_by_column(make_docs, spark, rows):
    docs = make_docs(rows)
    texts = docs.select("doc_id", "text")
    found = {}
    for family in (4096, 2):
        none = np.zeros(0, np.uint64)
        entries = texts.select("text").mapInArrow(ngram_join._entries(0, none, 4), ngram_join._BLOCK_DDL).groupBy("block").applyInArrow(ngram_join._shared(4), ngram_join._SHARED_DDL)
        sets = texts.mapInArrow(ngram_join._documents(0, none), "doc_id long, n long, node long, node2 long, often binary")
        entries = entries.union(ngram_join._nodes(sets).mapInArrow(ngram_join._often(4), ngram_join._SHARED_DDL))
        matrix = entries.groupBy("part").applyInArrow(ngram_join._rows, "node long, n long, lead array<long>, shared binary")
        links = ngram_join.link_rows(matrix, family_rows=family, chunk=3)
        found[family] = Counter((r.node, r.component) for r in ngram_join.connected_components(links).collect())
    assert found[4096] == found[2] and found[2]


def cut_repeats(rows, length):
    raw = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(b[p : p + length] for _, b in raw for p in range(len(b) - length + 1))
    out = Counter()
    for i, b in raw:
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if seen[b[p : p + length]] > 1:
                gone[p : p + length] = b"\1" * length
        runs = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out[i, len(b), sum(gone), runs, hashlib.sha256(bytes(x for x, g in zip(b, gone, strict=True) if not g)).hexdigest()] += 1
    return out


@pytest.mark.parametrize("crowd", [8192, 1])
def test_repeats_equal_brute_force(make_docs, rows, crowd):
    short = [(i, t[:6000] if t else t) for i, t in rows]
    got = suffix_dedup.remove_repeats(make_docs(short), with_text=False, crowd=crowd).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == cut_repeats(short, 400)
    assert "node" in got[0].asDict() and "score" in got[0].asDict()


def test_shorter_passages_are_counted_and_stay(make_docs):
    rng = random.Random(12)
    passage = prose(rng, 60)[:300]
    rows = [(1, prose(rng, 80) + passage + prose(rng, 40)), (2, passage + prose(rng, 90)), (3, prose(rng, 200)), (4, passage[:255]), (5, None)]
    got = {r.doc_id: r for r in suffix_dedup.remove_repeats(make_docs(rows), with_text=False, passage=256).collect()}
    want = {i: (runs, gone) for i, _, gone, runs, _ in cut_repeats(rows, 256)}
    assert {i: r.n_passages for i, r in got.items()} == {i: runs for i, (runs, _) in want.items()} and got[1].n_passages == got[2].n_passages == 1
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got.values()) == cut_repeats(rows, 400)


def test_removed_spans_and_kept_text_agree(make_docs, rows):
    for r in suffix_dedup.remove_repeats(make_docs(rows)).collect():
        assert r.n_removed == sum(b - a for a, b in r.removed) and len(r.kept) == r.n_bytes - r.n_removed
        assert (r.text or "") == r.kept.decode("utf-8", "ignore")


def test_merged_transforms_find_repeats():
    rng = np.random.default_rng(0)
    for _ in range(150):
        depth = int(rng.integers(1, 8))
        strings = [rng.integers(1, 3, rng.integers(0, 20)).astype(np.uint16) for _ in range(rng.integers(1, 10))]
        weight = rng.integers(1, 4, len(strings))
        flag = bwt.repeated(np.concatenate(strings), np.array(list(map(len, strings))), weight, depth, int(rng.integers(1, 4)))
        seen = Counter()
        for s, w in zip(strings, weight.tolist(), strict=True):
            for i in range(len(s) - depth + 1):
                seen[tuple(s[i : i + depth])] += w
        assert flag.tolist() == [i + depth <= len(s) and seen[tuple(s[i : i + depth])] > 1 for s in strings for i in range(len(s))]


def test_merged_transforms_give_common_prefixes():
    rng = np.random.default_rng(4)
    for _ in range(60):
        depth = int(rng.integers(1, 9))
        strings = [[*rng.integers(1, 3, rng.integers(0, 15)), 0] for _ in range(rng.integers(1, 7))]
        per = int(rng.integers(1, 4))
        shards = [np.concatenate([np.array(s) for s in strings[a : a + per]]).astype(np.uint16) for a in range(0, len(strings), per)]
        orders = [bwt.suffixes(x, depth) for x in shards]
        shard, common = bwt.merge([bwt.transform(x, o) for x, o in zip(shards, orders, strict=True)], depth)
        taken, merged = [0] * len(shards), []
        for k in shard.tolist():
            x = shards[k][orders[k][taken[k]] :]
            merged.append(tuple(x[: int(np.flatnonzero(x == 0)[0]) + 1].tolist()))
            taken[k] += 1
        cut = [s[:depth] for s in merged]
        assert [tuple(c for c in s if c) for s in cut] == sorted(tuple(c for c in s if c) for s in cut)

        def shared(a, b):  # ends differ from each other
            n = 0
            while n < depth and n < len(a) and n < len(b) and a[n] == b[n] != 0:
                n += 1
            return n

        assert common[0] == 0 and common[1:].tolist() == [shared(a, b) for a, b in zip(merged, merged[1:], strict=False)]


def test_anchor_of_a_window_depends_on_its_bytes_alone():
    rng = np.random.default_rng(2)
    window = rng.integers(0, 4, 400).astype(np.uint8)
    found = set()
    for left in (0, 17, 300):
        data = np.concatenate([rng.integers(0, 4, left).astype(np.uint8), window, rng.integers(0, 4, 99).astype(np.uint8)])
        a = anchors(data, np.array([0]), np.array([len(data)]), RollingHash(1), RollingHash(2), 400)
        hit = (a["at"] - a["far"] <= left) & (left <= a["at"] - a["near"])
        found.add((int((a["at"][hit] - left)[0]), int(a["core"][hit][0])))
        assert hit.sum() == 1
    assert len(found) == 1
    x = rng.integers(0, 99, 500).astype(np.uint64)
    assert sliding_least(x, SPAN).tolist() == [min(x[i : i + SPAN]) for i in range(500 - SPAN + 1)]


@pytest.mark.parametrize("run", [ngram_join.ngram_components, packing.pack_documents, token_counts.count_tokens, pieces.encode_texts, suffix_dedup.remove_repeats])
def test_empty_tables_give_no_rows(make_docs, run):
    assert run(make_docs([]).limit(0)).count() == 0
