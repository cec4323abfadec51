"""Collocations, hard negatives and archives against plain Python."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from minewright.llm import collocations as C
from minewright.llm import hard_negatives as H
from minewright.llm import warc as W


def plain_collocations(rows, least, longest=5, top=2000):
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        for piece in re.split(r"[.,;:!?\n-\r]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            w = re.findall(r"[^ \t]+", piece)
            n[lang or "und"] += len(w)
            for k in range(1, longest + 1):
                f[lang or "und"].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = set()
    for lang, counts in f.items():
        found = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        kept = []
        for p, a in found.items():
            inside = any(len(q) > len(p) and b >= a and any(q[i : i + len(p)] == p for i in range(len(q))) for q, b in found.items())
            if not inside:
                score, k = min((1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p)))
                kept.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        out |= {(lang, i, p.decode(), -a, l, r, n[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(kept)[:top], 1)}
    return out


ODD = [(None, "en"), ("", "en"), (" . , ;", None), ("A b c. a  b\tc! É É é", None), ("x" * 40_000 + " y " + "x" * 40_000 + " y", "fr"), ("a\x0bb\x0cc\rd\x1ce", "und"), ("the end " * 3000, "en"), ("the end of it, the end of it", "")]


@pytest.mark.parametrize("window", [50, 1 << 20])
def test_collocations_equal_brute_force(spark, monkeypatch, window):
    rng = np.random.default_rng(3)
    texts = [(" ".join(rng.choice(["a", "B", "c", "dd.", "é", "f,"], 60)), ["en", "fr"][i % 2]) for i in range(40)] * 2
    rows = texts + ODD
    # In tasks the window stays what it is; the functions are run here with a small one.
    monkeypatch.setattr(C, "WINDOW", window)
    batch = pa.record_batch({"lang": [l or "und" for _, l in rows], "text": [t for t, _ in rows]})
    again = [b for x in C._pieces(iter([batch])) for b in [x]]
    grams = [g for n in (1, 2, 3) for g in C._grams(range(n, n + 1))(iter(again))]
    total = Counter()
    for g in grams:
        for r in g.to_pylist():
            total[r["lang"], r["phrase"]] += r["f"]
    for lang in {l or "und" for _, l in rows}:
        assert total[lang, ""] == sum(len(re.findall(r"[^ \t.,;:!?\n-\r]+", t or "")) for t, l in rows if (l or "und") == lang)
    df = spark.createDataFrame([(t, l, 1, 2, "x") for t, l in rows], "text string, lang string, n int, rank int, phrase string").repartition(3)
    got = C.collocations(df, least=5, top=30)
    assert {tuple(r) for r in got.collect()} == plain_collocations(rows, 5, top=30)


def test_collocations_of_nothing_and_hot_parts(spark, monkeypatch):
    empty = spark.createDataFrame([], "text string, lang string")
    assert C.collocations(empty).collect() == []
    monkeypatch.setattr(C, "HOT", 2)
    rows = [(f"the w{i} of the w{i} it", "en") for i in range(12) for _ in range(3)]
    assert {tuple(r) for r in C.collocations(spark.createDataFrame(rows, "text string, lang string"), least=3).collect()} == plain_collocations(rows, 3)


def test_score_is_exact_beyond_64_bits(spark):
    a, n, l, r = 9 * 10**14, 9 * 10**17, 9 * 10**14, 10**15
    got = spark.createDataFrame([(a, n, l, r)], "a long, n long, l long, r long").selectExpr(
        "CAST(CAST(CAST(1000 AS DECIMAL(4,0)) * CAST(a AS DECIMAL(15,0)) AS DECIMAL(19,0)) * CAST(n AS DECIMAL(19,0)) AS DECIMAL(38,0)) div CAST(CAST(l AS DECIMAL(19,0)) * CAST(r AS DECIMAL(19,0)) AS DECIMAL(38,0))").first()[0]
    assert got == 1000 * a * n // (l * r)


def plain_negatives(rows, every=50, k=5, m=3):
    live = [(i, l, v) for i, l, v in rows if i is not None and l is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    out = Counter()
    for a, (i, label, v) in enumerate(live):
        if i % every:
            continue
        scored = sorted(((-int(sum(int(x) * int(y) for x, y in zip(v, w, strict=True))), j, l) for b, (j, l, w) in enumerate(live) if b != a and len(w) == len(v)), key=lambda x: x[:2])
        for s, j, _ in [x for x in scored if x[2] == label][:k]:
            fit = [(t, o) for t, o, l in scored if l != label and 50 * -s <= 100 * -t <= 95 * -s][:m]
            out.update((i, j, rank, o, -s, -t) for rank, (t, o) in enumerate(fit, 1))
    return out


VECTORS = "id long, label int, v array<double>, score long, block string"


@pytest.mark.parametrize("sizes", [{}, {"row_block": 7, "anchor_block": 3, "dim_chunk": 3, "round_scores": 600}])
def test_hard_negatives_equal_brute_force(spark, sizes):
    rng = np.random.default_rng(5)
    rows = [(i, int(rng.integers(0, 3)), [float(x) for x in rng.integers(-4, 9, 8)]) for i in range(160)]
    rows += [(50, 1, [1.0] * 8), (50, 1, [1.0] * 8), rows[3], rows[3], (None, 1, [1.0] * 8), (200, None, [1.0] * 8), (250, 1, None), (300, 1, []), (350, 1, [float("nan")] * 8), (400, 1, [None] * 8), (450, 0, [3.0, 4.0]), (451, 0, [3.0, 3.0]), (452, 2, [2.0, 2.0]), (500, 0, [0.0] * 8)]
    df = spark.createDataFrame([(*r, 7, "x") for r in rows], VECTORS).repartition(4)
    assert Counter(tuple(r) for r in H.hard_negatives(df, every=10, **sizes).collect()) == plain_negatives(rows, every=10)


def test_hard_negatives_of_nothing_and_large_numbers(spark):
    assert H.hard_negatives(spark.createDataFrame([], VECTORS)).collect() == []
    big = [(0, 1, [2.0**30, 1.0]), (1, 1, [2.0**30, 3.0]), (2, 2, [2.0**29 + 1, 5.0]), (3, 2, [2.0**29, 5.0]), (4, 2, [2.0**29, 5.0])]
    got = H.hard_negatives(spark.createDataFrame([(*r, 0, "") for r in big], VECTORS))
    assert Counter(tuple(r) for r in got.collect()) == plain_negatives(big)
    with pytest.raises(Exception, match="64 bits"):
        H.hard_negatives(spark.createDataFrame([(0, 1, [2.0**62, 2.0**62], 0, ""), (1, 1, [2.0**62, 2.0**62], 0, "")], VECTORS)).collect()


def test_best_breaks_ties_by_column_in_both_forms():
    rng = np.random.default_rng(1)
    s, ok = rng.integers(-3, 4, (20, 50)), rng.random((20, 50)) < 0.5
    want = {(r, c) for r in range(20) for c in sorted(np.flatnonzero(ok[r]), key=lambda c: (-s[r, c], c))[:4]}
    for scores in (s, s * 2**58):
        assert set(zip(*(x.tolist() for x in H.best(scores.astype(np.int64), ok, 4)), strict=True)) == want


PAGES = "page_id long, url string, html string, bundle string, sha string, refers_to int"
LONG = "<p>é</p>" * 200


def pages_of(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", 1) for r in rows], PAGES).repartition(3)


ROWS = [(1, "http://a/", LONG), (5, None, LONG), (3, "http://b/\r\nX: y", LONG), (5, "http://again/", LONG), (7, "u", "short"), (8, "u", "short"), (9, "u", None), (10, "u", ""), (None, "u", LONG), (None, "u", "z" * 2000), (None, None, "z" * 2000),
        (11, "u", "é" * 500), (12, "u", "é" * 500), (13, "u", "w" * 999), (14, "u", "w" * 999), (15, "u", "a\r\n\r\nWARC/1.1\r\n" * 100), (16, "u", "m" * 3_000_000)]


def plain_pages(rows):
    out = Counter()
    for i, _, html in rows:
        body = (html or "").encode()
        top = max((j for j, _, h in rows if (h or "") == (html or "") and j is not None), default=None)
        again = len(body) >= 1000 and top is not None and top != i
        out[i, len(body), hashlib.sha1(body).hexdigest(), "revisit" if again else "response", top if again else None] += 1
    return out


@pytest.mark.parametrize("few", [W.FEW, 0])
def test_archives_round_trip(spark, monkeypatch, tmp_path, few):
    monkeypatch.setattr(W, "FEW", few)
    monkeypatch.setattr(W, "HOT", 3)
    folder = str(tmp_path / "archives")
    index = W.write_archives(pages_of(spark, ROWS), folder, frame_bytes=5000, bundle_bytes=3000)
    read = W.read_archives(index.select("bundle").distinct(), folder)
    got = read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert Counter(tuple(r) for r in got.collect()) == plain_pages(ROWS)
    bodies = {(r.page_id, bytes(r.payload)) for r in read.where("record_type = 'response'").collect()}
    assert bodies <= {(i, (h or "").encode()) for i, _, h in ROWS} and len(bodies) == 11
    assert {r.url for r in read.where("page_id = 3").collect()} == {"http://b/%0D%0AX:%20y"}
    every = read.collect()
    by_id = {r.record_id: r.payload_digest for r in every if r.record_type == "response"}
    revisits = [r for r in every if r.record_type == "revisit"]
    assert len(revisits) == 4 and all(by_id[r.refers_to_record] == r.payload_digest and r.payload is None for r in revisits)
    # Any reader of the format reads a bundle from its start, and the index leads to each record.
    import zstandard

    for r in index.collect():
        data = open(f"{folder}/{r.bundle}", "rb").read()
        plain = zstandard.ZstdDecompressor().decompress(data[r.frame_start : r.frame_start + r.frame_bytes])
        assert len(plain) == r.frame_size and plain[r.offset : r.offset + r.length].startswith(b"WARC/1.1\r\n") and r.record_id.encode() in plain[r.offset : r.offset + r.length]
        whole = zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True).read()
        assert whole.count(b"WARC-Record-ID: ") == index.where(index.bundle == r.bundle).count()
    wanted = index.where("page_id IN (7, 15)").select("record_id")
    assert sorted((r.page_id, len(r.payload)) for r in W.fetch_records(index, folder, wanted).collect()) == [(7, 5), (15, 1500)]


def test_archives_of_nothing_and_damage(spark, tmp_path):
    folder = str(tmp_path / "none")
    index = W.write_archives(pages_of(spark, []), folder)
    assert W.read_archives(index.select("bundle").distinct(), folder).collect() == []
    index = W.write_archives(pages_of(spark, [(1, "u", "x" * 500)]), folder)
    path = f"{folder}/{index.first().bundle}"
    data = bytearray(open(path, "rb").read())
    data[len(data) // 3] ^= 1
    open(path, "wb").write(data)
    with pytest.raises(Exception, match="ZstdError|damaged|checksum"):
        W.read_archives(index.select("bundle").distinct(), folder).collect()


CLASHING = "doc_id long, text string, _key int, _text int, _runs int, _passages int, _check int, _found int, _row int, _component int, _first int"


def test_extra_columns_named_like_inner_ones(spark):
    from corpus_pipeline import drop_near_copies
    from minewright.llm.language_id import fit_language_id, identify_languages
    from minewright.llm.suffix_dedup import remove_repeats

    shared = "the same words again and again " * 30
    docs = spark.createDataFrame([(i, t, *range(9)) for i, t in [(1, "a " + shared), (2, "b " + shared), (3, None), (4, "12")]], CLASHING)
    got = {r.doc_id: r for r in remove_repeats(docs, 400, passage=256).collect()}
    assert got[1].n_removed > 400 and got[3].n_bytes == 0 and all(got[i]._passages == 3 and got[i]._key == 0 for i in got)
    coder = fit_language_id(spark.createDataFrame([(i, w * 9, l) for i, (w, l) in enumerate([("the same words again ", "en"), ("le chat noir et blanc ", "fr")] * 6)], "doc_id long, text string, lang string"))
    assert {r.doc_id: (r._found, r.lang_pred) for r in identify_languages(docs, coder).collect()} == {1: (5, "en"), 2: (5, "en"), 3: (5, "und"), 4: (5, "und")}
    near = drop_near_copies(spark, docs, "")
    assert near.columns == docs.columns and {r.doc_id for r in near.collect()} == {1, 3, 4}


@pytest.mark.parametrize("window", [7, 50])
def test_letter_runs_do_not_depend_on_the_window(window):
    from minewright.llm.words import _parts, letter_runs

    texts = ["a" * 120 + " bc " + "é" * 60 + "1" + "x" * 49, "", None, "ab cd " * 40]
    assert ["".join(_parts(t, window)) for t in texts if t] == [t for t in texts if t]
    read = lambda w: [(int(o), "".join(map(chr, r.codes[s : s + n]))) for r in letter_runs(pa.array(texts), w) for s, n, o in zip(r.start, r.size, r.owner, strict=True)]
    assert read(window) == read(1 << 17)
