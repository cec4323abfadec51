"""The pipeline's stages on a small corpus, each against what it must do."""

import random
import zlib

import numpy as np
import plain
import public_tokenizers as P
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from corpus_pipeline import PASSAGE, STAGES, drop_near_copies, drop_repeated_passages, drop_toxic, drop_unknown_language, run
from minewright.llm.language_id import fit_language_id
from minewright.llm.toxicity import THRESHOLD, fit_toxicity
from minewright.llm.words import fold

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def corpus(spark, tmp_path):
    rng = random.Random(7)
    words = [a + b for a in "ba ke li mo nu sha tri".split() for b in "ra so ti vu len".split()]
    say = lambda n: " ".join(rng.choice(words) for _ in range(n))
    base, passage = say(120), say(90)
    docs = [(i, say(40) + (" moronic scum" if i % 5 == 0 else ""), "en") for i in range(100)]
    docs += [(200, base, "en"), (201, base + " tail", "en"), (202, base, "en"), (300, say(30) + " " + passage + " " + say(30), "en"), (301, say(30) + " " + passage + " " + say(30), "en"), (400, "12 34", "en"), (401, None, None), (402, "", None)]
    rows = [(i, t, lang, "s", len(t or "")) for i, t, lang in docs]
    spark.createDataFrame(rows, DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i % 5 == 0)) for i in range(100)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    return str(tmp_path), {i: t for i, t, _ in docs}, passage


def test_stages_take_effect(spark, tmp_path):
    sf_dir, texts, passage = corpus(spark, tmp_path)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    clean = drop_toxic(spark, docs, sf_dir)
    ids = {r.doc_id for r in clean.collect()}
    assert not ids & set(range(0, 100, 5)) and ids >= set(texts) - set(range(0, 100, 5)) and clean.columns == docs.columns
    known = drop_unknown_language(spark, clean, sf_dir)
    assert ids - {r.doc_id for r in known.collect()} == {400, 401, 402}
    single = drop_near_copies(spark, known, sf_dir)
    left = {r.doc_id for r in single.collect()}
    assert left & {200, 201, 202} == {200} and left >= {300, 301}
    cut = drop_repeated_passages(spark, single, sf_dir)
    kept = {r.doc_id: r.text for r in cut.collect()}
    assert passage not in kept[300] and passage not in kept[301] and kept[200] == texts[200] and cut.columns == docs.columns


def test_run_equals_the_rules_in_plain_python(spark, tmp_path):
    sf_dir, _, _ = corpus(spark, tmp_path)
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    model = fit_toxicity(docs, labels.select("doc_id", "toxic").where(fold(F.col("doc_id"), 4) != 2))
    coder = fit_language_id(docs.where(fold(F.col("doc_id"), 3) != 1))
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    rows = [(i, t) for i, t in rows if plain.toxic_score(t, model) < THRESHOLD]
    rows = [(i, t) for i, t in rows for lang, _, torn in [plain.language(t, coder, 0.02)] if lang != "und" and not torn]
    rows = [min((rows[k] for k in g), key=lambda r: r[0]) for g in plain.near_groups(rows)]
    left = [(i, kept.decode("utf-8", "ignore")) for (i, _), kept in zip(rows, plain.without_repeats([t for _, t in rows], PASSAGE), strict=True)]
    tokenizer = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    want = set()
    for i, t in left:
        if t:
            ids = np.array([*tokenizer.encode(t, add_special_tokens=False).ids, 1], "<u4")
            want |= {(i, k, s, len(ids[s : s + 4096]), zlib.crc32(ids[s : s + 4096].tobytes())) for k, s in enumerate(range(0, len(ids), 4096))}
    got = run(spark, sf_dir).collect()
    assert {(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got} == want and len(got) == len(want) > 70 and len(STAGES) == 5
    for sequence in {r.sequence_id for r in got}:
        places = sorted((r.offset, r.length) for r in got if r.sequence_id == sequence)
        assert [o for o, _ in places] == [sum(n for _, n in places[:k]) for k in range(len(places))] and sum(n for _, n in places) <= 4096


def test_empty_documents_go_through_all_stages(spark, tmp_path):
    spark.createDataFrame([], DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert run(spark, str(tmp_path)).count() == 0


def test_near_copies_go_by_row(spark):
    rng = random.Random(3)
    say = lambda: " ".join("w%d" % rng.randrange(999) for _ in range(60))
    base, other, third = say(), say(), say()
    rows = [(1, base), (2, base + " tail"), (2, other), (None, third), (None, third + " tail"), (5, other + " x"), (5, other + " y"), (7, None), (8, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], DOCS).repartition(3)
    kept = sorted(((r.doc_id, r.text) for r in drop_near_copies(spark, docs, "").collect()), key=repr)
    assert len(kept) == 5 and {(1, base), (2, other), (7, None), (8, "")} <= set(kept)
    assert [t for i, t in kept if i is None] in ([third], [third + " tail"])
