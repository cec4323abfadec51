import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, node string"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from ``(doc_id, text)`` pairs, with extra columns whose names clash with those of the operators."""

    def make(rows, lang="en"):
        return spark.createDataFrame([(i, t, lang, "s", len(t or ""), 0.5, "x") for i, t in rows], SCHEMA).repartition(3)

    return make


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empties, ties, repeats, a null id, long and odd texts."""
    return [(1, None), (2, ""), (3, "   "), (4, "one"), (5, "one"), (5, "one"), (None, "one two"), (7, "word " * 30_000), (8, "é" * 500), (9, "a\x1cb\u3000c \U0001f642 ½"), (10, "a <|endoftext|> b")]
