import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, content string, fp long, part int"


@pytest.fixture(scope="session")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="session")
def texts(docs):
    return {r["doc_id"]: r["text"] or "" for r in docs.collect()}


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows, columns whose names clash with inner ones."""
    words = " ".join(f"w{i % 97}x{i}" for i in range(9000))
    passage = " ".join(f"passage{i}" for i in range(80))
    rows = [
        (1, None, "en", "a", None),
        (2, "", None, "a", 0),
        (3, " \t\n ", "en", None, 4),
        (4, "one", "en", "b", 3),
        (5, words, "en", "b", len(words)),
        (6, words, "en", "b", len(words)),
        (7, passage + " tail one", "en", "c", 9),
        (8, "head " + passage, "en", "c", 9),
        (8, "head " + passage, "en", "c", 9),
        (9, "x" * 5000, "en", "c", 5000),
        (9, "another text under a repeated key", "en", "c", 1),
        (None, passage, "en", None, 1),
        (None, None, None, None, None),
        (10, "ünïcödé 漢字 \U0001f600 straße", "de", "c", 1),
        (11, "a b c d e f g a b c d e f g", "en", "c", 1),
        (9223372036854775807, "last of all", "en", "c", 1),
        (-5, "first of all", "en", "c", 1),
    ]
    return spark.createDataFrame([(*r, "c", 7, 1) for r in rows], SCHEMA)


@pytest.fixture(scope="session")
def empty(odd):
    return odd.limit(0)
