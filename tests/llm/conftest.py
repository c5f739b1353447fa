import random

import pytest

LONG = " ".join(random.Random(7).choices(["the", "of", "and", "river", "mountain", "Straße", "naïve", "it's", "2048", "x"], k=40_000))
EDGES = [
    (1, "the river and the mountain of it's 2048", "en", "a", 5), (2, None, "en", None, None), (3, "", None, "a", 0),
    (4, LONG, "en", "b", 1), (4, LONG, "en", "b", 1), (None, "no id here", "en", "a", 2), (None, None, None, None, None),
    (5, " \t\n\x0b\x0c\r ", "fr", "b", 3), (6, "é" * 300, "fr", "c", 4), (7, "é" * 300, "fr", "c", 4), (8, "a" * 5000, "en", "a", 6),
    (9, "word " * 300, "en", "b", 7), (10, "\U0001f600 emoji   line   space", "xx", "", 8),
]


@pytest.fixture(scope="session")
def edges(spark):
    """Nulls in every column, empty, blank and very long texts, repeated rows and ties, and columns with names used inside."""
    rows = [(*r, 1, "k", "s", 0.5, "c", "m", "b") for r in EDGES]
    return spark.createDataFrame(
        rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, id int, key string, state string, n double, "
              "component string, mixed string, best string").repartition(3)


@pytest.fixture(scope="session")
def edge_rows():
    return EDGES


@pytest.fixture(scope="session")
def sample(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
