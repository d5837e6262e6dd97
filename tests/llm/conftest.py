import random

import pytest

COLUMNS = "doc_id long, text string, lang string, digest string, `set` long, row long, start long, n long, kind string"


@pytest.fixture(scope="session")
def table(spark):
    """Makes a table of documents out of (doc_id, text), with more columns, some named like inner ones."""

    def make(rows, partitions=3):
        filled = [(i, t, None, "d", None, 1, 2, None, "k") for i, t in rows]
        return spark.createDataFrame(filled, COLUMNS).repartition(partitions)

    return make


@pytest.fixture(scope="session")
def odd_rows():
    """Null and repeated identifiers, null, empty, blank and long texts, ties."""
    words = [f"w{i}" for i in range(3000)]
    long = " ".join(words * 20)
    return [
        (1, "a b c d e f g"),
        (1, "a b c d e f g"),
        (2, "A B C D E F G"),
        (None, "a b c d e f g"),
        (3, None),
        (4, ""),
        (5, " \n\t "),
        (6, long),
        (7, long + " end"),
        (None, None),
        (8, "x"),
        (9, "x"),
        (9, "y z"),
        (10, "é ü ß  日本 🙂 naïve İstanbul"),
    ]


@pytest.fixture
def rng():
    return random.Random(5)
