import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, digest string, h double, row long"


@pytest.fixture(scope="session")
def prose():
    """Deterministic prose: sentences over a small vocabulary."""

    def make(seed, n=120):
        rng = random.Random(seed)
        vocab = ["amber", "brook", "candle", "drift", "ember", "fable", "grove", "harbor", "ivory", "juniper", "kettle", "lantern", "meadow", "nectar", "orchid", "pebble"]
        return " ".join(rng.choice(vocab) + str(rng.randrange(400)) for _ in range(n))

    return make


@pytest.fixture(scope="session")
def odd_docs(spark, prose):
    """Nulls in every column, empty and very long texts, repeated rows, and extra columns whose names operators use."""
    base = prose(1)
    rows = [
        (1, base, "en", "a", 1, "d", 0.5, 9),
        (1, base, "en", "a", 1, "d", 0.5, 9),
        (2, base + " tail", "en", None, None, None, None, None),
        (3, None, None, "b", None, None, None, None),
        (4, "", "fr", "b", 0, None, None, None),
        (5, " \n\t ", "fr", "b", 3, None, None, None),
        (6, "x" * 200_000, "de", "a", 200_000, None, None, None),
        (7, "la " * 60_000, "fr", "a", 180_000, None, None, None),
        (8, "Ünïcödé \U0001f600 中文 <|endoftext|> é \x1c z", "de", "c", 1, None, None, None),
        (None, base, "en", "a", 1, None, None, None),
        (None, None, None, None, None, None, None, None),
    ]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
