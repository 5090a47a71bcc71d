import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, size long, hash long, row long, salt long, label string, text_hash long, n long, target double, spans string"


def prose(seed, n, vocabulary=4000):
    rng = random.Random(seed)
    return " ".join(f"w{int(rng.random() ** 2 * vocabulary)}" for _ in range(n))


@pytest.fixture(scope="session")
def prose_of():
    return prose


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table from `(doc_id, text[, source[, lang]])`, with further columns whose names clash with inner ones."""

    def make(rows):
        full = []
        for r in rows:
            doc_id, text, source, lang = (*r, "s0", "en")[:4] if len(r) == 2 else (*r, "en")[:4]
            full.append((doc_id, text, lang, source, len(text or ""), "x", -1, 0, 0, 0, "y", 1, 2, 0.5, "z"))
        return spark.createDataFrame(full, SCHEMA)

    return make


@pytest.fixture(scope="session")
def odd(prose_of):
    """Nulls, empty, tiny, repeated and very long texts, ties."""
    long = prose_of(1, 30_000)
    return [
        (1, None), (2, ""), (3, " \n\t "), (4, "one two"), (5, long), (6, long), (7, "a " * 20_000), (8, prose_of(2, 200) + "\n" + "é漢字 " * 60),
        (8, prose_of(2, 200) + "\n" + "é漢字 " * 60), (9, prose_of(3, 120), None, None), (None, prose_of(4, 90)), (10, "X" * 100_000),
    ]
