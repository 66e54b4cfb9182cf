import random

import pytest


@pytest.fixture(scope="session")
def frame(spark):
    """A small DataFrame of rows and a DDL schema, over a few partitions."""

    def make(rows, ddl, parts=3):
        return spark.createDataFrame(rows, ddl).repartition(parts)

    return make


@pytest.fixture(scope="session")
def prose():
    """Seeded sentences of invented words."""
    rng = random.Random(11)
    words = ["".join(rng.choice(["an", "er", "ti", "on", "the", "ing", "re", "st"]) for _ in range(rng.randint(1, 4))) for _ in range(900)]

    def make(n, seed):
        r = random.Random(seed)
        return " ".join(r.choice(words) for _ in range(n))

    return make


DOCS = "doc_id long, text string, lang string, source string, n_chars long, shard int, token string, key int, class int, position int"


@pytest.fixture(scope="session")
def odd_docs(frame, prose):
    """Documents with every defined oddity and extra columns whose names clash."""
    long_text = prose(60_000, 1)
    rows = [
        (1, None, "en", "a", 1), (2, "", None, "a", 1), (3, "   \n\t", "en", None, 1), (4, "123 456 !!", "de", "b", None),
        (5, prose(40, 2), "en", "b", 1), (6, prose(40, 2), "en", "c", 1), (6, prose(40, 2), "en", "c", 1),
        (None, prose(40, 3), "en", "c", 1), (None, None, None, None, None), (8, long_text, "fr", "c", 1),
        (9, "Émile était là 🙂", "fr", "a", 1), (10, "one", "en", "a", 1),
    ]
    return frame([(*r, 7, "x", 7, 7, 7) for r in rows], DOCS)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
