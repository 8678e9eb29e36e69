import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, row long, key string, score double"


def words(rng, n):
    return " ".join(rng.choice("the of and river stone paper light green house music window garden".split()) + rng.choice("aeiou") * rng.randint(0, 3) for _ in range(n))


@pytest.fixture(scope="session")
def awkward_rows():
    """Nulls in every column, empty and very long texts, ties, repeated rows, a text that a third of all rows share."""
    rng = random.Random(7)
    hot = words(rng, 40)
    rows = [(i, hot if i % 3 == 0 else words(rng, 1 + i % 60), "en", "s", 1, i, "k", 0.5) for i in range(60)]
    rows += [
        (100, None, None, None, None, None, None, None),
        (101, "", "en", "s", 0, 1, "k", 0.0),
        (None, "no id at all", "en", "s", 0, 1, "k", 0.0),
        (None, None, None, None, None, None, None, None),
        (102, words(rng, 30_000), "en", "s", 0, 1, "k", 0.0),
        (103, "x" * 200_000, "en", "s", 0, 1, "k", 0.0),
        (104, "Ωμέγα Straße ﬁne 日本語   \x1f it's <|endoftext|>", "el", "s", 0, 1, "k", 0.0),
        (105, " \t\n ", "en", "s", 0, 1, "k", 0.0),
        (106, "the same  text", "en", "s", 0, 1, "k", 0.0),
        (107, "the same\ttext", "en", "s", 0, 1, "k", 0.0),
    ]
    return rows + [rows[5], rows[5], rows[6]]


@pytest.fixture(scope="session")
def awkward(spark, awkward_rows):
    return spark.createDataFrame(awkward_rows, DOCS).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], DOCS)
