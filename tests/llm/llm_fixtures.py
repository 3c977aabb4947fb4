"""Rows shared by the tests of the training-data operators."""
import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns whose names an operator uses itself.
CLASHING = ("row", "kept", "size", "rank", "node", "core", "n_words", "place", "copies", "items", "rid", "t")


def words(n, seed=0, vocab=400):
    import random
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefgh") for _ in range(2 + r.randrange(5))) + str(r.randrange(vocab) % 7 or "")
                    for _ in range(n))


def odd_rows():
    """Nulls in every column, empty and long texts, ties, repeated rows."""
    a, b = words(300, 1), words(120, 2)
    near = a.replace(a.split()[40], "changed", 1)
    return [
        (1, a, "en", "s0", len(a)), (2, a, "en", "s0", len(a)), (3, near, "en", "s1", None), (4, b, None, "s1", 1),
        (5, None, "en", "s1", 0), (6, "", "de", None, 0), (7, " \t\n\r ", None, None, 5), (8, "one", "en", "s2", 3),
        (9, "one", "en", "s2", 3), (10, words(30_000, 3), "en", "s2", None), (11, b + "\n" + b, "de", "s0", None),
        (12, "x" * 5000, "en", "s0", 5000), (13, "\n".join(["same line here"] * 60), "en", "s0", None),
        (None, words(80, 4), "en", "s1", None), (14, b, None, "s1", 1), (14, b, None, "s1", 1),
    ]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def clashing(odd):
    """The odd rows with extra columns named like the operators' own."""
    from pyspark.sql import functions as F
    return odd.select("*", *(F.lit("extra").alias(c) for c in CLASHING))
