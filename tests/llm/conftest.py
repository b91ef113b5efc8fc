import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _id string, at string, score string, row string, head string"


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls everywhere, empty, blank, letterless and very long texts, repeated rows and ids, and columns whose names the operators use."""
    long = " ".join(f"word{i % 977}x{i}" for i in range(30_000))
    rows = [(1, "the cat sat on the mat today", "en", "a"), (1, "the cat sat on the mat today", "en", "a"), (1, "another text under the same id here", "en", "b"), (2, None, None, None), (3, "", "en", "a"), (4, " \n\t ", "fr", "b"), (5, "1 2 3 !!", "fr", "c"), (None, "the cat sat on the mat today", "en", None), (None, None, None, "a"), (7, long, "en", "a"), (8, long + " tail", "fr", "b"), (9, "le chat\n\nle chat\nnoir 😀 日本", "fr", "c"), (10, "a", "fr", "a")]
    return spark.createDataFrame([(*r, None, "x", "y", "z", "r", "h") for r in rows], SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)
