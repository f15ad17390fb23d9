import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, digest string, size int, _id int"

ROWS = [  # nulls, empty and odd texts, ties, repeated rows; the last columns clash with names used inside
    (1, "Alpha beta  gamma", "en", "a", 17, "x", 1, 1), (2, "alpha BETA  gamma", "en", "a", 17, "x", 2, 2),
    (3, None, None, None, None, None, None, None), (4, "", "en", "b", 0, "y", 0, 0), (4, "", "en", "b", 0, "y", 0, 0),
    (5, "Éa É", "fr", None, 4, "z", 5, 5), (6, "éa É", "fr", "b", 4, "z", 5, 5), (None, "no id", "en", "c", 5, "q", 1, 1),
    (7, "word " * 3000, "en", "a", 15000, "w", 9, 9), (8, " \t\n", "en", "c", 3, "w", 9, 9), (9, "x" * 60000, "en", "d", 1, "", 1, 1),
]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)
