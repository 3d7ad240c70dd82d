import pytest

KINDS = "doc_id long, text string, lang string, source string, n_chars long, score string, hit string"


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in any column, empty and long texts, ties, repeated rows, columns with clashing names."""
    long = "word and more " * 4000
    rows = [
        (1, "the same words again and again here", "en", "a", 5, "x", "y"),
        (2, "the same words again and again here", "en", "a", 5, None, "y"),
        (3, None, None, None, None, None, None),
        (4, "", "en", "b", 0, "x", "y"),
        (5, long, "en", "b", None, "x", "y"),
        (5, long, "en", "b", None, "x", "y"),
        (6, long + "tail", "de", None, 1, "x", "y"),
        (None, "no id", "de", "c", 1, "x", "y"),
        (7, "äöü €\n\n\nline\nline\nline\nlast \U0001f600", "de", "c", 1, "x", "y"),
        (8, " \t\n ", "fr", "c", 1, "x", "y"),
    ]
    return spark.createDataFrame(rows, KINDS)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], KINDS)
