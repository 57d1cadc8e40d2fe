from __future__ import annotations

import pytest
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fp long, row string, mark int, kept string"
#: names that a schema written as text can't hold
ODD_NAMES = ("my col", "a.b", "x-y")

WORDS = "one two three four five six seven eight nine ten eleven twelve thirteen".split()


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows, and column names that operators use."""
    rows = [
        (1, "a b c d e f", "en", "s1", 5, 1, "x", 1, "k"),
        (1, "a b c d e f", "en", "s1", 5, 1, "x", 1, "k"),
        (2, "A b C d e f", None, "s2", None, None, None, None, None),
        (None, "a b c d e f", "en", None, 5, 1, "x", 1, "k"),
        (3, None, "en", "s1", 0, 1, "x", 1, "k"),
        (4, "", "en", "s1", 0, 1, "x", 1, "k"),
        (5, " \t\n", "de", "s3", 3, 1, "x", 1, "k"),
        (6, "word " * 40_000, "en", "s3", 200_000, 1, "x", 1, "k"),
        (7, "x" * 50_000 + "\n é\U0001f600\u0000", "fr", "s4", 1, 1, "x", 1, "k"),
        (8, " ".join(WORDS * 30), "en", "s5", 1, 1, "x", 1, "k"),
        (None, None, None, None, None, None, None, None, None),
    ]
    return with_odd_names(spark.createDataFrame(rows, SCHEMA))


def with_odd_names(df):
    return df.select("*", *(F.lit(i).alias(name) for i, name in enumerate(ODD_NAMES)))


@pytest.fixture(scope="session")
def no_docs(spark):
    return with_odd_names(spark.createDataFrame([], SCHEMA))
