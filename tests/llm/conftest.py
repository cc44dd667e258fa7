import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"

#: Nulls in every column, empty and long texts, ties, repeated rows.
AWKWARD = [
    (1, "alpha beta gamma delta epsilon", "en", "a", 30),
    (1, "alpha beta gamma delta epsilon", "en", "a", 30),
    (2, None, None, None, None),
    (3, "", "en", "a", 0),
    (4, " \t\n ", "en", None, 4),
    (None, "alpha beta gamma delta epsilon", "en", "b", 30),
    (5, "word " * 30_000, "fr", "b", 150_000),
    (6, "x", None, "a", 1),
    (7, "ünïcödé 漢字 🎉 <|endoftext|> end space", "de", "b", 40),
]


@pytest.fixture
def awkward(spark):
    from pyspark.sql import functions as F

    rows = spark.createDataFrame(AWKWARD, DOCS)
    clashing = ("score", "size", "target", "node", "component", "rank", "n", "_key", "_tie", "start", "ids", "bucket")
    return rows.withColumns({c: F.lit("clash") for c in clashing})


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], DOCS)
