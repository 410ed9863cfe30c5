import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use for their own columns.
CLASHES = ("score", "predicted", "size", "target", "tokens", "node", "n_lines", "removed", "h1",
           "words", "label", "kept", "copies")


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in any column, empty and very long texts, ties and repeated rows."""
    long = " ".join(f"w{i % 997}x{i}" for i in range(60_000)) + "."
    story = ("The first sentence of this story is quite long and calm. The second one adds some "
             "more words to it. A third one ends the whole passage at last.")
    return [
        (1, story, "en", "a", 10), (2, story, "en", "a", 10), (3, story + " And more.", "en", "b", 1),
        (4, None, "en", "a", 0), (5, "", "de", None, 0), (6, " \n\t ", None, "a", 3),
        (None, story, "en", "a", 10), (None, None, None, None, None), (7, long, "en", "a", 9),
        (8, "dup", "en", "b", 3), (8, "dup", "en", "b", 3), (8, "other text", "en", "b", 3),
        (9, "▁ \U0001F600 naïve 日本語\x00 end", "fr", "c", 5),
        (10, "short.\nshort.\n\nshort.", "en", "c", 20),
    ]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    """The rows with extra columns whose names clash with the operators' own."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(odd_rows, DOCS)
    return df.select("*", *[F.lit(f"own {c}").alias(c) for c in CLASHES])


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")
