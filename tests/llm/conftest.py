import pytest
from pyspark.sql import functions as F


@pytest.fixture
def docs(spark):
    """Rows with nulls, empty and long texts, ties, repeated rows, and columns named like inner ones."""

    def make(rows, **more):
        frame = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
        for name in ("words", "size", "stratum", "bucket", "order", "node", "digest", "pos", "term", "n", "key", "block", "slot"):
            frame = frame.withColumn(name, F.lit(-1))
        return frame

    return make


@pytest.fixture
def odd_rows():
    long = " ".join(f"w{i % 997}x{i}" for i in range(30000))
    return [
        (1, "the cat sat on the mat and the cat sat on the mat", "a", "en"),
        (1, "the cat sat on the mat and the cat sat on the mat", "a", "en"),
        (2, None, "a", "en"),
        (3, "", None, None),
        (None, "a text without a key is a text all the same", "b", "en"),
        (4, long, "b", "en"),
        (5, " \t\n\x0b ", "c", "de"),
        (6, "ÄRGER über ÄRGER</s> <|endoftext|> \U0001f600 日本語", None, "de"),
        (7, "one two three", "c", None),
        (8, "x" * 50000, "b", "fr"),
    ]
