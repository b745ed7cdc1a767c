from __future__ import annotations


import pytest
from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)

LABELS = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("quality", T.IntegerType()), T.StructField("toxic", T.IntegerType())]
)


@pytest.fixture(scope="session")
def make(spark):
    """Documents from (doc_id, text, source) rows."""

    def build(rows):
        full = [(i, t, "en", s, None if t is None else len(t)) for i, t, s in rows]
        return spark.createDataFrame(full, DOCS)

    return build


@pytest.fixture(scope="session")
def odd():
    """Rows with NULLs, empty, blank and long texts, ties and repeats."""
    long = " ".join(f"wort{i % 977} größe{i % 31}" for i in range(30_000))
    return [
        (1, "one two three four five six seven", "a"),
        (1, "one two three four five six seven", "a"),
        (2, None, "a"),
        (3, "", None),
        (4, "  \n\t ", "b"),
        (None, "one two three four five six seven", None),
        (5, long, "b"),
        (6, "x" * 20_000, "c"),
        (7, "naïve 日本語 😀 <|endoftext|> it's\x00 ok\r\n\x0bend", "c"),
    ]
