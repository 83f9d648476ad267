import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("score", T.StringType()),
    T.StructField("group", T.LongType()), T.StructField("kept", T.StringType()), T.StructField("n", T.LongType()),
])


@pytest.fixture(scope="session")
def table(spark):
    """Documents with extra columns whose names clash with those the operators use."""

    def make(texts, ids=None):
        ids = range(len(texts)) if ids is None else ids
        return spark.createDataFrame([(i, t, "x", 7, None, 1) for i, t in zip(ids, texts)], SCHEMA)

    return make


ODD = [None, "", " ", "\n\n", "word", "a a a a", "b b b c b b b c", "Two words", "a b c d", "A B C D", "é ß 日本語 😀", "<|endoftext|>", "x" * 3000, "to be or " * 4000, "Two words", "\x01 \x00\x7f tab\there"]


@pytest.fixture(scope="session")
def odd(table):
    """Nulls, empty and very long texts, repeated rows, a null id."""
    return table([*ODD, "word", "word"], [*range(len(ODD)), 4, None])
