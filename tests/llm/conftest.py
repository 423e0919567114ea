import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("text", T.StringType()),
    # Names that operators use themselves.
    T.StructField("n_words", T.StringType()),
    T.StructField("key", T.IntegerType()),
])


@pytest.fixture
def docs(spark):
    """Rows (doc_id, text) with extra columns of clashing names."""

    def make(rows):
        return spark.createDataFrame([(i, t, "x", 7) for i, t in rows], SCHEMA)

    return make


ODD = [(1, None), (2, ""), (3, " \t\n"), (None, "no id here"), (4, "one"), (4, "one"), (5, "a b " * 4000), (6, "x" * 300_000), (7, "ça  va\n\nbien▁ \U0001f600")]


@pytest.fixture
def odd(docs):
    """Nulls, empty and very long texts, repeated rows, a missing id."""
    return docs(ODD)
