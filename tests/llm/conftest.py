import pytest
from pyspark.sql import types as T

SMALL = "/root/testdata/sf0.001"
#: documents with extra columns whose names clash with working columns
SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("n", T.LongType()),
    T.StructField("node", T.StringType()), T.StructField("_row", T.StringType()), T.StructField("x", T.DoubleType()),
    T.StructField("path", T.StringType()), T.StructField("label", T.StringType()), T.StructField("score", T.DoubleType())])


@pytest.fixture
def docs_of(spark):
    def make(rows):
        return spark.createDataFrame([(i, t, 1, "a", None, 0.5, "p", None, 1.0) for i, t in rows], SCHEMA)
    return make


@pytest.fixture
def odd(docs_of):
    """Null id, null text, empty and white-space texts, ties, a repeated row, a very long text."""
    base = " ".join(f"word{i}" for i in range(40))
    long_text = " ".join(f"token{i % 5000} x{i}" for i in range(150_000))
    return docs_of([(1, base), (2, base), (2, base), (None, base), (3, None), (4, ""), (5, " \n\t "), (None, None),
                    (6, "two words"), (7, "two words"), (8, long_text), (9, long_text + " end")])


@pytest.fixture
def small_docs(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")
