import pytest
from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("source", T.StringType()),
    # Names that the operators use themselves.
    T.StructField("r", T.StringType()), T.StructField("found", T.LongType()), T.StructField("score", T.DoubleType())])


@pytest.fixture
def docs(spark):
    """docs(texts): a table with ids from 0, or docs([(id, text), ...])."""

    def make(texts, source="s"):
        rows = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
        return spark.createDataFrame([(i, t, source, "x", 1, 0.5) for i, t in rows], DOCS)

    return make


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}
