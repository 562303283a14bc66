"""Text embeddings as a table keyed by ticket."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline
from pyspark.ml.feature import IDF, HashingTF, Normalizer, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F, types as T

from tickloom.sources.tables import read_table, versions, write_table

Encoder = Callable[[list[str]], np.ndarray]


def embed(df: DataFrame, text: str, make_encoder: Callable[[], Encoder], key: str = "key",
          batch: int = 256) -> DataFrame:
    """ML-11: unit vectors from a caller's encoder, loaded once per task, in Arrow batches."""

    @F.pandas_udf("array<float>")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = make_encoder()
        for texts in batches:
            vectors = []
            for start in range(0, len(texts), batch):
                chunk = texts.iloc[start:start + batch].fillna("").tolist()
                raw = np.asarray(encoder(chunk), dtype="float64")
                norm = np.linalg.norm(raw, axis=1, keepdims=True)
                vectors.extend((raw / np.where(norm == 0, 1, norm)).astype("float32"))
            yield pd.Series(vectors, index=texts.index)

    return df.select(key, encode(F.col(text)).alias("embedding"))


def text_digest(text: Column) -> Column:
    """What a text is known by; NULL and the empty text are the same."""
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def merge_embeddings(known: DataFrame, df: DataFrame, text: str, make_encoder: Callable[[], Encoder],
                     key: str = "key") -> DataFrame:
    """ML-11: key, digest, embedding, encoded: one row per row of df.

    known (key, digest, embedding) is the table as it was.  A vector belongs to a
    text: one that is known under any key is taken over, a new or changed one is
    encoded, once for all rows that hold it (``encoded``).  Keys that have left df
    are not in the result.  Texts are combined by digest before the shuffle, so a
    text that many rows share travels as a row per task.
    """
    current = df.select(key, F.col(text).alias("_text"), text_digest(F.col(text)).alias("digest"))
    have = known.groupBy("digest").agg(F.first("embedding").alias("embedding"))
    new = current.groupBy("digest").agg(F.first("_text").alias("_text")).join(have.select("digest"), "digest", "left_anti")
    vectors = have.withColumn("encoded", F.lit(False)).unionByName(
        embed(new, "_text", make_encoder, "digest").withColumn("encoded", F.lit(True)))
    return current.select(key, "digest").join(vectors, "digest").select(key, "digest", "embedding", "encoded")


def update_embeddings(spark: SparkSession, path: str, df: DataFrame, text: str, make_encoder: Callable[[], Encoder],
                      key: str = "key") -> DataFrame:
    """Bring the embedding table in path up to date with df; its rows as written.

    Who reads the table meanwhile keeps the version before (see ``sources.tables``).
    """
    if versions(spark, path):
        known = read_table(spark, path).select(key, "digest", "embedding")
    else:
        known = spark.createDataFrame([], T.StructType([df.schema[key], T.StructField("digest", T.StringType()),
                                                        T.StructField("embedding", T.ArrayType(T.FloatType()))]))
    return write_table(merge_embeddings(known, df, text, make_encoder, key), path)


def embed_tfidf(df: DataFrame, text: str, key: str = "key", dim: int = 1024, as_vector: bool = False) -> DataFrame:
    """Default without a model: hashed word counts, inverse frequency, unit length.

    ``as_vector`` leaves the embedding a sparse vector: a text has far fewer words
    than there are dimensions, and the array holds them all.
    """
    words = df.select(key, F.coalesce(text, F.lit("")).alias("_text"))
    stages = [
        RegexTokenizer(inputCol="_text", outputCol="_words", pattern=r"(?U)\W+"),
        HashingTF(inputCol="_words", outputCol="_counts", numFeatures=dim),
        IDF(inputCol="_counts", outputCol="_weighted"),
        Normalizer(inputCol="_weighted", outputCol="_unit"),
    ]
    out = Pipeline(stages=stages).fit(words).transform(words)
    return out.select(key, (F.col("_unit") if as_vector else vector_to_array("_unit", "float32")).alias("embedding"))
