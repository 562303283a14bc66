"""Small literal tables.  Built through Arrow they are local relations, whose
size Spark knows and broadcasts by itself."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tickloom.functions import fixed_values as fv


def literal_table(spark: SparkSession, columns: list[str], rows: list[tuple]) -> DataFrame:
    values = zip(*rows) if rows else [[] for _ in columns]
    return spark.createDataFrame(pa.table(dict(zip(columns, map(list, values)))))


def issuetype_map(spark: SparkSession) -> DataFrame:
    return literal_table(spark, ["issuetype_raw", "issuetype"], list(fv.ISSUETYPE_MAPPING.items()))


def resolution_map(spark: SparkSession) -> DataFrame:
    return literal_table(spark, ["resolution_raw", "resolution"], list(fv.RESOLUTION_MAPPING.items()))
