"""Row restrictions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def filter_ci(df: DataFrame, column: str, values: list[str], normalised: str | None = None) -> DataFrame:
    """Case-insensitive IN list.

    ``normalised`` names an upper-cased column written at landing; a filter on
    it reaches the Parquet scan, which ``upper(column)`` cannot.
    """
    wanted = [v.upper() for v in values]
    if normalised and normalised in df.columns:
        return df.filter(F.col(normalised).isin(wanted))
    return df.filter(F.upper(column).isin(wanted))


def with_min_length(df: DataFrame, name: str, value: Column, n: int) -> DataFrame:
    """Add a computed text and keep the rows where it has at least ``n`` characters.

    Works as a list of one or no element: Spark would push a filter below the
    computation and compute a costly text twice.
    """
    long_enough = F.filter(F.array(F.coalesce(value, F.lit(""))), lambda x: F.length(x) >= n)
    return df.withColumn(name, F.explode(long_enough))


def in_years(ts: Column, first: int, last: int) -> Column:
    return F.year(ts).between(first, last)


def in_splits(df: DataFrame, splits: list[str]) -> DataFrame:
    return df.filter(F.col("split").isin(splits))
