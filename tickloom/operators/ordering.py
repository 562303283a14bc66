"""Orders and top-k."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.functions.labels import list_position
from tickloom.operators.windows import first_n


def order_by_list(df: DataFrame, column: str, values: list[str]) -> DataFrame:
    """Domain order; values outside the list come last."""
    return df.orderBy(list_position(F.col(column), values), column)


def similar_refs(mart: DataFrame, issuetype: str, k: int = 3) -> DataFrame:
    """``k`` past tickets of one type, by key."""
    return (
        mart.filter(F.col("issuetype") == issuetype)
        .select("key", "summary_clean", "issuetype", "resolution",
                F.lit(0.0).alias("similarity"), F.lit("mart").alias("source"))
        .orderBy("key").limit(k)
    )


def similar_refs_per_type(mart: DataFrame, k: int = 3) -> DataFrame:
    """``k`` past tickets for each type, by key."""
    refs = mart.select("key", "summary_clean", "issuetype", "resolution")
    return first_n(refs, ["issuetype"], ["key"], k).withColumns(
        {"similarity": F.lit(0.0), "source": F.lit("mart")}
    )
