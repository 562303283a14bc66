"""Equi-joins.  Spark picks the strategy; lookups are broadcast as tables of known size."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LOOKUP_ROWS, LOOKUP_BYTES = 100_000, 64 << 20


def checked_broadcast(df: DataFrame, max_rows: int = LOOKUP_ROWS, max_bytes: int = LOOKUP_BYTES) -> DataFrame:
    """Broadcast a narrow side of at most ``max_rows`` rows and ``max_bytes`` bytes,
    else leave the join to Spark.

    What the check reads becomes the side itself, a literal table: the plan of
    ``df`` runs once, for the check and the join together.
    """
    rows = df.limit(max_rows + 1).toArrow()
    if rows.num_rows > max_rows or rows.nbytes > max_bytes:
        return df
    return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema))


def keep_known(df: DataFrame, known: DataFrame, key: str = "key") -> DataFrame:
    """Rows whose key is in ``known``, a table with one row per key.

    No broadcast hint: the set of kept keys grows with the data.  Adaptive
    execution broadcasts it when small and splits hot keys when not.
    """
    return df.join(known.select(key), key, "left_semi")


def keep_new(df: DataFrame, done: DataFrame, key: str = "key") -> DataFrame:
    """Rows whose key is not in ``done`` (resume)."""
    return df.join(done.select(key).distinct(), key, "left_anti")


def map_label(df: DataFrame, lookup: DataFrame, raw: str, label: str,
              default: str | None = None) -> DataFrame:
    """Add ``label`` from a lookup table ``(raw, label)``; unknown gives the default.

    Literal tables and seed files have a size Spark knows: it broadcasts them
    below its own threshold without a hint.
    """
    small = lookup.select(raw, label)
    joined = df.join(small, raw, "left")
    if default is None:
        return joined
    return joined.withColumn(label, F.coalesce(F.col(label), F.lit(default)))


def wide_join(base: DataFrame, sides: list[DataFrame], key: str = "key") -> DataFrame:
    """Left joins of feature tables, each with one row per key."""
    return reduce(lambda left, right: left.join(right, key, "left"), sides, base)


def full_align(series: list[DataFrame], key: str) -> DataFrame:
    """Chained full joins on a coalesced key; NULL keys stay separate rows."""
    return reduce(lambda left, right: left.join(right, key, "full"), series)


def enrich_parent(df: DataFrame, parents: DataFrame, key: str = "key") -> DataFrame:
    """Add ``has_parent`` (0 or 1); a missing key or a failed lookup counts as 0."""
    return df.join(parents.select(key, "has_parent"), key, "left").withColumn(
        "has_parent", clip_flag(F.col("has_parent"))
    )


def clip_flag(value: Column) -> Column:
    return F.greatest(F.least(F.coalesce(value, F.lit(0)), F.lit(1)), F.lit(0)).cast("int")
