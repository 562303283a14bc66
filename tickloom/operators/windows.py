"""Ordered operators per group.  NULLs sort last; ties need tie-break columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.operators.skew import (
    PART, HeavyKeys, ascending, order_value, separate_hot, split_by_order,
)


def dedup(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Keep the first row per key.

    Spark cuts the groups to one row per key inside each map task before the
    shuffle, so a hot key costs no more than one row per map task.
    """
    w = Window.partitionBy(*keys).orderBy(*ascending(order))
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def first_n(df: DataFrame, keys: list[str], order: list[str], n: int) -> DataFrame:
    """Keep the first ``n`` rows per key, cut before the shuffle like :func:`dedup`."""
    w = Window.partitionBy(*keys).orderBy(*ascending(order))
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def lag_in_order(df: DataFrame, keys: list[str], order: list[str], columns: dict[str, str],
                 heavy: HeavyKeys | None = None) -> DataFrame:
    """Add the previous row's values: ``columns`` maps new name to source column.

    A hot group is cut into ranges; the last row of a range is sent to the next
    one too, where it comes first and is dropped again, so that all rows are
    shuffled once by range and no join follows.
    """
    cold, hot = separate_hot(df, keys, heavy)
    w = Window.partitionBy(*keys).orderBy(*ascending(order))
    result = cold.withColumns({new: F.lag(old).over(w) for new, old in columns.items()})
    if hot is None:
        return result

    parts = split_by_order(hot, keys, order)
    row_order = [*order, "_row"]
    last = F.struct(*[F.col(old).alias(f"_{new}") for new, old in columns.items()])
    tails = parts.groupBy(*keys, PART).agg(F.max_by(last, order_value(row_order)).alias("_tail"))
    # A row per range, sent on to the next one as the row before its first.
    after = Window.partitionBy(*keys).orderBy(PART)
    heads = tails.select(*keys, F.lead(PART).over(after).alias(PART), "_tail.*", F.lit(True).alias("_head")).filter(F.col(PART).isNotNull())
    own = parts.withColumns({**{f"_{new}": F.col(old) for new, old in columns.items()}, "_head": F.lit(False)})
    inside = Window.partitionBy(*keys, PART).orderBy(F.desc("_head"), *ascending(row_order))
    lagged = own.unionByName(heads, allowMissingColumns=True).withColumns(
        {new: F.lag(f"_{new}").over(inside) for new in columns})
    return result.unionByName(lagged.filter(~F.col("_head")).select(*df.columns, *columns))


def number_in_order(df: DataFrame, keys: list[str], order: list[str], name: str, heavy: HeavyKeys | None = None) -> DataFrame:
    """Add the row number within the group; hot groups are numbered by ranges."""
    cold, hot = separate_hot(df, keys, heavy)
    w = Window.partitionBy(*keys).orderBy(*ascending(order))
    result = cold.withColumn(name, F.row_number().over(w).cast("bigint"))
    if hot is None:
        return result

    parts = split_by_order(hot, keys, order)
    before = Window.partitionBy(*keys).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    # A row per range: how many rows of its group come before it.
    heads = (
        parts.groupBy(*keys, PART).agg(F.count("*").alias("_rows"))
        .select(*keys, PART, F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"), F.lit(True).alias("_head"))
    )
    inside = Window.partitionBy(*keys, PART).orderBy(F.desc("_head"), *ascending([*order, "_row"]))
    own = parts.withColumns({"_offset": F.lit(0).cast("bigint"), "_head": F.lit(False)})
    numbered = own.unionByName(heads, allowMissingColumns=True).withColumn(
        name, F.row_number().over(inside) - 1 + F.first("_offset").over(inside))
    return result.unionByName(numbered.filter(~F.col("_head")).select(*df.columns, name))


# --- windows over a whole table -------------------------------------------------
# They run in one task.  Use them only on a table with a bounded number of rows,
# such as one row per day or per label; never before that aggregation.

def cumulative(value: Column, order: str) -> Column:
    w = Window.orderBy(F.col(order).asc_nulls_last())
    return F.sum(value).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))


def rolling_avg(value: Column, order: str, rows: int, digits: int = 1) -> Column:
    """Mean over this row and the ``rows - 1`` before it (rows, not days)."""
    w = Window.orderBy(F.col(order).asc_nulls_last())
    return F.round(F.avg(value).over(w.rowsBetween(1 - rows, Window.currentRow)), digits)


def share_of_max(value: Column, digits: int = 1) -> Column:
    top = F.max(value).over(Window.partitionBy())
    return F.round(F.try_divide(F.lit(100.0) * value, top.cast("double")), digits)


def share_of_sum(value: Column, digits: int = 1) -> Column:
    total = F.sum(value).over(Window.partitionBy())
    return F.round(F.try_divide(F.lit(100.0) * value, total.cast("double")), digits)
