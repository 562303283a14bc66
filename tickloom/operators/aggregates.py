"""Group aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.operators.skew import ascending, order_value, separate_hot
from tickloom.operators.windows import first_n
from tickloom.functions.numbers import pct


def mean(value: Column, digits: int = 1, scale: int = 1) -> Column:
    """Rounded mean of whole numbers divided by ``scale``.

    One division only, so that rounding sees the correctly rounded quotient.
    """
    parts = F.count(value) * F.lit(scale)
    return F.round(F.try_divide(F.sum(value).cast("double"), parts.cast("double")), digits)


def counted(df: DataFrame, keys: list[str], values: list[Column], *more: Column) -> DataFrame:
    """One row per key and value with the number of rows ``times``: combined
    before the shuffle, so that what follows sees distinct values only."""
    return df.groupBy(*keys, *values).agg(F.count("*").alias("times"), *more)


def mean_of_counts(value: Column, digits: int = 1, scale: int = 1) -> Column:
    """:func:`mean` after :func:`counted`."""
    parts = F.sum(F.when(value.isNotNull(), F.col("times"))) * F.lit(scale)
    return F.round(F.try_divide(F.sum(value * F.col("times")).cast("double"), parts.cast("double")), digits)


def median(value: Column, digits: int = 1, scale: int = 1) -> Column:
    """Rounded exact median after :func:`counted`."""
    return F.round(F.percentile(value, 0.5, F.col("times")) / F.lit(float(scale)), digits)


def mode(df: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    """Most frequent value per group, the smallest one on a tie; a NULL does not count."""
    each = counted(df.filter(F.col(value).isNotNull()), keys, [F.col(value)])
    return each.groupBy(*keys).agg(F.min_by(value, F.struct(-F.col("times"), F.col(value))).alias(name))


def first_by(df: DataFrame, keys: list[str], order: list[str], column: str, name: str) -> DataFrame:
    """Value of the first row per key as an aggregate, combined before the shuffle."""
    return df.groupBy(*keys).agg(F.min_by(column, order_value(order)).alias(name))


def was_escalated(changes: DataFrame, key: str, rank: str, previous_rank: str) -> DataFrame:
    """1 when any change has a higher rank than the change before it."""
    rises = F.col(rank) > F.col(previous_rank)
    return changes.groupBy(key).agg(F.max(F.when(rises, 1).otherwise(0)).alias("was_escalated"))


def with_start(df: DataFrame, key: str, order: list[str], column: str, separator: str,
               limit: int) -> DataFrame:
    """Add ``_start``: where a text begins in the ordered concatenation of its group.

    A text is cut to ``limit`` before the shuffle: what follows it then begins
    behind the limit, just as it would behind the whole text.
    """
    df = df.withColumn(column, F.left(F.col(column), F.lit(limit)))
    w = Window.partitionBy(key).orderBy(*ascending(order)).rowsBetween(Window.unboundedPreceding, -1)
    before = F.sum(F.length(column) + len(separator)).over(w)
    return df.withColumn("_start", F.coalesce(before, F.lit(0)))


def joined_texts(column: str, separator: str, limit: int) -> Column:
    """Aggregate after :func:`with_start`: texts in order, cut to ``limit`` characters.

    NULLs do not count.  Only texts whose separator begins before the limit are
    collected: a bounded number of characters, however large the group.
    """
    shows = F.col(column).isNotNull() & (F.col("_start") < limit + len(separator))
    visible = F.when(shows, F.struct("_start", F.col(column).alias("text")))
    texts = F.transform(F.array_sort(F.collect_list(visible)), lambda x: x["text"])
    return F.left(F.array_join(texts, separator), F.lit(limit))


def visible_rows(separator: str, limit: int, min_length: int = 0) -> int:
    """How many rows of a group can show, when each takes ``min_length`` and a separator."""
    return -(-(limit + len(separator)) // (min_length + len(separator)))


def concat_in_order(df: DataFrame, key: str, order: list[str], column: str, name: str,
                    separator: str, limit: int, min_length: int = 0) -> DataFrame:
    """Concatenate texts in order, cut to ``limit`` characters.

    Only the first few texts of a group can show: in hot groups they are picked
    inside each map task, before the shuffle.
    """
    def build(rows: DataFrame) -> DataFrame:
        return with_start(rows, key, order, column, separator, limit).groupBy(key).agg(
            joined_texts(column, separator, limit).alias(name)
        )

    rows = df.select(key, *order, column).filter(F.col(column).isNotNull())
    cold, hot = separate_hot(rows, [key])
    if hot is None:
        return build(cold)
    visible = visible_rows(separator, limit, min_length)
    return build(cold).unionByName(build(first_n(hot, [key], order, visible)))


def flag_rate(df: DataFrame, by: str, flag: str, name: str, digits: int = 1) -> DataFrame:
    """Mean of a 0/1 flag per group as a percentage, highest first."""
    rate = pct(F.sum(F.coalesce(flag, F.lit(0))), F.count("*"), digits)
    return df.groupBy(by).agg(rate.alias(name)).orderBy(F.desc(name), by)


def prefix_rate(df: DataFrame, by: str, text: str, prefix: str, name: str, digits: int = 1) -> DataFrame:
    """Share of the texts of a group that begin with ``prefix``, as a percentage,
    highest first.  A NULL text begins with nothing and counts in the total."""
    return flag_rate(df.select(by, F.startswith(F.col(text), F.lit(prefix)).cast("int").alias("_begins")), by, "_begins", name, digits)


def profile(df: DataFrame) -> DataFrame:
    """Counts that show whether the feature table is complete, in one pass."""
    return df.agg(
        F.count("*").alias("total"),
        F.count_if(F.col("split") == "train").alias("train"),
        F.count_if(F.col("split") == "validation").alias("validation"),
        F.count_if(F.col("has_parent") == 1).alias("with_parent"),
        F.count_if((F.col("issuetype") == "Sub-task") & (F.col("has_parent") == 1))
        .alias("subtask_with_parent"),
    )


def distinct_keys(df: DataFrame, key: str = "key") -> DataFrame:
    return df.select(key).distinct().orderBy(key)
