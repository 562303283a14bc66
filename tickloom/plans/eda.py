"""Exploratory aggregates over the issue-grain mart."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.functions import fixed_values as fv
from tickloom.functions.numbers import pct
from tickloom.operators.aggregates import counted, mean_of_counts, median
from tickloom.operators.filters import in_years
from tickloom.operators.ordering import order_by_list
from tickloom.operators.windows import share_of_sum


def dist(ops: DataFrame, column: str) -> DataFrame:
    """EDA-01, EDA-02: tickets per value with their share, largest first."""
    counts = ops.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    return counts.withColumn("pct", share_of_sum(F.col("n"))).orderBy(F.desc("n"), column)


def dist_ordered(ops: DataFrame, column: str, order: list[str]) -> DataFrame:
    """EDA-03: the same in a domain order, other values last."""
    return order_by_list(dist(ops, column), column, order)


def overview(ops: DataFrame, first: int = 2010, last: int = 2025) -> DataFrame:
    """Totals and the range of plausible creation years, in one pass."""
    year = F.when(in_years(F.col("created_at"), first, last), F.year("created_at"))
    return ops.agg(
        F.count("*").alias("total"),
        F.count_if(F.col("is_resolved") == 1).alias("resolved"),
        F.min(year).alias("first_year"),
        F.max(year).alias("last_year"),
    )


def yearly(ops: DataFrame, first: int = 2010, last: int = 2025) -> DataFrame:
    """EDA-04: creations per year."""
    return (
        ops.filter(in_years(F.col("created_at"), first, last))
        .groupBy(F.year("created_at").alias("year"))
        .agg(F.count("*").alias("n")).orderBy("year")
    )


def monthly_summary(ops: DataFrame, lengths: DataFrame) -> DataFrame:
    """EDA-05: month by type.  ``lengths`` has one row per key with the text lengths.

    Percentages refer to the tickets with a resolution.
    """
    days = F.when(F.col("is_resolved") == 1, F.col("resolution_days"))
    joined = ops.join(lengths.select("key", "summary_length", "description_length"), "key", "left")
    # Resolutions are few and durations whole days below a limit.
    sums = {n: [F.sum(n).alias(f"{n}_sum"), F.count(n).alias(f"{n}_n")] for n in ("summary_length", "description_length", "n_comments")}
    each = counted(
        joined.withColumn("month", F.to_date("created_month")), ["month", "issuetype"],
        [F.col("resolution"), days.alias("days")], *[a for pair in sums.values() for a in pair])
    total = lambda condition: F.sum(F.when(condition, F.col("times")).otherwise(0))
    resolved = total(F.col("resolution").isNotNull())
    share = lambda name: pct(total(F.col("resolution") == name), resolved)
    average = lambda n, digits=1: F.round(
        F.try_divide(F.sum(f"{n}_sum").cast("double"), F.sum(f"{n}_n").cast("double")), digits)
    return each.groupBy("month", "issuetype").agg(
        F.sum("times").alias("total_issues"),
        resolved.alias("total_resolved"),
        median(F.col("days")).alias("median_resolution_days"),
        mean_of_counts(F.col("days")).alias("avg_resolution_days"),
        share("Fixed").alias("pct_fixed"),
        share("Won't Fix").alias("pct_wontfix"),
        share("Duplicate").alias("pct_duplicate"),
        share("Cannot Reproduce").alias("pct_cannot_reproduce"),
        average("summary_length").alias("avg_summary_length"),
        average("description_length").alias("avg_description_length"),
        average("n_comments", 2).alias("avg_n_comments"),
    )
