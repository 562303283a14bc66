"""Evaluation from joint counts: one small aggregate, then arithmetic per class."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.sources.lookups import literal_table


def joint_counts(df: DataFrame, true: str, pred: str) -> DataFrame:
    return df.groupBy(F.col(true).alias("true"), F.col(pred).alias("pred")).agg(F.count("*").alias("n"))


def class_report(df: DataFrame, true: str, pred: str) -> DataFrame:
    """ML-08: precision, recall, F1 and support per class that occurs on either side.

    A class never predicted, or never true, scores 0.
    """
    zero = F.lit(0).cast("bigint")
    hit = F.when(F.col("true") == F.col("pred"), F.col("n")).otherwise(zero)

    def side(label: str, support: Column, hits: Column, predicted: Column) -> Column:
        return F.struct(F.col(label).alias("label"), support.alias("support"), hits.alias("hits"),
                        predicted.alias("predicted"))

    sides = F.array(side("true", F.col("n"), hit, zero), side("pred", zero, zero, F.col("n")))
    per_class = joint_counts(df, true, pred).select(F.inline(sides)).groupBy("label").agg(
        *[F.sum(c).alias(c) for c in ("support", "hits", "predicted")]
    )
    ratio = lambda a, b: F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))
    hits, support, predicted = F.col("hits"), F.col("support"), F.col("predicted")
    return per_class.select(
        "label",
        ratio(hits, predicted).alias("precision"),
        ratio(hits, support).alias("recall"),
        ratio(2 * hits, support + predicted).alias("f1"),
        "support",
    )


def full_report(df: DataFrame, true: str, pred: str, digits: int = 6) -> DataFrame:
    """Class report with macro and support-weighted averages, in one pass.

    Each class counts for its own row and, with its weight, for both averages.
    """
    def row(place: int, name: Column, weight: Column) -> Column:
        return F.struct(F.lit(place).alias("place"), name.alias("name"), weight.alias("weight"))

    one = F.lit(1).cast("bigint")
    rows = F.array(
        row(0, F.col("label"), one),
        row(1, F.lit("macro avg"), one),
        row(2, F.lit("weighted avg"), F.col("support")),
    )
    spread = class_report(df, true, pred).select("precision", "recall", "f1", "support", F.inline(rows))
    average = lambda c: F.try_divide(F.sum(F.col(c) * F.col("weight")), F.sum("weight"))
    return spread.groupBy("place", F.col("name").alias("label")).agg(
        *[F.round(average(c), digits).alias(c) for c in ("precision", "recall", "f1")],
        F.sum("support").alias("support"),
    ).orderBy("place", "label").drop("place")


def evaluate(df: DataFrame, true: str, pred: str, digits: int = 4) -> DataFrame:
    """ML-07: accuracy and macro F1 in one row."""
    report = class_report(df, true, pred)
    hits = F.col("recall") * F.col("support")
    return report.agg(
        F.round(F.try_divide(F.sum(hits), F.sum("support")), digits).alias("accuracy"),
        F.round(F.avg("f1"), digits).alias("macro_f1"),
        F.sum("support").alias("n"),
    )


def confusion(df: DataFrame, true: str, pred: str, labels: list[str]) -> DataFrame:
    """ML-09: counts of predicted labels (columns) per true label (rows), zeros kept."""
    counts = joint_counts(df, true, pred).groupBy(F.col("true").alias("true_label"))
    wide = counts.pivot("pred", labels).agg(F.sum("n"))
    rows = literal_table(df.sparkSession, ["true_label", "_place"], [(x, i) for i, x in enumerate(labels)])
    full = rows.join(wide, "true_label", "left").na.fill(0, subset=labels)
    return full.orderBy("_place").drop("_place")


def class_distribution(df: DataFrame, label: str) -> DataFrame:
    """ML-10: class sizes in train and validation."""
    size = lambda split: F.count_if(F.col("split") == split)
    return df.groupBy(label).agg(size("train").alias("n_train"), size("validation").alias("n_validation"))
