"""Label expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tickloom.functions import fixed_values as fv


def temporal_split(created: Column, train_before: str = fv.TRAIN_BEFORE,
                   validation_before: str = fv.VALIDATION_BEFORE) -> Column:
    """A NULL date is ``excluded``."""
    first = F.lit(train_before).cast("timestamp")
    second = F.lit(validation_before).cast("timestamp")
    return F.when(created < first, "train").when(created < second, "validation").otherwise("excluded")


def priority_rank(priority: Column) -> Column:
    """1 (lowest) to 5, NULL for anything else."""
    chain = F
    for rank, name in enumerate(fv.PRIORITIES_LOW_TO_HIGH, start=1):
        chain = chain.when(F.upper(priority) == name.upper(), rank)
    return chain


def is_reopen(from_status: Column, to_status: Column) -> Column:
    reopened = (F.upper(to_status) == "REOPENED") & F.upper(from_status).isin("RESOLVED", "CLOSED")
    return F.when(reopened, 1).otherwise(0)


def merge_rare(label: Column, rare: list[str]) -> Column:
    return F.when(label.isin(rare), "Other").otherwise(label)


def confidence_band(confidence: Column) -> Column:
    chain = F
    for lower, name in fv.CONFIDENCE_BANDS:
        chain = chain.when(confidence >= lower, name)
    return chain.when(confidence.isNotNull(), fv.CONFIDENCE_LOWEST)


def list_position(value: Column, ordered: list[str]) -> Column:
    """Position in a list from 0; values outside the list come after it."""
    place = F.array_position(F.array(*[F.lit(v) for v in ordered]), value)
    return F.when(F.coalesce(place, F.lit(0)) > 0, place - 1).otherwise(len(ordered)).cast("int")


def encode_label(label: Column, classes: list[str]) -> Column:
    """Index of the class in the fixed order, NULL when it is not a class."""
    place = F.array_position(F.array(*[F.lit(v) for v in classes]), label)
    return F.when(place > 0, place - 1).cast("int")


def decode_label(index: Column, classes: list[str]) -> Column:
    return F.get(F.array(*[F.lit(v) for v in classes]), index)
