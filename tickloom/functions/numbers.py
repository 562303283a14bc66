"""Number expressions in which NULL stays NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_number(text: Column) -> Column:
    """value decimal(38,0), rounded half up, and reason why a text has none.

    A NULL, empty or blank text has neither.
    """
    value = text.try_cast("decimal(38,0)")
    blank = F.trim(text) == ""
    reason = F.when(value.isNotNull() | blank | text.isNull(), F.lit(None).cast("string")).when(
        text.try_cast("double").isNull() | F.isnan(text.try_cast("double")), "not a number").otherwise("more than 38 digits")
    return F.struct(value.alias("value"), reason.alias("reason"))


def try_number(text: Column) -> Column:
    """Tolerant parse to a whole number of 64 bits: '1.6' gives 2, 'abc' gives
    NULL; :func:`parse_number` keeps larger ones and says what was lost."""
    return text.try_cast("decimal(38,0)").try_cast("bigint")


def cap(value: Column, limit: int) -> Column:
    """Upper bound.  Spark's ``least`` skips NULLs, so NULL is kept by hand."""
    return F.when(value.isNotNull(), F.least(value, F.lit(limit)))


def at_least(value: Column, floor: int) -> Column:
    return F.when(value.isNotNull(), F.greatest(value, F.lit(floor)))


def fill_clip(value: Column, upper: float) -> Column:
    return F.least(F.coalesce(value.cast("double"), F.lit(0.0)), F.lit(float(upper)))


def zero_if_null(value: Column) -> Column:
    return F.coalesce(value, F.lit(0))


def pct(part: Column, whole: Column, digits: int = 2) -> Column:
    """Percentage, NULL when the whole is zero.  One division, then one rounding."""
    return F.round(F.try_divide(F.lit(100.0) * part, whole.cast("double")), digits)


def flag(condition: Column) -> Column:
    return F.when(condition, 1).otherwise(0)
