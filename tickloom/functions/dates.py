"""Date expressions with boundary-counting differences (session zone UTC)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tickloom.functions.numbers import cap


# Forms that dates come in: which texts have one, and the pattern that reads it.
FORMS = [
    (r"^[0-9]{8}$", "yyyyMMdd"),
    (r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}$", "M/d/yyyy"),
    (r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4} ", "M/d/yyyy H:mm[:ss]"),
    (r"^[0-9]{4}/[0-9]{1,2}/[0-9]{1,2}$", "yyyy/M/d"),
    (r"^[0-9]{4}/[0-9]{1,2}/[0-9]{1,2} ", "yyyy/M/d H:mm[:ss]"),
    (r"^[0-9]{1,2}-[A-Za-z]{3}-[0-9]{4}$", "d-MMM-yyyy"),
    (r"^[0-9]{1,2}-[A-Za-z]{3}-[0-9]{4} ", "d-MMM-yyyy H:mm[:ss]"),
    (r"^[0-9]{1,2} [A-Za-z]{3} [0-9]{4} .*[+-][0-9]{4}$", "d MMM yyyy H:mm[:ss] Z"),
]
WEEKDAY = "^(Mon|Tue|Wed|Thu|Fri|Sat|Sun), "
BARE_TIME = r"^[0-9]{1,2}:[0-9]{2}(:[0-9]{2})?"


def _without_weekday(plain: Column) -> Column:
    return F.when(plain.rlike(WEEKDAY), F.substring(plain, 6, 100)).otherwise(plain)


def _month_as_written(dated: Column) -> Column:
    """The name of the month as in Jan, whatever case it has behind the day and a hyphen or space."""
    day = F.regexp_extract(dated, "^[0-9]{1,2}[- ]", 0)
    return F.concat(day, F.initcap(F.substring(dated, F.length(day) + 1, F.length(dated))))


def parse_timestamp(text: Column) -> Column:
    """Tolerant parse: NULL when the text is not a dated timestamp.

    Forms: year first with hyphens (ISO, with or without time and zone); those in
    ``FORMS``, with English month names, a weekday before them is skipped; nine or ten
    digits of seconds and twelve or thirteen of milliseconds since 1970.  A bare
    time is NULL; Spark alone would read it as today.
    """
    plain = F.trim(text)
    # No other form is shorter than 8 characters, so blanks go no further.
    return F.when(F.substring(plain, 5, 1) == "-", F.try_to_timestamp(text)).when(
        F.length(plain) >= 8, F.transform(F.array(plain), _other_forms)[0])


def _other_forms(plain: Column) -> Column:
    """All forms that do not begin with the year and a hyphen.

    Written for the element of an array: as code of its own in every column that
    is parsed, the chain makes the code of a stage so long that the JVM leaves
    all of it uncompiled.
    """
    number = plain.try_cast("bigint")
    dated = _without_weekday(plain)
    found = F.when(plain.rlike("^[0-9]{9,10}$"), F.timestamp_seconds(number)).when(plain.rlike("^[0-9]{12,13}$"), F.timestamp_millis(number))
    for form, pattern in FORMS:
        found = found.when(dated.rlike(form), F.try_to_timestamp(_month_as_written(dated) if "MMM" in pattern else dated, F.lit(pattern)))
    return found


def parse_dated(text: Column) -> Column:
    """value, as by :func:`parse_timestamp`, and reason why a text has none.

    A NULL, empty or blank text has neither.
    """
    value, plain = parse_timestamp(text), F.trim(text)
    dated = _without_weekday(plain)
    known = plain.like("____-%") | plain.rlike("^([0-9]{8,10}|[0-9]{12,13})$")
    for form, _ in FORMS:
        known |= dated.rlike(form)
    reason = F.when(value.isNotNull() | (plain == "") | text.isNull(), F.lit(None).cast("string")).when(
        plain.rlike(BARE_TIME), "no date").when(known, "no such time").otherwise("unknown form")
    return F.struct(value.alias("value"), reason.alias("reason"))


def day_diff(start: Column, end: Column) -> Column:
    """Midnights between two instants."""
    return F.datediff(end, start)


def hour_diff(start: Column, end: Column) -> Column:
    """Full hours on the clock between two instants (10:59 to 11:01 is 1)."""
    seconds = F.unix_seconds(F.date_trunc("hour", end)) - F.unix_seconds(F.date_trunc("hour", start))
    return (seconds / 3600).cast("bigint")


def age_days(created: Column, resolved: Column, as_of: Column, limit: int) -> Column:
    return cap(day_diff(created, F.coalesce(resolved, as_of)), limit)


def day_of(ts: Column) -> Column:
    return F.to_date(ts)


def day_of_week(date: Column) -> Column:
    """0 is Sunday."""
    return F.dayofweek(date) - 1


def iso_week(date: Column) -> Column:
    return F.weekofyear(date)
