"""Text expressions: every function takes and returns columns, no UDF."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tickloom.functions import fixed_values as fv


def clean_text(text: Column) -> Column:
    """Ticket text cleaner; NULL becomes ''.

    A code block keeps its first 200 characters.  When a second block follows
    a short one, the greedy 200 characters run over the closing tag, exactly
    as the stated pattern says.
    """
    given = F.coalesce(text, F.lit(""))
    cleaned = given
    for pattern, replacement in fv.CLEANING_STEPS:
        cleaned = F.regexp_replace(cleaned, pattern, replacement)
    # A text in which no step can begin is done after one search, not six.
    return F.trim(F.when(given.rlike(fv.CLEANING_BEGINS), cleaned).otherwise(given))


def blank_to(text: Column, default: str) -> Column:
    return F.coalesce(F.nullif(F.trim(text), F.lit("")), F.lit(default))


def not_blank(text: Column) -> Column:
    return text.isNotNull() & (F.trim(text) != "")


def raw_length(text: Column) -> Column:
    return F.length(F.coalesce(text, F.lit("")))


def min_len(text: Column, n: int) -> Column:
    return raw_length(text) >= n


def upper_is(text: Column, value: str) -> Column:
    return F.upper(text) == value


def contains_any(text: Column, words: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [text.contains(word) for word in words])


def first_match(text: Column, rules: list[tuple[list[str], str]], default: str) -> Column:
    """Value of the first rule with a word that occurs in ``text``."""
    chain = F
    for words, value in rules:
        chain = chain.when(contains_any(text, words), F.lit(value))
    return chain.otherwise(F.lit(default))


# --- versions -------------------------------------------------------------------

def version_minor(version: Column) -> Column:
    return F.regexp_substr(version, F.lit(r"^[0-9]+\.[0-9]+"))


def version_major(version: Column) -> Column:
    chain = F
    for branch in fv.VERSION_BRANCHES:
        chain = chain.when(version.like(branch[:-1] + "%"), F.lit(branch))
    return chain.otherwise(F.lit("Other"))


def is_release_candidate(version: Column) -> Column:
    return F.when(version.ilike("%-rc%"), 1).otherwise(0)


# --- assembled model texts ----------------------------------------------------------

def _or_blank(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def text_for_it(summary: Column, priority: Column, description: Column, comments: Column,
                n_comments: Column, n_container: Column, limit: int = 2000) -> Column:
    """Text for predicting the type: structure flags, then content, no type."""
    body = _or_blank(description)
    size = F.length(body)
    flags = [
        F.when(size == 0, "[NO-DESCRIPTION] ").otherwise(""),
        F.when(size.between(1, 79), "[SHORT-DESC] ").otherwise(""),
        F.when(F.coalesce(n_comments, F.lit(0)) == 0, "[NO-COMMENTS] ").otherwise(""),
        F.when(F.coalesce(n_container, F.lit(0)) > 0, "[CONTAINER-LINK] ").otherwise(""),
    ]
    padded = F.when(
        size < 50, F.concat(body, F.lit(" "), F.left(_or_blank(comments), F.lit(600)))
    ).otherwise(body)
    content = F.concat(
        *flags,
        F.lit("TICKET: "), _or_blank(summary), F.lit("\n"),
        F.lit("PRI: "), _or_blank(priority), F.lit("\n"),
        F.lit("DESC: "), padded,
    )
    return F.left(content, F.lit(limit))


def _typed_head(summary: Column, issuetype: Column, priority: Column, description: Column) -> Column:
    return F.concat(
        F.lit("TICKET: "), _or_blank(summary), F.lit("\n"),
        F.lit("TYPE: "), _or_blank(issuetype), F.lit(" | PRI: "), _or_blank(priority), F.lit("\n"),
        F.lit("DESC: "), F.left(_or_blank(description), F.lit(800)),
    )


def text_for_res(summary: Column, issuetype: Column, priority: Column, description: Column,
                 comments: Column, limit: int = 2000) -> Column:
    """Text for predicting the resolution: type known, some comments."""
    head = _typed_head(summary, issuetype, priority, description)
    return F.left(
        F.concat(head, F.lit("\nCOMMENTS: "), F.left(_or_blank(comments), F.lit(400))),
        F.lit(limit),
    )


def text_noco(summary: Column, issuetype: Column, priority: Column, description: Column,
              limit: int = 2000) -> Column:
    return F.left(_typed_head(summary, issuetype, priority, description), F.lit(limit))


def signal_text(text: Column, summary: Column, has_parent: Column, limit: int = 512) -> Column:
    """Parent flag and keyword signal in front of a model text.

    An empty text falls back to the summary.
    """
    content = F.coalesce(F.nullif(text, F.lit("")), summary, F.lit(""))
    parent = F.when(has_parent == 1, "[HAS-PARENT] ").otherwise("[NO-PARENT] ")
    signal = first_match(F.lower(_or_blank(summary)), fv.SUMMARY_SIGNALS, "")
    return F.left(F.concat(parent, signal, content), F.lit(limit))


def duration_label(name: Column, days: Column) -> Column:
    label = F.format_string("%s (moy. %.1fj)", name, days)
    return F.when(name.isNotNull() & days.isNotNull(), label)
