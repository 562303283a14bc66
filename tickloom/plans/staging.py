"""Staging: raw all-string tables to typed, restricted tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.functions import fixed_values as fv
from tickloom.functions.dates import parse_timestamp
from tickloom.functions.numbers import try_number
from tickloom.functions.text import blank_to
from tickloom.operators.filters import filter_ci
from tickloom.operators.joins import keep_known
from tickloom.operators.windows import dedup


def kept_keys(raw_issues: DataFrame, project: str) -> DataFrame:
    """Keys of the project's issues.

    Cheaper than the deduplicated table: one column at the scan.  Copies of an
    issue are combined before the shuffle, however many there are.
    """
    return raw_issues.filter(F.col("project_key") == project).select("key").distinct()


def stg_issues(raw_issues: DataFrame, project: str) -> DataFrame:
    """M-01: one typed row per issue of the project.

    The copy with the smallest id (as text) wins.  Ties are broken by narrow
    columns only: a text in the order would be read and shuffled by every job.
    """
    own = raw_issues.filter(F.col("project_key") == project)
    first = dedup(own, ["key"], ["id", "created", "resolutiondate", "status_name"])
    return first.select(
        F.col("id").alias("issue_id"),
        "key",
        "summary",
        "description",
        parse_timestamp(F.col("created")).alias("created_at"),
        parse_timestamp(F.col("resolutiondate")).alias("resolved_at"),
        F.col("issuetype_name").alias("issuetype_raw"),
        F.col("resolution_name").alias("resolution_raw"),
        F.col("priority_name").alias("priority"),
        F.col("status_name").alias("status"),
        F.col("project_key").alias("project"),
        blank_to(F.col("assignee"), "Unassigned").alias("assignee"),
        "reporter",
        "creator",
        try_number(F.col("votes_votes")).alias("votes"),
        try_number(F.col("watches_watchcount")).alias("watches"),
    )


def stg_comments(raw_comments: DataFrame, known: DataFrame) -> DataFrame:
    """M-02: comments of kept issues."""
    return keep_known(raw_comments, known).select(
        "key", "comment_id", "comment_author", "comment_body",
        parse_timestamp(F.col("comment_created")).alias("comment_created"),
        parse_timestamp(F.col("comment_updated")).alias("comment_updated"),
    )


def stg_changelog(raw_changelog: DataFrame, known: DataFrame) -> DataFrame:
    """M-03: changes of kept issues in the fields of interest."""
    useful = filter_ci(raw_changelog, "field", fv.CHANGELOG_FIELDS, normalised="field_norm")
    return keep_known(useful, known).select(
        "key", "author",
        parse_timestamp(F.col("created")).alias("created"),
        "field",
        F.col("fromstring").alias("from_string"),
        F.col("tostring").alias("to_string"),
    )


def stg_issuelinks(raw_links: DataFrame, known: DataFrame) -> DataFrame:
    """M-04: links of kept issues."""
    return keep_known(raw_links, known).select("key", "type_name", "inwardissue_key", "outwardissue_key")
