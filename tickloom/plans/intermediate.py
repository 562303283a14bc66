"""Intermediate tables: labels, texts, features and events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions import dates, fixed_values as fv
from tickloom.functions.labels import is_reopen, priority_rank, temporal_split
from tickloom.functions.numbers import at_least, cap, flag, zero_if_null
from tickloom.functions.text import (
    blank_to, clean_text, is_release_candidate, min_len, not_blank, raw_length, upper_is,
    version_major, version_minor,
)
from tickloom.operators.aggregates import first_by, joined_texts, visible_rows, was_escalated, with_start
from tickloom.operators.filters import filter_ci
from tickloom.operators.joins import keep_known, map_label, wide_join
from tickloom.operators.skew import HeavyKeys, order_value, separate_hot
from tickloom.operators.windows import first_n, lag_in_order

CHANGE_TIES = ["from_string", "to_string", "author"]


def _with_labels(issues: DataFrame, types: DataFrame, resolutions: DataFrame) -> DataFrame:
    labelled = map_label(issues, types, "issuetype_raw", "issuetype", default="Other")
    return map_label(labelled, resolutions, "resolution_raw", "resolution")


def issues_cleaned(issues: DataFrame, types: DataFrame, resolutions: DataFrame,
                   train_before: str = fv.TRAIN_BEFORE,
                   validation_before: str = fv.VALIDATION_BEFORE) -> DataFrame:
    """M-05: issues with a known resolution, cleaned texts and the time split."""
    known = _with_labels(issues, types, resolutions).filter(F.col("resolution").isNotNull())
    days = dates.day_diff(F.col("created_at"), F.col("resolved_at"))
    return known.select(
        "key", "issue_id", "created_at", "resolved_at", "priority", "status", "project",
        "assignee", "reporter", "creator", "votes", "watches", "issuetype_raw", "resolution_raw",
        "issuetype", "resolution",
        clean_text(F.col("summary")).alias("summary"),
        clean_text(F.col("description")).alias("description"),
        cap(zero_if_null(days), fv.MAX_DAYS).alias("resolution_days"),
        raw_length(F.col("summary")).alias("summary_length"),
        raw_length(F.col("description")).alias("description_length"),
        temporal_split(F.col("created_at"), train_before, validation_before).alias("split"),
    )


def issues_analytics(issues: DataFrame, types: DataFrame, resolutions: DataFrame,
                     as_of: str) -> DataFrame:
    """M-06: all issues, open ones too.  ``as_of`` stands for the current time."""
    created, resolved = F.col("created_at"), F.col("resolved_at")
    now = F.lit(as_of).cast("timestamp")
    return _with_labels(issues, types, resolutions).select(
        "key", "issue_id", "created_at", "resolved_at",
        blank_to(F.col("priority"), "Unknown").alias("priority"),
        "status", "project", "assignee", "reporter", "votes", "watches", "issuetype", "resolution",
        dates.age_days(created, resolved, now, fv.MAX_DAYS).alias("age_days"),
        cap(dates.day_diff(created, resolved), fv.MAX_DAYS).alias("resolution_days"),
        flag(resolved.isNotNull()).alias("is_resolved"),
        F.date_trunc("month", created).alias("created_month"),
        F.date_trunc("year", created).alias("created_year"),
    )


def clean_comments(comments: DataFrame) -> DataFrame:
    """Comments with cleaned bodies; a short one becomes NULL.

    The rows stay.  A filter on the cleaned text would be pushed below the
    restriction to kept issues and clean every text twice.
    """
    cleaned = comments.withColumn("comment_body", clean_text(F.col("comment_body")))
    long_enough = min_len(F.col("comment_body"), fv.MIN_COMMENT_LENGTH)
    return cleaned.withColumn("comment_body", F.when(long_enough, F.col("comment_body")))


def comments_agg(comments: DataFrame, known: DataFrame | None = None, heavy: HeavyKeys | None = None) -> DataFrame:
    """M-07: one row per issue with the first 3000 characters of its discussion.

    Texts and counts come from one pass and one shuffle.  A hot issue takes a
    second way: its counts are combined before the shuffle, and so is the
    choice of the first comments.  ``heavy`` is the sketch of the landed comments,
    weighed with their bodies.  Pass ``known`` unless the comments are
    restricted to kept issues already.
    """
    order = ["comment_created", "comment_id", "comment_body"]
    text = joined_texts("comment_body", fv.COMMENT_SEPARATOR, fv.COMMENT_LIMIT).alias("all_comments")
    kept = lambda name: F.when(F.col("comment_body").isNotNull(), F.col(name))
    counts = [
        F.count("comment_body").alias("n_comments"),
        F.count_distinct(kept("comment_author")).alias("n_commenters"),
        F.min(kept("comment_created")).alias("first_comment_at"),
        F.max(kept("comment_created")).alias("last_comment_at"),
    ]
    started = lambda df: with_start(
        df, "key", order, "comment_body", fv.COMMENT_SEPARATOR, fv.COMMENT_LIMIT
    )

    cold, hot = separate_hot(comments, ["key"], heavy)
    result = started(clean_comments(cold)).groupBy("key").agg(text, *counts)
    if hot is not None:
        cleaned = clean_comments(hot)
        visible = visible_rows(fv.COMMENT_SEPARATOR, fv.COMMENT_LIMIT, fv.MIN_COMMENT_LENGTH)
        texts = started(first_n(cleaned.filter("comment_body IS NOT NULL"), ["key"], order, visible))
        texts = texts.groupBy("key").agg(text)
        result = result.unionByName(texts.join(cleaned.groupBy("key").agg(*counts), "key"))
    result = result.filter(F.col("n_comments") > 0)
    return result if known is None else keep_known(result, known)


def changelog_features(changes: DataFrame, cleaned: DataFrame, heavy: HeavyKeys | None = None) -> DataFrame:
    """M-08: counts, people, escalation and first assignee per cleaned issue.

    Aggregates first: the semi-join then sees one row per issue.  The changes
    are read twice, for the aggregate and for the ordered priority changes.
    """
    field = lambda name: F.count_if(upper_is(F.col("field"), name))
    counts = changes.groupBy("key").agg(
        F.count("*").alias("n_total_changes"),
        field("STATUS").alias("n_status_changes"),
        field("PRIORITY").alias("n_priority_changes"),
        field("ASSIGNEE").alias("n_assignee_changes"),
        field("RESOLUTION").alias("n_resolution_changes"),
        F.count_distinct("author").alias("n_people_involved"),
        F.min_by(F.when(_given(), F.col("to_string")), F.when(_given(), order_value(ASSIGNED_ORDER))).alias("first_assignee"),
    )
    features = wide_join(keep_known(counts, cleaned), [escalation(changes, heavy)])
    return features.select(
        *[n for n in counts.columns if n != "first_assignee"],
        zero_if_null(F.col("was_escalated")).alias("was_escalated"), "first_assignee",
    )


ASSIGNED_ORDER = ["created", "to_string"]


def _given() -> Column:
    """Does a change give the issue to somebody?"""
    return upper_is(F.col("field"), "ASSIGNEE") & F.col("to_string").isNotNull()


def escalation(changes: DataFrame, heavy: HeavyKeys | None = None) -> DataFrame:
    """WIN-03: did the target priority rise from one change to the next?

    Compares consecutive targets, so a single change from Minor to Major is 0.
    """
    ranked = filter_ci(changes, "field", ["PRIORITY"]).select(
        "key", "created", *CHANGE_TIES, priority_rank(F.col("to_string")).alias("rank")
    )
    chained = lag_in_order(ranked, ["key"], ["created", *CHANGE_TIES], {"previous_rank": "rank"}, heavy)
    return was_escalated(chained, "key", "rank", "previous_rank")


def first_assignee(changes: DataFrame) -> DataFrame:
    """WIN-04: the first assignee by time."""
    given = filter_ci(changes, "field", ["ASSIGNEE"]).filter(F.col("to_string").isNotNull())
    return first_by(given, ["key"], ASSIGNED_ORDER, "to_string", "first_assignee")


def issuelinks_features(links: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """M-09: link counts by type per issue."""
    link = lambda name: F.count_if(upper_is(F.col("type_name"), name))
    counts = links.groupBy("key").agg(
        F.count("*").alias("n_links_total"),
        link("DUPLICATE").alias("n_duplicates"),
        link("BLOCKER").alias("n_blocks"),
        link("BLOCKED").alias("n_blocked_by"),
        link("REFERENCE").alias("n_relates"),
        link("CLONERS").alias("n_clones"),
        link("CONTAINER").alias("n_container"),
    )
    return counts if known is None else keep_known(counts, known)


def status_transitions(changes: DataFrame, heavy: HeavyKeys | None = None) -> DataFrame:
    """M-10: one row per status change with the hours spent in the state before."""
    moves = filter_ci(changes, "field", ["STATUS"]).filter(F.col("to_string").isNotNull())
    chained = lag_in_order(moves, ["key"], ["created", *CHANGE_TIES], {"previous": "created"}, heavy)
    from_status = blank_to(F.col("from_string"), "Open")
    hours = dates.hour_diff(F.col("previous"), F.col("created"))
    return chained.select(
        "key",
        from_status.alias("from_status"),
        F.col("to_string").alias("to_status"),
        F.col("created").alias("transition_at"),
        at_least(hours, 0).alias("hours_in_from_status"),
        is_reopen(from_status, F.col("to_string")).alias("is_reopen_event"),
    )


def daily_activity(issues: DataFrame, changes: DataFrame) -> DataFrame:
    """M-11: one row per day with creations, resolutions and changes.

    Issues are read once, as a creation and, where there is one, a resolution.
    Changes are combined per day, issue and author first, so that the two
    distinct counts multiply those rows and not the events.  One aggregate over
    both takes the place of full joins; undated creations and undated changes
    stay two rows.
    """
    day = "activity_date"
    names = ["issues_created", "bugs_created", "issues_resolved", "changelog_events", "active_issues", "active_contributors"]
    event = lambda date, created, bug, resolved: F.struct(
        dates.day_of(date).alias(day), F.lit(created).alias("issues_created"), bug.alias("bugs_created"),
        F.lit(resolved).alias("issues_resolved"))
    creation = event(F.col("created_at"), 1, flag(F.col("issuetype") == "Bug"), 0)
    resolution = event(F.col("resolved_at"), 0, F.lit(0), 1)
    of_issues = issues.select(F.explode(
        F.when(F.col("resolved_at").isNull(), F.array(creation)).otherwise(F.array(creation, resolution))).alias("e")
    ).select("e.*").groupBy(day).agg(*[F.sum(n).alias(n) for n in names[:3]])
    changed = (
        changes.groupBy(dates.day_of(F.col("created")).alias(day), "key", "author")
        .agg(F.count("*").alias("events"))
        .groupBy(day)
        .agg(
            F.sum("events").alias("changelog_events"),
            F.count_distinct("key").alias("active_issues"),
            F.count_distinct("author").alias("active_contributors"),
        )
    )
    both = of_issues.withColumn("undated", flag(F.col(day).isNull())).unionByName(
        changed.withColumn("undated", 2 * flag(F.col(day).isNull())), allowMissingColumns=True)
    count = lambda name: F.col(name)
    return both.groupBy(day, "undated").agg(*[zero_if_null(F.sum(n)).alias(n) for n in names]).select(
        day,
        dates.day_of_week(F.col(day)).alias("day_of_week"),
        dates.iso_week(F.col(day)).alias("week_of_year"),
        F.year(day).alias("year"),
        count("issues_created"), count("bugs_created"), count("issues_resolved"),
        count("changelog_events"), count("active_issues"), count("active_contributors"),
        (F.col("issues_created") - F.col("issues_resolved")).alias("daily_backlog_delta"),
    )


def fix_versions(changes: DataFrame, issues: DataFrame) -> DataFrame:
    """M-12: version assignments with their branch and the issue's attributes."""
    version = F.col("to_string")
    assigned = filter_ci(changes, "field", fv.VERSION_FIELDS).filter(not_blank(version)).select(
        "key",
        version.alias("version_raw"),
        version_minor(version).alias("version_minor"),
        version_major(version).alias("version_major"),
        is_release_candidate(version).alias("is_rc"),
        F.col("created").alias("assigned_at"),
    )
    attributes = issues.select("key", "issuetype", "resolution", "priority", "resolution_days", "is_resolved")
    return assigned.join(attributes, "key")
