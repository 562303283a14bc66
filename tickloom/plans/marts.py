"""Gold tables: the feature mart and the dashboard marts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions import dates, text
from tickloom.functions.numbers import pct, zero_if_null
from tickloom.operators.aggregates import counted, mean_of_counts, median
from tickloom.operators.filters import in_splits
from tickloom.operators.joins import wide_join
from tickloom.operators.windows import cumulative, rolling_avg, share_of_max


def mart_ml(cleaned: DataFrame, comments: DataFrame, changes: DataFrame, links: DataFrame,
            parents: DataFrame) -> DataFrame:
    """M-13: one wide row per issue of the train and validation splits.

    Every side has one row per key, so the joins share one partitioning.
    """
    base = in_splits(cleaned, ["train", "validation"])
    sides = [comments, changes, links, parents.select("key", "parent_key", "has_parent")]
    wide = wide_join(base, sides)
    c = F.col
    zero = lambda name: zero_if_null(c(name)).alias(name)
    return wide.select(
        "key", "created_at", "split", "issuetype", "resolution",
        c("summary").alias("summary_clean"),
        c("description").alias("description_clean"),
        F.coalesce("all_comments", F.lit("")).alias("comments_concat"),
        text.text_for_it(c("summary"), c("priority"), c("description"), c("all_comments"),
                         c("n_comments"), c("n_container")).alias("text_for_it"),
        text.text_for_res(c("summary"), c("issuetype"), c("priority"), c("description"),
                          c("all_comments")).alias("text_for_res"),
        text.text_noco(c("summary"), c("issuetype"), c("priority"), c("description"))
        .alias("text_noco"),
        "priority", "status", "reporter", "assignee",
        zero("n_total_changes"), zero("n_status_changes"), zero("n_priority_changes"),
        zero("n_assignee_changes"), zero("n_resolution_changes"), zero("was_escalated"),
        zero("n_people_involved"), "first_assignee",
        zero("n_links_total"), zero("n_duplicates"), zero("n_blocks"), zero("n_blocked_by"),
        zero("n_relates"), zero("n_container"),
        zero("n_comments"), zero("n_commenters"),
        "resolution_days", "summary_length", "description_length",
        zero("has_parent"), "parent_key",
    )


def ops(issues: DataFrame, comments: DataFrame) -> DataFrame:
    """M-14: one row per issue with comment counts and hours to the first response."""
    response = comments.select("key", "n_comments", "n_commenters", "first_comment_at")
    return issues.join(response, "key", "left").select(
        "key", "issuetype", "priority", "status", "assignee", "reporter", "resolution",
        "created_at", "resolved_at", "resolution_days", "age_days", "is_resolved",
        "created_month", "created_year", "votes", "watches",
        zero_if_null(F.col("n_comments")).alias("n_comments"),
        zero_if_null(F.col("n_commenters")).alias("n_commenters"),
        "first_comment_at",
        dates.hour_diff(F.col("created_at"), F.col("first_comment_at")).alias("hours_to_first_response"),
    )


def workload(issues: DataFrame) -> DataFrame:
    """M-15: load per assignee, open tickets included."""
    named = issues.filter(F.col("assignee") != "Unassigned")
    # Durations are whole days below a limit and types are few: a bounded number of rows per assignee.
    each = counted(
        named, ["assignee"], [F.col("issuetype"), F.col("is_resolved"), F.col("resolution_days")],
        F.min("created_at").alias("first_assignment"), F.max("created_at").alias("last_assignment"))
    of_type = Window.partitionBy("assignee", "issuetype")
    each = each.withColumn("of_type", F.sum("times").over(of_type))
    days = F.when(F.col("is_resolved") == 1, F.col("resolution_days"))
    total, resolved = F.sum("times"), F.sum(F.col("is_resolved") * F.col("times"))
    kind = lambda name: F.sum(F.when(F.col("issuetype") == name, F.col("times")).otherwise(0))
    return each.groupBy("assignee").agg(
        total.alias("n_assigned"),
        resolved.alias("n_fixed"),
        (total - resolved).alias("n_open_backlog"),
        mean_of_counts(days).alias("avg_resolution_days"),
        median(days).alias("median_resolution_days"),
        pct(resolved, total).alias("resolution_rate_pct"),
        kind("Bug").alias("n_bugs"),
        kind("Improvement").alias("n_improvements"),
        kind("New Feature").alias("n_new_features"),
        F.min_by("issuetype", F.struct(-F.col("of_type"), F.col("issuetype"))).alias("top_issuetype"),
        F.count_distinct("issuetype").alias("n_distinct_issuetypes"),
        F.min("first_assignment").alias("first_assignment"),
        F.max("last_assignment").alias("last_assignment"),
    )


def links(features: DataFrame) -> DataFrame:
    """M-16: link metrics of issues with links."""
    return features.filter(F.col("n_links_total") > 0).select(
        "key", "n_links_total", "n_duplicates", "n_blocks", "n_blocked_by", "n_relates",
        (F.col("n_duplicates") + F.col("n_blocks") + F.col("n_blocked_by"))
        .alias("n_outgoing_plus_incoming"),
    )


def transitions_sankey(transitions: DataFrame) -> DataFrame:
    """M-17: flow between each pair of states."""
    hours = F.col("hours_in_from_status")
    each = counted(transitions, ["from_status", "to_status"], [hours], F.sum("is_reopen_event").alias("is_reopen_event"))
    return each.groupBy("from_status", "to_status").agg(
        F.sum("times").alias("n_transitions"),
        mean_of_counts(hours).alias("avg_hours_before_transition"),
        median(hours).alias("median_hours_before_transition"),
        F.sum("is_reopen_event").alias("n_reopen_events"),
    ).orderBy(F.desc("n_transitions"), "from_status", "to_status")


def transitions_time(transitions: DataFrame) -> DataFrame:
    """M-18: time spent in each state."""
    hours = F.col("hours_in_from_status")
    each = counted(transitions.filter(hours.isNotNull()), ["from_status"], [hours])
    per_state = each.groupBy(F.col("from_status").alias("status")).agg(
        F.sum("times").alias("n_exits"),
        mean_of_counts(hours).alias("avg_hours"),
        median(hours).alias("median_hours"),
        mean_of_counts(hours, scale=24).alias("avg_days"),
        median(hours, scale=24).alias("median_days"),
    )
    label = text.duration_label(F.col("status"), F.col("avg_days"))
    return per_state.withColumn("status_label", label).orderBy(F.desc("avg_hours"), "status")


def versions(assigned: DataFrame) -> DataFrame:
    """M-19: metrics per version and type.

    An issue has one type, one state and one duration, so a first aggregate
    per issue turns the distinct counts into plain ones and keeps how often
    the issue counts in mean and median.
    """
    group = ["version_major", "version_minor", "issuetype"]
    per_issue = (
        assigned.filter(F.col("version_major") != "Other")
        .groupBy(*group, "key", "is_resolved", "resolution_days")
        .agg(F.count("*").alias("times"))
        .withColumn("days", F.when(F.col("is_resolved") == 1, F.col("resolution_days")))
    )
    issues = F.count("*")
    weight = F.sum(F.when(F.col("days").isNotNull(), F.col("times")))
    kind = lambda name: F.count_if(F.col("issuetype") == name)
    return per_issue.groupBy(*group).agg(
        issues.alias("n_issues"),
        kind("Bug").alias("n_bugs"),
        kind("Improvement").alias("n_improvements"),
        kind("New Feature").alias("n_new_features"),
        F.count_if(F.col("is_resolved") == 1).alias("n_resolved"),
        F.round(F.try_divide(F.sum(F.col("days") * F.col("times")).cast("double"), weight.cast("double")), 1)
        .alias("avg_resolution_days"),
        F.round(F.percentile("days", 0.5, F.col("times")), 1).alias("median_resolution_days"),
        pct(kind("Bug"), issues).alias("bug_ratio_pct"),
    ).orderBy(*[F.col(c).asc_nulls_last() for c in group])


def calendar(daily: DataFrame) -> DataFrame:
    """M-20: daily series with running backlog, 7-row means and intensity.

    The windows take the whole table in one task: it has one row per day.
    """
    activity = F.col("issues_created") + F.col("changelog_events")
    average = lambda name: rolling_avg(F.col(name), "activity_date", 7)
    return daily.select(
        "activity_date", "year", "week_of_year", "day_of_week",
        "issues_created", "bugs_created", "issues_resolved", "changelog_events",
        "active_issues", "active_contributors", "daily_backlog_delta",
        cumulative(F.col("daily_backlog_delta"), "activity_date").alias("cumulative_backlog"),
        average("issues_created").alias("issues_created_7d_avg"),
        average("issues_resolved").alias("issues_resolved_7d_avg"),
        average("active_contributors").alias("contributors_7d_avg"),
        share_of_max(activity).alias("activity_intensity"),
    ).orderBy(F.col("activity_date").asc_nulls_last())
