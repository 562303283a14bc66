"""Hand-made rows through the jobs."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tickloom.plans import intermediate as mid, marts, staging
from tickloom.sources import lookups

ISSUE = ("id key summary description created resolutiondate issuetype_name resolution_name resolution_description "
         "priority_name status_name project_key assignee reporter creator votes_votes watches_watchcount").split()


def issues(spark, *given):
    base = dict.fromkeys(ISSUE)
    base.update(project_key="P", created="2020-01-01T10:00:00.000+0000")
    data = [tuple({**base, **g}[c] for c in ISSUE) for g in given]
    return spark.createDataFrame(data, ", ".join(f"{c} string" for c in ISSUE))


def test_stg_issues_keeps_smallest_text_id(spark):
    raw = issues(spark,
                 dict(id="9", key="P-1", summary="nine"), dict(id="10", key="P-1", summary="ten"),
                 dict(id=None, key="P-1", summary="none"), dict(id="1", key="Q-1", project_key="Q"),
                 dict(id="2", key="P-2", assignee=" ", votes_votes="1.6", watches_watchcount="x"))
    got = staging.stg_issues(raw, "P").select("issue_id", "key", "summary", "assignee", "votes", "watches")
    assert rows(got, "key") == [("10", "P-1", "ten", "Unassigned", None, None), ("2", "P-2", None, "Unassigned", 2, None)]


def test_cleaned_and_analytics(spark):
    raw = issues(
        spark,
        dict(id="1", key="P-1", issuetype_name="Bug", resolution_name="Done", resolutiondate="2019-12-30", summary="a <b> c"),
        dict(id="2", key="P-2", issuetype_name="Legal", resolution_name="Auto Closed", resolutiondate="2040-01-01"),
        dict(id="3", key="P-3", issuetype_name=None, resolution_name="Fixed", created="bad", priority_name=" "),
    )
    stg = staging.stg_issues(raw, "P")
    types, resolutions = lookups.issuetype_map(spark), lookups.resolution_map(spark)
    cleaned = mid.issues_cleaned(stg, types, resolutions)
    assert rows(cleaned.select("key", "issuetype", "resolution", "summary", "resolution_days", "summary_length", "split"), "key") == [
        ("P-1", "Bug", "Fixed", "a c", -2, 7, "train"), ("P-3", "Other", "Fixed", "", 0, 0, "excluded")]
    analytics = mid.issues_analytics(stg, types, resolutions, "2021-01-01")
    assert rows(analytics.select("key", "issuetype", "resolution", "priority", "age_days", "resolution_days", "is_resolved"), "key") == [
        ("P-1", "Bug", "Fixed", "Unknown", -2, -2, 1),
        ("P-2", "Other", None, "Unknown", 5000, 5000, 1),
        ("P-3", "Other", "Fixed", "Unknown", None, None, 0)]


def changes(spark, *given):
    data = [(k, a, datetime.fromisoformat(t) if t else None, f, x, y) for k, a, t, f, x, y in given]
    return spark.createDataFrame(data, "key string, author string, created timestamp, field string, from_string string, to_string string")


@pytest.mark.parametrize("targets, expected", [
    (["Major"], None), (["Minor", "Major"], 1), (["Major", "Minor", "Blocker"], 1), (["Major", "Minor"], 0),
    (["Minor", "Odd", "Major"], 0), (["Major", "Major"], 0),
])
def test_escalation(spark, targets, expected):
    df = changes(spark, *[("k", "a", f"2020-01-0{i + 1}", "Priority", None, t) for i, t in enumerate(targets)])
    got = rows(mid.escalation(df))
    # A single change has no pair; the feature table then says 0.
    assert got == [("k", expected or 0)]


def test_first_assignee_puts_missing_times_last(spark):
    df = changes(spark, ("k", "a", None, "assignee", None, "early?"), ("k", "a", "2020-01-02", "Assignee", None, "second"),
                 ("k", "a", "2020-01-01", "ASSIGNEE", None, None), ("n", "a", None, "assignee", None, "only"))
    assert rows(mid.first_assignee(df), "key") == [("k", "second"), ("n", "only")]


def test_status_transitions(spark):
    df = changes(spark,
                 ("k", "a", "2020-01-01T10:59:00", "status", " ", "In Progress"),
                 ("k", "a", "2020-01-01T11:01:00", "Status", "In Progress", "Resolved"),
                 ("k", "a", "2020-01-02T11:01:00", "status", "Resolved", "Reopened"),
                 ("k", "a", None, "status", "Open", "Reopened"),
                 ("k", "a", "2020-01-01T11:00:00", "status", "x", None))
    got = mid.status_transitions(df).select("from_status", "to_status", "hours_in_from_status", "is_reopen_event")
    assert sorted(map(repr, rows(got))) == sorted(map(repr, [
        ("Open", "In Progress", None, 0), ("In Progress", "Resolved", 1, 0),
        ("Resolved", "Reopened", 24, 1), ("Open", "Reopened", None, 0)]))


def test_daily_and_calendar(spark):
    issue = lambda key, created, resolved: dict(id=key, key=key, created=created, resolutiondate=resolved, issuetype_name="Bug")
    raw = issues(spark, issue("1", "2020-01-01", "2020-01-03"), issue("2", "bad", None), issue("3", "2020-01-01", None))
    stg = staging.stg_issues(raw, "P")
    analytics = mid.issues_analytics(stg, lookups.issuetype_map(spark), lookups.resolution_map(spark), "2021-01-01")
    df = changes(spark, ("1", "a", "2020-01-02", "status", None, "x"), ("1", "b", "2020-01-02", "status", None, "x"),
                 ("1", "a", None, "status", None, "x"))
    daily = mid.daily_activity(analytics, df)
    got = rows(daily.select("activity_date", "day_of_week", "issues_created", "issues_resolved", "changelog_events",
                            "active_issues", "active_contributors", "daily_backlog_delta"))
    assert sorted(map(repr, got)) == sorted(map(repr, [
        (date(2020, 1, 1), 3, 2, 0, 0, 0, 0, 2), (date(2020, 1, 2), 4, 0, 0, 2, 1, 2, 0),
        (date(2020, 1, 3), 5, 0, 1, 0, 0, 0, -1), (None, None, 1, 0, 0, 0, 0, 1), (None, None, 0, 0, 1, 1, 1, 0)]))
    series = rows(marts.calendar(daily).select("activity_date", "cumulative_backlog", "issues_created_7d_avg", "activity_intensity"))
    assert series[:3] == [(date(2020, 1, 1), 2, 2.0, 100.0), (date(2020, 1, 2), 2, 1.0, 100.0), (date(2020, 1, 3), 1, 0.7, 0.0)]
    assert [r[0] for r in series[3:]] == [None, None]


def test_versions_equal_naive_form(spark):
    data = [("k1", "3.x", "3.1", "Bug", 1, 10), ("k1", "3.x", "3.1", "Bug", 1, 10), ("k2", "3.x", "3.1", "Bug", 0, None),
            ("k3", "3.x", "3.1", "Bug", 1, 3), ("k4", "1.x", None, "Task", 1, None), ("k5", "Other", None, "Bug", 1, 1)]
    df = spark.createDataFrame(data, "key string, version_major string, version_minor string, issuetype string, is_resolved int, resolution_days int")
    assert rows(marts.versions(df)) == [
        ("1.x", None, "Task", 1, 0, 0, 0, 1, None, None, 0.0), ("3.x", "3.1", "Bug", 3, 3, 0, 0, 2, 7.7, 10.0, 100.0)]


def test_workload_mode_tie(spark):
    data = [("d", 1, 5, "Task"), ("d", 0, None, "Bug"), ("Unassigned", 1, 1, "Bug"), (None, 1, 1, "Bug")]
    df = spark.createDataFrame(data, "assignee string, is_resolved int, resolution_days int, issuetype string")
    df = df.withColumn("created_at", F.lit("2020-01-01").cast("timestamp"))
    got = rows(marts.workload(df).select("assignee", "n_assigned", "n_open_backlog", "resolution_rate_pct", "top_issuetype"))
    assert got == [("d", 2, 1, 50.0, "Bug")]
