"""The 66 declared data tests.  Fixed values: tables, columns, lists, severities."""

from __future__ import annotations

from tickloom.functions import fixed_values as fv
from tickloom.operators.quality import Test

NOT_NULL = {
    "stg_issues": ["key", "issue_id", "created_at"],
    "stg_comments": ["key", "comment_id"],
    "stg_changelog": ["key", "field"],
    "stg_issuelinks": ["key", "type_name"],
    "issues_cleaned": ["key", "created_at", "issuetype", "resolution", "split"],
    "comments_aggregated": ["key"],
    "changelog_features": ["key"],
    "issuelinks_features": ["key"],
    "mart_ops": ["key", "issuetype", "priority", "n_comments"],
    "mart_workload": ["assignee", "n_assigned", "n_fixed", "n_open_backlog"],
    "mart_links": ["key", "n_links_total"],
    "mart_transitions_sankey": ["from_status", "to_status", "n_transitions"],
    "mart_transitions_time": ["status", "avg_hours"],
    "mart_versions": ["version_major", "n_issues", "bug_ratio_pct"],
    "mart_calendar": ["activity_date", "activity_intensity"],
    "mart_ml": ["key", "split", "issuetype", "resolution", "text_noco", "created_at"],
}
UNIQUE = {
    "stg_issues": "key",
    "issues_cleaned": "key",
    "comments_aggregated": "key",
    "changelog_features": "key",
    "issuelinks_features": "key",
    "mart_ops": "key",
    "mart_workload": "assignee",
    "mart_links": "key",
    "mart_transitions_time": "status",
    "mart_calendar": "activity_date",
    "mart_ml": "key",
}
RELATIONSHIPS = {
    "comments_aggregated": "stg_issues",
    "changelog_features": "issues_cleaned",
    "issuelinks_features": "stg_issues",
}


def data_tests(project: str) -> list[Test]:
    tests = [Test(m, c, "not_null") for m, columns in NOT_NULL.items() for c in columns]
    tests += [Test(m, c, "unique") for m, c in UNIQUE.items()]
    tests += [Test(m, "key", "relationships", parent=p) for m, p in RELATIONSHIPS.items()]

    def accepted(model, column, values, severity="error"):
        tests.append(Test(model, column, "accepted_values", values=tuple(values), severity=severity))

    accepted("stg_issues", "project", [project])
    accepted("issues_cleaned", "issuetype", fv.ISSUETYPES, "warn")
    accepted("issues_cleaned", "resolution", fv.RESOLUTIONS, "warn")
    accepted("issues_cleaned", "split", fv.SPLITS)
    accepted("mart_ops", "is_resolved", [0, 1])
    accepted("mart_versions", "version_major", fv.VERSION_BRANCHES)
    accepted("mart_ml", "split", ["train", "validation"])
    accepted("mart_ml", "issuetype", fv.ISSUETYPES, "warn")
    accepted("mart_ml", "resolution", fv.RESOLUTIONS, "warn")
    return tests
