"""The whole build: raw tables to written layers and marts.

Tables that several jobs read are written once, so that cleaning and joins do
not run again for every mart.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from tickloom.functions import fixed_values as fv
from tickloom.operators.skew import HeavyKeys
from tickloom.plans import intermediate as mid, marts, staging
from tickloom.sources import lookups
from tickloom.sources.parents import load_parent_keys
from tickloom.sources.tables import materialize


@dataclass(frozen=True)
class Settings:
    project: str
    as_of: str
    train_before: str = fv.TRAIN_BEFORE
    validation_before: str = fv.VALIDATION_BEFORE


def build(issues: DataFrame, comments: DataFrame, changelog: DataFrame, issuelinks: DataFrame,
          parents: DataFrame, settings: Settings, base: str, heavy: dict[str, HeavyKeys] | None = None) -> dict[str, DataFrame]:
    """Build every table under ``base``; returns them by name.

    ``heavy`` holds the sketches of the landed comments and changes, by the
    names ``comments`` and ``changelog``, where they were made.
    """
    heavy = heavy or {}
    spark = issues.sparkSession
    types, resolutions = lookups.issuetype_map(spark), lookups.resolution_map(spark)
    out: dict[str, DataFrame] = {}

    def write(layer: str, name: str, df: DataFrame) -> DataFrame:
        out[name] = materialize(df, layer, name, base)
        return out[name]

    # Issues and changes feed four jobs each: they are written, not viewed.
    stg = write("staged", "stg_issues", staging.stg_issues(issues, settings.project))
    changes = write("staged", "stg_changelog", staging.stg_changelog(changelog, stg))
    notes = write("staging", "stg_comments", staging.stg_comments(comments, stg))
    links = write("staging", "stg_issuelinks", staging.stg_issuelinks(issuelinks, stg))

    cleaned = write("intermediate", "issues_cleaned", mid.issues_cleaned(
        stg, types, resolutions, settings.train_before, settings.validation_before))
    analytics = write("intermediate", "issues_analytics", mid.issues_analytics(stg, types, resolutions, settings.as_of))
    discussion = write("intermediate", "comments_aggregated", mid.comments_agg(notes, heavy=heavy.get("comments")))
    features = write("intermediate", "changelog_features", mid.changelog_features(changes, cleaned, heavy.get("changelog")))
    link_counts = write("intermediate", "issuelinks_features", mid.issuelinks_features(links))
    transitions = write("intermediate", "status_transitions", mid.status_transitions(changes, heavy.get("changelog")))
    daily = write("intermediate", "daily_activity", mid.daily_activity(analytics, changes))
    assigned = write("intermediate", "fix_versions", mid.fix_versions(changes, analytics))

    write("marts", "mart_ml", marts.mart_ml(cleaned, discussion, features, link_counts, load_parent_keys(parents)))
    write("marts", "mart_ops", marts.ops(analytics, discussion))
    write("marts", "mart_workload", marts.workload(analytics))
    write("marts", "mart_links", marts.links(link_counts))
    write("marts", "mart_transitions_sankey", marts.transitions_sankey(transitions))
    write("marts", "mart_transitions_time", marts.transitions_time(transitions))
    write("marts", "mart_versions", marts.versions(assigned))
    write("marts", "mart_calendar", marts.calendar(daily))
    return out
