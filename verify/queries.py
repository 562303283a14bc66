"""Registered queries: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.operators.skew import HeavyKeys, heavy_keys
from tickloom.plans import intermediate as mid, marts, staging
from tickloom.session import checkpoint_dir, configure
from tickloom.sources import lookups
from tickloom.sources.delimited import with_field_norm
from tickloom.sources.parents import load_parent_keys
from tickloom.sources.tables import write_table
from verify import adapter as ad
from verify.oracle import table as oracle_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
# The column all jobs filter the raw changes on.
FILTERED = {"changelog": "field_norm"}
LANDED: dict[tuple[str, str, str], DataFrame] = {}
HEAVY: dict[tuple[str, str, str], HeavyKeys] = {}
# Texts that a group takes into a task.
WEIGHED = {"comments": ["comment_body"], "changelog": ["fromstring", "tostring"]}


class Models:
    """The jobs over the adapter tables; each call states its plan anew."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = configure(spark), sf_dir

    def table(self, name: str) -> DataFrame:
        return ad.table(self.spark, self.sf_dir, name)

    def raw_issues(self): return self.landed("issues", ad.raw_issues)
    def raw_comments(self): return self.landed("comments", ad.raw_comments)
    def raw_changelog(self): return self.landed("changelog", ad.raw_changelog)
    def raw_issuelinks(self): return self.landed("issuelinks", ad.raw_issuelinks)
    def raw_parents(self): return self.landed("parents", ad.raw_parent_keys)

    def landed(self, name: str, build: Callable[[SparkSession, str], DataFrame]) -> DataFrame:
        """The raw table as the load leaves it: whole, written once per session."""
        place = (self.spark.sparkContext.applicationId, self.sf_dir, name)
        if place not in LANDED:
            path = f"{checkpoint_dir(self.spark)}/landed/{uuid.uuid4().hex}/{name}"
            raw = with_field_norm(build(self.spark, self.sf_dir))
            LANDED[place] = write_table(raw, path, sort_by=FILTERED.get(name))
        return LANDED[place]
    def heavy(self, name: str):
        """The sketch of a landed table's keys, made once beside it."""
        table = getattr(self, f"raw_{name}")()
        place = (self.spark.sparkContext.applicationId, self.sf_dir, name)
        if place not in HEAVY:
            path = f"{checkpoint_dir(self.spark)}/landed/{uuid.uuid4().hex}/{name}-heavy"
            HEAVY[place] = heavy_keys(table, "key", WEIGHED[name], path)
        return HEAVY[place]

    def types(self): return lookups.issuetype_map(self.spark)
    def resolutions(self): return lookups.resolution_map(self.spark)

    def keys(self): return staging.kept_keys(self.raw_issues(), ad.PROJECT)
    def stg_issues(self): return staging.stg_issues(self.raw_issues(), ad.PROJECT)
    def stg_comments(self): return staging.stg_comments(self.raw_comments(), self.keys())
    def stg_changelog(self): return staging.stg_changelog(self.raw_changelog(), self.keys())
    def stg_issuelinks(self): return staging.stg_issuelinks(self.raw_issuelinks(), self.keys())

    def cleaned(self):
        return mid.issues_cleaned(self.stg_issues(), self.types(), self.resolutions(),
                                  ad.TRAIN_BEFORE, ad.VALIDATION_BEFORE)

    def analytics(self):
        return mid.issues_analytics(self.stg_issues(), self.types(), self.resolutions(), ad.AS_OF)

    def comments(self): return mid.comments_agg(self.stg_comments(), heavy=self.heavy("comments"))
    def changelog_features(self): return mid.changelog_features(self.stg_changelog(), self.cleaned(), self.heavy("changelog"))
    def link_features(self): return mid.issuelinks_features(self.stg_issuelinks())
    def transitions(self): return mid.status_transitions(self.stg_changelog(), self.heavy("changelog"))
    def daily(self): return mid.daily_activity(self.analytics(), self.stg_changelog())
    def fix_versions(self): return mid.fix_versions(self.stg_changelog(), self.analytics())
    def parents(self): return load_parent_keys(self.raw_parents())

    def mart_ml(self):
        return marts.mart_ml(self.cleaned(), self.comments(), self.changelog_features(),
                             self.link_features(), self.parents())

    def ops(self): return marts.ops(self.analytics(), self.comments())
    def workload(self): return marts.workload(self.analytics())
    def links(self): return marts.links(self.link_features())
    def sankey(self): return marts.transitions_sankey(self.transitions())
    def state_time(self): return marts.transitions_time(self.transitions())
    def versions(self): return marts.versions(self.fix_versions())
    def calendar(self): return marts.calendar(self.daily())


def plain(df: DataFrame) -> DataFrame:
    """Timestamps without zone, as the comparison reads them."""
    return df.select(*[
        F.col(f"`{c}`").cast("timestamp_ntz").alias(c) if t == "timestamp" else F.col(f"`{c}`")
        for c, t in df.dtypes
    ])


def register(name: str, build: Callable[[Models], DataFrame], oracle: str | None = None) -> None:
    if name in QUERIES:
        raise ValueError(name)
    QUERIES[name] = lambda spark, sf_dir: plain(build(Models(spark, sf_dir)))
    if oracle is not None:
        ORACLE[name] = oracle


for _name, _method, _cte in [
    ("m01_stg_issues", "stg_issues", "stg_issues"),
    ("m02_stg_comments", "stg_comments", "stg_comments"),
    ("m03_stg_changelog", "stg_changelog", "stg_changelog"),
    ("m04_stg_issuelinks", "stg_issuelinks", "stg_issuelinks"),
    ("m05_issues_cleaned", "cleaned", "cleaned"),
    ("m06_issues_analytics", "analytics", "analytics"),
    ("m07_comments_aggregated", "comments", "comments"),
    ("m08_changelog_features", "changelog_features", "changelog_features"),
    ("m09_issuelinks_features", "link_features", "link_features"),
    ("m10_status_transitions", "transitions", "transitions"),
    ("m11_daily_activity", "daily", "daily"),
    ("m12_fix_versions", "fix_versions", "fix_versions"),
    ("m13_mart_ml", "mart_ml", "mart_ml"),
    ("m14_mart_ops", "ops", "ops"),
    ("m15_mart_workload", "workload", "workload"),
    ("m16_mart_links", "links", "links"),
    ("m17_mart_transitions_sankey", "sankey", "sankey"),
    ("m18_mart_transitions_time", "state_time", "state_time"),
    ("m19_mart_versions", "versions", "versions"),
    ("m20_mart_calendar", "calendar", "calendar"),
]:
    register(_name, lambda m, method=_method: getattr(m, method)(), oracle_table(_cte))
