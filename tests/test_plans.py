"""The plans Spark makes: what must, and must not, be in them."""

import pytest
from pyspark.sql import functions as F

from verify import queries
from verify.queries import Models

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def models(spark):
    return Models(spark, SF)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_dedup_is_cut_before_the_shuffle(models):
    text = plan(models.stg_issues())
    assert text.count("WindowGroupLimit") == 2 and text.count("Exchange") == 1
    assert "EqualTo(project_key,CORE)" in text


def test_transitions_have_one_shuffle_and_no_self_join(models):
    text = plan(models.transitions())
    # One shuffle of the changes, one of the distinct keys.
    assert text.count("Exchange hashpartitioning") == 2 and text.count("Window [") == 1
    assert "In(field_norm" in text and "LeftSemi" in text and "SortMergeJoin" not in text


def test_comments_are_cleaned_once(models):
    text = plan(models.comments())
    assert text.count("regexp_replace") == 6 and text.count("Exchange hashpartitioning") == 2


def test_minimum_length_computes_the_text_once(models):
    from tickloom.functions.text import clean_text
    from tickloom.operators.filters import with_min_length

    docs = with_min_length(models.table("documents"), "clean", clean_text(F.col("text")), 10)
    assert plan(docs).count("regexp_replace") == 6


def test_no_cartesian_product_anywhere(models):
    for name in ("mart_ml", "ops", "versions", "calendar", "workload", "daily"):
        text = plan(getattr(models, name)())
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name


def test_version_metrics_need_no_expand(models):
    assert "Expand" not in plan(models.versions())


def test_changes_and_issues_are_read_once_for_each_purpose(models):
    from tickloom.plans import intermediate as mid

    scans = lambda df: plan(df).count("FileScan")
    changes, issues = models.raw_changelog().select("key", "author", "created", "field", F.col("fromstring").alias("from_string"), F.col("tostring").alias("to_string")), models.raw_issues()
    # The aggregate and the ordered priority changes; the keys to keep.
    assert scans(mid.changelog_features(changes, issues.select("key"))) == 3
    named = issues.select(F.col("created").alias("created_at"), F.col("resolutiondate").alias("resolved_at"), F.col("issuetype_name").alias("issuetype"))
    daily = mid.daily_activity(named, changes)
    assert scans(daily) == 2 and "Join" not in plan(daily)


def test_medians_see_counts(models):
    for df in (models.workload(), models.sankey(), models.state_time()):
        text = plan(df)
        assert "percentile(" in text and "median(" not in text and "partial_count" in text


def test_narrow_scan(models):
    text = plan(models.workload())
    assert "description" not in text.split("ReadSchema")[1].split("\n")[0].replace("resolution_description", "")


def test_issues_and_their_copies_come_from_one_pass(spark):
    from verify import adapter as ad

    text = plan(ad.raw_issues(spark, SF))
    assert text.count("FileScan") == 5 and "Union" not in text


def longest_method(df):
    """Bytes of the longest method among the generated code of a plan."""
    stages = df._jdf.queryExecution().debug().codegenToSeq()
    return max(stages.apply(i)._3().maxMethodCodeSize() for i in range(stages.size()))


def test_code_that_parses_times_is_short_enough_to_be_compiled(models, spark):
    # The JVM leaves methods above 8,000 bytes to its interpreter.
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # the code is made with the plan
    try:
        for df in (models.stg_issues(), models.cleaned().filter("split <> 'excluded'"), models.stg_comments(),
                   models.mart_ml().select("issuetype", "text_for_it", "summary_clean", "has_parent")):
            assert 0 < longest_method(df) <= 8000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_registry():
    import __spark_entry__ as entry

    names = entry.queries()
    assert set(entry.oracle_sql()) <= set(names)
    assert len(names) >= 140 and set(queries.QUERIES) <= set(names)
