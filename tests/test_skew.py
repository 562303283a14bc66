"""Hot groups take another way; the result must be the same."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tests.conftest import rows
from tickloom.operators import aggregates as agg, windows
from tickloom.operators import skew
from tickloom.operators.skew import separate_hot
from tickloom.plans import intermediate as mid


def events(spark):
    """One key holds most rows; ties, NULL times, NULL keys and equal copies occur."""
    rng = random.Random(7)
    data = []
    for i in range(400):
        key = rng.choice(["hot"] * 6 + ["a", "b", None])
        at = None if rng.random() < 0.05 else rng.randrange(60)
        data.append((key, at, rng.randrange(3), rng.choice("xyz"), i))
    data += [("copies", 5, 1, "x", -1)] * 40
    return spark.createDataFrame(data, "key string, at int, tie int, v string, id int")


def test_separate_hot(spark, hot_limit):
    cold, hot = separate_hot(events(spark), ["key"])
    assert cold.count() + hot.count() == 440
    assert {r.key for r in hot.select("key").distinct().collect()} >= {"hot", "copies"}


def test_no_hot_group(spark):
    assert separate_hot(events(spark), ["key"])[1] is None


def test_lag_in_order(spark, hot_limit):
    df = events(spark)
    order = ["at", "tie", "v", "id"]
    w = Window.partitionBy("key").orderBy(*[F.col(c).asc_nulls_last() for c in order])
    expected = df.withColumns({"pa": F.lag("at").over(w), "pv": F.lag("v").over(w)})
    got = windows.lag_in_order(df, ["key"], order, {"pa": "at", "pv": "v"})
    assert got.columns == expected.columns
    assert sorted(map(repr, rows(got))) == sorted(map(repr, rows(expected)))


def test_number_in_order(spark, hot_limit):
    df = events(spark)
    order = ["at", "tie", "v", "id"]
    w = Window.partitionBy("key").orderBy(*[F.col(c).asc_nulls_last() for c in order])
    expected = df.withColumn("n", F.row_number().over(w))
    got = windows.number_in_order(df, ["key"], order, "n")
    assert sorted(map(repr, rows(got))) == sorted(map(repr, rows(expected)))


def test_concat_in_order(spark, hot_limit):
    df = events(spark).filter("key is not null").withColumn("text", F.concat(F.col("v"), F.col("id").cast("string")))
    got = dict(rows(agg.concat_in_order(df, "key", ["at", "id"], "text", "all", " | ", 50)))
    for key, group in df.toPandas().groupby("key"):
        ordered = sorted(group.itertuples(), key=lambda r: (r.at != r.at, 0 if r.at != r.at else r.at, r.id))
        assert got[key] == " | ".join(r.text for r in ordered)[:50]


def test_concat_cut(spark):
    for size in (2999, 3000, 3001):
        df = spark.createDataFrame([("k", 1, "a" * (size - 4)), ("k", 2, "b"), ("k", 3, None)], "key string, o int, t string")
        text = rows(agg.concat_in_order(df, "key", ["o"], "t", "all", " | ", 3000))[0][1]
        assert text == ("a" * (size - 4) + " | b")[:3000]


def comments(spark):
    rng = random.Random(3)
    data = [
        (rng.choice(["hot"] * 5 + ["a", "b"]), f"id{i:04d}", rng.choice(["p", "q", None]),
         "w" * rng.randrange(5, 400), rng.choice([None, "2020-01-01", "2020-01-02"]))
        for i in range(150)
    ]
    df = spark.createDataFrame(data, "key string, comment_id string, comment_author string, comment_body string, t string")
    return df.withColumn("comment_created", F.col("t").cast("timestamp"))


def test_comments_hot_equals_plain(spark, hot_limit):
    hot = rows(mid.comments_agg(comments(spark)), "key")
    spark.conf.unset("tickloom.maxGroupRows")
    assert hot == rows(mid.comments_agg(comments(spark)), "key")
    assert all(len(r[1]) <= 3000 for r in hot)


def changes(spark):
    rng = random.Random(5)
    priorities = ["Trivial", "Minor", "Major", "Critical", "Blocker", "Odd", None]
    data = [
        (rng.choice(["hot"] * 5 + ["a", "b", "c"]), rng.choice("pqr"), rng.randrange(40), rng.choice(["Status", "priority", "ASSIGNEE"]),
         rng.choice(["Open", " ", None, "Resolved"]), rng.choice(priorities + ["Reopened"]))
        for _ in range(300)
    ]
    df = spark.createDataFrame(data, "key string, author string, h int, field string, from_string string, to_string string")
    return df.withColumn("created", F.timestamp_seconds(F.lit(1_600_000_000) + F.col("h") * 5000))


def test_changes_hot_equals_plain(spark, hot_limit):
    df = changes(spark)
    hot = sorted(map(repr, rows(mid.status_transitions(df)))), rows(mid.escalation(df), "key")
    spark.conf.unset("tickloom.maxGroupRows")
    assert hot == (sorted(map(repr, rows(mid.status_transitions(df)))), rows(mid.escalation(df), "key"))


@pytest.mark.parametrize("slots", [8, 4096])
def test_heavy_keys_are_bounded_from_both_sides(spark, tmp_path, slots):
    rng = random.Random(1)
    data = [(rng.choice(["hot", "hot", "warm", None, f"k{rng.randrange(300)}"]), "x" * rng.randrange(50)) for _ in range(6000)]
    df = spark.createDataFrame(data, "key string, t string").repartition(3)
    truth = {}
    for k, t in data:
        truth[k] = truth.get(k, 0) + len(t) + 64
    found = skew.heavy_keys(df, "key", ["t"], str(tmp_path / "sketch"), slots)
    assert len(found.keys) <= slots and found == skew.read_heavy_keys(spark, str(tmp_path / "sketch"), "key", slots)
    for k, n in found.keys:
        assert n <= truth[k] <= n + found.missed
    assert all(n <= found.missed for k, n in truth.items() if k not in dict(found.keys))
    assert found.missed <= 2 * sum(truth.values()) / slots if slots == 8 else found.missed == 0
    assert {"hot", None} <= set(found.above(80_000)) and not found.above(10**9)


def test_no_job_runs_while_a_plan_is_stated(spark, tmp_path):
    df = comments(spark)
    df.write.parquet(str(tmp_path / "comments"))
    landed = spark.read.parquet(str(tmp_path / "comments"))
    heavy = skew.heavy_keys(landed, "key", ["comment_body"], str(tmp_path / "sketch"))
    expected = rows(mid.comments_agg(landed), "key")
    sc = spark.sparkContext
    sc.setJobGroup("stated", "")
    plain = mid.comments_agg(landed, heavy=heavy)
    # A limit that only the hot issue is above, and one below all of them.
    limits = []
    for limit in (max(n for _, n in heavy.keys) - 1, 0):
        spark.conf.set(skew.MAX_GROUP_BYTES_CONF, str(limit))
        limits.append(mid.comments_agg(landed, heavy=heavy))
    spark.conf.unset(skew.MAX_GROUP_BYTES_CONF)
    assert len(sc.statusTracker().getJobIdsForGroup("stated")) == 0
    sc.setLocalProperty("spark.jobGroup.id", None)
    for df in (plain, *limits):
        assert rows(df, "key") == expected


@pytest.mark.parametrize("step", ["lag", "number"])
def test_hot_rows_take_few_tasks_however_low_the_limit(spark, hot_limit, step):
    """Ranges stay within the limit, tasks follow the rows, and the rows of a group are shuffled by range once."""
    df = spark.range(4000).select((F.col("id") % 3).alias("key"), (F.col("id") % 50).alias("at"), "id")
    ranges = skew.split_by_order(df, ["key"], ["at", "id"])
    assert ranges.groupBy("key", skew.PART).count().agg(F.max("count")).first()[0] <= hot_limit
    tasks = F.shiftright(skew.PART, 33)
    assert ranges.select(tasks).distinct().count() <= 2
    w = Window.partitionBy("key").orderBy("at", "id")
    if step == "lag":
        got, expected = windows.lag_in_order(df, ["key"], ["at", "id"], {"before": "id"}), df.withColumn("before", F.lag("id").over(w))
    else:
        got, expected = windows.number_in_order(df, ["key"], ["at", "id"], "n"), df.withColumn("n", F.row_number().over(w).cast("bigint"))
    assert got.schema.simpleString() == expected.schema.simpleString() and rows(got, "id") == rows(expected, "id")
    assert " Join" not in got._jdf.queryExecution().optimizedPlan().toString().replace("Join LeftAnti", "")
