from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tickloom.functions import dates, fixed_values as fv, labels, numbers, text

c = F.col


def one(spark, values, schema, *columns):
    return [tuple(r) for r in spark.createDataFrame(values, schema).select(*columns).collect()]


@pytest.mark.parametrize("raw, expected", [
    (None, ""),
    ("List<String> of x", "List of x"),
    ("a {code}short1{code} mid {CODE}short2{code} b", "a [CODE:short1{code} mid {CODE}short2] b"),
    ("x {CODE:java}npe{CODE} y", "x [CODE:npe] y"),
    ("{code}" + "x\n" * 150 + "{code}", "[CODE:" + "x\n" * 100 + "]"),
    ("{noformat}log{noformat}", "[CODE:log]"),
    ("{code} never closed", "{code} never closed"),
    ("ask [~bob] now", "ask now"),
    ("see https://a.b/c?d", "see"),
    ("one\nline", "one\nline"),
    ("tabs\t\there", "tabs here"),
    ("  padded  ", "padded"),
])
def test_clean_text(spark, raw, expected):
    assert one(spark, [(raw,)], "t string", text.clean_text(c("t"))) == [(expected,)]


def test_blank_and_length(spark):
    values = [("  ",), ("",), (None,), (" a ",)]
    got = one(spark, values, "t string", text.blank_to(c("t"), "d"), text.not_blank(c("t")), text.raw_length(c("t")))
    assert [g[0] for g in got] == ["d", "d", "d", "a"]
    assert [bool(g[1]) for g in got] == [False, False, False, True]
    assert [g[2] for g in got] == [2, 0, 0, 3]


@pytest.mark.parametrize("version, minor, major, rc", [
    ("3.2.1-rc1", "3.2", "3.x", 1), ("3.2", "3.2", "3.x", 0), ("v3.2", None, "Other", 0),
    ("10.1.0", "10.1", "Other", 0), ("1.", None, "1.x", 0), (" ", None, "Other", 0), ("2.0-RC", "2.0", "2.x", 1),
])
def test_versions(spark, version, minor, major, rc):
    got = one(spark, [(version,)], "v string", text.version_minor(c("v")), text.version_major(c("v")),
              text.is_release_candidate(c("v")))
    assert got == [(minor, major, rc)]


@pytest.mark.parametrize("size, flag", [
    (0, "[NO-DESCRIPTION] "), (1, "[SHORT-DESC] "), (49, "[SHORT-DESC] "), (50, "[SHORT-DESC] "), (79, "[SHORT-DESC] "), (80, ""),
])
def test_text_for_it(spark, size, flag):
    row = ("s", "Major", "d" * size, "k" * 700, 2, 1)
    got = one(spark, [row], "s string, p string, d string, k string, n long, l long",
              text.text_for_it(c("s"), c("p"), c("d"), c("k"), c("n"), c("l")))[0][0]
    body = "d" * size + (" " + "k" * 600 if size < 50 else "")
    assert got == f"{flag}[CONTAINER-LINK] TICKET: s\nPRI: Major\nDESC: {body}"


def test_text_limits_and_defaults(spark):
    row = (None, None, "d" * 3000, None, None, None)
    schema = "s string, p string, d string, k string, n long, l long"
    it, res, noco = one(
        spark, [row], schema,
        text.text_for_it(c("s"), c("p"), c("d"), c("k"), c("n"), c("l")),
        text.text_for_res(c("s"), F.lit("Bug"), c("p"), c("d"), c("k")),
        text.text_noco(c("s"), F.lit("Bug"), c("p"), c("d")))[0]
    assert len(it) == 2000 and it.startswith("[NO-COMMENTS] TICKET: \nPRI: \nDESC: ddd")
    assert res == "TICKET: \nTYPE: Bug | PRI: \nDESC: " + "d" * 800 + "\nCOMMENTS: "
    assert noco == "TICKET: \nTYPE: Bug | PRI: \nDESC: " + "d" * 800


def test_signal_text(spark):
    values = [("t", "Fix and improve", 1), ("t", "Improve", 0), ("", "plain", None), ("x" * 600, None, 0)]
    got = [g[0] for g in one(spark, values, "t string, s string, p int", text.signal_text(c("t"), c("s"), c("p")))]
    assert got[:3] == ["[HAS-PARENT] [BUG-SIGNAL] t", "[NO-PARENT] [IMPROVEMENT-SIGNAL] t", "[NO-PARENT] plain"]
    assert len(got[3]) == 512


@pytest.mark.parametrize("raw, expected", [
    ("2014-03-01T12:34:56.000+0000", datetime(2014, 3, 1, 12, 34, 56)),
    ("2014-03-01T12:34:56.000+0530", datetime(2014, 3, 1, 7, 4, 56)),
    ("2014-03-01 12:34:56", datetime(2014, 3, 1, 12, 34, 56)),
    ("20140301", datetime(2014, 3, 1)), ("1393677296", datetime(2014, 3, 1, 12, 34, 56)), ("1393677296000", datetime(2014, 3, 1, 12, 34, 56)),
    ("3/1/2014", datetime(2014, 3, 1)), ("03/01/2014 12:34:56", datetime(2014, 3, 1, 12, 34, 56)), ("03/01/2014 12:34", datetime(2014, 3, 1, 12, 34)),
    ("13/01/2014", None), ("20141301", None), ("12:34", None), ("bad", None), ("", None), (None, None),
])
def test_parse_timestamp(spark, raw, expected):
    got = one(spark, [(raw,)], "t string", dates.parse_timestamp(c("t")).cast("timestamp_ntz"))
    assert got == [(expected,)]


@pytest.mark.parametrize("raw, value, reason", [
    ("3/4/2021", "2021-03-04 00:00:00", None), ("2021/3/4 5:06", "2021-03-04 05:06:00", None), ("04-MAR-2021", "2021-03-04 00:00:00", None),
    ("4-mar-2021 10:11:12", "2021-03-04 10:11:12", None), ("Thu, 4 Mar 2021 10:11:12 +0200", "2021-03-04 08:11:12", None),
    ("2021-02-30", None, "no such time"), ("31/31/2021", None, "no such time"), ("4-xyz-2021", None, "no such time"), ("10:11", None, "no date"),
    ("soon", None, "unknown form"), ("12", None, "unknown form"), ("", None, None), ("  ", None, None), (None, None, None)])
def test_parse_dated_says_why(spark, raw, value, reason):
    p = dates.parse_dated(c("t"))
    assert one(spark, [(raw,)], "t string", p["value"].cast("timestamp_ntz").cast("string"), p["reason"]) == [(value, reason)]


def test_parse_number_keeps_long_ones(spark):
    p = numbers.parse_number(c("t"))
    texts = ["12345678901234567890", "-1.5", "1e3", "abc", "9" * 39, "", " ", None, "NaN"]
    got = one(spark, [(t,) for t in texts], "t string", p["value"].cast("string"), p["reason"])
    assert got == [("12345678901234567890", None), ("-2", None), ("1000", None), (None, "not a number"), (None, "more than 38 digits"),
                   (None, None), (None, None), (None, None), (None, "not a number")]


@pytest.mark.parametrize("start, end, days, hours", [
    ("2020-01-01 23:59:00", "2020-01-02 00:01:00", 1, 1),
    ("2020-01-01 10:59:00", "2020-01-01 11:01:00", 0, 1),
    ("2020-01-01 10:01:00", "2020-01-01 10:59:00", 0, 0),
    ("2020-01-02 00:01:00", "2020-01-01 23:59:00", -1, -1),
    (None, "2020-01-01 00:00:00", None, None),
])
def test_differences(spark, start, end, days, hours):
    a, b = c("a").cast("timestamp"), c("b").cast("timestamp")
    got = one(spark, [(start, end)], "a string, b string", dates.day_diff(a, b), dates.hour_diff(a, b))
    assert got == [(days, hours)]


def test_calendar_parts(spark):
    got = one(spark, [("2021-01-01",), ("2021-01-03",)], "d string",
              dates.day_of_week(c("d").cast("date")), dates.iso_week(c("d").cast("date")))
    assert got == [(5, 53), (0, 53)]


def test_numbers(spark):
    got = one(spark, [(None,), (5001,), (-3,)], "x int", numbers.cap(c("x"), 5000), numbers.at_least(c("x"), 0),
              numbers.fill_clip(c("x"), 1e6))
    assert got == [(None, None, 0.0), (5000, 5001, 5001.0), (-3, 0, -3.0)]
    parsed = one(spark, [("1.6",), ("abc",), ("",), (None,), (" 7 ",)], "t string", numbers.try_number(c("t")))
    assert parsed == [(2,), (None,), (None,), (None,), (7,)]
    assert one(spark, [(1, 8), (1, 0), (2010, 200000)], "a int, b int", numbers.pct(c("a"), c("b"))) == [(12.5,), (None,), (1.01,)]


def test_labels(spark):
    at = c("t").cast("timestamp")
    values = [("2022-12-31",), ("2023-01-01",), ("2024-01-01",), (None,)]
    assert [g[0] for g in one(spark, values, "t string", labels.temporal_split(at))] == [
        "train", "validation", "excluded", "excluded"]
    ranks = one(spark, [("minor",), ("Blocker",), ("Odd",), (None,)], "p string", labels.priority_rank(c("p")))
    assert ranks == [(2,), (5,), (None,), (None,)]
    moves = [("Resolved", "Reopened"), ("Open", "Reopened"), ("closed", "reopened"), (None, "Reopened")]
    assert one(spark, moves, "a string, b string", labels.is_reopen(c("a"), c("b"))) == [(1,), (0,), (1,), (0,)]
    rare = one(spark, [("Task",), ("Bug",), (None,)], "l string", labels.merge_rare(c("l"), fv.RARE_ISSUETYPES_5))
    assert rare == [("Other",), ("Bug",), (None,)]
    bands = one(spark, [(0.65,), (0.45,), (0.1,), (None,)], "x double", labels.confidence_band(c("x")))
    assert bands == [("High",), ("Medium",), ("Low",), (None,)]
    codes = one(spark, [("Bug",), ("Sub-task",), ("Legal",), (None,)], "l string", labels.encode_label(c("l"), fv.CLASSES_4))
    assert codes == [(0,), (3,), (None,), (None,)]


def test_duration_label(spark):
    assert one(spark, [("Open", 2.25), (None, 1.0), ("x", None)], "s string, d double",
               text.duration_label(c("s"), c("d"))) == [("Open (moy. 2.3j)",), (None,), (None,)]


def test_texts_that_no_cleaning_step_touches_are_searched_once(spark):
    texts = [None, "", " plain ", "a b", "a  b", "a\n\tb", "x < y", "<b>x</b>", "{CODE}y{code}", "{code:java}" + "z" * 300 + "{code}tail", "{noformat}n{noformat}", "[~me] x",
             "see https://e.org/x y", "http:/x", "HTTP://x", "{", "[", "~", "a\r\nb", "é  ü", "<>{code}<b>{code}"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    every = F.coalesce("t", F.lit(""))
    for pattern, replacement in fv.CLEANING_STEPS:
        every = F.regexp_replace(every, pattern, replacement)
    both = df.select(text.clean_text(F.col("t")).alias("a"), F.trim(every).alias("b"))
    assert both.filter(~F.col("a").eqNullSafe(F.col("b"))).count() == 0
    guarded = df.select(text.clean_text(F.col("t")).alias("a"))._jdf.queryExecution().executedPlan().toString()
    assert guarded.count("RLIKE") == 1 and guarded.count("regexp_replace") == 6
