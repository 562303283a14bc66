from tests.conftest import rows
from tickloom.operators import quality
from tickloom.operators.joins import keep_known
from tickloom.operators.quality import Test
from tickloom.plans.data_tests import data_tests


def table(spark):
    return spark.createDataFrame([("a", "Fixed"), ("a", None), ("b", "Won't Fix"), (None, "odd"), (None, "odd")], "key string, label string")


def test_checks(spark):
    df = table(spark)
    assert rows(quality.check_unique(df, "key")) == [("a", 2)]
    assert quality.check_not_null(df, "key").count() == 2
    assert rows(quality.check_accepted(df, "label", ["Fixed", "Won't Fix"])) == [("odd", 2)]
    parent = spark.createDataFrame([("a",)], "key string")
    assert rows(quality.check_fk(df, "key", parent, "key")) == [("b", 1)]
    assert rows(quality.value_counts(df, "key")) == [("a", 2), (None, 2), ("b", 1)]


def test_suite(spark):
    tests = [
        Test("t", "key", "not_null"), Test("t", "label", "not_null"), Test("t", "key", "unique"),
        Test("t", "label", "accepted_values", ("Fixed", "Won't Fix"), severity="warn"),
        Test("t", "key", "relationships", parent="p"), Test("p", "key", "unique"),
    ]
    parent = spark.createDataFrame([("a",), ("b",)], "key string")
    got = quality.run_suite({"t": table(spark), "p": parent}, tests).select("model", "column", "test", "failures", "status")
    assert set(rows(got)) == {
        ("t", "key", "not_null", 2, "ERROR"), ("t", "label", "not_null", 1, "ERROR"), ("t", "key", "unique", 1, "ERROR"),
        ("t", "label", "accepted_values", 1, "WARN"), ("t", "key", "relationships", 0, "PASS"), ("p", "key", "unique", 0, "PASS")}


def test_signal(spark):
    df = spark.createDataFrame([(1, "S"), (0, "B"), (1, "B")], "flag int, kind string")
    assert rows(quality.check_signal(df, "flag", "kind", "S")) == [(3, 2, 2, 1, "PASS")]
    assert rows(quality.check_signal(df.filter("flag = 0"), "flag", "kind", "S")) == [(1, 0, 1, 0, "ERROR")]


def test_declared_tests():
    tests = data_tests("P")
    assert len(tests) == 66 == len(set(tests))
    assert sum(t.severity == "warn" for t in tests) == 4


def test_the_suite_reads_every_table_once(spark, tmp_path):
    """Unique, accepted, not-null and keys, through a chain of relationships, out of one aggregate."""
    a = spark.createDataFrame([(1, "x", None), (2, "y", "t"), (2, None, "t"), (None, "z", "t")], "id int, label string, text string")
    b = spark.createDataFrame([(1, 1), (2, 9), (9, 9), (None, 1)], "key int, a_id int")
    c = spark.createDataFrame([("1",), ("7",), ("7",), (None,)], "b_key string")
    written = {}
    for name, df in {"a": a, "b": b, "c": c}.items():
        df.write.parquet(str(tmp_path / name))
        written[name] = spark.read.parquet(str(tmp_path / name))
    tests = [
        quality.Test("a", "id", "unique"), quality.Test("a", "id", "not_null"), quality.Test("a", "text", "not_null"),
        quality.Test("a", "label", "accepted_values", values=("x", "y"), severity="warn"), quality.Test("b", "key", "unique"),
        quality.Test("b", "a_id", "relationships", parent="a", parent_column="id"), quality.Test("c", "b_key", "relationships", parent="b"),
        quality.Test("b", "a_id", "unique")]
    suite = quality.run_suite(written, tests)
    got = {(r["model"], r["column"], r["test"]): (r["failures"], r["status"]) for r in suite.collect()}
    assert got == {
        ("a", "id", "unique"): (1, "ERROR"), ("a", "id", "not_null"): (1, "ERROR"), ("a", "text", "not_null"): (1, "ERROR"),
        ("a", "label", "accepted_values"): (1, "WARN"), ("b", "key", "unique"): (0, "PASS"), ("b", "a_id", "relationships"): (2, "ERROR"),
        ("c", "b_key", "relationships"): (2, "ERROR"), ("b", "a_id", "unique"): (2, "ERROR")}
    plan = suite._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan") == 3 and "Join" not in plan and plan.count("Exchange") == 2
    empty = quality.run_suite({n: df.limit(0) for n, df in written.items()}, tests)
    assert {r["status"] for r in empty.collect()} == {"PASS"}


def test_values_that_pass_are_not_shuffled(spark):
    """Of listed columns only NULLs and values outside every list are counted, of unique ones and keys all."""
    df = spark.createDataFrame([(1, "a", 1), (1, "b", 0), (2, "a", 7), (None, "odd", None), (3, None, 1)], "id int, label string, flag int")
    tests = [
        Test("t", "id", "unique"), Test("t", "label", "accepted_values", ("a", "b")), Test("t", "label", "accepted_values", ("a",), severity="warn"),
        Test("t", "flag", "accepted_values", (0, 1)), Test("t", "label", "not_null")]
    place = {("t", "id"): (0, 0), ("t", "label"): (1, 0), ("t", "flag"): (2, 0)}
    got = quality.tested_values({"t": df}, tests, place).groupBy("domain", "value").count()
    assert set(rows(got)) == {(0, "1", 2), (0, "2", 1), (0, "3", 1), (0, None, 1), (1, "b", 1), (1, "odd", 1), (1, None, 1), (2, "7", 1), (2, None, 1)}
    assert rows(quality.run_suite({"t": df}, tests).select("failures")) == [(1,), (1,), (2,), (1,), (1,)]


def test_not_null_tests_of_a_view_reach_its_files(spark, tmp_path):
    """A view that is tested for NULLs only is not joined row by row to find them."""
    links = spark.createDataFrame([("a", "x"), ("a", None), ("b", None), (None, None)], "key string, kind string")
    links.write.parquet(str(tmp_path / "links"))
    view = keep_known(spark.read.parquet(str(tmp_path / "links")), spark.createDataFrame([("a",)], "key string"))
    suite = quality.run_suite({"v": view}, [Test("v", "key", "not_null"), Test("v", "kind", "not_null")])
    assert rows(suite.select("failures")) == [(0,), (1,)]
    assert "IsNull(kind)" in suite._jdf.queryExecution().executedPlan().toString()
