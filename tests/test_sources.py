import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tickloom.functions import fixed_values as fv
from tickloom.sources import delimited, parents, tables

HEADER = "key,issuetype.name,text\n"


def write(tmp_path, content, name="in.csv"):
    path = tmp_path / name
    path.write_text(content, encoding="utf-8")
    return str(path)


def test_read_csv_table(spark, tmp_path):
    path = write(tmp_path, HEADER + 'P-1,Bug,"two\nlines, and ""quotes"""\nP-2,,None\n')
    df = delimited.read_csv_table(spark, path)
    assert df.dtypes == [("key", "string"), ("issuetype.name", "string"), ("text", "string")]
    assert rows(df, "key") == [("P-1", "Bug", 'two\nlines, and "quotes"'), ("P-2", None, "None")]


def test_read_tolerant(spark, tmp_path):
    path = write(tmp_path, HEADER + 'P-1,Bug,"a\nb"\nP-2,short\nP-3,Bug,x,extra\nP-4,Task,y\n')
    good, rejected = delimited.read_tolerant(spark, path)
    assert rows(good, "key") == [("P-1", "Bug", "a\nb"), ("P-4", "Task", "y")]
    assert sorted(r[0] for r in rows(rejected)) == ["P-2,short", "P-3,Bug,x,extra"]
    assert (good.count(), rejected.count()) == (2, 2)


@pytest.mark.parametrize("multi_line", [True, False])
def test_every_file_is_read_by_its_own_header(spark, tmp_path, multi_line):
    write(tmp_path, "key,author\nK1,ann\n", "a.csv")
    write(tmp_path, "author,extra,key\namy,x,K2\nbad\n", "b.csv")
    df = delimited.read_csv_table(spark, str(tmp_path), ["key", "author"], multi_line)
    assert rows(df.filter("key is not null"), "key") == [("K1", "ann"), ("K2", "amy")]
    good, rejected = delimited.read_tolerant(spark, str(tmp_path), ["key", "author"], multi_line)
    assert rows(good, "key") == [("K1", "ann"), ("K2", "amy")] and rows(rejected) == [("bad",)]
    write(tmp_path, "key,writer\nK3,abe\n", "c.csv")
    with pytest.raises(ValueError, match="missing columns: author"):
        delimited.read_csv_table(spark, str(tmp_path), ["key", "author"], multi_line)


def test_land_raw_writes_good_and_rejected_rows_once(spark, tmp_path):
    write(tmp_path, "created,key,author,field,fromString,toString\nnan,K1,ann,Status,a,b\nshort\n")
    good, rejected = delimited.land_raw(spark, str(tmp_path / "in.csv"), fv.CHANGELOG_COLUMNS, str(tmp_path / "raw"), multi_line=True)
    assert rows(good) == [("K1", "ann", None, "Status", "a", "b", "STATUS")] and rows(rejected) == [("short",)]
    plan = good.filter("field_norm = 'STATUS'")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(field_norm,STATUS)" in plan and "csv" not in plan


@pytest.mark.parametrize("count", [40, 400])
def test_headers_of_many_files_take_one_job(spark, tmp_path, count):
    for i in range(count):
        head, row = ("key,author", f"K{i},a{i}") if i % 2 else ("author,\"odd, name\",key", f"a{i},x,K{i}")
        write(tmp_path, f"{head}\n" + f"{row}\n" * 3, f"part {i:03d} 100%.csv")
    write(tmp_path, "", "empty.csv")
    sc = spark.sparkContext
    sc.setJobGroup(f"headers{count}", "")
    groups = delimited.files_by_header(spark, str(tmp_path))
    jobs = sc.statusTracker().getJobIdsForGroup(f"headers{count}")
    sc.setLocalProperty("spark.jobGroup.id", None)
    assert {h: len(f) for h, f in groups.items()} == {("author", "odd, name", "key"): count // 2, ("key", "author"): count // 2}
    # The read and its aggregate, and one for each header; the number of files plays no part.
    assert len(jobs) <= 6
    df = delimited.read_csv_table(spark, str(tmp_path), ["key", "author"])
    assert df.count() == 3 * count and df.filter("substr(key, 2) <> substr(author, 2)").count() == 0


def test_first_lines_read_no_further_than_a_buffer(spark, tmp_path):
    write(tmp_path, "\n\nkey,text\n" + "k,0123456789\n" * 2_000_000)
    files = delimited.files_by_header(spark, str(tmp_path))
    assert list(files) == [("key", "text")]


def test_landing_counts_rows_and_emptied_values_by_file(spark, tmp_path):
    head = "created,key,author,field,fromString,toString\n"
    write(tmp_path, head + "nan,K1,ann,Status,None,b\nshort\n2020,K2,None,Status,None,c\n", "a.csv")
    write(tmp_path, head + "one,two\nthree\n2020,K3,,Status,x,\n", "b.csv")
    landing = delimited.land_counted(spark, str(tmp_path / "*.csv"), fv.CHANGELOG_COLUMNS, str(tmp_path / "raw"), multi_line=True)
    name = F.element_at(F.split("file", "/"), -1).alias("file")
    assert rows(landing.files().select(name, "loaded", "rejected"), "file") == [("a.csv", 2, 1), ("b.csv", 1, 2)]
    assert rows(landing.nulled().select(name, "column_name", "nulled"), "file", "column_name") == [
        ("a.csv", "author", 1), ("a.csv", "created", 1), ("a.csv", "fromstring", 2)]
    assert {k: v for k, v in landing.totals.items() if v} == {
        "loaded": 3, "rejected": 3, "nulled": 4, "nulled.author": 1, "nulled.created": 1, "nulled.fromstring": 2}
    plan = landing.files()._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<_bad:string,_file:string>" in plan


def test_replacing_a_table_leaves_open_readers_and_failed_writes_alone(spark, tmp_path):
    path = str(tmp_path / "table")
    with pytest.raises(ValueError, match="no table"):
        tables.read_table(spark, path)
    tables.write_table(spark.range(3), path)
    opened = tables.read_table(spark, path)
    tables.write_table(spark.range(10, 12), path)
    assert rows(opened, "id") == [(0,), (1,), (2,)]
    assert rows(tables.read_table(spark, path), "id") == [(10,), (11,)]
    with pytest.raises(Exception):
        tables.write_table(spark.range(5).select(F.raise_error(F.lit("broken")).alias("id")), path)
    assert rows(tables.read_table(spark, path), "id") == [(10,), (11,)]
    # A table can be computed from itself.
    tables.write_table(tables.read_table(spark, path).select((F.col("id") + 1).alias("id")), path)
    assert rows(tables.read_table(spark, path), "id") == [(11,), (12,)]
    assert tables.drop_old_versions(spark, path) == 2 and len(tables.versions(spark, path)) == 1
    assert rows(tables.read_table(spark, path), "id") == [(11,), (12,)]


def test_null_tokens(spark):
    df = spark.createDataFrame([("nan", 1, ""), ("None", 2, "none"), ("ok", 3, None)], "`a.b` string, n int, c string")
    assert rows(delimited.null_tokens(df), "n") == [(None, 1, None), (None, 2, None), ("ok", 3, None)]
    assert rows(delimited.null_tokens(df, fv.NULL_TOKENS_SCRIPT), "n") == [(None, 1, None), ("None", 2, "none"), ("ok", 3, None)]


def test_contract(spark):
    df = spark.createDataFrame([("k", "a", "c", "f", "x", "y", "z")],
                               "key string, author string, created string, field string, fromString string, toString string, more string")
    landed = delimited.land(df, fv.CHANGELOG_COLUMNS)
    assert landed.columns == ["key", "author", "created", "field", "fromstring", "tostring", "field_norm"]
    with pytest.raises(ValueError, match="missing columns: type.name"):
        delimited.select_contract(df, {"key": "key", "type.name": "type_name"})


def test_row_count_audit(spark):
    audit = delimited.row_count_audit({"a": spark.range(991), "b": spark.range(989)}, {"a": 1000, "b": 1000})
    assert rows(audit.select("table_name", "row_count", "status"), "table_name") == [("a", 991, "OK"), ("b", 989, "CHECK")]


def test_parents(spark):
    df = spark.createDataFrame([("1", '{"fields":{"parent":{"key":"P-9"}}}'), ("2", '{"fields":{}}'), ("3", None)], "key string, payload string")
    fetched = parents.parents_from_payloads(df)
    assert rows(fetched, "key") == [("1", "P-9", 1), ("2", None, 0), ("3", None, -1)]
    assert [r[2] for r in rows(parents.load_parent_keys(fetched), "key")] == [1, 0, 0]
    batch = spark.createDataFrame([("3", "x", 1), ("4", "y", 1), ("4", "y", 1)], "key string, parent_key string, has_parent int")
    assert rows(parents.append_new(fetched, batch), "key")[2:] == [("3", None, -1), ("4", "y", 1)]


def test_layers_and_predictions(spark, tmp_path):
    df = spark.range(3).withColumn("label", F.lit(" kept, \"as\" is "))
    assert tables.materialize(df, "staging", "a_view", str(tmp_path)) is df
    assert spark.table("a_view").count() == 3
    written = tables.materialize(df, "marts", "a_table", str(tmp_path))
    again = tables.materialize(df.limit(1), "marts", "a_table", str(tmp_path))
    assert written.columns == ["id", "label"] and again.count() == 1
    tables.export_csv(df, str(tmp_path / "csv"))
    assert rows(delimited.read_csv_table(spark, str(tmp_path / "csv")), "id")[0] == ("0", " kept, \"as\" is ")
    preds = spark.createDataFrame([("k", "Bug", "Fixed", "Bug", "Fixed", 0.5, 0.25, "M", None)], ", ".join(
        f"{c} {t}" for c, t in tables.PREDICTION_SCHEMA.items()))
    assert rows(tables.write_predictions(preds, str(tmp_path / "preds"))) == [("k", "Bug", "Fixed", "Bug", "Fixed", 0.5, 0.25, "M", "")]


def test_seed(spark, tmp_path):
    path = write(tmp_path, "raw,label\nWon't Do,Won't Fix\n007,x\n")
    assert rows(delimited.load_seed(spark, path, ["raw", "label"]), "raw") == [("007", "x"), ("Won't Do", "Won't Fix")]
