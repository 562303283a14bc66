"""Registered queries for sources, operators and expressions."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions import dates, fixed_values as fv, labels, numbers, text
from tickloom.operators import aggregates as agg, filters, joins, ordering, quality, windows
from tickloom.operators.skew import MAX_GROUP_BYTES_CONF, MAX_GROUP_ROWS_CONF, ROW_BYTES, heavy_keys
from tickloom.plans import data_tests, eda, intermediate as mid, pipeline
from tickloom.session import checkpoint_dir
from tickloom.sources import delimited, lookups, parents, tables
from verify import adapter as ad
from verify.oracle import (
    TIES, case, clean, days, half_up, hours, in_list, kcase, q, sql, values,
)
from verify.queries import ORACLE, QUERIES, Models, register

c = F.col


def scratch(m: Models, name: str) -> str:
    return f"{checkpoint_dir(m.spark)}/scratch/{name}-{uuid.uuid4().hex}"


# ---- sources and sinks ------------------------------------------------------------

def _src01(m: Models) -> DataFrame:
    path = scratch(m, "comments")
    tables.export_csv(m.raw_comments().select("key", "comment_id", "comment_author", "comment_body"), path)
    return delimited.read_csv_table(m.spark, path)


register("src01_read_csv", _src01, sql("SELECT key, comment_id, comment_author, comment_body FROM raw_comments"))

register(
    "src02_null_tokens",
    lambda m: delimited.null_tokens(
        m.raw_issues().select("key", "id", "votes_votes", "watches_watchcount", "resolutiondate"),
        [*fv.NULL_TOKENS, "many"]).withColumn("open", c("resolutiondate").isNull()).drop("resolutiondate"),
    sql("""SELECT key, id, CASE WHEN votes IS NOT NULL THEN (votes - 1) || '.6' END AS votes_votes,
           CAST(watches AS VARCHAR) AS watches_watchcount, resolved_at IS NULL AS open FROM raw_issues"""))


def _src03(m: Models) -> DataFrame:
    dotted = m.raw_issues().select(*[c(v).alias(k) for k, v in fv.ISSUE_COLUMNS.items()], F.lit("x").alias("extra.column"))
    return delimited.select_contract(dotted, fv.ISSUE_COLUMNS).select(
        "id", "key", "summary", "description", "issuetype_name", "resolution_name", "priority_name", "status_name",
        "project_key", "reporter", "creator")


register("src03_select_contract", _src03, sql(
    """SELECT id, key, summary, description, issuetype_raw AS issuetype_name, resolution_raw AS resolution_name,
       priority AS priority_name, status AS status_name, project AS project_key, reporter, creator FROM raw_issues"""))


def _tolerant(m: Models) -> tuple[DataFrame, DataFrame]:
    """Orders as CSV; rows of one status lack the last field."""
    path = scratch(m, "orders")
    rows = m.table("orders").select(c("o_orderkey").cast("string").alias("key"), "o_orderstatus", "o_orderpriority")
    tables.export_csv(rows.filter("o_orderstatus <> 'P'"), f"{path}/whole")
    # The header names three columns, each row has two fields.
    short = F.concat_ws(",", "key", "o_orderstatus").alias("key,o_orderstatus,o_orderpriority")
    rows.filter("o_orderstatus = 'P'").select(short).write.options(header=True, sep="\u0001").csv(f"{path}/short")
    return delimited.read_tolerant(m.spark, f"{path}/*", rows.columns)


register("src04_read_tolerant_good", lambda m: _tolerant(m)[0],
         "SELECT CAST(o_orderkey AS VARCHAR) AS key, o_orderstatus, o_orderpriority FROM orders WHERE o_orderstatus <> 'P'")
register("src04_read_tolerant_rejected", lambda m: _tolerant(m)[1].select(c(delimited.BAD).alias("bad")),
         "SELECT o_orderkey || ',' || o_orderstatus AS bad FROM orders WHERE o_orderstatus = 'P'")



def _src05(m: Models) -> DataFrame:
    """Landed raw tables against the rows of the tables they come from."""
    landed = {"issues": (m.raw_issues(), "orders"), "changelog": (m.raw_changelog(), "events"),
              "comments": (m.raw_comments(), "conversations"), "parents": (m.raw_parents(), "orders")}
    return delimited.row_count_audit(
        {name: df for name, (df, _) in landed.items()}, {name: m.table(source).count() for name, (_, source) in landed.items()})


register("src05_row_count_audit", _src05, sql("SELECT * REPLACE (CASE WHEN rel_error <= 0.01 THEN 'OK' ELSE 'CHECK' END AS status) FROM ("
    + " UNION ALL ".join(
        f"""SELECT '{name}' AS table_name, n AS row_count, e AS expected, round(abs(n - e) / e::DOUBLE, 6) AS rel_error, '' AS status
            FROM (SELECT count(*) AS n FROM raw_{name}), (SELECT count(*) AS e FROM {source})"""
        for name, source in [("issues", "orders"), ("changelog", "events"), ("comments", "conversations"), ("parents", "orders")]) + ")"))


# Orders whose dates and prices are written in many forms, some of them unreadable.
_WRITTEN = """SELECT o_orderkey AS id, 'f' || (o_orderkey % 3) AS source,
    CASE o_orderkey % 11 WHEN 0 THEN strftime(d, '%Y-%m-%d') WHEN 1 THEN strftime(d, '%m/%d/%Y') WHEN 2 THEN strftime(d, '%Y%m%d')
      WHEN 3 THEN strftime(d, '%Y/%m/%d') WHEN 4 THEN strftime(d, '%d-%b-%Y') WHEN 5 THEN strftime(d, '%a, %d %b %Y') || ' 00:00:00 +0000'
      WHEN 6 THEN '10:30:00' WHEN 7 THEN '2021-02-30' WHEN 8 THEN 'soon' WHEN 9 THEN '' END AS written,
    CASE o_orderkey % 7 WHEN 0 THEN k WHEN 1 THEN k || '.6' WHEN 2 THEN '12345678901234' || lpad(k, 6, '0') WHEN 3 THEN 'many' WHEN 4 THEN repeat('9', 45)
      WHEN 5 THEN '' END AS number
    FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d, CAST(o_orderkey % 1000 AS VARCHAR) AS k FROM orders)"""


def _written(m: Models) -> DataFrame:
    """The same by Spark, through delimited files: each source is a folder of its own."""
    o, d, k = c("o_orderkey"), c("o_orderdate"), (c("o_orderkey") % 1000).cast("string")
    day = F.substring(F.date_format(d, "E"), 1, 3)
    forms = [F.date_format(d, "yyyy-MM-dd"), F.date_format(d, "MM/dd/yyyy"), F.date_format(d, "yyyyMMdd"), F.date_format(d, "yyyy/MM/dd"),
             F.date_format(d, "dd-MMM-yyyy"), F.concat(day, F.date_format(d, "', 'dd MMM yyyy' 00:00:00 +0000'")), F.lit("10:30:00"), F.lit("2021-02-30"),
             F.lit("soon"), F.lit("")]
    numbers_ = [k, F.concat(k, F.lit(".6")), F.concat(F.lit("12345678901234"), F.lpad(k, 6, "0")), F.lit("many"), F.lit("9" * 45), F.lit("")]
    pick = lambda of, n: F.get(F.array(*of), (o % n).cast("int"))
    return m.table("orders").select(o.alias("id"), F.concat(F.lit("f"), o % 3).alias("source"), pick(forms, 11).alias("written"), pick(numbers_, 7).alias("number"))


register("dt01_parse_forms", lambda m: _written(m).select("id", dates.parse_dated(c("written")).alias("p")).select("id", "p.value", "p.reason").withColumn(
    "value", c("value").cast("timestamp_ntz")),
    f"""SELECT id, CAST(CASE WHEN id % 11 < 6 THEN d END AS TIMESTAMP) AS value,
        CASE id % 11 WHEN 6 THEN 'no date' WHEN 7 THEN 'no such time' WHEN 8 THEN 'unknown form' END AS reason
        FROM ({_WRITTEN}) JOIN (SELECT o_orderkey AS id, CAST(o_orderdate AS DATE) AS d FROM orders) USING (id)""")
register("mth02_parse_number", lambda m: _written(m).select("id", numbers.parse_number(c("number")).alias("p")).select(
    "id", c("p.value").cast("string").alias("value"), "p.reason"),
    f"""SELECT id, CASE WHEN id % 7 IN (0, 2) THEN number WHEN id % 7 = 1 THEN CAST(id % 1000 + 1 AS VARCHAR) END AS value,
        CASE id % 7 WHEN 3 THEN 'not a number' WHEN 4 THEN 'more than 38 digits' END AS reason FROM ({_WRITTEN})""")


def _landed(m: Models) -> delimited.Landing:
    """Orders in three folders, each with rows that lack a field, landed with their accounting."""
    path = scratch(m, "written")
    rows = _written(m).withColumn("id", c("id").cast("string")).withColumn("number", F.coalesce("number", F.lit("None")))
    for source in ("f0", "f1", "f2"):
        own = rows.filter(c("source") == source).drop("source")
        whole, short = own.filter("id % 5 <> 0"), own.filter("id % 5 = 0")
        tables.export_csv(whole, f"{path}/{source}-whole")
        short.select(F.concat_ws(",", "id", F.lit("x")).alias("id,written,number")).write.options(header=True, sep="\u0001").csv(f"{path}/{source}-short")
    return delimited.land_counted(m.spark, f"{path}/*", {"id": "id", "written": "written", "number": "number"}, scratch(m, "raw"), multi_line=True)


def _source_of(file: str = "file") :
    return F.regexp_extract(file, "/(f[0-2])-(whole|short)/", 1)


register("src04_rows_by_file", lambda m: _landed(m).files().groupBy(_source_of().alias("source")).agg(
    F.sum("loaded").alias("loaded"), F.sum("rejected").alias("rejected")),
    f"SELECT source, count(*) FILTER (id % 5 <> 0) AS loaded, count(*) FILTER (id % 5 = 0) AS rejected FROM ({_WRITTEN}) GROUP BY 1")
register("src04_nulled_by_file", lambda m: _landed(m).nulled().groupBy(_source_of().alias("source"), "column_name").agg(F.sum("nulled").alias("nulled")),
    f"""SELECT source, 'number' AS column_name, count(*) AS nulled FROM ({_WRITTEN}) WHERE id % 5 <> 0 AND number IS NULL GROUP BY 1""")
register("src05_parse_losses", lambda m: _landed(m).losses({"written": dates.parse_dated, "number": numbers.parse_number}).groupBy(
    _source_of().alias("source"), "column_name", "reason").agg(F.sum("lost").alias("lost")),
    f"""SELECT source, column_name, reason, count(*) AS lost FROM (
        SELECT source, 'written' AS column_name, CASE id % 11 WHEN 6 THEN 'no date' WHEN 7 THEN 'no such time' WHEN 8 THEN 'unknown form' END AS reason
        FROM ({_WRITTEN}) WHERE id % 5 <> 0
        UNION ALL SELECT source, 'number', CASE id % 7 WHEN 3 THEN 'not a number' WHEN 4 THEN 'more than 38 digits' END FROM ({_WRITTEN}) WHERE id % 5 <> 0)
        WHERE reason IS NOT NULL GROUP BY ALL""")


def _src06(m: Models) -> DataFrame:
    path = scratch(m, "seed")
    tables.export_csv(m.types(), path)
    seed = delimited.load_seed(m.spark, path, ["issuetype_raw", "issuetype"])
    issues = m.raw_issues().select("id", "key", c("issuetype_name").alias("issuetype_raw"))
    return joins.map_label(issues, seed, "issuetype_raw", "issuetype")


register("src06_load_seed", _src06, sql(
    "SELECT id, key, issuetype_raw, issuetype FROM raw_issues LEFT JOIN type_map USING (issuetype_raw)"))
register("src07_load_parent_keys", lambda m: parents.load_parent_keys(ad.raw_parent_keys(m.spark, m.sf_dir, whole=True)),
         sql("SELECT key, parent_key, CAST(CASE WHEN has_parent >= 1 THEN 1 ELSE 0 END AS INTEGER) AS has_parent FROM every_parent"))
register("src08_materialize", lambda m: tables.materialize(m.analytics(), "intermediate", "issues_analytics", scratch(m, "layers")),
         sql("SELECT * FROM analytics"))


def _rule_predictions(m: Models) -> DataFrame:
    from tickloom.ml.rules import rule_predict

    tickets = filters.in_splits(m.cleaned(), ["train", "validation"])
    return rule_predict(tickets, "summary", "description").select(
        "key", c("issuetype").alias("true_issuetype"), c("resolution").alias("true_resolution"),
        "pred_issuetype", "pred_resolution", F.lit(1.0).alias("conf_issuetype"), F.lit(1.0).alias("conf_resolution"),
        F.lit("RULES").alias("method"), F.lit(None).cast("string").alias("fix_summary"))


PREDICTIONS = """SELECT key, issuetype AS true_issuetype, resolution AS true_resolution, pred_issuetype, pred_resolution,
    1.0::DOUBLE AS conf_issuetype, 1.0::DOUBLE AS conf_resolution, 'RULES' AS method, '' AS fix_summary FROM predicted"""
def _land_raw(m: Models, raw: DataFrame, contract: dict[str, str]) -> DataFrame:
    """A raw table as two folders of files with opposite orders of columns, landed by name."""
    path = scratch(m, "export")
    dotted = raw.select(*[c(new).alias(name) for name, new in contract.items()], F.lit("x").alias("extra.column"))
    odd = F.crc32(F.coalesce("key", F.lit(""))) % 2
    tables.export_csv(dotted.filter(odd == 0), f"{path}/a")
    tables.export_csv(dotted.filter(odd == 1).select(*[f"`{n}`" for n in reversed(dotted.columns)]), f"{path}/b")
    return delimited.land_raw(m.spark, f"{path}/*", contract, scratch(m, "raw"), multi_line=True)[0]


register("src08_land_raw_issues", lambda m: _land_raw(m, m.raw_issues(), fv.ISSUE_COLUMNS).select(
    "id", "key", "summary", "description", "issuetype_name", "resolution_name", "status_name", "project_key", "reporter", "creator"),
    sql("""SELECT id, key, nullif(summary, '') AS summary, nullif(description, '') AS description, issuetype_raw AS issuetype_name,
           resolution_raw AS resolution_name, status AS status_name, project AS project_key, reporter, creator FROM raw_issues"""))
register("src08_land_raw_comments", lambda m: _land_raw(m, m.raw_comments(), fv.COMMENT_COLUMNS).select(
    "key", "comment_id", "comment_author", "comment_body"),
    sql("SELECT key, comment_id, comment_author, nullif(comment_body, '') AS comment_body FROM raw_comments"))
register("src08_land_raw_changelog", lambda m: _land_raw(m, m.raw_changelog(), fv.CHANGELOG_COLUMNS).drop("created"),
    sql("""SELECT key, author, field, from_string AS fromstring, to_string AS tostring, upper(field) AS field_norm FROM raw_changelog"""))
register("src08_land_raw_issuelinks", lambda m: _land_raw(m, m.raw_issuelinks(), fv.ISSUELINK_COLUMNS), sql("SELECT * FROM raw_issuelinks"))
register("src09_write_predictions", lambda m: tables.write_predictions(_rule_predictions(m), scratch(m, "predictions")),
         sql(PREDICTIONS))


def _src10(m: Models) -> DataFrame:
    path = scratch(m, "export")
    mart = m.mart_ml().select("key", "split", "issuetype", "resolution", "text_for_it", "n_comments")
    tables.export_csv(mart, path)
    return delimited.read_csv_table(m.spark, path).withColumn("n_comments", c("n_comments").cast("bigint"))


register("src10_export_csv", _src10, sql("SELECT key, split, issuetype, resolution, text_for_it, n_comments FROM mart_ml"))

# ---- projections and filters ---------------------------------------------------------

register("prj01_rename_cast", lambda m: m.raw_changelog().select(
    "key", dates.parse_timestamp(c("created")).alias("created"), c("fromstring").alias("from_string"),
    c("tostring").alias("to_string")), sql("SELECT key, created, from_string, to_string FROM raw_changelog"))
register("prj02_pass_through", lambda m: m.transitions().withColumns({"long": numbers.flag(c("hours_in_from_status") > 24)}),
         sql("SELECT *, CASE WHEN hours_in_from_status > 24 THEN 1 ELSE 0 END AS long FROM transitions"))
register("flt01_project", lambda m: m.raw_issues().filter(c("project_key") == ad.PROJECT).select("id", "key"),
         sql("SELECT id, key FROM raw_issues WHERE project = 'CORE'"))
register("flt02_filter_ci", lambda m: filters.filter_ci(m.raw_changelog(), "field", fv.CHANGELOG_FIELDS)
         .select("key", "field", "tostring"),
         sql(f"SELECT key, field, to_string AS tostring FROM raw_changelog WHERE upper(field) IN {in_list(fv.CHANGELOG_FIELDS)}"))
register("flt03_not_blank", lambda m: m.raw_issues().filter(text.not_blank(c("priority_name"))).select("id", "key", "priority_name"),
         sql("SELECT id, key, priority AS priority_name FROM raw_issues WHERE priority IS NOT NULL AND trim(priority, ' ') <> ''"))
register("flt04_min_len", lambda m: filters.with_min_length(
    m.table("documents"), "clean", text.clean_text(c("text")), fv.MIN_COMMENT_LENGTH).select("doc_id", "clean"),
         f"SELECT * FROM (SELECT doc_id, {clean('text')} AS clean FROM documents) WHERE length(clean) >= 10")
register("flt05_not_null", lambda m: m.analytics().filter(c("resolved_at").isNotNull()).select("key", "resolved_at"),
         sql("SELECT key, resolved_at FROM analytics WHERE resolved_at IS NOT NULL"))
register("flt06_sentinel", lambda m: m.analytics().filter(c("assignee") != "Unassigned").select("key", "assignee"),
         sql("SELECT key, assignee FROM analytics WHERE assignee <> 'Unassigned'"))
register("flt07_splits", lambda m: filters.in_splits(m.cleaned(), ["train", "validation"]).select("key", "split"),
         sql("SELECT key, split FROM cleaned WHERE split IN ('train', 'validation')"))
register("flt08_years", lambda m: m.table("orders").filter(filters.in_years(c("o_orderdate"), 1996, 1999)).select("o_orderkey", "o_orderdate"),
         "SELECT o_orderkey, o_orderdate FROM orders WHERE year(o_orderdate) BETWEEN 1996 AND 1999")

# ---- joins -----------------------------------------------------------------------------

register("j01_left_semi", lambda m: joins.keep_known(m.raw_issuelinks(), m.keys()).select("key", "type_name"),
         sql("SELECT key, type_name FROM raw_issuelinks WHERE key IN (SELECT key FROM raw_issues WHERE project = 'CORE')"))
register("j02_lookup", lambda m: joins.map_label(joins.map_label(
    m.stg_issues(), m.types(), "issuetype_raw", "issuetype", "Other"), m.resolutions(), "resolution_raw", "resolution")
    .select("key", "issuetype", "resolution"), sql("SELECT key, issuetype, resolution FROM labelled"))
register("j03_inner", lambda m: m.stg_changelog().join(m.analytics().select("key", "issuetype"), "key").select("key", "field", "issuetype"),
         sql("SELECT key, field, issuetype FROM stg_changelog JOIN analytics USING (key)"))
register("j04_wide_join", lambda m: joins.wide_join(
    m.analytics().select("key", "issuetype"),
    [m.comments().select("key", "n_comments"), m.link_features().select("key", "n_links_total"), m.parents()]),
    sql("""SELECT key, issuetype, n_comments, n_links_total, parent_key, has_parent FROM analytics
           LEFT JOIN comments USING (key) LEFT JOIN link_features USING (key) LEFT JOIN parents USING (key)"""))


def _daily_counts(m: Models, column: str, name: str) -> DataFrame:
    return m.analytics().groupBy(dates.day_of(c(column)).alias("day")).agg(F.count("*").alias(name))


register("j05_full_align", lambda m: joins.full_align([
    _daily_counts(m, "created_at", "created"), _daily_counts(m, "resolved_at", "resolved"),
    m.stg_changelog().groupBy(dates.day_of(c("created")).alias("day")).agg(F.count("*").alias("changed"))], "day"),
    sql("""SELECT day, created, resolved, changed FROM (SELECT CAST(created_at AS DATE) AS day, count(*) AS created FROM analytics GROUP BY 1)
           FULL JOIN (SELECT CAST(resolved_at AS DATE) AS day, count(*) AS resolved FROM analytics GROUP BY 1) USING (day)
           FULL JOIN (SELECT CAST(created AS DATE) AS day, count(*) AS changed FROM stg_changelog GROUP BY 1) USING (day)"""))
register("j06_next_change", lambda m: windows.lag_in_order(
    m.stg_changelog().select("key", "created", "from_string", "to_string", "author", "field"), ["key"],
    ["created", *mid.CHANGE_TIES], {"previous_field": "field", "previous_at": "created"}),
    sql(f"""SELECT key, created, from_string, to_string, author, field, lag(field) OVER w AS previous_field, lag(created) OVER w AS previous_at
            FROM stg_changelog WINDOW w AS (PARTITION BY key ORDER BY created NULLS LAST, {TIES})"""))
register("j07_attach_first", lambda m: m.cleaned().select("key").join(mid.first_assignee(m.stg_changelog()), "key", "left"),
         sql("SELECT key, first_assignee FROM cleaned LEFT JOIN first_assignee USING (key)"))
register("j08_left_anti", lambda m: joins.keep_new(m.stg_issues().select("key"), m.raw_parents()),
         sql("SELECT key FROM stg_issues WHERE key NOT IN (SELECT key FROM raw_parents)"))
register("j09_enrich_parent", lambda m: joins.enrich_parent(m.cleaned().select("key", "issuetype"), m.raw_parents()),
         sql("SELECT key, issuetype, coalesce(has_parent, 0) AS has_parent FROM cleaned LEFT JOIN parents USING (key)"))

# ---- aggregations ------------------------------------------------------------------------

_resolved_days = lambda: F.when(c("is_resolved") == 1, c("resolution_days"))
SQL_DAYS = "CASE WHEN is_resolved = 1 THEN resolution_days END"
register("agg01_group_count", lambda m: m.raw_changelog().groupBy("key", "field").agg(F.count("*").alias("n")),
         sql("SELECT key, field, count(*) AS n FROM raw_changelog GROUP BY key, field"))
register("agg02_count_if", lambda m: m.raw_issuelinks().groupBy("key").agg(
    F.count_if(text.upper_is(c("type_name"), "DUPLICATE")).alias("n_duplicates"),
    F.count_if(text.upper_is(c("type_name"), "BLOCKER")).alias("n_blocks")),
    sql("""SELECT key, count(*) FILTER (upper(type_name) = 'DUPLICATE') AS n_duplicates,
           count(*) FILTER (upper(type_name) = 'BLOCKER') AS n_blocks FROM raw_issuelinks GROUP BY key"""))
register("agg03_count_distinct", lambda m: m.raw_changelog().groupBy("key").agg(F.count_distinct("author").alias("people")),
         sql("SELECT key, count(DISTINCT author) AS people FROM raw_changelog GROUP BY key"))
register("agg04_conditional_distinct", lambda m: m.fix_versions().groupBy("version_major", "is_resolved", "key").agg(F.lit(1).alias("x"))
         .groupBy("version_major").agg(F.count_distinct("key").alias("n_issues"),
                                       F.count_distinct(F.when(c("is_resolved") == 1, c("key"))).alias("n_resolved")),
         sql("""SELECT version_major, count(DISTINCT key) AS n_issues,
                count(DISTINCT CASE WHEN is_resolved = 1 THEN key END) AS n_resolved FROM fix_versions GROUP BY 1"""))
register("agg05_min_max", lambda m: m.stg_comments().groupBy("key").agg(
    F.min("comment_created").alias("first_at"), F.max("comment_created").alias("last_at")),
    sql("SELECT key, min(comment_created) AS first_at, max(comment_created) AS last_at FROM stg_comments GROUP BY key"))
register("agg06_sum_complement", lambda m: m.analytics().groupBy("reporter").agg(
    F.sum("is_resolved").alias("n_resolved"), (F.count("*") - F.sum("is_resolved")).alias("n_open")),
    sql("""SELECT reporter, sum(is_resolved)::BIGINT AS n_resolved, (count(*) - sum(is_resolved))::BIGINT AS n_open
           FROM analytics GROUP BY 1"""))
register("agg07_mean", lambda m: m.analytics().groupBy("reporter").agg(agg.mean(_resolved_days()).alias("avg_days")),
         sql(f"SELECT reporter, {half_up(f'sum({SQL_DAYS})', f'count({SQL_DAYS})', 1)} AS avg_days FROM analytics GROUP BY 1"))
register("agg08_median", lambda m: agg.counted(m.analytics(), ["reporter"], [_resolved_days().alias("days")])
         .groupBy("reporter").agg(agg.median(c("days")).alias("median_days")),
         sql(f"SELECT reporter, round(median({SQL_DAYS}), 1) AS median_days FROM analytics GROUP BY 1"))
register("agg09_mode", lambda m: agg.mode(m.analytics(), ["reporter"], "issuetype", "top_type"),
         sql("""SELECT reporter, issuetype AS top_type FROM analytics GROUP BY reporter, issuetype
                QUALIFY row_number() OVER (PARTITION BY reporter ORDER BY count(*) DESC, issuetype) = 1"""))
register("agg10_pct", lambda m: m.analytics().groupBy("reporter").agg(
    numbers.pct(F.count_if((c("is_resolved") == 1) & (c("resolution") == "Fixed")), F.sum("is_resolved")).alias("fixed_pct")),
    sql(f"""SELECT reporter, {half_up("100 * count(*) FILTER (is_resolved = 1 AND resolution = 'Fixed')", 'sum(is_resolved)', 2)} AS fixed_pct
            FROM analytics GROUP BY 1"""))
register("agg11_concat_ordered", lambda m: agg.concat_in_order(
    m.table("conversations"), "conv_id", ["turn"], "text", "transcript", " | ", 3000),
    "SELECT conv_id, left(string_agg(text, ' | ' ORDER BY turn), 3000) AS transcript FROM conversations GROUP BY 1")
register("agg12_profile", lambda m: agg.profile(m.mart_ml()), sql(
    """SELECT count(*) AS total, count(*) FILTER (split = 'train') AS train, count(*) FILTER (split = 'validation') AS validation,
       count(*) FILTER (has_parent = 1) AS with_parent,
       count(*) FILTER (issuetype = 'Sub-task' AND has_parent = 1) AS subtask_with_parent FROM mart_ml"""))
register("agg13_flag_rate", lambda m: agg.flag_rate(
    joins.enrich_parent(m.cleaned(), m.raw_parents()), "issuetype", "has_parent", "parent_pct"),
    sql(f"""SELECT issuetype, {half_up('100 * sum(coalesce(has_parent, 0))', 'count(*)', 1)} AS parent_pct
            FROM cleaned LEFT JOIN parents USING (key) GROUP BY 1"""))
register("agg13_prefix_rate", lambda m: agg.prefix_rate(m.mart_ml().select(
    "issuetype", text.signal_text(c("text_for_it"), c("summary_clean"), c("has_parent")).alias("text")),
    "issuetype", "text", "[HAS-PARENT]", "parent_pct"),
    sql(f"""SELECT issuetype, {half_up("100 * count(*) FILTER (has_parent = 1)", 'count(*)', 1)} AS parent_pct
            FROM mart_ml GROUP BY 1"""))
register("agg14_year_range", lambda m: eda.overview(m.analytics(), 1996, 2000), sql(
    """SELECT count(*) AS total, count(*) FILTER (is_resolved = 1) AS resolved,
       CAST(min(year(created_at)) FILTER (year(created_at) BETWEEN 1996 AND 2000) AS INTEGER) AS first_year,
       CAST(max(year(created_at)) FILTER (year(created_at) BETWEEN 1996 AND 2000) AS INTEGER) AS last_year FROM analytics"""))
register("agg15_distinct_keys", lambda m: agg.distinct_keys(m.raw_changelog()), sql("SELECT DISTINCT key FROM raw_changelog"))

# ---- windows ---------------------------------------------------------------------------------

register("win01_dedup", lambda m: windows.dedup(m.raw_issues().select("key", "id", "summary"), ["key"], ["id", "summary"]),
         sql("SELECT key, id, summary FROM raw_issues QUALIFY row_number() OVER (PARTITION BY key ORDER BY id) = 1"))
register("win02_sequence", lambda m: windows.number_in_order(
    m.stg_changelog().select("key", "created", "from_string", "to_string", "author"), ["key"],
    ["created", *mid.CHANGE_TIES], "change_order", m.heavy("changelog")),
    sql(f"""SELECT key, created, from_string, to_string, author,
            row_number() OVER (PARTITION BY key ORDER BY created NULLS LAST, {TIES}) AS change_order FROM stg_changelog"""))
register("win03_was_escalated", lambda m: m.stg_changelog().select("key").distinct().join(
    mid.escalation(m.stg_changelog()), "key", "left").withColumn("was_escalated", numbers.zero_if_null(c("was_escalated"))),
    sql("""SELECT key, coalesce(was_escalated, 0) AS was_escalated FROM (SELECT DISTINCT key FROM stg_changelog)
           LEFT JOIN escalation USING (key)"""))
register("win04_first_assignee", lambda m: mid.first_assignee(m.stg_changelog()), sql("SELECT * FROM first_assignee"))
register("win05_previous_time", lambda m: windows.lag_in_order(
    m.table("events").select("user_id", "ts", "event_id"), ["user_id"], ["ts", "event_id"], {"previous_ts": "ts"}),
    "SELECT user_id, ts, event_id, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS previous_ts FROM events")


def _orders_per_day(m: Models) -> DataFrame:
    return m.table("orders").groupBy(F.to_date("o_orderdate").alias("day")).agg(F.count("*").alias("n"))


PER_DAY = "(SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS n FROM orders GROUP BY 1)"
register("win06_cumulative", lambda m: _orders_per_day(m).withColumn("total", windows.cumulative(c("n"), "day")),
         f"SELECT day, n, CAST(sum(n) OVER (ORDER BY day ROWS UNBOUNDED PRECEDING) AS BIGINT) AS total FROM {PER_DAY}")
register("win07_rolling_avg", lambda m: _orders_per_day(m).withColumn("mean7", windows.rolling_avg(c("n"), "day", 7)),
         f"""SELECT day, n, {half_up('sum(n) OVER w', 'count(*) OVER w', 1)} AS mean7 FROM {PER_DAY}
             WINDOW w AS (ORDER BY day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""")
register("win08_share_of_max", lambda m: _orders_per_day(m).withColumn("intensity", windows.share_of_max(c("n"))),
         f"SELECT day, n, {half_up('100 * n', 'max(n) OVER ()', 1)} AS intensity FROM {PER_DAY}")
register("win09_share_of_sum", lambda m: m.table("lineitem").groupBy("l_returnflag").agg(F.count("*").alias("n"))
         .withColumn("pct", windows.share_of_sum(c("n"))),
         f"""SELECT l_returnflag, n, {half_up('100 * n', 'sum(n) OVER ()', 1)} AS pct
             FROM (SELECT l_returnflag, count(*) AS n FROM lineitem GROUP BY 1)""")

# ---- orders, top-k, sets ------------------------------------------------------------------------

register("ord01_order_desc", lambda m: m.raw_changelog().groupBy("field").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "field"),
         sql("SELECT field, count(*) AS n FROM raw_changelog GROUP BY field ORDER BY n DESC, field"))
register("ord02_order_asc", lambda m: m.raw_issuelinks().groupBy("type_name", "inwardissue_key").agg(F.count("*").alias("n"))
         .orderBy("type_name", "inwardissue_key"),
         sql("SELECT type_name, inwardissue_key, count(*) AS n FROM raw_issuelinks GROUP BY 1, 2 ORDER BY 1, 2"))
register("ord03_order_by_list", lambda m: ordering.order_by_list(
    m.analytics().groupBy("priority").agg(F.count("*").alias("n")), "priority", fv.PRIORITIES_REPORT_ORDER)
    .withColumn("place", labels.list_position(c("priority"), fv.PRIORITIES_REPORT_ORDER)),
    sql(f"""SELECT priority, count(*) AS n, CAST(coalesce(list_position([{', '.join(map(q, fv.PRIORITIES_REPORT_ORDER))}], priority) - 1, 5)
            AS INTEGER) AS place FROM analytics GROUP BY priority"""))
register("ord04_similar_refs", lambda m: ordering.similar_refs(
    m.cleaned().withColumnRenamed("summary", "summary_clean"), "Bug", 3), sql(
    """SELECT key, summary AS summary_clean, issuetype, resolution, 0.0::DOUBLE AS similarity, 'mart' AS source
       FROM cleaned WHERE issuetype = 'Bug' ORDER BY key LIMIT 3"""))
register("ord04_similar_refs_per_type", lambda m: ordering.similar_refs_per_type(
    m.cleaned().withColumnRenamed("summary", "summary_clean"), 3), sql(
    """SELECT key, summary AS summary_clean, issuetype, resolution, 0.0::DOUBLE AS similarity, 'mart' AS source
       FROM cleaned QUALIFY row_number() OVER (PARTITION BY issuetype ORDER BY key) <= 3"""))
register("set01_union_all", lambda m: m.raw_issues().select("key").unionByName(m.raw_issuelinks().select("key"))
         .groupBy("key").agg(F.count("*").alias("n")),
         sql("""SELECT key, count(*) AS n FROM (SELECT key FROM raw_issues UNION ALL SELECT key FROM raw_issuelinks) GROUP BY key"""))


def _set02(m: Models) -> DataFrame:
    fetched = m.raw_parents()
    batch = m.stg_issues().select("key", F.lit(None).cast("string").alias("parent_key"), F.lit(0).alias("has_parent"))
    return parents.append_new(fetched, batch)


register("set02_append_new", _set02, sql(
    """SELECT key, parent_key, has_parent FROM raw_parents UNION ALL
       SELECT key, NULL, 0 FROM stg_issues WHERE key NOT IN (SELECT key FROM raw_parents)"""))

# ---- scalar expressions -------------------------------------------------------------------------

register("str01_clean_documents", lambda m: m.table("documents").select("doc_id", text.clean_text(c("text")).alias("clean")),
         f"SELECT doc_id, {clean('text')} AS clean FROM documents")
register("str01_clean_pages", lambda m: m.table("pages").select("page_id", text.clean_text(c("html")).alias("clean")),
         f"SELECT page_id, {clean('html')} AS clean FROM pages")
register("str02_blank_to", lambda m: m.raw_issues().select("id", "key", text.blank_to(c("assignee"), "Unassigned").alias("assignee")),
         sql("SELECT id, key, assignee FROM raw_issues"))
register("str03_raw_length", lambda m: m.raw_issues().select("id", "key", text.raw_length(c("description")).alias("n")),
         sql("SELECT id, key, CAST(length(coalesce(description, '')) AS INTEGER) AS n FROM raw_issues"))
register("str04_upper_is", lambda m: m.raw_issuelinks().select("key", "type_name", numbers.flag(text.upper_is(c("type_name"), "DUPLICATE")).alias("dup")),
         sql("SELECT key, type_name, CASE WHEN upper(type_name) = 'DUPLICATE' THEN 1 ELSE 0 END AS dup FROM raw_issuelinks"))
_versions = lambda m: m.raw_changelog().filter(c("field") == "Fix Version/s")
VERSION_ROWS = "FROM raw_changelog WHERE field = 'Fix Version/s'"
register("str05_version_minor", lambda m: _versions(m).select("key", "tostring", text.version_minor(c("tostring")).alias("minor")),
         sql(rf"SELECT key, to_string AS tostring, nullif(regexp_extract(to_string, '^[0-9]+\.[0-9]+'), '') AS minor {VERSION_ROWS}"))
register("str06_version_major", lambda m: _versions(m).select("key", "tostring", text.version_major(c("tostring")).alias("major")),
         sql(f"""SELECT key, to_string AS tostring, CASE WHEN starts_with(to_string, '1.') THEN '1.x' WHEN starts_with(to_string, '2.') THEN '2.x'
                 WHEN starts_with(to_string, '3.') THEN '3.x' WHEN starts_with(to_string, '4.') THEN '4.x' ELSE 'Other' END AS major {VERSION_ROWS}"""))
register("str07_release_candidate", lambda m: _versions(m).select("key", "tostring", text.is_release_candidate(c("tostring")).alias("rc")),
         sql(f"SELECT key, to_string AS tostring, CASE WHEN contains(lower(to_string), '-rc') THEN 1 ELSE 0 END AS rc {VERSION_ROWS}"))
for _n, _name in (("08", "text_for_it"), ("09", "text_for_res"), ("10", "text_noco")):
    register(f"str{_n}_{_name}", lambda m, name=_name: m.mart_ml().select("key", name), sql(f"SELECT key, {_name} FROM mart_ml"))
register("str11_duration_label", lambda m: m.stg_issues().select(
    "key", text.duration_label(c("status"), c("watches") / 4.0).alias("label")),
    sql("""SELECT key, CASE WHEN watches IS NOT NULL THEN status || ' (moy. ' || printf('%.1f', floor(watches * 2.5 + 0.5) / 10.0) || 'j)' END AS label
           FROM stg_issues"""))
_signal = lambda words: "(" + " OR ".join(f"contains(lower(summary_clean), {q(w)})" for w in words) + ")"
register("str12_signal_text", lambda m: m.mart_ml().select(
    "key", text.signal_text(c("text_for_it"), c("summary_clean"), c("has_parent")).alias("text")),
    sql(f"""SELECT key, left(CASE WHEN has_parent = 1 THEN '[HAS-PARENT] ' ELSE '[NO-PARENT] ' END
            || CASE WHEN {_signal(fv.SUMMARY_SIGNALS[0][0])} THEN '[BUG-SIGNAL] '
                    WHEN {_signal(fv.SUMMARY_SIGNALS[1][0])} THEN '[IMPROVEMENT-SIGNAL] ' ELSE '' END
            || text_for_it, 512) AS text FROM mart_ml"""))

register("dt01_parse_timestamp", lambda m: m.raw_issues().select("id", "key", dates.parse_timestamp(c("created")).alias("at")),
         sql("SELECT id, key, created_at AS at FROM raw_issues"))
register("dt02_day_diff", lambda m: m.stg_issues().select("key", dates.day_diff(c("created_at"), c("resolved_at")).alias("n")),
         sql(f"SELECT key, CAST({days('created_at', 'resolved_at')} AS INTEGER) AS n FROM stg_issues"))
register("dt03_hour_diff", lambda m: m.stg_issues().select("key", dates.hour_diff(c("created_at"), c("resolved_at")).alias("n")),
         sql(f"SELECT key, {hours('created_at', 'resolved_at')} AS n FROM stg_issues"))
register("dt04_truncate", lambda m: m.table("events").select(
    "event_id", F.date_trunc("month", "ts").alias("month"), F.date_trunc("year", "ts").alias("year"), dates.day_of(c("ts")).alias("day")),
    """SELECT event_id, CAST(date_trunc('month', ts) AS TIMESTAMP) AS month, CAST(date_trunc('year', ts) AS TIMESTAMP) AS year,
       CAST(ts AS DATE) AS day FROM events""")
register("dt05_calendar_parts", lambda m: m.table("orders").select(
    "o_orderkey", dates.day_of_week(c("o_orderdate")).alias("dow"), dates.iso_week(c("o_orderdate")).alias("week"), F.year("o_orderdate").alias("year")),
    """SELECT o_orderkey, CAST(dayofweek(o_orderdate) AS INTEGER) AS dow, CAST(weekofyear(o_orderdate) AS INTEGER) AS week,
       CAST(year(o_orderdate) AS INTEGER) AS year FROM orders""")
register("dt06_age_days", lambda m: m.stg_issues().select(
    "key", dates.age_days(c("created_at"), c("resolved_at"), F.lit(ad.AS_OF).cast("timestamp"), 1000).alias("age")),
    sql(f"""SELECT key, CAST(CASE WHEN created_at IS NOT NULL THEN least({days('created_at', f"coalesce(resolved_at, TIMESTAMP '{ad.AS_OF}')")}, 1000) END AS INTEGER) AS age
            FROM stg_issues"""))
register("mth01_cap_floor", lambda m: m.analytics().select(
    "key", numbers.cap(c("resolution_days"), 500).alias("capped"), numbers.at_least(c("resolution_days"), 0).alias("floored")),
    sql("""SELECT key, CASE WHEN resolution_days > 500 THEN 500 ELSE resolution_days END AS capped,
           CASE WHEN resolution_days < 0 THEN 0 ELSE resolution_days END AS floored FROM analytics"""))
register("mth02_try_number", lambda m: m.raw_issues().select("id", "key", numbers.try_number(c("votes_votes")).alias("votes")),
         sql("SELECT id, key, votes FROM raw_issues"))
register("mth03_fill_clip", lambda m: m.analytics().select("key", numbers.fill_clip(c("resolution_days"), 300).alias("x")),
         sql("SELECT key, least(coalesce(resolution_days, 0), 300)::DOUBLE AS x FROM analytics"))
register("mth04_zero_defaults", lambda m: m.analytics().join(m.comments(), "key", "left").select("key", numbers.zero_if_null(c("n_comments")).alias("n")),
         sql("SELECT key, coalesce(n_comments, 0) AS n FROM analytics LEFT JOIN comments USING (key)"))
register("cnd01_temporal_split", lambda m: m.stg_issues().select(
    "key", labels.temporal_split(c("created_at"), ad.TRAIN_BEFORE, ad.VALIDATION_BEFORE).alias("split")),
    sql(f"""SELECT key, CASE WHEN created_at IS NULL THEN 'excluded' WHEN created_at < TIMESTAMP '{ad.TRAIN_BEFORE}' THEN 'train'
            WHEN created_at < TIMESTAMP '{ad.VALIDATION_BEFORE}' THEN 'validation' ELSE 'excluded' END AS split FROM stg_issues"""))
register("cnd02_priority_rank", lambda m: m.raw_changelog().filter(c("field") == "Priority").select("key", "tostring", labels.priority_rank(c("tostring")).alias("rank")),
         sql("""SELECT key, to_string AS tostring, CAST(nullif(list_position(['TRIVIAL','MINOR','MAJOR','CRITICAL','BLOCKER'], upper(to_string)), 0) AS INTEGER) AS rank
                FROM raw_changelog WHERE field = 'Priority'"""))
register("cnd03_is_reopen", lambda m: m.raw_changelog().filter(c("field") == "status").select(
    "key", "fromstring", "tostring", labels.is_reopen(c("fromstring"), c("tostring")).alias("reopen")),
    sql("""SELECT key, from_string AS fromstring, to_string AS tostring,
           CASE WHEN upper(to_string) = 'REOPENED' AND upper(from_string) IN ('RESOLVED', 'CLOSED') THEN 1 ELSE 0 END AS reopen
           FROM raw_changelog WHERE field = 'status'"""))
register("cnd04_merge_rare", lambda m: m.analytics().select(
    "key", labels.merge_rare(c("issuetype"), fv.RARE_ISSUETYPES_5).alias("five"), labels.merge_rare(c("issuetype"), fv.RARE_ISSUETYPES_4).alias("four")),
    sql(f"""SELECT key, CASE WHEN issuetype IN {in_list(fv.RARE_ISSUETYPES_5)} THEN 'Other' ELSE issuetype END AS five,
            CASE WHEN issuetype IN ('Bug', 'Improvement', 'Sub-task') THEN issuetype ELSE 'Other' END AS four FROM analytics"""))
register("cnd05_confidence_band", lambda m: m.table("orders").select("o_orderkey", labels.confidence_band(c("o_totalprice") / 500000).alias("band")),
         """SELECT o_orderkey, CASE WHEN o_totalprice / 500000 >= 0.65 THEN 'High' WHEN o_totalprice / 500000 >= 0.45 THEN 'Medium' ELSE 'Low' END AS band
            FROM orders""")
register("jsn01_parse_parent", lambda m: parents.parents_from_payloads(ad.parent_payloads(m.spark, m.sf_dir)),
         sql("""SELECT key, parent_key, CASE WHEN has_parent = -1 THEN -1 WHEN parent_key IS NULL THEN 0 ELSE 1 END AS has_parent
         FROM every_parent"""))

# ---- data quality ---------------------------------------------------------------------------------

register("dq01_unique", lambda m: quality.check_unique(m.raw_issues(), "key"),
         sql("SELECT key, count(*) AS n FROM raw_issues GROUP BY key HAVING count(*) > 1"))
register("dq02_not_null", lambda m: quality.check_not_null(m.stg_issues(), "created_at").select("key", "status"),
         sql("SELECT key, status FROM stg_issues WHERE created_at IS NULL"))
register("dq03_accepted_values", lambda m: quality.check_accepted(m.raw_changelog(), "field", ["status", "Priority", "assignee"]),
         sql("SELECT field, count(*) AS n FROM raw_changelog WHERE field NOT IN ('status', 'Priority', 'assignee') GROUP BY field"))
register("dq04_relationships", lambda m: quality.check_fk(m.raw_issuelinks(), "key", m.stg_issues(), "key"),
         sql("SELECT key, count(*) AS n FROM raw_issuelinks WHERE key NOT IN (SELECT key FROM stg_issues) GROUP BY key"))

CTE_OF = {
    "issues_cleaned": "cleaned", "comments_aggregated": "comments", "issuelinks_features": "link_features", "mart_ops": "ops",
    "mart_workload": "workload", "mart_links": "links", "mart_transitions_sankey": "sankey", "mart_transitions_time": "state_time",
    "mart_versions": "versions", "mart_calendar": "calendar",
}


def _build(m: Models) -> dict[str, DataFrame]:
    settings = pipeline.Settings(ad.PROJECT, ad.AS_OF, ad.TRAIN_BEFORE, ad.VALIDATION_BEFORE)
    return pipeline.build(m.raw_issues(), m.raw_comments(), m.raw_changelog(), m.raw_issuelinks(), m.raw_parents(),
                          settings, scratch(m, "build"))


def _suite_sql() -> str:
    rows = []
    for t in data_tests.data_tests(ad.PROJECT):
        name = CTE_OF.get(t.model, t.model)
        col = t.column
        if t.kind == "not_null":
            count = f"(SELECT count(*) FROM {name} WHERE {col} IS NULL)"
        elif t.kind == "unique":
            count = f"(SELECT count(*) FROM (SELECT {col} FROM {name} WHERE {col} IS NOT NULL GROUP BY {col} HAVING count(*) > 1))"
        elif t.kind == "accepted_values":
            listed = ", ".join(q(v) if isinstance(v, str) else str(v) for v in t.values)
            count = f"(SELECT count(DISTINCT {col}) FROM {name} WHERE {col} NOT IN ({listed}))"
        else:
            parent = CTE_OF.get(t.parent, t.parent)
            count = f"(SELECT count(*) FROM {name} WHERE {col} NOT IN (SELECT {t.parent_column} FROM {parent}))"
        rows.append(f"SELECT '{t.model}' AS model, '{col}' AS \"column\", '{t.kind}' AS test, '{t.severity}' AS severity, {count} AS failures")
    body = " UNION ALL ".join(rows)
    return sql(f"""SELECT *, CASE WHEN failures = 0 THEN 'PASS' WHEN severity = 'warn' THEN 'WARN' ELSE 'ERROR' END AS status FROM ({body})""")


register("dq05_suite", lambda m: quality.run_suite(_build(m), data_tests.data_tests(ad.PROJECT)), _suite_sql())
register("dq06_value_counts", lambda m: quality.value_counts(
    m.raw_issues().filter(c("project_key") == ad.PROJECT), "issuetype_name"),
    sql("SELECT issuetype_raw AS issuetype_name, count(*) AS n FROM raw_issues WHERE project = 'CORE' GROUP BY 1"))
register("dq07_check_signal", lambda m: quality.check_signal(
    joins.enrich_parent(m.cleaned(), m.raw_parents()), "has_parent", "issuetype", "Sub-task"),
    sql("""SELECT *, CASE WHEN flagged > 0 AND distinct_values >= 2 THEN 'PASS' ELSE 'ERROR' END AS status FROM (
           SELECT count(*) AS total, count(*) FILTER (h = 1) AS flagged, count(DISTINCT h) AS distinct_values,
             count(*) FILTER (h = 1 AND issuetype = 'Sub-task') AS overlap
           FROM (SELECT issuetype, coalesce(has_parent, 0) AS h FROM cleaned LEFT JOIN parents USING (key)))"""))

# ---- exploratory aggregates -------------------------------------------------------------------------

DIST = "SELECT {0}, n, {1} AS pct FROM (SELECT {0}, count(*) AS n FROM analytics WHERE {0} IS NOT NULL GROUP BY 1)"
_share = half_up("100 * n", "sum(n) OVER ()", 1)
register("eda01_issuetype", lambda m: eda.dist(m.analytics(), "issuetype"), sql(DIST.format("issuetype", _share)))
register("eda02_resolution", lambda m: eda.dist(m.analytics(), "resolution"), sql(DIST.format("resolution", _share)))
register("eda03_priority", lambda m: eda.dist_ordered(m.analytics(), "priority", fv.PRIORITIES_REPORT_ORDER), sql(DIST.format("priority", _share)))
register("eda04_yearly", lambda m: eda.yearly(m.analytics(), 1990, 2025),
         sql("SELECT CAST(year(created_at) AS INTEGER) AS year, count(*) AS n FROM analytics WHERE year(created_at) BETWEEN 1990 AND 2025 GROUP BY 1"))
_res_pct = lambda name: half_up(f"100 * count(*) FILTER (resolution = {q(name)})", "count(resolution)", 2)
register("eda05_monthly_summary", lambda m: eda.monthly_summary(m.ops(), m.stg_issues().select(
    "key", text.raw_length(c("summary")).alias("summary_length"), text.raw_length(c("description")).alias("description_length"))),
    sql(f"""SELECT CAST(created_month AS DATE) AS month, o.issuetype, count(*) AS total_issues, count(resolution) AS total_resolved,
            round(median({SQL_DAYS}), 1) AS median_resolution_days,
            {half_up(f'sum({SQL_DAYS})', f'count({SQL_DAYS})', 1)} AS avg_resolution_days,
            {_res_pct('Fixed')} AS pct_fixed, {_res_pct("Won't Fix")} AS pct_wontfix, {_res_pct('Duplicate')} AS pct_duplicate,
            {_res_pct('Cannot Reproduce')} AS pct_cannot_reproduce,
            {half_up('sum(sl)', 'count(*)', 1)} AS avg_summary_length, {half_up('sum(dl)', 'count(*)', 1)} AS avg_description_length,
            {half_up('sum(n_comments)', 'count(*)', 2)} AS avg_n_comments
            FROM ops o JOIN (SELECT key, length(coalesce(summary, '')) AS sl, length(coalesce(description, '')) AS dl FROM stg_issues) USING (key)
            GROUP BY 1, 2"""))


# ---- the way of hot groups: the same queries with a low limit, against the same SQL ----------

HOT_ROWS = 20

# The sketch itself: counters for few keys, so that weights are taken away; every heavy key stays, within its bounds.


def _heavy_sketch(m: Models) -> DataFrame:
    lines = m.table("lineitem").withColumn("k", F.when(c("l_orderkey") % 3 > 0, c("l_orderkey") % 7).otherwise(c("l_orderkey") + 7))
    found = heavy_keys(lines, "k", ["l_returnflag"], scratch(m, "heavy"), slots=64)
    bounds = m.spark.createDataFrame(list(found.keys), "k bigint, bytes bigint").filter(c("k") < 7)
    truth = lines.filter(c("l_orderkey") % 3 > 0).groupBy("k").agg(F.sum(F.octet_length("l_returnflag") + ROW_BYTES).alias("true_bytes"))
    return truth.join(bounds, "k", "left").select(
        "k", "true_bytes", ((c("bytes") <= c("true_bytes")) & (c("bytes") + found.missed >= c("true_bytes"))).alias("within"))



def _hot(name: str):
    def build(m: Models) -> DataFrame:
        m.spark.conf.set(MAX_GROUP_ROWS_CONF, str(HOT_ROWS))
        m.spark.conf.set(MAX_GROUP_BYTES_CONF, str(HOT_ROWS * ROW_BYTES))
        try:  # the limit is read while the plan is stated
            return QUERIES[name](m.spark, m.sf_dir)
        finally:
            m.spark.conf.unset(MAX_GROUP_ROWS_CONF)
            m.spark.conf.unset(MAX_GROUP_BYTES_CONF)

    return build


register("skew_heavy_keys", _heavy_sketch, f"""SELECT l_orderkey % 7 AS k, CAST(sum(strlen(l_returnflag) + {ROW_BYTES}) AS BIGINT) AS true_bytes, true AS within
    FROM lineitem WHERE l_orderkey % 3 > 0 GROUP BY 1""")
for _name in ("m07_comments_aggregated", "m10_status_transitions", "win02_sequence", "win05_previous_time"):
    register(f"{_name}_hot", _hot(_name), ORACLE[_name])
