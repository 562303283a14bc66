"""Ticket-shaped raw tables derived from the supplied test tables.

Values are derived from natural columns (segment, status, priority, balance);
all rows and whole texts are used.  ``verify/oracle.py`` states the same
derivation in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PROJECT = "CORE"
AS_OF = "2002-01-01"
TRAIN_BEFORE = "2000-01-01"
VALIDATION_BEFORE = "2001-01-01"
STAMP = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+0000'"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ticket_key(number: str) -> Column:
    return F.concat(F.lit(f"{PROJECT}-"), F.col(number).cast("string"))


def choose(value: Column, options: dict[str, str | None], default: str | None = None) -> Column:
    chain = F
    for key, result in options.items():
        chain = chain.when(value == key, F.lit(result))
    return chain.otherwise(F.lit(default))


def choose_index(number: Column, options: list[str | None]) -> Column:
    chain = F
    for i, result in enumerate(options):
        chain = chain.when(number == i, F.lit(result))
    return chain


def stamp(ts: Column) -> Column:
    return F.date_format(ts, STAMP)


SEGMENT_TYPE = {"BUILDING": "Bug", "MACHINERY": "Improvement", "AUTOMOBILE": "Sub-task"}
FURNITURE_TYPE = {"F": "New Feature", "O": "Technical task", "P": "Documentation"}
HOUSEHOLD_TYPE = {"F": "Epic", "O": "Legal", "P": "Test"}
PRIORITY_NAME = {"1-URGENT": "Blocker", "2-HIGH": "Critical", "3-MEDIUM": "Major", "5-LOW": "Minor"}
PRIORITY_RESOLUTION = {"1-URGENT": "Fixed", "2-HIGH": "Done", "3-MEDIUM": "Won't Do", "4-NOT SPECIFIED": "Duplicate"}
STATUS_NAME = {"F": "Resolved", "O": "Open", "P": "In Progress"}
SUMMARY_HEAD = {
    "1-URGENT": "Crash with memory error in order of ",
    "2-HIGH": "Improve performance of order of ",
    "3-MEDIUM": "Feature request from ",
    "4-NOT SPECIFIED": "Duplicate order of ",
    "5-LOW": "Housekeeping for ",
}


def raw_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = lambda name: table(spark, sf_dir, name)
    last_ship = read("lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.max("l_shipdate").alias("last_ship")
    )
    docs = read("documents").select(F.col("doc_id").alias("o_orderkey"), "text")
    html = read("pages").select(F.col("page_id").alias("o_orderkey"), "html")
    base = (
        read("orders")
        .join(read("customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(last_ship, "o_orderkey", "left")
        .join(docs, "o_orderkey", "left")
        .join(html, "o_orderkey", "left")
    )
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    title = F.substring_index("text", "\n", 1)
    plain = F.concat(choose(priority, SUMMARY_HEAD), F.col("c_name"))
    block = F.concat(F.lit("\n{code:xml}"), F.col("html"), F.lit("{code} [~"), F.col("c_name"),
                     F.lit("] https://example.org/x"))
    created = F.col("o_orderdate") + F.make_dt_interval(mins=F.col("o_orderkey") % 1440)
    shipped = F.when(status == "F", stamp(F.col("last_ship")))
    low = F.when(status == "F", "Cannot Reproduce").when(status == "P", "Auto Closed")
    nation = F.col("c_nationkey").cast("string")
    rows = base.select(
        F.col("o_orderkey").cast("string").alias("id"),
        ticket_key("o_orderkey").alias("key"),
        F.coalesce(title, plain).alias("summary"),
        F.concat(F.col("text"), F.coalesce(block, F.lit(""))).alias("description"),
        F.when(F.col("o_totalprice") < 1500, "n/a").otherwise(stamp(created)).alias("created"),
        F.coalesce(shipped, F.lit("")).alias("resolutiondate"),
        F.coalesce(
            choose(F.col("c_mktsegment"), SEGMENT_TYPE),
            F.when(F.col("c_mktsegment") == "FURNITURE", choose(status, FURNITURE_TYPE)),
            F.when(F.col("c_mktsegment") == "HOUSEHOLD", choose(status, HOUSEHOLD_TYPE)),
        ).alias("issuetype_name"),
        F.when(status != "O", F.coalesce(choose(priority, PRIORITY_RESOLUTION), low)).alias("resolution_name"),
        F.lit(None).cast("string").alias("resolution_description"),
        choose(priority, PRIORITY_NAME, " ").alias("priority_name"),
        choose(status, STATUS_NAME).alias("status_name"),
        F.when(F.col("c_acctbal") >= 0, PROJECT).otherwise("EDGE").alias("project_key"),
        F.when(F.col("c_acctbal") < 2000, "  ").otherwise(F.concat(F.lit("dev"), nation)).alias("assignee"),
        F.col("c_name").alias("reporter"),
        F.concat(F.lit("nation"), nation).alias("creator"),
        F.when(priority == "1-URGENT", "many").otherwise(F.concat(nation, F.lit(".6"))).alias("votes_votes"),
        F.when(status == "O", "").otherwise(nation).alias("watches_watchcount"),
        F.col("o_totalprice"),
    )
    # An order of a high price comes with a copy, made of the row itself: the
    # joins and their texts run once.
    itself = F.struct(F.col("id"), F.col("summary"))
    copy = F.struct(
        F.concat(F.when(F.col("status_name") == "In Progress", "0").otherwise("z"), F.col("id")).alias("id"),
        F.lit("copy").alias("summary"))
    both = rows.withColumn("_as", F.explode(
        F.when(F.col("o_totalprice") > 495000, F.array(itself, copy)).otherwise(F.array(itself))))
    return both.select(*[F.col(f"_as.{n}").alias(n) if n in ("id", "summary") else F.col(n) for n in rows.columns]).drop("o_totalprice")


def raw_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = F.lit("2001-09-01 00:50:00").cast("timestamp_ntz") + F.make_dt_interval(mins=F.col("turn") * 25)
    return table(spark, sf_dir, "conversations").select(
        ticket_key("conv_id").alias("key"),
        F.concat_ws("-", "conv_id", "turn").alias("comment_id"),
        F.col("role").alias("comment_author"),
        F.col("text").alias("comment_body"),
        stamp(at).alias("comment_created"),
        F.lit("").alias("comment_updated"),
    )


FIELD_NAME = {"signup": "status", "error": "Priority", "click": "assignee", "view": "Fix Version/s"}
STATUS_TO = ["Open", "In Progress", "Resolved", "Closed", "Reopened", None]
STATUS_FROM = ["Resolved", "Closed", "Open", " ", "In Progress", "Reopened"]
PRIORITY_TO = ["Trivial", "Minor", "Major", "Critical", "Blocker", "Odd"]


def raw_changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("int")
    kind = F.col("event_type")
    number = lambda c: c.cast("int").cast("string")
    version = F.when(k % 11 == 0, "master").otherwise(F.concat(
        number(1 + k % 5), F.lit("."), number(k % 7), F.lit(".0"), F.when(k % 10 == 0, "-RC1").otherwise("")))
    target = (
        F.when(kind == "signup", choose_index(k % 6, STATUS_TO))
        .when(kind == "error", choose_index(k % 6, PRIORITY_TO))
        .when((kind == "click") & (k % 8 != 0), F.concat(F.lit("u"), number(k % 12)))
        .when(kind == "view", version)
        .when(kind == "purchase", "Fixed")
    )
    # Events lie in one month; they are moved and spread over the years of the orders.
    at = F.col("ts") - F.make_dt_interval(days=8400 + 30 * (k % 60))
    events = table(spark, sf_dir, "events").withColumn("ticket", F.col("user_id") + 150 * (k % 7))
    return events.select(
        ticket_key("ticket").alias("key"),
        F.concat(F.lit("a"), number(k % 9)).alias("author"),
        stamp(at).alias("created"),
        F.coalesce(choose(kind, FIELD_NAME), F.when(F.col("value") < 10, "resolution").otherwise("Rank")).alias("field"),
        F.when(kind == "signup", choose_index(F.floor(k / 6) % 6, STATUS_FROM)).alias("fromstring"),
        target.alias("tostring"),
    )


def raw_issuelinks(spark: SparkSession, sf_dir: str) -> DataFrame:
    by_line = choose_index(F.col("l_linenumber") - 5, ["Cloners", "Blocked", "Blocker"])
    by_flag = choose(F.col("l_returnflag"), {"R": "Reference", "A": "duplicate", "N": "Container"})
    return table(spark, sf_dir, "lineitem").select(
        ticket_key("l_orderkey").alias("key"),
        F.coalesce(by_line, by_flag).alias("type_name"),
        ticket_key("l_partkey").alias("inwardissue_key"),
        ticket_key("l_suppkey").alias("outwardissue_key"),
    )


PARENT_FLAG = {"1-URGENT": 1, "2-HIGH": 0, "3-MEDIUM": 1, "5-LOW": -1}


def raw_parent_keys(spark: SparkSession, sf_dir: str, whole: bool = False) -> DataFrame:
    """Fetched parent rows: 1, 0, -1 for a failed lookup, NULL when empty.

    Orders in progress have not been fetched yet, unless ``whole``.
    """
    flag = choose(F.col("o_orderpriority"), PARENT_FLAG).cast("int")
    parent = F.concat(F.lit(f"{PROJECT}-"), (F.col("o_orderkey") - 1).cast("string"))
    orders = table(spark, sf_dir, "orders")
    return (orders if whole else orders.filter("o_orderstatus <> 'P'")).select(
        ticket_key("o_orderkey").alias("key"),
        F.when(flag == 1, parent).alias("parent_key"),
        flag.alias("has_parent"),
    )


def parent_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The parents of all orders as nested payloads; a failed lookup has none."""
    rows = raw_parent_keys(spark, sf_dir, whole=True)
    parent = F.when(F.col("parent_key").isNotNull(), F.struct(F.col("parent_key").alias("key")))
    payload = F.to_json(F.struct(F.struct(parent.alias("parent")).alias("fields")))
    return rows.select("key", F.when(~F.col("has_parent").eqNullSafe(-1), payload).alias("payload"))
