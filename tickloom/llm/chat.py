"""Prefix-target expansion of conversations, with built-in functions only.

A conversation is formatted turn by turn as ``### role: text </turn>`` and a
line end.  Inside roles and texts the backslash, ``#`` and ``<`` (in roles
also ``:``) are written as a backslash and a letter, so no text can hold a
mark, and every example can be read back.

Every assistant turn becomes an example of its own: all turns before it are
context, and only its text lies under the loss mask.  Turns after the last
assistant turn go out as one more example without a mask, so that no turn is
lost.  Examples are formed from whole conversations: a conversation is the
unit of the output, whose size grows with the square of its turns by
definition.

Defined results: a NULL text or role is empty; rows of a conversation are
ordered by turn (NULL first), then role, then text, so repeated rows are
repeated turns; a NULL conv_id is a conversation of its own; an empty table
gives no rows; further columns of the input are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ASSISTANT = "assistant"
END = " </turn>\n"
# What is written for a character inside a text; the backslash first.
ESCAPES = [("\\", "\\b"), ("#", "\\h"), ("<", "\\l"), (":", "\\c")]


def escape(text: Column, role: bool = False) -> Column:
    for plain, code in ESCAPES[: 4 if role else 3]:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescape(text: Column) -> Column:
    for plain, code in reversed(ESCAPES):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def conversations(rows: DataFrame) -> DataFrame:
    """conv_id and its turns in order: structs of role, head and body as formatted."""
    text, role = F.coalesce(F.col("text"), F.lit("")), F.coalesce(F.col("role"), F.lit(""))
    turns = F.sort_array(F.collect_list(F.struct(F.col("turn"), role.alias("role"), text.alias("text"))))
    return rows.groupBy("conv_id").agg(turns.alias("turns")).select("conv_id", F.transform("turns", lambda t: F.struct(
        t["role"].alias("role"),
        F.concat(F.lit("### "), escape(t["role"], role=True), F.lit(": ")).alias("head"),
        escape(t["text"]).alias("body"))).alias("turns"))


def examples(rows: DataFrame) -> DataFrame:
    """conv_id, target (position of the reply from 1, NULL without one), n_turns,
    complete (are all turns of the conversation in it?), formatted, loss_start,
    loss_end (code points, end exclusive).

    A row is made for each position first, and its prefix is formed from the turns
    it points into: a task holds one example at a time, however many a conversation has."""
    turns = F.col("turns")
    at = F.sequence(F.lit(1), F.size("turns"))
    place = lambda target, k: F.struct(target.cast("int").alias("target"), k.cast("int").alias("k"))
    replies = F.transform(F.filter(at, lambda k: F.element_at(turns, k)["role"] == ASSISTANT), lambda k: place(k, k))
    rest = F.when(F.element_at(turns, -1)["role"] != ASSISTANT, F.array(place(F.lit(None), F.size("turns")))).otherwise(F.array())
    whole = F.transform(turns, lambda t: F.concat(t["head"], t["body"], F.lit(END)))
    places = conversations(rows).select("conv_id", "turns", whole.alias("whole"), F.explode(F.concat(replies, rest)).alias("p"))

    target, k = F.col("p")["target"], F.col("p")["k"]
    before = F.array_join(F.slice("whole", F.lit(1), k - 1), "")
    start = F.length(before) + F.length(F.element_at(turns, k)["head"])
    end = start + F.length(F.element_at(turns, k)["body"])
    return places.select(
        "conv_id", target.alias("target"), k.alias("n_turns"), (k == F.size("turns")).alias("complete"),
        F.concat(before, F.element_at("whole", k)).alias("formatted"),
        F.when(target.isNotNull(), start).alias("loss_start"), F.when(target.isNotNull(), end).alias("loss_end"))


def loss_text(formatted: Column, start: Column, end: Column) -> Column:
    """The text under the mask, as it was before formatting."""
    return unescape(F.substring(formatted, start + 1, end - start))


def read_back(formatted: Column) -> Column:
    """Turns (role, text) of a formatted example."""
    pieces = F.split(formatted, END, -1)
    return F.transform(F.slice(pieces, 1, F.size(pieces) - 1), lambda p: F.struct(
        unescape(F.substring(p, F.lit(5), F.locate(": ", p) - 5)).alias("role"),
        unescape(F.substring(p, F.locate(": ", p) + 2, F.length(p))).alias("text")))


def report(rows: DataFrame) -> DataFrame:
    """Per conversation, read back from its examples: conv_id, n_turns,
    turns_sha256, loss_chars, loss_sha256, formatted_chars."""
    found = examples(rows)
    loss = loss_text(F.col("formatted"), F.col("loss_start"), F.col("loss_end"))
    # Of each example only what is read back from it goes on: the reply, the length, and
    # all turns where it holds them, so what is gathered grows with the conversation, not with its square.
    read = found.select(
        "conv_id", F.when(F.col("complete"), F.col("formatted")).alias("longest"),
        F.when(F.col("target").isNotNull(), F.struct("target", loss.alias("text"))).alias("reply"),
        F.length("formatted").cast("long").alias("chars"))
    per = read.groupBy("conv_id").agg(
        F.max("longest").alias("longest"), F.sort_array(F.collect_list("reply")).alias("replies"),
        F.sum("chars").alias("formatted_chars"))
    turns = per.select("conv_id", "formatted_chars", read_back(F.col("longest")).alias("turns"),
                       F.array_join(F.transform("replies", lambda r: r["text"]), "").alias("loss"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return turns.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2(F.col("loss"), 256).alias("loss_sha256"),
        "formatted_chars")


# A conversation whose texts hold the template's own marks.
MARKS = "\\### Assistant: </turn> ok"


def with_marks(rows: DataFrame) -> DataFrame:
    """rows and conversation -7."""
    extra = rows.sparkSession.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise(ASSISTANT).alias("role"), F.lit(MARKS).alias("text"))
    return rows.select("conv_id", "turn", "role", "text").unionByName(extra)


ORACLE = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
e AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS k,
    count(*) OVER (PARTITION BY conv_id) AS n,
    length('### : ') + length(' </turn>' || chr(10)) + length(role) + length(text)
      + length(regexp_replace(role, '[^\\#<:]', '', 'g')) + length(regexp_replace(text, '[^\\#<]', '', 'g')) AS w
  FROM c),
p AS (SELECT *, sum(w) OVER (PARTITION BY conv_id ORDER BY k) AS upto FROM e)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(CASE WHEN role = 'assistant' OR k = n THEN upto ELSE 0 END) AS BIGINT) AS formatted_chars
FROM p GROUP BY conv_id
"""
