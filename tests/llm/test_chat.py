import hashlib

from tests.llm.conftest import by_id  # noqa: F401
from tickloom.llm import chat


def test_examples_expand_every_reply_and_read_back(spark):
    rows = [(1, 0, "user", "a #1 <b> \\h"), (1, 1, "assistant", "x </turn>\n### user: y"), (1, 2, "user", None), (1, 3, "assistant", ""),
            (1, 4, "user", "end"), (2, 0, None, "only"), (3, 1, "assistant", "é"), (3, 1, "assistant", "é"), (None, 0, "assistant", "n"),
            (4, None, "a: b", "first"), (4, 0, "assistant", "\\b\\")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "'z' as turns", "1 as e")
    found = chat.examples(table)
    assert sorted((r["conv_id"] or -1, r["target"] or 0) for r in found.collect()) == [(-1, 1), (1, 0), (1, 2), (1, 4), (2, 0), (3, 1), (3, 2), (4, 2)]
    got = {r["conv_id"]: r for r in chat.report(chat.with_marks(table)).collect()}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    for conv in {r[0] for r in rows} | {-7}:
        turns = [("user", chat.MARKS), ("assistant", chat.MARKS)] if conv == -7 else [
            (r[2] or "", r[3] or "") for r in sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0))]
        loss = "".join(t for role, t in turns if role == "assistant")
        assert got[conv]["n_turns"] == len(turns)
        assert got[conv]["turns_sha256"] == sha("".join(f"{a}\n{b}\n" for a, b in turns))
        assert (got[conv]["loss_chars"], got[conv]["loss_sha256"]) == (len(loss), sha(loss))
    lengths = {r["conv_id"]: r["n"] for r in found.groupBy("conv_id").agg({"formatted": "count"}).withColumnRenamed("count(formatted)", "n").collect()}
    assert lengths[1] == 3
    assert chat.examples(table.limit(0)).count() == 0


def test_long_conversation_forms_one_prefix_at_a_time(spark):
    n = 3000
    rows = spark.range(n).selectExpr("5L AS conv_id", "id AS turn", "if(id % 2 = 0, 'user', 'assistant') AS role", "concat('t#', id) AS text")
    got = chat.report(rows).collect()[0]
    texts = [f"t#{i}" for i in range(n)]
    sizes = [len(f"### {('user', 'assistant')[i % 2]}: {t} </turn>\n") + 1 for i, t in enumerate(texts)]
    loss = "".join(texts[1::2])
    assert (got["n_turns"], got["loss_chars"], got["loss_sha256"]) == (n, len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert got["formatted_chars"] == sum(sum(sizes[:k + 1]) for k in range(1, n, 2))
    # The explode is over positions; prefixes are formed above it.
    plan = chat.examples(rows)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("array_join") < plan.index("Generate explode")


def test_no_python_on_the_main_path(spark):
    table = spark.createDataFrame([(1, 0, "user", "a")], "conv_id long, turn long, role string, text string")
    plan = chat.report(table)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
