import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tickloom.functions import fixed_values as fv
from tickloom.ml import embed, evaluate, features, neighbours, rules, train
from tickloom.operators import aggregates, joins
from tickloom.sources import tables


def test_scaler(spark):
    df = spark.createDataFrame([(1.0, 5), (3.0, 5), (None, 5), (9e9, 5)], "a double, b int")
    scaler = features.fit_scaler(df, ["a", "b"])
    got = np.array(rows(scaler.transform(df).select("a_scaled", "b_scaled")))
    x = np.array([1.0, 3.0, 0.0, 1e6])
    assert np.allclose(got[:, 0], (x - x.mean()) / x.std()) and (got[:, 1] == 0).all()


def test_class_weights(spark):
    df = spark.createDataFrame([("a",)] * 6 + [("b",)] * 2, "l string")
    assert rows(features.class_weights(df, "l"), "l") == [("a", 6, 8 / 12), ("b", 2, 2.0)]
    assert features.with_class_weights(df, "l").agg(F.sum("weight")).first()[0] == pytest.approx(8)


def test_oversample(spark):
    data = [(f"k{i}", label) for i, label in enumerate(["a"] * 50 + ["b"] * 11 + ["c"] * 3 + ["d"] * 10)]
    df = spark.createDataFrame(data, "key string, l string")
    got = features.oversample(df, "l")
    sizes = dict(rows(got.groupBy("l").count()))
    assert sizes == {"a": 50, "b": 11, "c": 10, "d": 10}  # int(median(50, 11, 3, 10)) = 10
    assert got.select("key").distinct().count() == len(data)
    copies = [n for _, n in rows(got.filter("l = 'c'").groupBy("key").count())]
    assert sorted(copies) == [3, 3, 4]
    assert sorted(rows(got)) == sorted(rows(features.oversample(df, "l")))


@pytest.mark.parametrize("cell", [1000, 2])
def test_oversampling_takes_the_smallest_hashes_in_few_jobs(spark, monkeypatch, cell):
    """With all classes in one cell, and with histograms."""
    import hashlib

    monkeypatch.setattr(features, "CELL_ROWS", cell)
    labels = ["a"] * 400 + ["b"] * 700 + ["c"] * 70 + ["d"] * 390 + [None] * 30 + ["e"] * 500
    data = [(f"k{i}", label) for i, label in enumerate(labels)]
    df = spark.createDataFrame(data, "key string, l string")
    sc = spark.sparkContext
    sc.setJobGroup(f"oversample{cell}", "")
    got = features.oversample(df, "l")
    jobs = len(sc.statusTracker().getJobIdsForGroup(f"oversample{cell}"))
    sc.setLocalProperty("spark.jobGroup.id", None)
    assert jobs <= 8  # at most four passes; adaptive execution submits each shuffle and its result as jobs of their own
    median = 395
    expected = {}
    for label in set(labels):
        keys = sorted((k for k, l in data if l == label), key=lambda k: (hashlib.md5(f"{k}#42".encode()).hexdigest(), k))
        target = max(len(keys), median)
        for i, k in enumerate(keys):
            expected[k] = target // len(keys) + (i < target % len(keys))
    assert {k: n for k, n in rows(got.groupBy("key").count())} == expected
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "SortMergeJoin" not in plan


def test_oversampling_rows_that_share_a_key(spark):
    df = spark.createDataFrame([("same", "x")] * 7 + [(None, "y")] * 3 + [(f"k{i}", "z") for i in range(10)], "key string, l string")
    got = features.oversample(df, "l")
    assert dict(rows(got.groupBy("l").count())) == {"x": 7, "y": 7, "z": 10}
    assert features.oversample(df.limit(0), "l").columns == ["key", "l", "copy"]


def test_repeat_in_steps(spark):
    df = spark.createDataFrame([("a", 7), ("b", 1), ("c", 6)], "key string, n long")
    got = features._repeat(df, "key", "n", step=3)
    assert sorted(rows(got.select("key", "copy"))) == [
        (k, i) for k, n in (("a", 7), ("b", 1), ("c", 6)) for i in range(1, n + 1)]


def test_evaluation(spark):
    pairs = [("a", "a")] * 3 + [("a", "b")] + [("b", "a")] * 2 + [("c", "a")] + [("a", "d")]
    df = spark.createDataFrame(pairs, "t string, p string")
    report = {r[0]: r[1:] for r in rows(evaluate.class_report(df, "t", "p"))}
    assert report["a"] == (0.5, 0.6, 2 * 3 / 11, 5)
    assert report["b"] == (0.0, 0.0, 0.0, 2)
    assert report["c"] == (0.0, 0.0, 0.0, 1)  # never predicted
    assert report["d"] == (0.0, 0.0, 0.0, 0)  # never true
    assert rows(evaluate.evaluate(df, "t", "p")) == [(0.375, round(6 / 11 / 4, 4), 8)]
    assert rows(evaluate.confusion(df, "t", "p", ["b", "a", "e"])) == [("b", 0, 2, 0), ("a", 1, 3, 0), ("e", 0, 0, 0)]
    averages = {r[0]: r[1:] for r in rows(evaluate.full_report(df, "t", "p"))}
    assert averages["weighted avg"] == (0.3125, 0.375, round(6 / 11 * 5 / 8, 6), 8)


def brute_force(data, k, boosts):
    unit = {r[0]: np.array(r[1]) / np.linalg.norm(r[1]) for r in data}
    meta = {r[0]: r[3:] for r in data}
    out = {}
    for a in unit:
        scored = [
            (-round(float(unit[a] @ unit[b]) + sum(g * (meta[a][i] == meta[b][i]) for i, g in enumerate(boosts.values())), 6), b)
            for b in unit if b != a]
        out[a] = sorted(scored)[:k]
    return out


@pytest.mark.parametrize("boosts", [{}, {"priority": 0.1, "status": 0.08}])
def test_nearest_is_exact(spark, boosts):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(8, 6))
    data = []
    for i in range(240):
        # A third of the rows are near copies of one point.
        v = centres[0] + 1e-3 * rng.normal(size=6) if i % 3 == 0 else centres[i % 8] + 0.3 * rng.normal(size=6)
        data.append((i, [float(x) for x in v], int(i % 4), random.Random(i).choice("pq"), random.Random(-i).choice("xyz")))
    df = spark.createDataFrame(data, "key long, embedding array<double>, label int, priority string, status string")
    got = neighbours.nearest(df, df, k=7, boosts=boosts, pivots=10, block=16)
    expected = brute_force(data, 7, boosts)
    found = {}
    for q, n, score, label in rows(got):
        found.setdefault(q, []).append((-score, n))
    assert set(found) == set(expected)
    for q in expected:
        assert [n for _, n in sorted(found[q])] == [n for _, n in expected[q]]
        assert [s for s, _ in sorted(found[q])] == pytest.approx([s for s, _ in expected[q]])


def test_probes_find_most_of_a_larger_table_with_few_pairs(spark):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(30, 16))
    data = [(i, [float(x) for x in centres[i % 30] + 0.4 * rng.normal(size=16)], i % 30) for i in range(2000)]
    df = spark.createDataFrame(data, "key long, embedding array<double>, label int")
    batch = df.filter("key % 20 = 0")
    probes = neighbours.probes_for(df, df, k=5, sample=50)
    assert probes <= 15  # of 45 cells
    found = neighbours.nearest(df, df, k=5, probes=probes)
    assert neighbours.recall(found, neighbours.nearest(batch, df, k=5)).first()["recall"] >= 0.9
    with pytest.raises(ValueError, match="exact"):
        old, neighbours.EXACT_QUERIES = neighbours.EXACT_QUERIES, 10
        try:
            neighbours.nearest(df, df)
        finally:
            neighbours.EXACT_QUERIES = old


@pytest.mark.parametrize("probes", [1, 3])
def test_index_rows_sent_are_bounded_by_the_visits(spark, probes):
    """At two sizes: no more than probes x queries + rows, however many query blocks there are."""
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(10, 8))
    for n in (600, 2400):
        # Two thirds of the rows crowd around one point.
        data = [(i, [float(x) for x in centres[i % 10 if i % 3 == 0 else 0] + 0.3 * rng.normal(size=8)], 0) for i in range(n)]
        df = spark.createDataFrame(data, "key long, embedding array<double>, label int")
        cells = neighbours.build_cells(df, "key", "embedding", pivots=8, block=64)
        assert cells.children and len(cells.pivots) > n / 64 / 2
        asked, sent, _ = neighbours.sides(df, df, cells, 5, "key", "embedding", "label", {}, probes, 64)
        assert cells.size.sum() == n and cells.size.max() < n / 4
        rows_per_cell = {r["cell"]: r["n"] for r in sent.select("cell", "neighbour").distinct().groupBy("cell").agg(F.count("*").alias("n")).collect()}
        assert sum(rows_per_cell.values()) <= n
        split = -(-cells.size.max() // 64)
        assert sent.count() <= split * (probes * n + n) and asked.count() <= split * probes * n
        assert sent.groupBy("cell", "block", "query_block").count().agg(F.max("count")).first()[0] <= 128


def test_two_levels_of_pivots_lose_nothing(spark):
    rng = np.random.default_rng(4)
    data = [(i, [float(x) for x in (rng.normal(size=5) * 0.2 + (3 if i % 3 else 0))], int(i % 4), "p", "x") for i in range(200)]
    data += [(1000 + i, data[0][1], 1, "q", "y") for i in range(60)]  # copies, which no pivot splits
    df = spark.createDataFrame(data, "key long, embedding array<double>, label int, priority string, status string")
    got = neighbours.nearest(df, df, k=7, pivots=3, block=20)
    expected = brute_force(data, 7, {})
    found = {}
    for q, n, score, label in rows(got):
        found.setdefault(q, []).append((-score, n))
    assert {q: [n for _, n in sorted(v)] for q, v in found.items()} == {q: [n for _, n in v] for q, v in expected.items()}


def test_vote(spark):
    df = spark.createDataFrame([(1, 10, 0.9, "a"), (1, 11, 0.5, "b"), (1, 12, 0.4, "b"), (2, 13, 0.3, "c")],
                               "query int, neighbour int, score double, label string")
    assert rows(neighbours.vote(df), "query") == [(1, "a", 0.5), (2, "c", 1.0)]


def test_rules_and_recommendation(spark):
    df = spark.createDataFrame([("Memory LEAK", None, "Blocker"), ("Feature X", "", "Major"), ("duplicate", "", None), ("plain", "", "Minor")],
                               "s string, d string, p string")
    predicted = rules.rule_predict(df, "s", "d")
    assert [r[3:] for r in rows(predicted)] == [
        ("Bug", "Fixed"), ("New Feature", "Incomplete"), ("Sub-task", "Duplicate"), ("Task", "Incomplete")]
    text = rows(rules.recommend(predicted, "s", "d", "p", "pred_issuetype", "pred_resolution").select("recommendation"))
    lines = text[0][0].split("\n")
    assert lines[0] == "Assignation : " + fv.ASSIGNMENT_BY_TYPE["bug"]
    assert lines[1] == "Contexte : " + fv.CONTEXT_RULES[0][1]
    assert lines[4:7] == [f"{i + 1}. {t}" for i, t in enumerate(fv.STEPS_BY_TYPE[0][1])]
    assert lines[7] == "Priorité : " + fv.URGENCY_BY_PRIORITY[0][1]
    assert text[2][0].split("\n")[7] == "Priorité : " + fv.URGENCY_DEFAULT


def test_references(spark):
    mart = spark.createDataFrame([(f"k{i}", "s", "Bug", "Fixed") for i in range(5)],
                                 "key string, summary_clean string, issuetype string, resolution string")
    types = spark.createDataFrame([("Bug",), ("Task",), ("Epic",)], "issuetype string")
    got = rows(rules.references(types, mart).select("issuetype", "key", "similarity", "source"), "issuetype", "key")
    assert got[:3] == [("Bug", f"k{i}", 0.0, "mart") for i in range(3)]
    assert got[3:6] == [("Epic", f"SPARK-REF-GEN-{i + 1}", round(0.9 - 0.1 * i, 3), "fallback") for i in range(3)]
    assert [r[1] for r in got[6:]] == ["SPARK-REF-TSK-1", "SPARK-REF-TSK-2", "SPARK-REF-TSK-3"]


def test_request_features(spark):
    df = spark.createDataFrame([("k", None, 3)], "key string, n_links_total int, n_comments int")
    got = features.request_features(df, ["n_comments", "has_parent", "n_links_total"], 2)
    assert rows(got) == [("k", 3.0, 0.0, 0.0, [0.0, 0.0])]


def test_embeddings(spark):
    df = spark.createDataFrame([("a", "spark job fails"), ("b", "spark job fails"), ("c", None)], "key string, t string")
    got = dict(rows(embed.embed_tfidf(df, "t", dim=64)))
    assert got["a"] == got["b"] and np.linalg.norm(got["a"]) == pytest.approx(1, abs=1e-6)

    def make_encoder():
        return lambda texts: np.array([[len(t), 1.0] for t in texts])

    both = dict(rows(embed.embed(df, "t", make_encoder)))
    assert both["a"] == both["b"] and both["c"] == [0.0, 1.0]


def test_embedding_table_encodes_only_new_and_changed_texts(spark, tmp_path):
    calls = tmp_path / "calls"
    calls.mkdir()

    def make_encoder():
        import uuid

        def encode(texts):
            (calls / uuid.uuid4().hex).write_text("\n".join(texts))
            return np.array([[len(t), 1.0] for t in texts])

        return encode

    def encoded():
        texts = sorted(t for f in calls.iterdir() for t in f.read_text().split("\n"))
        for f in calls.iterdir():
            f.write_text("seen")
        return [t for t in texts if t != "seen"]

    path = str(tmp_path / "table")
    first = spark.createDataFrame([("a", "one"), ("b", "two two"), ("c", None), ("gone", "left"), ("d", "one")], "key string, t string")
    table = embed.update_embeddings(spark, path, first, "t", make_encoder)
    assert encoded() == ["", "left", "one", "two two"] and table.filter("encoded").count() == 5
    opened = table
    # Unchanged, a text that another key had, a changed one, an emptied one, a new key; one key is gone.
    second = spark.createDataFrame([("a", "one"), ("b", "left"), ("c", "three"), ("d", ""), ("e", "one")], "key string, t string")
    table = embed.update_embeddings(spark, path, second, "t", make_encoder)
    assert encoded() == ["three"]
    assert {r["key"]: r["encoded"] for r in table.collect()} == {"a": False, "b": False, "c": True, "d": False, "e": False}
    by = {r["key"]: r["embedding"] for r in table.collect()}
    assert by["a"] == by["e"] and by["b"][0] == pytest.approx(4 / 17**0.5) and by["d"] == [0.0, 1.0]
    assert opened.count() == 5 and {r["key"] for r in opened.collect()} == {"a", "b", "c", "d", "gone"}


def test_training_beats_majority(spark):
    rng = np.random.default_rng(0)
    data = []
    for i in range(300):
        kind = ["Bug", "Bug", "Improvement", "Other"][i % 4]
        centre = {"Bug": (1, 0), "Improvement": (0, 1), "Other": (-1, -1)}[kind]
        v = [float(x) for x in np.array(centre) + 0.3 * rng.normal(size=2)]
        data.append((f"k{i}", "train" if i < 220 else "validation", kind, "Fixed" if kind == "Bug" else "Invalid", i % 7, v))
    mart = spark.createDataFrame(data, "key string, split string, issuetype string, resolution string, n_comments int, embedding array<double>")
    vectors = mart.select("key", "embedding")
    preds = train.train_and_predict(mart.drop("embedding"), vectors, vectors, ["n_comments"], max_iter=50).cache()
    assert preds.count() == 80
    # A ticket without an embedding keeps its row.
    some = vectors.filter("key <> 'k299'")
    assert train.train_weighted(mart.drop("embedding"), some, some, ["n_comments"], max_iter=5).filter("key = 'k299'").count() == 1
    with pytest.raises(ValueError):
        train.prepare(mart.drop("embedding"), vectors.limit(0), ["n_comments"])
    assert preds.filter("conf_issuetype < 0.3 or conf_issuetype > 1").count() == 0
    accuracy = preds.agg(F.avg((F.col("true_issuetype") == F.col("pred_issuetype")).cast("int"))).first()[0]
    assert accuracy > 0.8
    assert rows(preds.select("method", "fix_summary").distinct()) == [("LR_BALANCED", "")]


def test_class_totals_are_one_narrow_pass(spark):
    df = spark.createDataFrame([("b", 2.0), ("a", 0.5), ("b", 1.0), (None, 9.0), ("c", None)], "l string, w double")
    assert train.class_totals(df, "l") == {"a": 1.0, "b": 2.0, "c": 1.0}
    assert train.class_totals(df, "l", "w") == {"a": 0.5, "b": 3.0, "c": 0.0}
    assert train.label_classes(df, "l") == ["a", "b", "c"]
    assert train.class_totals(df.limit(0), "l") == {}


def test_training_table_is_made_once(spark):
    """Counts, hashes and weights of a written table run nothing of the plan behind it."""
    made = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            made.add(b.num_rows)
            yield b

    df = spark.createDataFrame([(f"k{i}", "abc"[i % 7 % 3]) for i in range(70)], "key string, l string").mapInArrow(count, "key string, l string")
    once = tables.written_once(df, "train-l")
    assert made.value == 70
    weighted = features.with_class_weights(once, "l")
    assert sum(train.class_totals(weighted, "l", "weight").values()) == pytest.approx(70)
    assert features.oversample(once, "l").count() >= 70
    assert made.value == 70


def test_checked_broadcast_is_the_side_itself(spark):
    """The check's own rows are joined; beyond rows or bytes the side is left as it is."""
    made = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            made.add(b.num_rows)
            yield b

    side = spark.createDataFrame([(1, "x"), (2, None), (None, "y")], "k int, v string").coalesce(1).mapInArrow(count, "k int, v string")
    small = joins.checked_broadcast(side)
    assert made.value == 3 and small.schema == side.schema
    left = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    assert rows(left.join(small, "k", "left"), "k") == [(1, "x"), (2, None), (3, None)]
    assert made.value == 3
    assert joins.checked_broadcast(side, max_rows=2) is side and joins.checked_broadcast(side, max_bytes=1) is side
    assert joins.checked_broadcast(side.limit(0)).count() == 0


def test_prefix_rate(spark):
    df = spark.createDataFrame([("a", "[P] x"), ("a", "[N] y"), ("a", None), ("b", "[P]"), (None, "x[P]"), ("c", "")], "kind string, t string")
    got = rows(aggregates.prefix_rate(df, "kind", "t", "[P]", "pct"))
    assert got[:2] == [("b", 100.0), ("a", 33.3)] and set(got[2:]) == {(None, 0.0), ("c", 0.0)}


def test_best_of_block_equals_double_precision():
    """Tiles, copies, equal scores, boosts of few and of many values, and NULLs."""
    rng = np.random.default_rng(6)
    x = neighbours._unit(rng.normal(size=(900, 12)).astype("float32"))
    x[100:400] = x[50]  # copies: ties go to the smaller key
    q = np.vstack([x[40:60], x[700:720]])
    q_key, x_key = np.r_[40:60, 700:720], np.arange(900)
    few, many = pd.Series(rng.integers(0, 4, 900)).where(rng.random(900) > 0.1), pd.Series(rng.integers(0, 200, 900)).astype(str)
    same = [(0.1, *neighbours._codes(few.iloc[q_key], few)), (0.05, *neighbours._codes(many.iloc[q_key], many))]
    full = q @ x.T
    for gain, a, b in same:
        full += gain * (a[:, None] == b[None, :])
    full = np.round(full, 6)
    full[q_key[:, None] == x_key[None, :]] = -np.inf
    top = np.argsort(-full, axis=1, kind="stable")[:, :7]
    old = neighbours.CHUNK, neighbours.TILE, neighbours.PAIRS
    try:
        for neighbours.CHUNK, neighbours.TILE, neighbours.PAIRS in (old, (7, 300, 11), (64, 64, 1000)):
            asked, found, score = neighbours._best(q, x, same, q_key, x_key, 7)
            assert (asked == np.repeat(np.arange(40), 7)).all()
            assert (found.reshape(40, 7) == top).all() and np.allclose(score.reshape(40, 7), np.take_along_axis(full, top, 1))
    finally:
        neighbours.CHUNK, neighbours.TILE, neighbours.PAIRS = old


def test_exact_search_sends_queries_by_task_and_has_no_limit_of_its_own(spark):
    rng = np.random.default_rng(8)
    data = [(i, [float(v) for v in rng.normal(size=6)], 0) for i in range(400)]
    df = spark.createDataFrame(data, "key long, embedding array<double>, label int")
    assert neighbours.EXACT_QUERIES is None
    cells = neighbours.build_cells(df, "key", "embedding", pivots=40, block=16)
    asked, sent, _ = neighbours.sides(df, df, cells, 5, "key", "embedding", "label", {}, None, 16)
    # Far fewer than a row for each query and cell.
    assert asked.count() <= 400 * 4 and sent.count() <= 400 * 4


def test_training_takes_sparse_vectors_as_it_takes_arrays(spark):
    """The same predictions; a ticket without an embedding keeps its row; vectors stay sparse."""
    words = ["crash error memory", "improve speed cache", "docs typo page"]
    data = [(f"k{i}", "train" if i < 60 else "validation", ["Bug", "Improvement", "Other"][i % 3], ["Fixed", "Invalid"][i % 2], i % 5, words[i % 3] + f" w{i % 7}")
            for i in range(90)]
    mart = spark.createDataFrame(data, "key string, split string, issuetype string, resolution string, n_comments int, text string")
    arrays, vectors = (embed.embed_tfidf(mart.filter("key <> 'k89'"), "text", as_vector=v) for v in (False, True))
    ready, _ = train.prepare(mart, vectors, ["n_comments"])
    assert all(len(r.features.indices) < 10 and r.features.size == 1025 for r in ready.select("features").collect())
    found = [{r["key"]: (r["pred_issuetype"], r["pred_resolution"]) for r in
              train.train_and_predict(mart, v, v, ["n_comments"], max_iter=20).collect()} for v in (arrays, vectors)]
    assert found[0] == found[1] and len(found[1]) == 30


def test_products_send_a_row_per_task_class_and_feature(spark):
    from verify.ml_queries import _products

    rng = np.random.default_rng(5)
    miss, x = rng.normal(size=(500, 3)), rng.normal(size=(500, 4))
    df = spark.createDataFrame([(a.tolist(), b.tolist()) for a, b in zip(miss, x)], "miss array<double>, x array<double>").repartition(3)
    sent = _products(df)
    assert sent.count() <= 3 * 3 * 4
    total = {(r[0], r[1]): r[2] for r in sent.groupBy("class", "feature").agg(F.sum("product")).collect()}
    assert all(total[i, j] == pytest.approx((miss.T @ x)[i, j]) for i in range(3) for j in range(4))
