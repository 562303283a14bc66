import random

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.conftest import by_id
from tickloom.llm import minhash


def brute(texts):
    """doc_id -> (set size, component), from all pairs."""
    sets = {}
    for i, text in texts:
        words = (text or "").lower().split()
        sets[i] = {tuple(words[k:k + 5]) for k in range(max(1, len(words) - 4))} if words else set()
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def corpus(seed=1):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    out = []
    for g in range(12):
        base = [rnd.choice(words) for _ in range(rnd.choice([3, 8, 40, 120]))]
        for _ in range(rnd.choice([1, 2, 8, 25])):
            copy = list(base)
            for _ in range(rnd.choice([0, 0, 1, 2, 4, 6])):
                copy[rnd.randrange(len(copy))] = rnd.choice(words)
            out.append(" ".join(copy))
    rnd.shuffle(out)
    return out + [None, "", " ", "one", "ONE", "a b c d", "a b c", out[0], out[0].upper()]


@pytest.mark.parametrize("block", [200, 5])
def test_components_equal_brute_force(spark, docs, monkeypatch, block):
    """With whole groups in a block, and with groups cut into many."""
    monkeypatch.setattr(minhash, "BLOCK_DOCS", block)
    texts = list(enumerate(corpus()))
    expected = brute(texts)
    got = by_id(minhash.grouped(docs(texts)))
    assert len(got) == len(texts)
    for i, _ in texts:
        assert (got[i]["n_shingles"], got[i]["component_id"], got[i]["kept"]) == (*expected[i], expected[i][1] == i), i


def test_one_of_each_group_stays(spark, docs):
    texts = list(enumerate(corpus(2)))
    table = docs(texts)
    kept = minhash.deduplicate(table)
    assert kept.columns == table.columns
    assert sorted(by_id(kept)) == sorted(i for i, (_, c) in brute(texts).items() if c == i)


def test_null_ids_repeated_rows_and_empty_tables(spark, docs):
    text = " ".join(f"v{i}" for i in range(30))
    other = " ".join(f"u{i}" for i in range(30))
    rows = minhash.grouped(docs([(None, text), (None, text), (5, text), (5, text), (9, text), (7, other), (9, other)])).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["component_id"] or -1, r["kept"]) for r in rows) == [
        (False, 5, 5, True), (False, 5, 5, True), (False, 7, 5, False), (False, 9, 5, False), (False, 9, 5, False), (True, 0, -1, True), (True, 0, -1, True)]
    assert minhash.grouped(docs([])).count() == 0
    assert minhash.deduplicate(docs([])).count() == 0


def test_one_id_with_very_many_rows(spark, docs, monkeypatch):
    """Copies of a row are compared once; different texts of an id are spread over blocks."""
    monkeypatch.setattr(minhash, "BLOCK_DOCS", 20)
    text, other = (" ".join(f"{c}{i}" for i in range(60)) for c in "vu")
    near = text + " tail"
    varied = [(4, " ".join(f"v{i}" if i != k else "x" for i in range(60))) for k in range(0, 60)]
    rows = docs([(1, text)] * 3000 + [(2, near), (6, None), (6, other), (7, ""), (7, other + " end"), (3, other + " tail")] + varied)
    got = {r["doc_id"]: r["component_id"] for r in minhash.grouped(rows).where("n_shingles > 0").collect()}
    assert got == {1: 1, 2: 1, 4: 1, 6: 3, 7: 3, 3: 3}
    # The two texts without words of different ids tie nothing together.
    table = pa.table({"id": [1, 1, 2, 2], "text": [text.encode(), None, other.encode(), b""]})
    assert minhash._edges(False)(table).num_rows == 0


def test_sketch_fills_all_bins_and_is_unbiased():
    rng = np.random.default_rng(3)
    agree = []
    for n in (1, 2, 30, 500):
        a = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
        b = np.unique(np.concatenate([a[: n * 3 // 4], rng.integers(0, 2**63, n - n * 3 // 4, dtype=np.uint64)]))
        s = minhash.sketches([a, b]).view(np.uint16)
        truth = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        agree.append(abs((s[0] == s[1]).mean() - truth))
    assert max(agree) < 0.15
    assert (minhash.sketches([a])[0] == minhash.sketches([a[::-1].copy()])[0]).all()


def test_intersections_and_forest():
    rng = np.random.default_rng(4)
    sets = [np.unique(rng.integers(0, 40, 25).astype(np.uint64)) for _ in range(9)]
    both = minhash.shared(sets)
    off = ~np.eye(9, dtype=bool)
    assert (both[off] == np.array([[len(np.intersect1d(a, b)) for a in sets] for b in sets])[off]).all()
    links = np.zeros((5, 5), bool)
    links[0, 3] = links[3, 0] = links[3, 4] = links[4, 3] = True
    found = minhash.forest(links)
    assert len(found) == 2 and {x for edge in found for x in edge} == {0, 3, 4}


def test_long_chains_become_one_component(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 100), (201, 200)], "a long, b long")
    got = {r["id"]: r["component"] for r in minhash.components(edges).collect()}
    assert got == {**{i: 0 for i in range(61)}, 200: 200, 201: 200}


def test_no_side_of_a_join_goes_through_the_driver(spark, docs, monkeypatch):
    """However small a table seems: compressed files and explodes hide its size."""
    monkeypatch.setattr(minhash, "BLOCK_DOCS", 5)
    plans = []
    write = minhash.written

    def seen(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df)

    monkeypatch.setattr(minhash, "written", seen)
    texts = list(enumerate(corpus(3)))
    found = minhash.grouped(docs(texts))
    plans.append(found._jdf.queryExecution().executedPlan().toString())
    assert sum("SortMergeJoin" in p for p in plans) > 8
    assert not [p for p in plans if "Broadcast" in p]
    assert {i: r["component_id"] for i, r in by_id(found).items()} == {i: c for i, (_, c) in brute(texts).items()}


def test_what_the_pipeline_drops_does_not_go_through_the_driver(spark, docs):
    texts = list(enumerate(corpus(4)))
    kept = minhash.deduplicate(docs(texts))
    rows = by_id(kept)
    # After the run: adaptive execution chooses by the sizes it has met.
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    assert sorted(rows) == sorted(i for i, (_, c) in brute(texts).items() if c == i)
