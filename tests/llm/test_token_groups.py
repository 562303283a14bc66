import random

import numpy as np
import pytest

from tests.llm.conftest import by_id
from tickloom.llm import token_groups


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
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def corpus(seed):
    """Copies with few changes, around the threshold, and a passage that most texts hold."""
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    passage = [f"p{i}" for i in range(30)]
    out = []
    for g in range(25):
        base = [rnd.choice(words) for _ in range(rnd.choice([3, 8, 60, 150, 150]))]
        if g % 2:
            base += passage
        for _ in range(rnd.choice([1, 2, 8, 40])):
            copy = list(base)
            for _ in range(rnd.choice([0, 1, 2, 3, 4])):
                copy[rnd.randrange(len(copy))] = rnd.choice(words)
            out.append(" ".join(copy[: rnd.choice([len(copy), len(copy), len(copy) - len(copy) // 10])]))
    rnd.shuffle(out)
    return out + [None, "", " ", "one", "ONE", "a b c d", "a b c", out[0], out[0].upper(), " ".join(passage), "x " * 30000]


@pytest.mark.parametrize("group", [200, 3])
def test_components_equal_brute_force(spark, docs, monkeypatch, group):
    """With whole clusters in a group, and with clusters cut into many."""
    monkeypatch.setattr(token_groups, "GROUP_CLASSES", group)
    monkeypatch.setattr(token_groups, "QUERIES_TOKENS", 500 * group)
    texts = list(enumerate(corpus(group)))
    expected = brute(texts)
    got = by_id(token_groups.joined(docs(texts).repartition(6)))
    assert {i: (r["n_shingles"], r["component_id"]) for i, r in got.items()} == expected
    assert len({c for _, c in expected.values()}) < 0.8 * len(texts)


def test_hot_tokens_are_dealt_by_class(spark, docs, monkeypatch):
    """A passage in most documents is hot, and links stay the same."""
    rnd = random.Random(5)
    passage = " ".join(f"p{i}" for i in range(60))
    texts = []
    for i in range(150):
        own = " ".join(rnd.choice("abcdefgh") + str(rnd.randrange(50)) for _ in range(rnd.choice([4, 15, 200])))
        texts += [passage + " " + own] + [passage + " " + own + " end"] * (i % 3 == 0)
    texts = list(enumerate(texts))
    table = docs(texts)
    rows = token_groups.per_text(table.select("doc_id", "text"), "text", "r", token_groups.SIZED, token_groups._sizer).select("doc_id", "r.*")
    assert len(token_groups.hot_tokens(rows)) >= 56
    got = by_id(token_groups.joined(table))
    assert {i: (r["n_shingles"], r["component_id"]) for i, r in got.items()} == brute(texts)


def test_null_ids_repeated_rows_and_empty_tables(spark, docs):
    text = " ".join(f"v{i}" for i in range(30))
    other = " ".join(f"u{i}" for i in range(30))
    rows = token_groups.joined(docs([(None, text), (5, text), (5, text), (9, text), (7, other), (9, other), (11, None)])).collect()
    assert sorted((r["doc_id"] or 0, r["n_shingles"], r["component_id"] or -1) for r in rows) == [
        (0, 26, -1), (5, 26, 5), (5, 26, 5), (7, 26, 5), (9, 26, 5), (9, 26, 5), (11, 0, 11)]
    assert token_groups.joined(docs([])).count() == 0
    assert by_id(token_groups.joined(docs([None, ""])))[1]["component_id"] == 1


def test_overlaps_and_bound():
    rng = np.random.default_rng(4)
    sets = [np.unique(rng.integers(0, 60, 25).astype(np.uint64)) for _ in range(9)]
    assert (token_groups.overlaps(sets[:4], sets) == np.array([[len(np.intersect1d(a, b)) for b in sets] for a in sets[:4]])).all()
    assert token_groups.overlaps([], sets).shape == (0, 9)
