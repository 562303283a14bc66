import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import types as T

from tickloom.llm import merkle

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # Names that the operator uses itself.
    T.StructField("tree", T.StringType()), T.StructField("digest", T.LongType())])


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row, text):
    values = (row[0], row[3], row[2], row[4], text)
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def brute(rows):
    """Rows of the report, by plain recursion over the whole tree."""
    trees = {}
    for r in rows:
        trees.setdefault(r[3], []).append(r)
    order = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))

    def levels(nodes):
        out = [nodes]
        while len(out[-1]) > 1:
            out.append([h(*out[-1][i:i + 3]) for i in range(0, len(out[-1]), 3)])
        return out

    def climb(all_levels, at, new):
        siblings = []
        for level in all_levels[:-1]:
            first = at // 3 * 3
            run = level[first:first + 3]
            siblings += [x for i, x in enumerate(run) if first + i != at]
            run[at - first] = new
            new, at = h(*run), at // 3
        return new, siblings

    built = {}
    for s in order:
        own = sorted(trees[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r, r[1])))
        built[s] = own, levels([leaf_of(r, r[1]) for r in own])
    top = levels([built[s][1][-1][0] for s in order]) if order else []
    out = []
    for place, s in enumerate(order):
        own, tree = built[s]
        for i, r in enumerate(own):
            text = r[1]
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 and text is not None:
                text = text.replace("\n", "")
            new, below = climb(tree, i, leaf_of(r, text))
            new, above = climb(top, place, new)
            out.append((r[0], tree[0][i], tree[-1][0], top[-1][0], h(*below, *above), new, new == top[-1][0]))
    return out


def corpus(seed):
    rnd = random.Random(seed)
    rows = []
    for i in range(400):
        source = rnd.choice(["hot"] * 6 + [None, "", "a", "b", "ä", "a\x00"])
        text = rnd.choice([None, "", "one\nline", "täxt \n\n 𝄞", "x" * 5000, f"t{i}"])
        rows.append((i, text, rnd.choice([None, "en"]), source, rnd.choice([None, i]), "t", 1))
    rows += [(None, "null id\n", "en", "hot", 1, None, None), (7, "again\n", "en", "hot", 1, None, None), rows[3], rows[3],
             (-5, "alone\n", None, "single", None, "x", 2)]
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("levels", [1, 2, 6])
def test_report_equals_brute_force(spark, levels):
    """With groups inside a block, and groups over many blocks and rounds."""
    rows = corpus(levels)
    got = [tuple(r) for r in merkle.report(spark.createDataFrame(rows, SCHEMA).repartition(5), levels).collect()]
    key = lambda r: (r[0] is not None, r[0] or 0, *map(str, r[1:]))
    assert sorted(got, key=key) == sorted(brute(rows), key=key)
    assert 0 < sum(not r[-1] for r in got) < len(got)


@pytest.mark.parametrize("count", [1, 2, 3, 4, 9, 10, 28])
def test_sizes_around_powers_of_the_arity(spark, count):
    rows = [(i, f"a\n{i}", "en", "s", 1, None, None) for i in range(count)]
    got = [tuple(r) for r in merkle.report(spark.createDataFrame(rows, SCHEMA), 2).collect()]
    assert sorted(got) == sorted(brute(rows))


def test_empty_table(spark):
    assert merkle.report(spark.createDataFrame([], SCHEMA)).count() == 0


def test_states_are_those_of_the_hash():
    rng = np.random.default_rng(1)
    digests = rng.integers(0, 2**32, (5, 8), dtype=np.uint64).astype(np.uint32)
    text = ["".join(f"{w:08x}" for w in d) for d in digests]
    level = merkle.Level(digests, np.array([0, 1, 2, 0, 1]), np.array([0, 0, 0, 1, 1]))
    words = lambda t: np.array([int(t[i:i + 8], 16) for i in range(0, 64, 8)], np.uint32)
    assert (level.tops == np.stack([words(h(*text[:3])), words(h(*text[3:]))])).all()
    new = digests[[2, 3, 0]] ^ np.uint32(1)
    changed = ["".join(f"{w:08x}" for w in d) for d in new]
    folded = level.folded(new, np.array([1, 4, 0]))
    assert (folded == np.stack([words(h(text[0], changed[0], text[2])), words(h(text[3], changed[1])), words(h(changed[2], *text[1:3]))])).all()
    # An empty message, and round constants by their own rule.
    assert (merkle.closed(merkle.starts(1), np.zeros(1, np.int64))[0] == words(h())).all()
