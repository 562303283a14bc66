import math

import numpy as np
import pytest
from pyspark.sql import types as T

from tickloom.llm import whitening
from tickloom.llm.whitening import Spectrum

SCHEMA = T.StructType([
    T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
    # Names that the operator uses itself.
    T.StructField("x", T.StringType()), T.StructField("component", T.IntegerType())])


def table(spark, vectors):
    rows = [(v[0], v[1], "x", 1) if isinstance(v, tuple) else (i, None if v is None else [None if c is None else float(c) for c in v], "x", 1)
            for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def check(got, vectors, components=16):
    """got against a plain eigendecomposition; vectors: id -> list of floats."""
    x = {i: [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for i, v in vectors}
    ids = [i for i, _ in vectors]
    fit = np.array(sorted({tuple(v) for v in x.values()}), dtype=object)
    n, sums = len(fit), fit.sum(0)
    y = np.array([[float(c) / n for c in n * row - sums] for row in fit])
    values, vecs = np.linalg.eigh(y.T @ y / n)
    values, vecs = values[::-1], vecs[:, ::-1]
    k = min(components, int((values > 1e-12 * values.sum()).sum()))
    assert sorted((r["vec_id"], r["component"]) for r in got) == sorted((i, c) for i in ids for c in range(1, k + 1))
    by = {}
    for r in got:
        by.setdefault(r["component"], {}).setdefault(r["vec_id"], []).append(r)
    assert len({r["identity_error"] for r in got}) == 1 and got[0]["identity_error"] < 1e-9
    for c in range(k):
        truth = np.array([((n * np.array(x[i], object) - sums) / n).astype(float) @ vecs[:, c] / math.sqrt(values[c]) for i in ids])
        mine = np.array([by[c + 1][i][0]["whitened"] for i in ids])
        sign = np.sign(truth[np.abs(truth).argmax()] * mine[np.abs(truth).argmax()])
        assert np.abs(sign * mine - truth).max() < 1e-7
        for i in ids:
            r = by[c + 1][i][0]
            assert r["n"] == n and r["deviation"] == int(((n * np.array(x[i], object) - sums) ** 2).sum())
            assert r["explained"] == pytest.approx(values[c] / values.sum(), rel=1e-6)


def test_whitening_equals_a_plain_eigendecomposition(spark, monkeypatch):
    """With several spectra and rounds of combining."""
    monkeypatch.setattr(whitening, "TASK_ROWS", 20)
    rng = np.random.default_rng(1)
    vectors = (rng.standard_normal((500, 24)) * np.linspace(0.2, 3, 24)).astype(np.float32)
    vectors[100:180] = vectors[0]  # copies
    vectors[200] += 1e-5
    df = table(spark, list(vectors))
    check(whitening.report(df).collect(), list(enumerate(vectors)))


def test_fewer_dimensions_and_dependent_ones(spark):
    rng = np.random.default_rng(2)
    v = rng.integers(-50, 50, (60, 5)).astype(np.float32)
    v[:, 3] = v[:, 1]
    v[:, 4] = 2
    check(whitening.report(table(spark, list(v))).collect(), list(enumerate(v)))


def test_broken_vectors_repeated_rows_and_large_entries(spark):
    rng = np.random.default_rng(3)
    good = [(i, [float(c) for c in rng.standard_normal(3)]) for i in range(20)]
    bad = [(100, None), (101, [1.0, None, 2.0]), (102, [float("nan"), 0.0, 1.0]), (103, [float("inf"), 0.0, 1.0]), (104, []),
           (105, [1.0, 2.0]), (106, [1e30, 0.0, 0.0])]
    got = whitening.report(table(spark, good + bad)).collect()
    check(got, good)
    again = whitening.report(table(spark, good + [good[0], (None, good[1][1])])).collect()
    assert len(again) == 22 * 3 and {r["n"] for r in again} == {20}
    assert sum(r["vec_id"] is None for r in again) == 3
    far = whitening.report(table(spark, good + [(50, [1e9, 1e9, -1e9])])).collect()
    assert {r["deviation"] is None for r in far if r["vec_id"] == 50} == {True}


def test_nothing_to_fit(spark):
    assert whitening.report(table(spark, [])).count() == 0
    assert whitening.report(table(spark, [None, [1.0, 2.0], [1.0, 2.0]])).count() == 0
    assert whitening.report(table(spark, [[1.0], [2.0]])).count() == 2


@pytest.mark.parametrize("dims, count, ties", [(1, 5, False), (6, 200, True), (30, 12, False)])
def test_spectrum_follows_the_scatter(dims, count, ties):
    rng = np.random.default_rng(dims)
    y = rng.integers(-9, 9, (count, dims)).astype(float)
    y[: count // 4] = y[0]
    if ties:
        y[:, 1], y[:, 2] = 0, y[:, 3]
    whole, one, two = Spectrum(dims), Spectrum(dims), Spectrum(dims)
    for i, v in enumerate(y):
        whole.add(v)
        (one if i % 2 else two).add(v)
    one.merge(two)
    truth = y.T @ y
    for s in (whole, one):
        assert np.abs(s.u * s.d @ s.u.T - truth).max() < 1e-11 * max(1, np.abs(truth).max())
        assert np.abs(s.u.T @ s.u - np.eye(dims)).max() < 1e-11
        assert (np.diff(s.d) >= 0).all()


def test_equal_eigenvalues_are_deflated():
    s = Spectrum(4)
    for v in np.eye(4) * 3:
        s.add(v)
    s.add(np.array([1.0, 1, 1, 1]))
    assert np.allclose(s.d, [9, 9, 9, 13])
