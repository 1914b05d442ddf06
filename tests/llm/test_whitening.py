"""Whitening against the eigenvectors of a covariance in one place."""

from __future__ import annotations

from collections import Counter, defaultdict

import numpy as np
import pytest

from tenure.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, label int, n string, component string, sum string"


def table(spark, vectors):
    return spark.createDataFrame([(i, v, 0, "x", "y", "z") for i, v in enumerate(vectors)], SCHEMA).repartition(5)


def spread(count: int, width: int, seed: int = 7) -> np.ndarray:
    rng = np.random.default_rng(seed)
    return (rng.normal(size=(count, width)) * np.logspace(1.5, -1, width) @ np.linalg.qr(rng.normal(size=(width, width)))[0]).astype(np.float32)


def whole(vectors) -> np.ndarray:
    return np.floor(64 * np.asarray(vectors, np.float64)).astype(np.int64) + 1_000_000


def test_against_a_dense_decomposition(spark):
    vectors = spread(600, 40)
    rows = whitening.whiten(table(spark, vectors.tolist())).collect()
    x = whole(vectors)
    n = len(x)
    centred = (n * x - x.sum(axis=0)) / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    order = values.argsort()[::-1][:32]
    white = centred @ axes[:, order] / np.sqrt(values[order])
    found = np.zeros((n, 32))
    for r in rows:
        found[r["vec_id"], r["component"] - 1] = r["whitened"]
        assert r["n"] == n and r["deviation"] == int(np.square(n * x[r["vec_id"]] - x.sum(axis=0)).sum())
        assert r["explained"] == pytest.approx(values[order][r["component"] - 1] / values.sum(), rel=1e-8)
        assert r["identity_error"] < 1e-10
    assert len(rows) == n * 32
    signs = np.sign((found * white).sum(axis=0))
    assert np.abs(found * signs - white).max() < 1e-7


def test_unusable_vectors_are_left_out_and_repeated_rows_stay(spark):
    good = [[1.0, 2.0], [3.0, 1.0], [3.0, 1.0], [0.0, -4.0]]
    odd = [None, [], [1.0, None], [float("nan"), 1.0], [float("inf"), 1.0]]
    df = table(spark, good + odd).selectExpr("IF(vec_id = 2, null, vec_id) AS vec_id", "embedding", "label", "n", "component", "sum")
    rows = whitening.whiten(df).collect()
    assert Counter(r["vec_id"] for r in rows) == {0: 2, 1: 2, None: 2, 3: 2}
    by_id = defaultdict(list)
    for r in sorted(rows, key=lambda r: r["component"]):
        by_id[r["vec_id"]].append(r["whitened"])
    assert by_id[1] == by_id[None]


def test_directions_without_variance_have_no_component(spark):
    base = spread(50, 3)
    doubled = [[float(round(a)), b, 5.0, 2.0 * round(a)] for a, b, _ in base.tolist()]
    rows = whitening.whiten(table(spark, doubled)).collect()
    assert {r["component"] for r in rows} == {1, 2}
    assert all(r["identity_error"] < 1e-10 for r in rows)
    assert sum({r["component"]: r["explained"] for r in rows}.values()) == pytest.approx(1)


def test_nothing_to_fit(spark):
    for vectors in ([], [None], [[1.0, 2.0]], [[1.0, 2.0]] * 3):
        assert whitening.whiten(table(spark, vectors)).collect() == []


def test_vectors_of_different_lengths_are_refused(spark):
    with pytest.raises(Exception, match="different lengths"):
        whitening.whiten(table(spark, [[1.0, 2.0], [1.0], [3.0, 4.0]])).collect()


def test_badly_scaled_rows_come_out_orthogonal(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(400, 1)) * 1000
    vectors = (base + rng.normal(size=(400, 6)) * np.logspace(0, -1.5, 6)).tolist()
    rows = whitening.whiten(table(spark, vectors)).collect()
    assert max(r["identity_error"] for r in rows) < 1e-8


def test_triangular_solve():
    rng = np.random.default_rng(1)
    r = np.triu(rng.normal(size=(9, 9))) + 5 * np.eye(9)
    x = rng.normal(size=(30, 9))
    assert np.allclose(whitening.right_solve(x @ r, r), x)
