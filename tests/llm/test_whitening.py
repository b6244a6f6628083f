"""Whitening: the solver against numpy's, the query's rows against an eigendecomposition."""

from __future__ import annotations

import numpy as np
import pytest

from purchaseflow.llm import whitening as wh

RNG = np.random.default_rng(7)
TURN = np.linalg.qr(RNG.normal(size=(20, 20)))[0]
MATRICES = {
    "one": RNG.normal(size=(1, 1)),
    "two": RNG.normal(size=(2, 2)),
    "many": wh._triangle(RNG.normal(size=(300, 60))),
    "falling": wh._triangle(RNG.normal(size=(200, 24)) * np.logspace(0, -8, 24)),
    "rising": wh._triangle(RNG.normal(size=(200, 24)) * np.logspace(-8, 0, 24)),
    "equal": wh._triangle(TURN @ np.diag([5.0] * 5 + [1.0] + [0.5] * 14) @ TURN),
    "close": wh._triangle(TURN @ np.diag([5, 5 - 1e-9, 5 - 2e-9, 4, 4 - 1e-12] + [0.5] * 15)),
    "identity": np.eye(7),
    "rank one": wh._triangle(np.outer(RNG.normal(size=30), RNG.normal(size=9))),
    "columns of zero": wh._triangle(RNG.normal(size=(40, 8)) * np.array([1, 0, 2, 0, 1, 1, 0, 1])),
    "bidiagonal": np.diag(np.ones(21)) + np.diag(np.ones(20), 1),
    "nothing": np.zeros((5, 5)),
}


@pytest.mark.parametrize("kind", list(MATRICES))
def test_solver_finds_numpy_s_values_and_eigenvectors(kind):
    r = MATRICES[kind]
    a, b, v = wh.bidiagonal(r)
    assert np.abs(v.T @ v - np.eye(len(v))).max() < 1e-13
    expected = np.linalg.svd(r, compute_uv=False)
    values = np.sqrt(wh.dqds(a, b))
    strong = expected > expected[0] * 1e-5
    assert np.abs(values[strong] / expected[strong] - 1).max(initial=0) < 1e-11
    squares, found = wh.directions(r, 4)
    rank = np.linalg.matrix_rank(r) if r.any() else 0
    assert found.shape == (len(r), min(4, rank)) and squares.size == min(4, rank)
    # unit, orthogonal, and eigenvectors of r^T r
    assert np.abs(found.T @ found - np.eye(found.shape[1])).max(initial=0) < 1e-13
    if rank:
        far = np.linalg.norm(r.T @ (r @ found) - found * squares, axis=0)
        assert far.max() < 1e-13 * squares[0]


def rows(spark, vectors):
    listed = [(i, v, 1, 2.0) for i, v in enumerate(vectors)]
    return spark.createDataFrame(
        listed, "vec_id long, embedding array<float>, n int, whitened double"
    )


def brute(vectors, components=4):
    """n, and per vector its exact deviation; variances, total and eigenvectors of the fit list."""
    x = np.floor(np.array(vectors, dtype=np.float32).astype(float) * 256).astype(np.int64)
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    centred = (fit * n - sums) / n
    variance, directions = np.linalg.eigh(centred.T @ centred / n)
    far = ((x * n - sums) ** 2).sum(axis=1)
    return x, n, sums, far, variance[::-1], directions[:, ::-1][:, :components]


@pytest.mark.parametrize("tasks", [1, 40])
def test_whitened_rows_are_what_an_eigendecomposition_gives(spark, tasks):
    rng = np.random.default_rng(tasks)
    vectors = (rng.normal(size=(400, 12)) * np.linspace(2, 0.1, 12)).astype(np.float32).tolist()
    vectors += vectors[:150] + [vectors[0]] * 60
    got = wh.whiten(rows(spark, vectors).repartition(tasks)).collect()
    x, n, sums, far, variance, directions = brute(vectors)
    assert len(got) == 4 * len(vectors)
    values = np.zeros((len(vectors), 4))
    for r in got:
        assert (r["n"], r["deviation"]) == (n, far[r["vec_id"]])
        assert abs(r["explained"] / (variance[r["component"] - 1] / variance.sum()) - 1) < 1e-10
        assert r["identity_error"] < 1e-10
        values[r["vec_id"], r["component"] - 1] = r["whitened"]
    expected = ((x * n - sums) / n) @ directions / np.sqrt(variance[:4])
    signs = np.sign((values * expected).sum(axis=0))
    assert np.abs(values - expected * signs).max() < 1e-9


def test_rows_that_do_not_count_and_vectors_of_any_length(spark):
    nan, inf = float("nan"), float("inf")
    vectors = [[1.0, 2.0], [0.5], [3.0, -1.0], None, [1.0, None], [nan, 1.0], [inf, 0.0], [], [1.0, 2.0]]
    got = wh.whiten(rows(spark, vectors)).collect()
    assert sorted((r["vec_id"], r["component"]) for r in got) == [
        (i, c) for i in (0, 1, 2, 7, 8) for c in (1, 2)
    ]
    padded = [[1.0, 2.0], [0.5, 0.0], [3.0, -1.0], [0.0, 0.0]]
    _, n, _, far, variance, _ = brute(padded)
    assert {r["n"] for r in got} == {n} == {4}
    assert {r["vec_id"]: r["deviation"] for r in got} == dict(zip((0, 1, 2, 7, 8), [*far, far[0]]))
    assert max(r["identity_error"] for r in got) < 1e-12
    ids = spark.createDataFrame([(None, [1.0]), (1, [2.0]), (1, [2.0])], "vec_id int, embedding array<double>")
    assert sorted(map(str, (r["vec_id"] for r in wh.whiten(ids).collect()))) == ["1", "1", "None"]


def test_nothing_varies_or_nothing_is_there(spark):
    assert wh.whiten(rows(spark, [[1.0, 2.0]] * 5)).isEmpty()
    assert wh.whiten(rows(spark, [None, [None]])).isEmpty()
    assert wh.whiten(rows(spark, [])).isEmpty()
    assert wh.whiten(rows(spark, [[], []])).isEmpty()
    one = wh.whiten(rows(spark, [[1.0, 0.0, 5.0], [2.0, 0.0, 5.0]])).collect()
    assert [r["component"] for r in one] == [1, 1] and {abs(r["whitened"]) for r in one} == {1.0}


def test_deviations_beyond_a_long_are_null_and_exact_below():
    model = wh.Whitening(10**9, (3, -5), np.zeros((2, 0)), np.zeros(0), 0.0)
    x = np.array([[1, 2], [4, 5], [2**40, 0]])
    exact = [(10**9 * a - 3) ** 2 + (10**9 * b + 5) ** 2 for a, b in x.tolist()]
    assert model.deviations(x[:1]) == exact[:1]
    assert model.deviations(x) == [exact[0] if exact[0] < 1 << 63 else None, None, None]
