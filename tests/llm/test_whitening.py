"""Whitening against numpy's symmetric eigensolver and against exact whole-number arithmetic."""

import math

import numpy as np
import pytest

from newslake.llm import queries, whitening
from newslake.llm.bidiagonal import bidiagonalised, right_directions, squared_values

RNG = np.random.default_rng(5)


def turned(values):
    n = len(values)
    a, b = (np.linalg.qr(RNG.standard_normal((n, n)))[0] for _ in "ab")
    return np.linalg.qr(a @ np.diag(values) @ b, mode="r")


MATRICES = {
    "one": np.array([[-2.0]]), "two": np.array([[1.0, 2.0], [0.0, 3.0]]), "zero": np.zeros((5, 5)), "alike": np.eye(20) * 3, "rank_one": np.ones((6, 6)),
    "wide": np.linalg.qr(RNG.standard_normal((7, 30)), mode="r"), "plain": np.linalg.qr(RNG.standard_normal((300, 64)), mode="r"),
    "groups": turned(np.r_[np.full(10, 5.0), np.full(10, 2.0), np.linspace(1, 1e-3, 10)]), "near": turned(np.r_[5, 5 - 1e-9, 5 - 1e-7, 5 - 1e-4, np.linspace(4, 1, 20)]),
    "graded": turned(10.0 ** -np.arange(24)), "zero_columns": np.linalg.qr(RNG.standard_normal((40, 6)) * [1, 0, 1, 1, 0, 1], mode="r"),
    "pivots": np.diag([1.0, 0.0, 2.0, 0.0]) + np.diag([3.0, 1.0, 1.0], 1),
}


@pytest.mark.parametrize("name", MATRICES)
def test_right_directions(name):
    r = MATRICES[name]
    d = r.shape[1]
    values, z = right_directions(r, 16)
    want = np.linalg.svd(np.concatenate([r, np.zeros((d - len(r), d))]), compute_uv=False) ** 2
    top = max(want[0], 1e-300)
    assert np.abs(values - want).max() < 1e-13 * top
    count = z.shape[1]
    assert count == min(16, int((want > 1e-22 * top).sum())) if want[0] else count == 0
    if count:
        assert np.abs(z.T @ z - np.eye(count)).max() < 1e-13
        assert np.abs(r.T @ (r @ z) - z * values[:count]).max() < 1e-13 * top


def test_small_values_keep_their_digits():
    """Of a bidiagonal matrix, dqds finds the least value as well as the largest."""
    diagonal, above = 10.0 ** -np.arange(0, 24, 2.0), 10.0 ** -np.arange(1, 23, 2.0)
    got = squared_values(diagonal, above)
    product = math.prod(float(x) for x in got)
    assert math.isclose(product, math.prod(float(x) ** 2 for x in diagonal), rel_tol=1e-13)


def test_bidiagonal_form():
    r = MATRICES["plain"]
    diagonal, above, w = bidiagonalised(r)
    b = np.diag(diagonal) + np.diag(above, 1)
    assert np.abs(w @ b.T @ b @ w.T - r.T @ r).max() < 1e-11 and np.abs(w.T @ w - np.eye(64)).max() < 1e-13


def brute(rows):
    """The contract, row by row, with numpy's eigh for the components."""
    kept = [(i, [math.floor(64 * c) + 1_000_000 for c in v]) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted({tuple(x) for _, x in kept})
    n, d = len(fit), len(fit[0])
    sums = [sum(x[k] for x in fit) for k in range(d)]
    y = np.array([[n * x[k] - sums[k] for k in range(d)] for x in fit], float) / n
    e, z = np.linalg.eigh(y.T @ y / n)
    e, z = e[::-1], z[:, ::-1]
    out = {}
    for i, x in kept:
        apart = [n * x[k] - sums[k] for k in range(d)]
        out.setdefault(i, []).append((sum(a * a for a in apart), np.array(apart, float) / n @ z / np.sqrt(np.maximum(e, 1e-30))))
    return n, e, out


def table(spark, rows, work):
    spark.createDataFrame([(i, v, 9) for i, v in rows], "vec_id long, embedding array<float>, x int").write.parquet(f"{work}/embeddings.parquet")


def vectors(n, d, seed=1):
    rng = np.random.default_rng(seed)
    base = rng.standard_normal((n, d)) * np.linspace(3, 0.3, d)
    return [[float(np.float32(c)) for c in v] for v in base]


@pytest.mark.parametrize("n,d", [(300, 24), (40, 5)])
def test_query(spark, work, n, d):
    vs = vectors(n, d)
    rows = list(enumerate(vs)) + [(n + i, vs[0]) for i in range(200)] + [(0, vs[3]), (None, vs[5])]
    rows += [(-1, None), (-2, [None] * d), (-3, [float("nan")] * d), (-4, [float("inf")] + vs[0][1:]), (-5, [1.0]), (-6, [])]
    table(spark, rows, work)
    got = queries.op13_embedding_whitening(spark, work).collect()
    count, e, want = brute([r for r in rows if r[1] is None or len(r[1]) == d])
    k = min(16, d)
    assert len(got) == k * sum(map(len, want.values()))
    assert {r.n for r in got} == {count} and {r.component for r in got} == set(range(1, k + 1))
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-12
    signs = {r.component: np.sign(r.whitened * want[7][0][1][r.component - 1]) for r in got if r.vec_id == 7}
    for r in got:
        options = [(dev, w[r.component - 1] * signs[r.component]) for dev, w in want[r.vec_id]]
        assert any(r.deviation == dev and math.isclose(r.whitened, w, rel_tol=1e-9, abs_tol=1e-9) for dev, w in options)
        assert math.isclose(r.explained, e[r.component - 1] / e.sum(), rel_tol=1e-12)


def test_tables_without_components(spark, work):
    table(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0]), (3, None)], f"{work}/same")
    table(spark, [], f"{work}/empty")
    table(spark, [(1, []), (2, [])], f"{work}/void")
    for name in ("same", "empty", "void"):
        result = queries.op13_embedding_whitening(spark, f"{work}/{name}")
        assert result.count() == 0 and result.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_few_rows_have_few_components(spark, work):
    table(spark, list(enumerate(vectors(4, 30))), work)
    got = queries.op13_embedding_whitening(spark, work).collect()
    assert {r.component for r in got} == {1, 2, 3} and got[0].identity_error < 1e-9


def test_large_entries_are_exact(spark, work):
    rows = [(i, [float(np.float32(c * 1e8)) for c in v]) for i, v in enumerate(vectors(30, 3))] + [(99, [1e30, 0.0, 0.0])]
    found = whitening.whole_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    model = whitening.fit(whitening.fit_list(found, f"{work}/fit"))
    want = brute(rows[:-1])[2]
    got = whitening.whitened(found, model).collect()
    assert {r.vec_id: int(r.deviation) for r in got} == {i: w[0][0] for i, w in want.items()}
