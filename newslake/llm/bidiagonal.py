"""Singular values and right directions of a small square matrix by way of its bidiagonal form.

Householder reflections from both sides leave an upper bidiagonal matrix B. The squares
of its entries are a qd array; dqds steps, made of sums, products and quotients of
positive numbers, find the squared singular values to high relative accuracy. Of each
value wanted, a twisted factorisation of B'B less that value, the forward and backward
factors joined where the pivot is least, gives the direction in one product. Values too
close to tell apart share a block of directions.
"""

from __future__ import annotations

import math

import numpy as np

_EPS = np.finfo(float).eps
_NONE = (16 * _EPS) ** 2
_CLOSE = 1e-5
# Directions of singular values below this part of the largest would be mostly rounding.
_LEAST = 1e-11


def bidiagonalised(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal, superdiagonal and W of an upper bidiagonal B with the square ``r`` = U B W' for some orthogonal U."""
    a = np.array(r, float)
    d = a.shape[1]
    w = np.eye(d)
    for k in range(d):
        v = _reflector(a[k:, k])
        if v is not None:
            a[k:, k:] -= np.outer(2 * v, v @ a[k:, k:])
        if k < d - 2:
            v = _reflector(a[k, k + 1 :])
            if v is not None:
                a[k:, k + 1 :] -= np.outer(a[k:, k + 1 :] @ v, 2 * v)
                w[:, k + 1 :] -= np.outer(w[:, k + 1 :] @ v, 2 * v)
    return np.diag(a).copy(), np.diag(a, 1).copy(), w


def _reflector(x: np.ndarray) -> np.ndarray | None:
    """The unit vector whose reflection sends ``x`` to its first axis; None where it lies there."""
    if not np.any(x[1:]):
        return None
    scale = np.abs(x).max()
    v = x / scale
    v[0] += math.copysign(np.linalg.norm(v), v[0])
    return v / np.linalg.norm(v)


def _step(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], list[float]] | None:
    """One dqds transform: new q and e and the d of its way; None if the shift lies above the least value."""
    new_q, new_e, ds = [], [], []
    d = q[0] - shift
    for i, off in enumerate(e):
        if d < 0:
            return None
        ds.append(d)
        total = d + off
        if total == 0:
            return None
        t = q[i + 1] / total
        new_q.append(total)
        new_e.append(off * t)
        d = d * t - shift
    if not d >= 0:
        return None
    ds.append(d)
    new_q.append(d)
    return new_q, new_e, ds


def squared_values(diagonal: np.ndarray, above: np.ndarray) -> np.ndarray:
    """Squared singular values of an upper bidiagonal matrix, falling."""
    found: list[float] = []
    todo = [([float(x) ** 2 for x in diagonal], [float(x) ** 2 for x in above], 0.0)]
    while todo:
        q, e, sigma = todo.pop()
        if len(q) > 1 and q[0] < q[-1]:
            q, e = q[::-1], e[::-1]
        shift, wary = 0.0, False
        while len(q) > 1:
            small = [i for i, x in enumerate(e) if x <= _NONE * (sigma + max(q[i], q[i + 1]))]
            if small:
                # The matrix falls apart; its parts go their own ways.
                at = small[-1]
                todo.append((q[: at + 1], e[:at], sigma))
                q, e, shift, wary = q[at + 1 :], e[at + 1 :], 0.0, False
                continue
            moved = _step(q, e, shift) if shift else None
            if moved is None:
                wary, shift = shift > 0, 0.0
                moved = _step(q, e, shift)
            q, e, ds = moved
            sigma += shift
            # After a step without shift 1/d are the diagonal of an inverse, whose sum bounds the least
            # value from below. Near to it the last corner is a better guess, which a step may refuse.
            least = min(ds)
            bound = 0.99 / sum(1 / x for x in ds) if least > 0 else 0.0
            corner = q[-1] - math.sqrt(q[-1] * e[-1]) if e[-1] < 1e-2 * q[-1] else 0.0
            shift = bound if wary else max(bound, corner)
            wary = False
        found += [sigma + x for x in q]
    return np.array(sorted(found, reverse=True))


def _twisted(diagonal: np.ndarray, above: np.ndarray, value: float) -> np.ndarray:
    """The unit vector of B'B nearest to an eigenvector of ``value``."""
    n = len(diagonal)
    tiny = np.finfo(float).tiny
    pivots = diagonal * diagonal
    low = above / diagonal[:-1]
    down, up = np.zeros(n - 1), np.zeros(n - 1)
    s, p = np.empty(n), np.empty(n)
    s[0] = -value
    for i in range(n - 1):
        pivot = s[i] + pivots[i]
        pivot = pivot if abs(pivot) > tiny else -tiny
        down[i] = low[i] * pivots[i] / pivot
        s[i + 1] = down[i] * low[i] * s[i] - value
    p[-1] = pivots[-1] - value
    for i in range(n - 2, -1, -1):
        pivot = low[i] * low[i] * pivots[i] + p[i + 1]
        pivot = pivot if abs(pivot) > tiny else -tiny
        up[i] = low[i] * pivots[i] / pivot
        p[i] = p[i + 1] * (pivots[i] / pivot) - value
    gamma = np.abs(s + p + value)
    twist = int(np.argmin(np.where(np.isfinite(gamma), gamma, np.inf)))
    z = np.zeros(n)
    z[twist] = 1.0
    for i in range(twist - 1, -1, -1):
        z[i] = -down[i] * z[i + 1]
    for i in range(twist, n - 1):
        z[i + 1] = -up[i] * z[i]
    return z / np.linalg.norm(z)


def _times(diagonal: np.ndarray, above: np.ndarray, z: np.ndarray) -> np.ndarray:
    """B z for the columns of ``z``."""
    out = diagonal[:, None] * z
    out[:-1] += above[:, None] * z[1:]
    return out


def _close_block(diagonal: np.ndarray, above: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Orthonormal directions of values too close to tell apart: inverse steps of a block, then its own small problem."""
    n, m = len(diagonal), len(values)
    t = np.diag(diagonal**2) + np.diag(diagonal[:-1] * above, 1) + np.diag(diagonal[:-1] * above, -1)
    t[np.arange(1, n), np.arange(1, n)] += above**2
    # Just beside the values, so that the system can be solved.
    beside = t - (values.mean() + max(values[0] - values[-1], values[0] * 1e-10)) * np.eye(n)
    z = np.linalg.qr(np.random.default_rng(m).standard_normal((n, m)))[0]
    for _ in range(4):
        z = np.linalg.qr(np.linalg.solve(beside, z))[0]
    image = _times(diagonal, above, z)
    return z @ np.linalg.svd(image, full_matrices=False)[2].T


def right_directions(r: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """All squared singular values of ``r``, which is square or wider than high, falling, and the right directions of the first ``count`` as columns.

    Singular values below 1e-11 of the largest get no direction.
    """
    d = r.shape[1]
    scale = np.abs(r).max() if r.size else 0.0
    if not scale:
        return np.zeros(d), np.zeros((d, 0))
    square = np.concatenate([r / scale, np.zeros((max(0, d - len(r)), d))])
    diagonal, above, w = bidiagonalised(square)
    values = squared_values(diagonal, above)
    count = int((values[:count] > _LEAST**2 * values[0]).sum())
    # A zero pivot becomes one that no entry of B'B notices.
    solid = np.where(np.abs(diagonal) < _EPS * 1e-8, _EPS * 1e-8, diagonal)
    columns: list[np.ndarray] = []
    first = 0
    while first < count:
        last = first + 1
        while last < d and values[last - 1] - values[last] < _CLOSE * values[first]:
            last += 1
        own = values[first:last]
        z = _twisted(solid, above, own[0])[:, None] if len(own) == 1 else _close_block(diagonal, above, own)
        columns.append(z)
        first = last
    z = np.concatenate(columns, axis=1)[:, :count]
    # What rounding left between directions of different values goes, later ones giving way.
    basis, upper = np.linalg.qr(z)
    return values * scale * scale, w @ (basis * np.sign(np.diag(upper)))
