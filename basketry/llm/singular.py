"""Singular values and right singular vectors of a small upper triangular matrix.

Householder reflections bring the triangle to upper bidiagonal form B = U' R V. The squares of
its diagonals are the qd variables, and dqds finds the squared singular values from them without
subtractions, so small ones are as exact as large ones. A vector of B'B comes from a twisted
factorisation: stationary qd from the top and progressive qd from the bottom meet where the
residual is smallest. Vectors of values that lie too close together for that are found as one
invariant space. The matrix has one row per dimension, so all of this is small.
"""

from __future__ import annotations

import numpy as np

_EPS = np.finfo(np.float64).eps
_TINY = 1e-280


def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal and superdiagonal of U' r V, and V."""
    a = np.array(r, np.float64)
    n = a.shape[0]
    v = np.eye(n)
    for k in range(n):
        _reflect(a[k:, k:])
        if k + 2 < n:
            w = _reflect(a[k:, k + 1 :].T)
            if w is not None:
                v[:, k + 1 :] -= 2 * np.outer(v[:, k + 1 :] @ w, w)
    return np.diag(a).copy(), np.diag(a, 1).copy(), v


def _reflect(a: np.ndarray) -> np.ndarray | None:
    """Make the first column of `a` a multiple of the first unit vector, in place."""
    w = a[:, 0].copy()
    length = np.linalg.norm(w)
    if length == 0 or not np.any(w[1:]):
        return None
    w[0] += np.copysign(length, w[0])
    w /= np.linalg.norm(w)
    a -= 2 * np.outer(w, w @ a)
    return w


def _step(q: np.ndarray, e: np.ndarray, shift: float) -> tuple[np.ndarray, np.ndarray] | None:
    """One dqds transform; None if the shift was above the smallest value."""
    n = q.size
    new_q, new_e = np.empty(n), np.empty(n - 1)
    d = q[0] - shift
    for i in range(n - 1):
        if d < 0:
            return None
        new_q[i] = max(d + e[i], _TINY)
        ratio = q[i + 1] / new_q[i]
        new_e[i] = e[i] * ratio
        d = d * ratio - shift
    if d < 0:
        return None
    new_q[n - 1] = d
    return new_q, new_e


def squared_values(diagonal: np.ndarray, upper: np.ndarray) -> np.ndarray:
    """The squared singular values of a bidiagonal matrix, largest first."""
    scale = max(np.abs(diagonal).max(initial=0.0), np.abs(upper).max(initial=0.0))
    if scale == 0:
        return np.zeros(diagonal.size)
    found: list[float] = []
    blocks = [((diagonal / scale) ** 2, (upper / scale) ** 2, 0.0)]
    while blocks:
        q, e, moved = blocks.pop()
        # Off-diagonals that no longer matter cut the matrix.
        cut = np.flatnonzero(e <= (_EPS**2) * (moved + np.minimum(q[:-1], q[1:])) + _TINY)
        if cut.size:
            edges = [0, *(cut + 1), q.size]
            blocks += [(q[a:b], e[a : b - 1], moved) for a, b in zip(edges, edges[1:])]
            continue
        n = q.size
        if n == 1:
            found.append(moved + q[0])
            continue
        if n == 2:
            found += [moved + x for x in _pair(q, e)]
            continue
        # The smaller value of the last two rows is near the least one; too large a shift is seen.
        shift = min(_pair(q[-2:], e[-1:])[1], q.min())
        after = None
        while after is None and shift > _EPS * (moved + q.min()) * 1e-3:
            after = _step(q, e, shift)
            if after is None:
                shift *= 0.5 if shift > 1e-3 * q.min() else 0.01
        if after is None:
            shift = 0.0
            after = _step(q, e, 0.0)
        blocks.append((after[0], after[1], moved + shift))
    return np.sort(found)[::-1] * scale**2


def _pair(q: np.ndarray, e: np.ndarray) -> tuple[float, float]:
    """Both values of a matrix of two rows, the smaller one by a quotient."""
    trace, det = q[0] + q[1] + e[0], q[0] * q[1]
    root = np.sqrt(max((q[0] - q[1] + e[0]) ** 2 + 4 * q[1] * e[0], 0.0))
    large = (trace + root) / 2
    return float(large), float(det / large) if large > 0 else 0.0


def twisted_vector(diagonal: np.ndarray, upper: np.ndarray, value: float) -> np.ndarray:
    """The unit vector of B'B for one of its values, by the best of all twisted factorisations."""
    n = diagonal.size
    q, e, off = diagonal**2, upper**2, diagonal[:-1] * upper
    tiny = _EPS**2 * max(value, 1.0) + _TINY
    s, p, down, up = np.empty(n), np.empty(n), np.empty(n), np.empty(n)
    s[0] = -value
    for i in range(n - 1):  # stationary, from the top
        down[i] = q[i] + s[i] if abs(q[i] + s[i]) > tiny else tiny
        s[i + 1] = e[i] * (s[i] / down[i]) - value
    p[n - 1] = q[n - 1] - value
    for i in range(n - 2, -1, -1):  # progressive, from the bottom
        up[i + 1] = e[i] + p[i + 1] if abs(e[i] + p[i + 1]) > tiny else tiny
        p[i] = q[i] * (p[i + 1] / up[i + 1]) - value
    twist = int(np.argmin(np.abs(s + p + value)))
    z = np.zeros(n)
    z[twist] = 1.0
    for i in range(twist - 1, -1, -1):
        z[i] = -off[i] * z[i + 1] / down[i]
    for i in range(twist + 1, n):
        z[i] = -off[i - 1] * z[i - 1] / up[i]
    return z / np.linalg.norm(z)


def _refined(matrix: np.ndarray, z: np.ndarray, value: float) -> np.ndarray:
    """One step of inverse iteration for a vector, or for a space if z has several columns."""
    shifted = matrix - value * np.eye(matrix.shape[0])
    shifted[np.diag_indices_from(shifted)] += 4 * _EPS * max(abs(value), _TINY)
    try:
        return np.linalg.qr(np.linalg.solve(shifted, z))[0]
    except np.linalg.LinAlgError:
        return np.linalg.qr(z)[0]


def right_vectors(r: np.ndarray, count: int, close: float = 1e-6) -> tuple[np.ndarray, np.ndarray]:
    """All squared singular values, largest first, and the right vectors of the first `count`."""
    scale = float(np.abs(r).max(initial=0.0)) or 1.0
    diagonal, upper, v = bidiagonal(r / scale)
    values = squared_values(diagonal, upper)
    b = np.diag(diagonal) + np.diag(upper, 1)
    gram = b.T @ b
    out = np.zeros((diagonal.size, count))
    first = 0
    while first < count:
        end = first + 1
        while end < values.size and values[end - 1] - values[end] <= close * values[first]:
            end += 1
        if end == first + 1:
            z = twisted_vector(diagonal, upper, values[first])[:, None]
        else:
            z = np.random.default_rng(5).standard_normal((diagonal.size, end - first))
            for _ in range(3):
                z = _refined(gram, z, values[first:end].mean())
            # Within the space, the directions of its own values.
            z = z @ np.linalg.eigh(z.T @ gram @ z)[1][:, ::-1]
        for _ in range(2):  # leave nothing of the vectors found before
            z = z - out[:, :first] @ (out[:, :first].T @ z)
            z = np.linalg.qr(z)[0]
        keep = min(end, count) - first
        out[:, first : first + keep] = z[:, :keep]
        first = end
    return values * scale**2, v @ out
