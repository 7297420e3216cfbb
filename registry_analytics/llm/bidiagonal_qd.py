"""Singular values and right singular vectors of a small square matrix by bidiagonal qd algorithms.

Householder reflections give an upper bidiagonal B, dqds its singular values to high relative accuracy, and
twisted factorisations of B'B - s**2 I a vector for each. Matrices are as wide as vectors are long; this is
the driver's part of a whitening, whose rows Spark has reduced to one triangular factor.
"""

from __future__ import annotations

import numpy as np

EPS = np.finfo(np.float64).eps


def bidiagonalise(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(diagonal, superdiagonal, V) with r = U B V' for some orthogonal U."""
    a = r.astype(np.float64).copy()
    d = a.shape[1]
    v = np.eye(d)

    def reflector(x: np.ndarray) -> np.ndarray:
        w = x.copy()
        size = np.linalg.norm(x)
        w[0] += np.copysign(size, x[0])
        length = np.linalg.norm(w)
        return w / length if length else w

    for k in range(d):
        w = reflector(a[k:, k])
        a[k:, k:] -= 2 * np.outer(w, w @ a[k:, k:])
        if k + 2 < d:
            w = reflector(a[k, k + 1 :])
            a[k:, k + 1 :] -= 2 * np.outer(a[k:, k + 1 :] @ w, w)
            v[:, k + 1 :] -= 2 * np.outer(v[:, k + 1 :] @ w, w)
    return np.diagonal(a).copy(), np.diagonal(a, 1).copy(), v


def dqd_step(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], float] | None:
    """One differential qd transform with a shift: new q, e and the least d; None if the shift was too large."""
    new_q, new_e = [], []
    d = q[0] - shift
    least = d
    for i in range(len(e)):
        if d < 0:
            return None
        head = d + e[i]
        new_q.append(head)
        if head == 0:
            new_e.append(0.0)
            d = q[i + 1] - shift
        else:
            ratio = q[i + 1] / head
            new_e.append(e[i] * ratio)
            d = d * ratio - shift
        least = min(least, d)
    if d < 0:
        return None
    new_q.append(d)
    return new_q, new_e, least


def dqds(diagonal: np.ndarray, above: np.ndarray) -> np.ndarray:
    """Squared singular values of an upper bidiagonal matrix, falling."""
    found: list[float] = []
    blocks = [([float(x) ** 2 for x in diagonal], [float(x) ** 2 for x in above], 0.0)]
    while blocks:
        q, e, moved = blocks.pop()
        shift = 0.0
        while len(q) > 1:
            cut = next((i for i in range(len(e) - 1, -1, -1) if e[i] <= EPS**2 * (q[i] + moved) or e[i] <= EPS**2 * (q[i + 1] + moved)), None)
            if cut is not None:
                if cut + 1 < len(q) - 1:
                    blocks.append((q[: cut + 1], e[:cut], moved))
                    q, e = q[cut + 1 :], e[cut + 1 :]
                else:  # the last one has converged
                    found.append(moved + q.pop())
                    e.pop()
                shift = 0.0
                continue
            if q[0] < q[-1]:  # keep the small end last; singular values stay
                q, e = q[::-1], e[::-1]
            step = dqd_step(q, e, shift)
            while step is None:
                shift = shift / 4 if shift > EPS * min(x for x in q) else 0.0
                step = dqd_step(q, e, shift)
            q, e, least = step
            moved += shift
            # the least d bounds the least value left from above: near convergence it is very close
            shift = max(0.0, min(least, q[-1]) - min(e[-1] + (q[-1] * e[-1]) ** 0.5, least)) if e[-1] < q[-1] else 0.5 * least if least < 1e-2 * q[0] else 0.0
        found.extend(moved + x for x in q)
    return np.sort(np.array(found))[::-1]


def twisted(diagonal: np.ndarray, above: np.ndarray, value: float) -> np.ndarray:
    """A unit vector z with B'B z = value z, from the twisted factorisation of least pivot."""
    n = len(diagonal)
    big = diagonal**2
    tiny = np.finfo(np.float64).tiny / EPS
    low, s = np.zeros(n), np.zeros(n)  # B'B - value I = L+ D+ L+'
    s[0] = -value
    with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
        for i in range(n - 1):
            pivot = s[i] + big[i]
            pivot = pivot if abs(pivot) > tiny else np.copysign(tiny, pivot)
            low[i] = diagonal[i] * above[i] / pivot
            s[i + 1] = low[i] * (above[i] / diagonal[i]) * s[i] - value
        up, p = np.zeros(n), np.zeros(n)  # = U- D- U-'
        gamma = s.copy()
        p[n - 1] = big[n - 1] - value
        gamma[n - 1] += big[n - 1]
        for i in range(n - 2, -1, -1):
            pivot = above[i] ** 2 + p[i + 1]
            pivot = pivot if abs(pivot) > tiny else np.copysign(tiny, pivot)
            up[i] = diagonal[i] * above[i] / pivot
            p[i] = p[i + 1] * (big[i] / pivot) - value
            gamma[i] += big[i] / pivot * p[i + 1]
    at = int(np.argmin(np.where(np.isfinite(gamma), np.abs(gamma), np.inf)))
    z = np.zeros(n)
    z[at] = 1.0
    for i in range(at - 1, -1, -1):
        z[i] = -low[i] * z[i + 1]
    for i in range(at, n - 1):
        z[i + 1] = -up[i] * z[i]
    return z / np.linalg.norm(z)


def right_vectors(diagonal: np.ndarray, above: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(squared singular values, falling; unit vectors as columns) of an upper bidiagonal matrix.

    The matrix falls apart where an element above the diagonal is at rounding level; vectors of different
    blocks are orthogonal by their places. Inside a block, vectors of values that agree to a relative 1e-4
    are made orthogonal against each other, and inverse iteration replaces one that nothing is left of.
    """
    n = len(diagonal)
    size = max(np.abs(diagonal).max(initial=0), np.abs(above).max(initial=0))
    if size == 0:
        return np.zeros(n), np.eye(n)
    floor = EPS * size * 1e-3
    diagonal = np.where(np.abs(diagonal) < floor, floor, diagonal)  # moves no singular value by more than the floor
    breaks = [0, *(np.flatnonzero(np.abs(above) <= EPS * size) + 1).tolist(), n]
    values, vectors = np.zeros(n), np.zeros((n, n))
    for lo, hi in zip(breaks[:-1], breaks[1:], strict=True):
        a, b = diagonal[lo:hi], above[lo : hi - 1]
        squares = dqds(a, b)
        rows = np.zeros((hi - lo, hi - lo))

        def against(z: np.ndarray, others: list[int]) -> np.ndarray:
            for _ in range(2):
                z = z - rows[others].T @ (rows[others] @ z)
            return z

        for k, value in enumerate(squares):
            near = [j for j in range(k) if squares[j] - value <= 1e-4 * squares[j]]
            z = against(twisted(a, b, value), near)
            if np.linalg.norm(z) < 0.9:  # values equal to rounding: any further vector of their common space
                z = np.random.default_rng(k).standard_normal(hi - lo)
                dense = np.diag(a**2 + np.concatenate([[0.0], b**2])) + np.diag(a[:-1] * b, 1) + np.diag(a[:-1] * b, -1)
                shifted = dense - (value * (1 + 1e-8) + EPS * squares[0]) * np.eye(hi - lo)
                for _ in range(5):
                    z = against(np.linalg.solve(shifted, z / np.linalg.norm(z)), near)
            rows[k] = z / np.linalg.norm(z)
        values[lo:hi] = squares
        vectors[lo:hi, lo:hi] = rows.T
    order = np.argsort(-values, kind="stable")
    return values[order], vectors[:, order]


def right_singular(r: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(squared singular values, falling; right singular vectors as columns) of a square matrix."""
    size = np.abs(r).max(initial=0)
    if size == 0:
        return np.zeros(len(r)), np.eye(len(r))
    diagonal, above, v = bidiagonalise(r / size)
    values, z = right_vectors(diagonal, above)
    return values * size**2, v @ z
