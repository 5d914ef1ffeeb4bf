"""Leading eigenpairs of a symmetric matrix: Householder tridiagonalisation, bisection by
Sturm counts, inverse iteration. For matrices of a few thousand rows, on one machine."""

from __future__ import annotations

import numpy as np

EPS = np.finfo(np.float64).eps
CLUSTER = 1e-3  # eigenvalues nearer than this share of the norm are orthogonalised together


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, off-diagonal and the unit reflector of each step."""
    a = np.array(matrix, np.float64)
    d = len(a)
    reflectors = []
    for k in range(d - 2):
        column = a[k + 1 :, k]
        v = column.copy()
        norm = np.linalg.norm(column)
        if norm > 0 and np.any(column[1:]):
            v[0] += np.copysign(norm, column[0])
            v /= np.linalg.norm(v)
        else:
            v[:] = 0  # nothing to clear
        reflectors.append(v)
        rest = a[k + 1 :, k + 1 :]
        p = rest @ v
        p -= (v @ p) * v
        rest -= 2 * (np.outer(v, p) + np.outer(p, v))
        a[k + 1 :, k] -= 2 * (v @ column) * v
    return np.diag(a).copy(), np.diag(a, -1).copy(), reflectors


def sturm_counts(diagonal: np.ndarray, off: np.ndarray, at: np.ndarray) -> np.ndarray:
    """For each shift, how many eigenvalues lie below it."""
    squares = np.concatenate([[0.0], off * off])
    least = max(np.finfo(np.float64).tiny * max(squares.max(), 1.0) * 4, np.finfo(np.float64).tiny * 4)
    q = np.ones_like(at)
    below = np.zeros(len(at), np.int64)
    for x, s in zip(diagonal, squares):
        q = x - at - s / q
        q = np.where(np.abs(q) < least, -least, q)
        below += q < 0
    return below


def leading_values(diagonal: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """The k largest eigenvalues, falling, to the last bits of the norm."""
    d = len(diagonal)
    reach = np.concatenate([[0.0], np.abs(off)]) + np.concatenate([np.abs(off), [0.0]])
    norm = np.max(np.abs(diagonal) + reach, initial=0.0)
    low = np.full(k, np.min(diagonal - reach) - 2 * EPS * norm)
    high = np.full(k, np.max(diagonal + reach) + 2 * EPS * norm)
    wanted = d - np.arange(k)  # as many lie below anything above the value sought
    for _ in range(200):
        middle = low + (high - low) / 2
        above = sturm_counts(diagonal, off, middle) >= wanted
        high, low = np.where(above, middle, high), np.where(above, low, middle)
        if (high - low <= 2 * EPS * np.maximum(np.abs(low), np.abs(high)) + EPS * EPS * norm).all():
            break
    return low + (high - low) / 2


def _solve_shifted(diagonal: np.ndarray, off: np.ndarray, shift: float, least: float):
    """A solver of (T - shift) z = b, by elimination with row exchanges."""
    d = len(diagonal)
    main = (diagonal - shift).tolist()
    upper, lower = off.tolist() + [0.0], off.tolist()
    second = [0.0] * d
    steps = []
    for i in range(d - 1):
        if abs(main[i]) >= abs(lower[i]):
            if main[i] == 0.0:
                main[i] = least
            factor = lower[i] / main[i]
            steps.append((False, factor))
            main[i + 1] -= factor * upper[i]
        else:
            factor = main[i] / lower[i]
            steps.append((True, factor))
            main[i], upper[i], second[i], main[i + 1], upper[i + 1] = (
                lower[i],
                main[i + 1],
                upper[i + 1],
                upper[i] - factor * main[i + 1],
                -factor * upper[i + 1],
            )
    main = [x if abs(x) >= least else float(np.copysign(least, x)) for x in main]

    def solve(b: np.ndarray) -> np.ndarray:
        z = b.tolist()
        for i, (swapped, factor) in enumerate(steps):
            if swapped:
                z[i], z[i + 1] = z[i + 1], z[i] - factor * z[i + 1]
            else:
                z[i + 1] -= factor * z[i]
        for i in range(d - 1, -1, -1):
            x = z[i]
            if i + 1 < d:
                x -= upper[i] * z[i + 1]
            if i + 2 < d:
                x -= second[i] * z[i + 2]
            z[i] = x / main[i]
        return np.array(z)

    return solve


def tridiagonal_vectors(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors as columns, by inverse iteration; within a cluster of values each is
    kept orthogonal to those before it."""
    d = len(diagonal)
    norm = max(np.max(np.abs(diagonal)) + 2 * np.max(np.abs(off), initial=0.0), np.finfo(np.float64).tiny / EPS)
    draw = np.random.default_rng(0)
    out = np.zeros((d, len(values)))
    first, shift = 0, np.inf
    for k, value in enumerate(values):
        if k and values[k - 1] - value > CLUSTER * norm:
            first = k
        # equal values get shifts of their own, or all would find the same vector
        shift = value if k == first else min(value, shift - 2 * EPS * norm)
        solve = _solve_shifted(diagonal, off, shift, EPS * norm)
        z = draw.standard_normal(d)
        for _ in range(5):
            for _ in range(2):
                z -= out[:, first:k] @ (out[:, first:k].T @ z)
            z = solve(z / np.linalg.norm(z))
            z /= np.max(np.abs(z))
        for _ in range(2):
            z -= out[:, first:k] @ (out[:, first:k].T @ z)
            z /= np.linalg.norm(z)
        out[:, k] = z
    return out


def leading_components(matrix: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k largest eigenvalues, falling, and their unit eigenvectors as columns, each with
    its entry of the largest magnitude positive."""
    matrix = (matrix + matrix.T) / 2
    scale = np.max(np.abs(matrix), initial=0.0)
    k = min(k, len(matrix))
    if not k or not scale:
        return np.zeros(k), np.eye(len(matrix))[:, :k]
    diagonal, off, reflectors = tridiagonal(matrix / scale)
    values = leading_values(diagonal, off, k)
    z = tridiagonal_vectors(diagonal, off, values)
    for step in range(len(reflectors) - 1, -1, -1):
        v = reflectors[step]
        z[step + 1 :] -= 2 * np.outer(v, v @ z[step + 1 :])
    top = z[np.argmax(np.abs(z), axis=0), np.arange(k)]
    return values * scale, z * np.where(top < 0, -1.0, 1.0)
