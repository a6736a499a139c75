"""Singular values and right singular vectors of a triangular matrix: Householder bidiagonalisation, dqds, twisted factorisations."""

from __future__ import annotations

import numpy as np

EPS = float(np.finfo(np.float64).eps)


def bidiagonalise(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal, superdiagonal and V of R = U B V', with B upper bidiagonal, by reflections from both sides."""
    a = np.array(r, np.float64)
    n = len(a)
    v = np.eye(n)
    for k in range(n):
        if k < n - 1:
            u = _reflector(a[k:, k])
            a[k:, k:] -= np.outer(2 * u, u @ a[k:, k:])
        if k < n - 2:
            w = _reflector(a[k, k + 1 :])
            a[k:, k + 1 :] -= np.outer(a[k:, k + 1 :] @ w, 2 * w)
            v[:, k + 1 :] -= np.outer(v[:, k + 1 :] @ w, 2 * w)
    return np.diag(a).copy(), np.diag(a, 1).copy(), v


def _reflector(x: np.ndarray) -> np.ndarray:
    """The unit normal of the mirror that takes ``x`` to a multiple of the first axis; zero where it is there already."""
    most = np.abs(x).max()
    if most == 0 or not np.any(x[1:]):
        return np.zeros(len(x))
    u = x / most
    u[0] += np.copysign(np.linalg.norm(u), u[0])
    return u / np.linalg.norm(u)


def dqds(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared singular values of an unreduced upper bidiagonal matrix, falling, each to high relative accuracy.

    ``q`` and ``e`` are the squares of the two diagonals. A step replaces B'B - shift by a
    product of the same form without a subtraction among the ``q`` and ``e``; a shift that is too large shows
    in a negative ``d`` and is made smaller, zero always works. What has come off by shifts is added to each
    value as its ``e`` vanishes at the end, or a matrix that falls apart is worked on in its parts.
    """
    found: list[float] = []
    parts = [(a**2, b**2, 0.0)]
    while parts:
        q, e, off = parts.pop()
        least = float(q.min())
        while len(q):
            n = len(q)
            if n == 1:
                found.append(float(q[0]) + off)
                break
            # A negligible e parts the matrix.
            small = np.flatnonzero(e <= EPS**2 * (off + np.minimum(q[:-1], q[1:])))
            if len(small):
                k = int(small[-1])
                if k == n - 2:
                    found.append(float(q[-1]) + off)
                    q, e = q[:-1], e[:-1]
                    least = float(q.min())
                    continue
                parts.append((q[: k + 1], e[:k], off))
                q, e = q[k + 1 :], e[k + 1 :]
                least = float(q.min())
                continue
            if q[0] < q[-1] / 4:
                q, e = q[::-1].copy(), e[::-1].copy()  # the same values from the other end, where the small ones are
            shift = _shift(q, e, least)
            while True:
                qq, ee, low, last = _step(q, e, shift)
                if low >= 0:
                    break
                shift = 0.0 if shift < EPS * float(q.min()) else max(0.0, shift + last) if last < 0 and low == last and shift + last > 0.5 * shift else shift / 4
            q, e, off, least = qq, ee, off + shift, low
    return np.sort(np.array(found))[::-1]


def _shift(q: np.ndarray, e: np.ndarray, least: float) -> float:
    """Most of the smallest value, as the last two rows have it, and never over the least ``d`` of the step before."""
    a, b = float(q[-2] + e[-1]), float(q[-1])
    c = float(q[-1] * e[-1]) if len(q) else 0.0
    mean, half = (a + b) / 2, (a - b) / 2
    root = np.hypot(half, np.sqrt(c))
    small = (float(q[-2]) * b) / (mean + root) if mean + root > 0 else 0.0
    return max(0.0, min(small, least) * (1 - 1e-3) if e[-1] > 1e-6 * q[-1] else min(small, least) * (1 - 1e-12))


def _step(q: np.ndarray, e: np.ndarray, shift: float) -> tuple[np.ndarray, np.ndarray, float, float]:
    """One dqds transform, the smallest ``d`` in it and the last."""
    n, qq, ee = len(q), q.tolist(), e.tolist()
    d = qq[0] - shift
    low = d
    for i in range(n - 1):
        new = d + ee[i]
        ratio = qq[i + 1] / new if new > 0 else 0.0
        ee[i] *= ratio
        qq[i] = new
        d = (d * ratio if new > 0 else qq[i + 1]) - shift
        if d < low:
            low = d
    qq[n - 1] = d
    return np.array(qq), np.array(ee), low, d


def twisted(a: np.ndarray, b: np.ndarray, value: float) -> np.ndarray:
    """The unit right singular vector of a bidiagonal matrix for a squared singular value.

    B'B = LDL' is factored less the value from the top and from the bottom; joined at the
    row where the middle term is smallest, the two halves give the vector by multiplications alone.
    """
    n = len(a)
    d, lower = a**2, b / a[:-1]
    top, bottom = np.empty(n), np.empty(n)  # the middle terms' two parts
    plus, minus = np.empty(max(n - 1, 0)), np.empty(max(n - 1, 0))
    tiny = EPS**2 * (float(np.max(d)) + value) + np.finfo(np.float64).tiny
    s = -value
    for i in range(n - 1):
        top[i] = s
        pivot = d[i] + s
        pivot = pivot if abs(pivot) > tiny else np.copysign(tiny, pivot)
        plus[i] = d[i] * lower[i] / pivot
        s = plus[i] * lower[i] * s - value
    top[n - 1] = s
    p = d[n - 1] - value
    for i in range(n - 2, -1, -1):
        bottom[i + 1] = p
        pivot = d[i] * lower[i] ** 2 + p
        pivot = pivot if abs(pivot) > tiny else np.copysign(tiny, pivot)
        minus[i] = lower[i] * d[i] / pivot
        p = p * d[i] / pivot - value
    bottom[0] = p
    k = int(np.argmin(np.abs(top + bottom + value)))
    z = np.zeros(n)
    z[k] = 1.0
    for i in range(k - 1, -1, -1):
        z[i] = -plus[i] * z[i + 1]
    for i in range(k, n - 1):
        z[i + 1] = -minus[i] * z[i]
    return z / np.linalg.norm(z)


def right_singular(r: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Squared singular values of a square matrix, falling, and its right singular vectors as columns.

    Values that agree to many digits share a space; vectors there are made orthogonal to
    those before them.
    """
    n = len(r)
    scale = float(np.abs(r).max(initial=0.0))
    if not n or scale == 0:
        return np.zeros(n), np.eye(n)
    a, b, v = bidiagonalise(r / scale)
    norm = float(max(np.abs(a).max(), np.abs(b).max(initial=0.0)))
    # A vanished diagonal entry would stop the factorisations; this much is below the reflections' own rounding.
    a = np.where(np.abs(a) < EPS**2 * norm, EPS**2 * norm, a)
    cuts = np.flatnonzero(np.abs(b) <= EPS * np.minimum(np.abs(a[:-1]), np.abs(a[1:])))
    edges = [0, *(cuts + 1).tolist(), n]
    values, vectors = [], []
    for start, stop in zip(edges[:-1], edges[1:], strict=True):
        aa, bb = a[start:stop], b[start : stop - 1]
        block: list[np.ndarray] = []
        squares = dqds(aa, bb)
        for value in squares.tolist():
            z = twisted(aa, bb, value)
            near = [block[j] for j in range(len(block)) if squares[j] - value <= 1e-3 * squares[j]]
            block.append(_apart(z, near, aa, bb, value))
        for value, z in zip(squares.tolist(), block, strict=True):
            values.append(value)
            whole = np.zeros(n)
            whole[start:stop] = z
            vectors.append(whole)
    order = np.argsort(-np.array(values), kind="stable")
    return np.array(values)[order] * scale**2, v @ np.array(vectors).T[:, order]


def _apart(z: np.ndarray, near: list[np.ndarray], a: np.ndarray, b: np.ndarray, value: float) -> np.ndarray:
    """``z`` without its parts along ``near``; where little is left, inverse iteration finds what else the value has."""

    def rest(x: np.ndarray) -> np.ndarray:
        for _ in range(2):
            for other in near:
                x = x - (other @ x) * other
        return x

    out = rest(z)
    size = np.linalg.norm(out)
    if not near or size > 0.1:
        return out / size
    n = len(a)
    square = np.diag(a**2 + np.concatenate(([0.0], b**2))) + np.diag(a[:-1] * b, 1) + np.diag(a[:-1] * b, -1)
    shifted = square - value * (1 + 4 * EPS) * np.eye(n) - EPS**2 * np.abs(square).max() * np.eye(n)
    out = rest(np.random.default_rng(n).normal(size=n))
    for _ in range(4):
        out = rest(np.linalg.solve(shifted, out / np.linalg.norm(out)))
    return out / np.linalg.norm(out)
