"""Singular values and right singular vectors of a small triangle, by way of a bidiagonal matrix.

``bidiagonal`` reduces R to U B V' with Householder reflections. ``dqds`` finds the singular values of B from
the squares of its entries without a subtraction but that of the shift, so small ones are as accurate as
large ones. ``twisted`` finds the eigenvector of B'B for a squared singular value from two factorisations, one
from the top and one from the bottom, joined at the row where they agree best.

All of it is on a matrix as wide as a vector, whatever the number of rows.
"""

from __future__ import annotations

import numpy as np

EPS = np.finfo(np.float64).eps
ROUNDS = 200  # of dqds per singular value before giving up; a handful are needed
CLOSE = 1e-3  # neighbours of a relative gap below this are made orthogonal to each other
STEPS = 4  # of inverse iteration inside such a group


def _reflector(x: np.ndarray) -> tuple[np.ndarray, float]:
    """(v, b) so that (I - v v') x = b e1; v is zero if there is nothing to do."""
    norm = np.linalg.norm(x)
    if norm == 0 or not np.any(x[1:]):
        return np.zeros_like(x), float(x[0])
    b = -np.copysign(norm, x[0])
    v = x.copy()
    v[0] -= b
    return v * (np.sqrt(2) / np.linalg.norm(v)), float(b)


def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(diagonal, superdiagonal, V) of a square r = U B V'."""
    a = np.array(r, np.float64)
    d = len(a)
    v = np.eye(d)
    diagonal, above = np.zeros(d), np.zeros(max(d - 1, 0))
    for k in range(d):
        left, diagonal[k] = _reflector(a[k:, k])
        a[k:, k + 1:] -= np.outer(left, left @ a[k:, k + 1:])
        if k + 1 < d:
            right, above[k] = _reflector(a[k, k + 1:])
            a[k + 1:, k + 1:] -= np.outer(a[k + 1:, k + 1:] @ right, right)
            v[:, k + 1:] -= np.outer(v[:, k + 1:] @ right, right)
    return diagonal, above, v


def _step(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], list[float]] | None:
    """One differential qd step: (q, e, d) of the shifted matrix, or None if the shift was too large."""
    d = q[0] - shift
    new_q, new_e, all_d = [], [], []
    for i in range(len(e)):
        if d < 0:
            return None
        all_d.append(d)
        total = d + e[i]
        new_q.append(total)
        if total == 0:  # a zero on the diagonal moves down
            new_e.append(0.0)
            d = q[i + 1] - shift
        else:
            ratio = q[i + 1] / total
            new_e.append(e[i] * ratio)
            d = d * ratio - shift
    if d < 0:
        return None
    return [*new_q, d], new_e, [*all_d, d]


def dqds(diagonal: np.ndarray, above: np.ndarray) -> np.ndarray:
    """Singular values of the bidiagonal matrix, falling."""
    values: list[float] = []
    blocks = [([float(x) ** 2 for x in diagonal], [float(x) ** 2 for x in above], 0.0)]
    while blocks:
        q, e, sigma = blocks.pop()
        rounds = ROUNDS * max(len(q), 1)
        while q:
            if not e:
                values.append(sigma + q[0])
                break
            if _nothing(q, e, len(e) - 1, sigma):
                values.append(sigma + q.pop())
                e.pop()
                continue
            cut = next((i for i in range(len(e) - 1) if _nothing(q, e, i, sigma)), None)
            if cut is not None:  # two matrices that do not meet
                blocks.append((q[:cut + 1], e[:cut], sigma))
                q, e = q[cut + 1:], e[cut + 1:]
                continue
            if q[0] < q[-1] / 4:  # graded the wrong way: the same values, read from the other end
                q, e = _flipped(q, e)
            rounds -= 1
            if rounds < 0:
                raise ArithmeticError("the qd steps do not converge")
            q, e, d = _step(q, e, 0.0)
            if min(d) <= 0:
                continue
            # 1 / d are the diagonal of the inverse, so the shift is below the least value and above an m-th of it
            shift = (1 - 4 * len(q) * EPS) / sum(1 / x for x in d)
            bold = min(d) * (1 - 4 * len(q) * EPS)
            for s in (bold, shift, shift / 2):
                if shift > EPS * sigma and (moved := _step(q, e, s)) is not None:
                    q, e, _ = moved
                    sigma += s
                    break
    return np.sqrt(np.sort(np.array(values))[::-1])


def _nothing(q: list[float], e: list[float], i: int, sigma: float) -> bool:
    """True if leaving out e[i] moves no value by more than its last digits."""
    return e[i] <= EPS * (sigma + q[i]) and e[i] * q[i + 1] <= (EPS * (sigma + q[i + 1])) ** 2


def _flipped(q: list[float], e: list[float]) -> tuple[list[float], list[float]]:
    """qd values of the matrix with rows and columns in the opposite order."""
    d, new_q, new_e = q[-1], [], []
    for i in range(len(e) - 1, -1, -1):
        total = d + e[i]
        new_q.append(total)
        new_e.append(q[i] * e[i] / total if total else 0.0)
        d = q[i] * d / total if total else q[i]
    return [*new_q, d], new_e


class _Twisted:
    """B'B - value as N D N', factored from both ends; ``gamma`` is what is left where they meet, for each row."""

    def __init__(self, diagonal: np.ndarray, above: np.ndarray, value: float):
        n = self.n = len(diagonal)
        d, low = diagonal ** 2, above / diagonal[:-1]
        self.tiny = EPS * EPS * max(float(np.max(d)), 1e-300)
        s, p = np.empty(n), np.empty(n)
        self.top, self.bottom = np.empty(n - 1), np.empty(n - 1)
        self.upper, self.lower = np.empty(n), np.empty(n)  # the pivots of either factorisation
        s[0] = -value
        for i in range(n - 1):
            self.upper[i] = self._pivot(s[i] + d[i])
            self.top[i] = d[i] * low[i] / self.upper[i]
            s[i + 1] = self.top[i] * low[i] * s[i] - value
        p[-1] = d[-1] - value
        for i in range(n - 2, -1, -1):
            self.lower[i + 1] = self._pivot(d[i] * low[i] ** 2 + p[i + 1])
            ratio = d[i] / self.lower[i + 1]
            self.bottom[i] = low[i] * ratio
            p[i] = p[i + 1] * ratio - value
        self.gamma = s + p + value

    def _pivot(self, x: float) -> float:
        return x if abs(x) > self.tiny else -self.tiny

    def _outwards(self, y: np.ndarray, at: int) -> np.ndarray:
        for i in range(at - 1, -1, -1):
            y[i] -= self.top[i] * y[i + 1]
        for i in range(at, self.n - 1):
            y[i + 1] -= self.bottom[i] * y[i]
        return y

    def vector(self, at: int) -> np.ndarray:
        z = np.zeros(self.n)
        z[at] = 1.0
        return self._outwards(z, at)

    def solve(self, b: np.ndarray) -> np.ndarray:
        at = int(np.argmin(np.abs(self.gamma)))
        y = b.copy()
        for i in range(1, at + 1):
            y[i] -= self.top[i - 1] * y[i - 1]
        for i in range(self.n - 2, at - 1, -1):
            y[i] -= self.bottom[i] * y[i + 1]
        y /= np.r_[self.upper[:at], self._pivot(self.gamma[at]), self.lower[at + 1:]]
        return self._outwards(y, at)


def _unit(z: np.ndarray, others: np.ndarray) -> tuple[np.ndarray, float]:
    """(z made orthogonal to the columns of ``others`` and of unit length, the share of it that was left)."""
    z = z / np.max(np.abs(z))  # a long vector's square could overflow
    z = z / np.linalg.norm(z)
    z = z - others @ (others.T @ z)
    left = float(np.linalg.norm(z))
    z = z / max(left, 1e-300)
    z = z - others @ (others.T @ z)
    return z / max(float(np.linalg.norm(z)), 1e-300), left


def twisted(diagonal: np.ndarray, above: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors of B'B, one column for each of the falling singular ``values``.

    B is cut where an entry is nothing against its norm, and a vector is sought in the block where its value fits
    best. Values that agree to ``CLOSE`` share a space: a vector that has little outside those already found is
    sought again by inverse iteration with the same factors, orthogonal to them. One such step polishes each vector of a group.
    """
    n, wanted = len(diagonal), len(values)
    norm = max(float(np.max(np.abs(diagonal))), float(np.max(np.abs(above), initial=0.0)))
    floor = EPS * norm
    diagonal = np.where(np.abs(diagonal) < floor * 1e-3, floor * 1e-3, diagonal)
    cuts = [0, *(np.flatnonzero(np.abs(above) <= floor) + 1).tolist(), n]
    out = np.zeros((n, wanted))
    first = 0
    for j in range(wanted):
        if j and values[j - 1] - values[j] > CLOSE * values[j - 1]:
            first = j
        before = out[:, first:j]
        parts = [(lo, hi, _Twisted(diagonal[lo:hi], above[lo:hi - 1], values[j] ** 2)) for lo, hi in zip(cuts, cuts[1:])]
        lo, hi, part = min(parts, key=lambda p: float(np.min(np.abs(p[2].gamma))))
        z = np.zeros(n)
        with np.errstate(over="ignore", invalid="ignore"):
            z[lo:hi] = part.vector(int(np.argmin(np.abs(part.gamma))))
        left = 0.0
        if np.all(np.isfinite(z)):
            z, left = _unit(z, before)
        if left < 0.9:
            z, _ = _unit(np.random.default_rng(j).normal(size=n), before)
        crowded = j > first or j + 1 < wanted and values[j] - values[j + 1] <= CLOSE * values[j]
        for _ in range(STEPS if left < 0.9 else int(crowded)):
            with np.errstate(over="ignore", invalid="ignore"):
                y = np.concatenate([p.solve(z[a:b]) for a, b, p in parts])
            if not np.all(np.isfinite(y)):
                break
            z, _ = _unit(y, before)
        out[:, j] = z
    return out


def spectrum(r: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(values, vectors): up to ``most`` largest singular values of r, those that are nothing left out, and their
    right singular vectors as columns."""
    d = r.shape[1]
    scale = float(np.max(np.abs(r), initial=0.0))
    if scale == 0:
        return np.zeros(0), np.zeros((d, 0))
    square = np.zeros((d, d))
    square[:len(r)] = r / scale
    diagonal, above, v = bidiagonal(square)
    values = dqds(diagonal, above)
    values = values[:most][values[:most] > 64 * d * EPS * values[0]]
    return values * scale, v @ twisted(diagonal, above, values)
