"""Leading eigenvalues and eigenvectors of a symmetric matrix by spectrum slicing.

By Sylvester's law the signs of D in LDLᵀ = V - sI count the eigenvalues above s.  Bisection on these counts
gives each of the largest eigenvalues an interval that holds it alone; Rayleigh quotient iteration then
converges cubically, and is taken only if it stays in that interval.  At the end counts on both
sides of every value certify its number.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

EPS = float(np.finfo(np.float64).eps)
# Fixed value: bound of the growth of elements in diagonal pivoting.
PIVOT = (1 + 17**0.5) / 8


def count_above(matrix: np.ndarray, shift: float) -> int:
    """Eigenvalues greater than ``shift``, from a factorisation with pivots of size 1 and 2."""
    a = matrix - shift * np.eye(len(matrix))
    n, k, above = len(a), 0, 0
    # What cancellation leaves far below rounding needs no pivot.
    bound = np.abs(a).max()

    def swap(i: int, j: int) -> None:
        a[[i, j]] = a[[j, i]]
        a[:, [i, j]] = a[:, [j, i]]

    while k < n:
        size, diagonal = 1, abs(a[k, k])
        if k < n - 1:
            below = np.abs(a[k + 1:, k])
            r = k + 1 + int(below.argmax())
            largest = below[r - k - 1]
            if diagonal < PIVOT * largest and largest > EPS**2 * bound:
                others = np.abs(a[k:, r])
                others[r - k] = 0
                rival = others.max()
                if diagonal * rival < PIVOT * largest**2:
                    if abs(a[r, r]) >= PIVOT * rival:
                        swap(k, r)
                    else:
                        swap(k + 1, r)
                        size = 2
        if size == 1:
            above += a[k, k] > 0
            if abs(a[k, k]) > EPS**2 * bound:
                column = a[k + 1:, k]
                a[k + 1:, k + 1:] -= np.outer(column, column) / a[k, k]
        else:
            # Such a block is indefinite: one value on each side.
            above += 1
            side = a[k + 2:, k:k + 2]
            change = side @ np.linalg.solve(a[k:k + 2, k:k + 2], side.T)
            a[k + 2:, k + 2:] -= (change + change.T) / 2
        k += size
    return int(above)


@dataclass
class Slices:
    """Counts taken so far, so that the bisections of different eigenvalues share them."""

    matrix: np.ndarray
    counts: dict[float, int]

    def above(self, shift: float) -> int:
        if shift not in self.counts:
            self.counts[shift] = count_above(self.matrix, shift)
        return self.counts[shift]

    def halved(self, number: int, low: float, high: float) -> tuple[float, float]:
        middle = (low + high) / 2
        return (middle, high) if self.above(middle) >= number else (low, middle)

    def isolate(self, number: int, width: float) -> tuple[float, float]:
        """An interval that holds the ``number``-th largest eigenvalue, alone unless it is narrower than ``width``."""
        low = max(s for s, c in self.counts.items() if c >= number)
        high = min(s for s, c in self.counts.items() if c < number)
        while high - low > width and not (self.above(low) == number and self.above(high) == number - 1):
            low, high = self.halved(number, low, high)
        return low, high


def _solved(matrix: np.ndarray, shift: float, vector: np.ndarray, scale: float) -> np.ndarray:
    for step in (0.0, EPS, 4 * EPS):
        try:
            found = np.linalg.solve(matrix - (shift + step * scale) * np.eye(len(matrix)), vector)
        except np.linalg.LinAlgError:
            continue
        if np.isfinite(found).all():
            return found / np.linalg.norm(found)
    return vector


def _iterate(matrix: np.ndarray, low: float, high: float, found: np.ndarray, scale: float) -> tuple[float, np.ndarray]:
    """Rayleigh quotient iteration from the middle of an interval, orthogonal to the vectors found before."""

    def free(v: np.ndarray) -> np.ndarray:
        for _ in range(2):
            v = v - found.T @ (found @ v)
        return v / np.linalg.norm(v)

    v = free(np.random.Generator(np.random.PCG64(11)).standard_normal(len(matrix)))
    for _ in range(2):
        v = free(_solved(matrix, (low + high) / 2, v, scale))
    best, left = (float("inf"), 0.0, v), 30
    while left:
        value = float(v @ matrix @ v)
        residual = float(np.linalg.norm(matrix @ v - value * v))
        # Rounding is reached when the residual no longer falls.
        left = left - 1 if residual < best[0] else min(left - 1, 1)
        best = min(best, (residual, value, v), key=lambda b: b[0])
        v = free(_solved(matrix, value, v, scale))
    return best[1], best[2]


def leading(matrix: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues of a symmetric matrix, falling, and unit eigenvectors as rows.

    The largest component of each vector is positive.  Of eigenvalues that are equal up to rounding any
    orthonormal vectors of their space are given.
    """
    n = len(matrix)
    scale = float(np.abs(matrix).sum(axis=1).max())
    if not scale:
        return np.zeros(k), np.eye(n)[:k]
    # All eigenvalues lie within the largest row sum.
    slices = Slices(matrix, {-1.01 * scale: n, 1.01 * scale: 0})
    width = 4 * n * EPS * scale
    values, vectors = np.zeros(0), np.zeros((0, n))
    for number in range(1, k + 1):
        low, high = slices.isolate(number, width)
        while True:
            value, vector = _iterate(matrix, low, high, vectors, scale)
            if low - width <= value <= high + width or high - low <= width:
                break
            low, high = slices.halved(number, low, high)
        vector = vector if vector[np.abs(vector).argmax()] > 0 else -vector
        values, vectors = np.append(values, value), np.vstack([vectors, vector])
    for number, value in enumerate(values, 1):
        if slices.above(value - width) < number or slices.above(value + width) >= number:
            raise ArithmeticError(f"eigenvalue {number} can't be certified")
    return values, vectors
