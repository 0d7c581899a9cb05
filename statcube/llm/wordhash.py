"""Hashes of the words of a text, computed with arrays.

A word's hash is a polynomial over its bytes modulo 2**64, from one prefix sum over the whole text,
followed by a mixing step.  Equal words have equal hashes in every process.
"""

from __future__ import annotations

import numpy as np

_RANDOM = np.random.Generator(np.random.PCG64(20240229))
_BYTES = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 2**64)
_IS_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
MULTIPLIERS = _RANDOM.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

_powers: dict[str, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """At least ``n`` powers of a base; the table is kept and doubled when needed."""
    table = _powers.get(str(base))
    if table is None or len(table) < n:
        size = 1 << max(16, n.bit_length())
        table = np.full(size, base, np.uint64)
        table[0] = 1
        table = np.cumprod(table, dtype=np.uint64)
        _powers[str(base)] = table
    return table


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(32))


def word_hashes(data: bytes) -> np.ndarray:
    """One hash per word of a UTF-8 text, in order."""
    raw = np.frombuffer(data, np.uint8)
    n = len(raw)
    space = np.ones(n + 2, np.int8)
    space[1:-1] = _IS_SPACE[raw]
    edges = np.flatnonzero(np.diff(space))
    starts, ends = edges[::2], edges[1::2]
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTES[raw] * _power(_BASE, n)[:n], out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * _power(_BASE_INVERSE, n)[starts])


def windows(words: np.ndarray, width: int, first: int = 0) -> np.ndarray:
    """A hash per window of ``width`` words; ``first`` picks independent multipliers."""
    n = len(words) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for k in range(width):
        total += words[k:k + n] * MULTIPLIERS[first + k]
    return mixed(total)
