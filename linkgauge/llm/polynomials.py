"""Prefix polynomials: hashes of any stretch of a sequence from two of its prefixes, modulo 2^64."""

from __future__ import annotations

import numpy as np

#: Odd, so that they have inverses modulo 2^64. Stretches that agree under both have 128 bits in common.
BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
_tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base^i and base^-i for i up to n."""
    if base not in _tables or len(_tables[base][0]) <= n:
        size = 1 << max(n, 1 << 12).bit_length()
        _tables[base] = tuple(np.cumprod(np.append(np.uint64(1), np.full(size - 1, x, np.uint64))) for x in (base, pow(base, -1, 1 << 64)))
    return _tables[base]


class Prefixes:
    """Of a sequence of 64-bit values."""

    def __init__(self, values: np.ndarray, base: int) -> None:
        powers, self.inverse = _powers(base, len(values))
        self.sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * powers[: len(values)], out=self.sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hashes of the stretches from starts to ends: equal for equal stretches."""
        return (self.sums[ends] - self.sums[starts]) * self.inverse[starts]

    def windows(self, size: int) -> np.ndarray:
        """Hashes of all stretches of one size, in order."""
        n = max(len(self.sums) - size, 0)
        return (self.sums[size : size + n] - self.sums[:n]) * self.inverse[:n]
