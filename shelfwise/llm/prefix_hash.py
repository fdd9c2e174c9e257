"""Hashes of any byte ranges of a buffer from one pass of running sums."""

from __future__ import annotations

import numpy as np

from shelfwise.llm.textops import _power_tables, mix

_LENGTH = np.uint64(0xD6E8FEB86659FD93)


class PrefixHash:
    """64-bit hashes of ``data[begin:end]``: a polynomial in an odd base, mixed with the length."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        power, self._inverse = _power_tables(n + 1)
        self._total = np.zeros(n + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[:n], out=self._total[1:])

    def of(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        raw = (self._total[end] - self._total[begin]) * self._inverse[begin]
        return mix(raw + (end - begin).astype(np.uint64) * _LENGTH)

    def grams(self, size: int) -> np.ndarray:
        """Of all ranges of ``size`` bytes, by their begin."""
        n = len(self._total) - size
        if n <= 0:
            return np.zeros(0, np.uint64)
        raw = (self._total[size:] - self._total[:n]) * self._inverse[:n]
        return mix(raw + np.full(1, size, np.uint64) * _LENGTH)
