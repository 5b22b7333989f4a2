"""64-bit names for stretches of a sequence, from prefix sums.

A stretch's name is sum(value[i] * M^(i - start)) mod 2^64, mixed with its length.
Different stretches get equal names with a probability near 2^-64 per pair.
"""

from __future__ import annotations

import numpy as np

SLICE_BYTES = 1 << 19
_MULTIPLIER = 0x9E3779B97F4A7C15
_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def mix(values: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every bit (the multiply-xorshift of splitmix64)."""
    h = values.astype(np.uint64, copy=True)
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def combine(left: np.ndarray, right: np.ndarray, salt: int = 0) -> np.ndarray:
    """Name of an ordered pair of names."""
    return mix(left * np.uint64(_MULTIPLIER) + mix(right + np.uint64(salt * 2 + 1)))


BYTE_NAMES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_MULTIPLIER))


def _power_table(base: int, size: int) -> np.ndarray:
    table = _powers.get(base)
    if table is None or len(table) < size:
        table = np.full(max(size, 1 << 16), base, np.uint64)
        table[0] = 1
        np.multiply.accumulate(table, out=table)
        _powers[base] = table
    return table[:size]


class Stretches:
    """Names of stretches of one sequence of 64-bit values."""

    def __init__(self, values: np.ndarray):
        size = len(values)
        self._sums = np.zeros(size + 1, np.uint64)
        np.cumsum(values * _power_table(_MULTIPLIER, size), out=self._sums[1:])
        self._undo = _power_table(_INVERSE, size + 1)

    def raw(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return (self._sums[ends] - self._sums[starts]) * self._undo[starts]

    def every(self, length: int) -> np.ndarray:
        """Names of all stretches of one length."""
        count = max(len(self._sums) - length, 0)
        raw = (self._sums[length : length + count] - self._sums[:count]) * self._undo[:count]
        return mix(raw + np.uint64(length))

    def names(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix(self.raw(starts, ends) + (ends - starts).astype(np.uint64))


_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True


def word_bounds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words [^\\x20\\x09-\\x0D]+ of UTF-8 bytes."""
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = ~_SEPARATOR[data]
    steps = np.diff(inside)
    return np.flatnonzero(steps == 1), np.flatnonzero(steps == -1)


def word_names(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, names) of the words of UTF-8 bytes."""
    starts, ends = word_bounds(data)
    names, at = np.empty(len(starts), np.uint64), 0
    while at < len(starts):
        # A slice of whole words at a time: the sums take eight times the memory of the bytes.
        low = starts[at]
        end = max(at + 1, int(np.searchsorted(ends, low + SLICE_BYTES, side="right")))
        some = Stretches(BYTE_NAMES[data[low : ends[end - 1]]])
        names[at:end] = some.names(starts[at:end] - low, ends[at:end] - low)
        at = end
    return starts, ends, names
