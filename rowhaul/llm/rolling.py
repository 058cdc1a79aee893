"""Hashes of spans of small codes, modulo the prime 2**61 - 1.

Unlike a polynomial modulo a power of two, one modulo a prime has no inputs that
collide for every base: two spans of length n hash alike for at most n bases of
2**61. Running sums of the terms give the hash of any span in constant time.
"""

from __future__ import annotations

import numpy as np

_U = np.uint64
PRIME = (1 << 61) - 1
_P, _M31, _M30, _M32 = _U(PRIME), _U((1 << 31) - 1), _U((1 << 30) - 1), _U((1 << 32) - 1)
#: Bases of the lanes; any numbers between 2**32 and the prime would do.
BASES = (0x0A3F5C9E77D1B24D, 0x1B7E0D4C92A6F38B)


def reduced(x: np.ndarray) -> np.ndarray:
    """``x`` modulo the prime."""
    x = (x >> _U(61)) + (x & _P)
    return np.where(x >= _P, x - _P, x)


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Product modulo the prime of numbers below it, by halves that fit 64 bits."""
    a1, a0, b1, b0 = a >> _U(31), a & _M31, b >> _U(31), b & _M31
    middle = a0 * b1 + a1 * b0
    return reduced(a1 * b1 * _U(2) + (middle >> _U(30)) + ((middle & _M30) << _U(31)) + a0 * b0)


def shifted32(x: np.ndarray) -> np.ndarray:
    """``x * 2**32`` modulo the prime, for ``x`` below 2**61: a rotation."""
    return reduced(((x << _U(32)) & _P) + (x >> _U(29)))


_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, size: int) -> np.ndarray:
    """The first ``size`` powers of a base, or more."""
    known = _POWERS.get(base)
    if known is None:
        known = np.ones(1, np.uint64)
    while len(known) < size:
        known = np.concatenate([known, times(known, _U(pow(base, len(known), PRIME)))])
    _POWERS[base] = known
    return known


def inverse(base: int) -> int:
    return pow(base, -1, PRIME)


class Spans:
    """Hashes of any spans of one array of codes between 1 and 2**32, in one lane."""

    def __init__(self, codes: np.ndarray, lane: int = 0):
        base = BASES[lane]
        self._back = powers(inverse(base), len(codes) + 1)
        terms = times(codes.astype(np.uint64), powers(base, len(codes) + 1)[: len(codes)])
        self._low, self._high = (np.concatenate([np.zeros(1, np.uint64), np.cumsum(x)]) for x in (terms & _M32, terms >> _U(32)))

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        total = reduced(reduced(self._low[ends] - self._low[starts]) + shifted32(reduced(self._high[ends] - self._high[starts])))
        return times(total, self._back[starts])
