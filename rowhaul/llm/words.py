"""Words of a batch of texts, straight from Arrow's UTF-8 buffer, and their hashes.

A word is a maximal run of bytes other than space and tab to carriage return;
all of these are single bytes in UTF-8, so no text has to be decoded. Hashes
are polynomials over the bytes modulo the prime 2**61 - 1, taken from running
sums, so the work per byte does not depend on the number or length of words.
(Modulo a power of two there are words that collide for every base.)
"""

from __future__ import annotations

import ctypes

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from rowhaul.llm.rolling import BASES, PRIME, inverse, powers, reduced, shifted32, times

SEPARATOR = np.zeros(256, bool)
SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_BLOCK = 1 << 19


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values so that all bits depend on all bits."""
    x = x ^ (x >> _U(30))
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def _long_hash(data: np.ndarray, base: int) -> int:
    up = powers(base, _BLOCK + 1)
    total, step = 0, pow(base, _BLOCK, PRIME)
    for k, at in enumerate(range(0, len(data), _BLOCK)):
        part = data[at : at + _BLOCK].astype(np.uint64) + _U(1)
        low, high = (int((part * x[: len(part)]).sum()) for x in (up & _U(0xFFFFFFFF), up >> _U(32)))
        total += (low + (high << 32)) * pow(step, k, PRIME)
    return total % PRIME


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lane: int = 0) -> np.ndarray:
    """A 64-bit hash of every byte span; spans are ordered and do not overlap. Lanes are hashes of their own.

    Spans are taken a block at a time, so memory stays bounded for any text.
    """
    out, base = np.empty(len(starts), np.uint64), BASES[lane]
    up, down = powers(base, _BLOCK + 1), powers(inverse(base), _BLOCK + 1)
    low, high = up & _U(0xFFFFFFFF), up >> _U(32)
    i = 0
    while i < len(starts):
        at = int(starts[i])
        j = int(np.searchsorted(ends, at + _BLOCK, side="right"))
        if j <= i:
            out[i] = _long_hash(data[at : int(ends[i])], base)
            i += 1
            continue
        part = data[at : int(ends[j - 1])].astype(np.uint64) + _U(1)
        s, e = starts[i:j] - at, ends[i:j] - at
        halves = []
        for power in (low, high):
            sums = np.zeros(len(part) + 1, np.uint64)
            np.cumsum(part * power[: len(part)], out=sums[1:])
            halves.append(reduced(sums[e] - sums[s]))
        out[i:j] = times(reduced(halves[0] + shifted32(halves[1])), down[s])
        i = j
    return mix(out + (ends - starts).astype(np.uint64) * _U(0xA0761D6478BD642F))


def buffer_of(column) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column (nulls count as empty) and where each text begins and the last ends."""
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks != 1 else column.chunk(0)
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


class Words:
    """Where the words of a batch of texts lie: words of text d are ``first[d]`` up to ``first[d + 1]``."""

    def __init__(self, column):
        self.data, self.offsets = buffer_of(column)
        n = len(self.data)
        word = ~SEPARATOR[self.data]
        edge = np.zeros(n + 1, bool)
        edge[self.offsets] = True
        before = edge[:-1].copy()
        before[1:] |= ~word[:-1]
        self.starts = np.flatnonzero(word & before)
        after = edge[1:].copy()
        after[:-1] |= ~word[1:]
        self.ends = np.flatnonzero(word & after) + 1
        self.first = np.searchsorted(self.starts, self.offsets)
        self.counts = np.diff(self.first)

    def __len__(self) -> int:
        return len(self.starts)

    def hashes(self, lower: bool = False, lane: int = 0) -> np.ndarray:
        data = self.data
        if lower:
            table = np.arange(256, dtype=np.uint8)
            table[65:91] += 32
            data = table[data]
        return span_hashes(data, self.starts, self.ends, lane)

    def text_of(self) -> np.ndarray:
        """The text each word belongs to."""
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def chars(self) -> np.ndarray:
        """Code points in each word."""
        sums = np.zeros(len(self.data) + 1, np.int32 if len(self.data) < 1 << 31 else np.int64)
        np.cumsum((self.data & 0xC0) != 0x80, out=sums[1:])
        return sums[self.ends] - sums[self.starts]


def window_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of n hashes, whether or not it stays within one text."""
    size = len(hashes) - n + 1
    if size <= 0:
        return np.zeros(0, np.uint64)
    total = np.full(size, n, np.uint64)
    for j in range(n):
        total *= _U(_BASE)
        total += hashes[j : j + size]
    return mix(total)


def windows_within(first: np.ndarray, n: int, size: int) -> np.ndarray:
    """Which of the ``size`` window starts have all n words in one text."""
    inside = np.ones(max(0, size), bool)
    for d in range(1, n):
        at = first[1:-1] - d
        inside[at[(at >= 0) & (at < size)]] = False
    return inside


def covered(starts: np.ndarray, n: int, size: int) -> np.ndarray:
    """Which of ``size`` words lie in a window of n words that begins at one of the starts."""
    change = np.bincount(starts, minlength=size + 1) - np.bincount(np.minimum(starts + n, size), minlength=size + 1)
    return np.cumsum(change[:-1]) > 0


def release() -> None:
    """Give memory that the allocators keep for later back to the system: Python workers live on after a task."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def pieces(batches, limit: int = 2 << 20):
    """Cut record batches so that each piece has about ``limit`` bytes of columns, but one row at least."""
    for batch in batches:
        size, rows = max(1, batch.nbytes), batch.num_rows
        step = max(1, int(rows * limit / size)) if rows else 1
        for at in range(0, rows, step):
            yield batch.slice(at, min(step, rows - at))
    release()
