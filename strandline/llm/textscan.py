"""Words and rolling hashes over the bytes of many texts at once.

A text column is one byte array with offsets, so a few numpy passes find every word of a batch and hash it;
there is no Python loop over words or characters. Hashes are polynomials modulo 2**64 with an odd base
(prefix sums times inverse powers) that a 64-bit finalizer mixes.
"""

from __future__ import annotations

import functools

import numpy as np

BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)
#: Bytes that are hashed at a time (or one word), so that a text of any length needs few bytes of memory for each of its own.
STRETCH = 2 << 20


@functools.lru_cache(maxsize=4)
def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


def _sized(n: int) -> int:
    return 1 << max(16, int(n).bit_length())


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finalizer."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Rolling:
    """Hashes of any byte ranges of an array."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(BASE, _sized(n))[:n], out=self.sums[1:])
        self.back = powers(INVERSE, _sized(n))

    def ranges(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.back[start])

    def grams(self, width: int) -> np.ndarray:
        """Of every range of a width, in order of position."""
        n = len(self.sums) - width
        return mix((self.sums[width:] - self.sums[:n]) * self.back[:n]) if n > 0 else np.zeros(0, np.uint64)


def table_of(ranges: list[tuple[int, int]]) -> np.ndarray:
    out = np.zeros(256, bool)
    for a, b in ranges:
        out[a : b + 1] = True
    return out


#: [^\x20\x09-\x0D]
NOT_SPACE = ~table_of([(0x20, 0x20), (0x09, 0x0D)])
#: [^\x00-\x2F\x3A-\x60\x7B-\x7F], after lower-casing
ALNUM = ~table_of([(0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F)])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


class Words:
    """The words of texts that lie end to end, lower-cased (A-Z).

    start, end: byte ranges; hash: 64 bits; first: for each text, and one past the last, its first word."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, kind: np.ndarray):
        low = LOWER[data]
        inside = kind[low]
        n = len(low)
        edge = np.zeros(n + 1, bool)
        edge[offsets] = True
        before = np.zeros(n, bool)
        before[1:] = inside[:-1]
        before &= ~edge[:n]
        after = np.zeros(n, bool)
        after[:-1] = inside[1:]
        after &= ~edge[1:]
        self.start = np.flatnonzero(inside & ~before)
        self.end = np.flatnonzero(inside & ~after) + 1
        self.hash = np.empty(len(self.start), np.uint64)
        k = 0
        while k < len(self.start):  # hashes need 8-byte numbers for each byte: a stretch of words at a time
            base = self.start[k]
            j = max(k + 1, int(np.searchsorted(self.end, base + STRETCH, "right")))
            self.hash[k:j] = Rolling(low[base : self.end[j - 1]]).ranges(self.start[k:j] - base, self.end[k:j] - base)
            k = j
        self.first = np.searchsorted(self.start, offsets)
        self.first[-1] = len(self.start)

    def count(self) -> np.ndarray:
        return np.diff(self.first)

    def document(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.count())
