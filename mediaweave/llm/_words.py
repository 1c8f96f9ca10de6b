"""Vectorised words and word hashes over a block of texts.

Words are runs of bytes other than 0x20 and 0x09-0x0D, which in UTF-8 are the runs of code points other than those.
A word's hash is a polynomial in an odd multiplier modulo 2**64, finished by a bijective mix, so equal words have equal
hashes in every block, partition and run.
"""

from __future__ import annotations

import numpy as np

U = np.uint64
_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[0x20, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_tables: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64; grown by doubling and kept for the next block."""
    have = _tables.get(base)
    if have is None or len(have) < n:
        have = np.ones(1, U)
        while len(have) < n:
            have = np.concatenate([have, have * U(pow(base, len(have), 1 << 64))])
        if n <= 1 << 23:
            _tables[base] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> U(31))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(29))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(32))


def span_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of raw[start:end] for each span."""
    n = len(raw)
    sums = np.zeros(n + 1, U)
    np.cumsum((raw.astype(U) + U(1)) * powers(_BASE, n), out=sums[1:])
    return mix((sums[ends] - sums[starts]) * powers(_BASE_INVERSE, n + 1)[starts] + (ends - starts).astype(U))


class Words:
    """Words of a block: starts and ends in raw, the text each is in, and the first word of each text (n+1 offsets)."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray):
        n = len(raw)
        inside = ~_SEPARATOR[raw]
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        heads = offsets[:-1][offsets[:-1] < offsets[1:]]
        first[heads] = inside[heads]
        last = inside.copy()
        last[:-1] &= ~inside[1:]
        tails = offsets[1:][offsets[:-1] < offsets[1:]] - 1
        last[tails] = inside[tails]
        self.raw, self.offsets = raw, offsets
        self.starts, self.ends = np.flatnonzero(first), np.flatnonzero(last) + 1
        self.first = np.searchsorted(self.starts, offsets)
        self.counts = np.diff(self.first)
        self.text = np.repeat(np.arange(len(offsets) - 1), self.counts)
        self.inside = inside
        self.n = n

    def hashes(self) -> np.ndarray:
        return span_hashes(self.raw, self.starts, self.ends)


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """A hash of each n words on end."""
    k = len(hashes) - n + 1
    if k <= 0:
        return np.zeros(0, U)
    out = np.zeros(k, U)
    for j in range(n):
        out += hashes[j : j + k] * U((0xD6E8FEB86659FD93 * (2 * j + 1) + (j << 40)) % (1 << 64) | 1)
    return mix(out)
