"""Vectorised 64-bit hashes of words and byte windows for Python workers."""

from __future__ import annotations

import numpy as np

MASK = (1 << 64) - 1
BASE = 0x9E3779B97F4A7C15
CHUNK = 1 << 20


def _mixed(seed: int) -> int:
    x = (seed + 0x9E3779B97F4A7C15) & MASK
    x = ((x ^ x >> 30) * 0xBF58476D1CE4E5B9) & MASK
    x = ((x ^ x >> 27) * 0x94D049BB133111EB) & MASK
    return x ^ x >> 31


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


BYTE_VALUES = np.array([_mixed(b) | 1 for b in range(256)], np.uint64)
LOWERED = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)


def powers(n: int, base: int = BASE) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


class WordHasher:
    """Hashes of a text's words: maximal runs of bytes that are no separators, after A-Z became a-z."""

    def __init__(self, separators: bytes):
        self.inside = np.ones(256, bool)
        self.inside[list(separators)] = False
        self.values = BYTE_VALUES[LOWERED]

    def __call__(self, text: bytes) -> np.ndarray:
        if len(text) <= CHUNK:
            return self._hashes(np.frombuffer(text, np.uint8))
        out, data, start = [], np.frombuffer(text, np.uint8), 0
        while start < len(data):  # cut where a separator stands, so that memory follows the chunk
            end = start + CHUNK
            while end < len(data):
                gaps = np.flatnonzero(~self.inside[data[end : end + CHUNK]])
                if len(gaps):
                    end += int(gaps[0])
                    break
                end += CHUNK
            out.append(self._hashes(data[start:end]))
            start = end
        return np.concatenate(out)

    def _hashes(self, data: np.ndarray) -> np.ndarray:
        inside = self.inside[data]
        edge = np.flatnonzero(np.diff(inside.view(np.int8), prepend=0, append=0))
        starts, ends = edge[::2], edge[1::2]
        if not len(starts):
            return np.empty(0, np.uint64)
        lengths = ends - starts
        spots = np.flatnonzero(inside)
        offsets = np.arange(len(spots)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        products = self.values[data[spots]] * powers(int(lengths.max()))[offsets]
        sums = np.add.reduceat(products, np.cumsum(lengths) - lengths)
        return mix(sums + lengths.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct hashes (as int64) of ``size`` consecutive words; fewer words make one shingle."""
    if not len(words):
        return np.empty(0, np.int64)
    size, factors = min(size, len(words)), [np.uint64(_mixed(1000 + j) | 1) for j in range(size)]
    count = len(words) - size + 1
    total = np.full(count, _mixed(size), np.uint64)
    for j in range(size):
        total += words[j : j + count] * factors[j]
    return np.unique(mix(total).view(np.int64))
