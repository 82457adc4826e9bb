"""Word hashes and shingle sets of Arrow text columns, inside Spark tasks.

A word's hash is a polynomial of its bytes modulo 2^64 (a random value per byte,
an odd base), taken from running sums over all bytes of a run of rows and mixed
with its length, so no word becomes a Python object."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from .common import by_value

by_value(__name__)

RUN_BYTES = 1_000_000
BASE = 0x9E3779B97F4A7C15 | 1


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that scatters them."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


class WordHashes:
    """Hashes of words (runs of bytes but 09-0D and 20), A-Z read as a-z if ``fold``."""

    def __init__(self, fold: bool = False):
        codes = np.arange(256, dtype=np.uint64)
        if fold:
            codes[65:91] += np.uint64(32)
        self.value = mix(codes + np.uint64(1))
        self.blank = np.zeros(256, bool)
        self.blank[[9, 10, 11, 12, 13, 32]] = True
        self._powers(1 << 16)

    def _powers(self, n: int) -> None:
        with np.errstate(over="ignore"):
            self.power = np.cumprod(np.r_[np.uint64(1), np.full(n - 1, BASE, np.uint64)], dtype=np.uint64)
            self.inverse = np.cumprod(np.r_[np.uint64(1), np.full(n - 1, pow(BASE, -1, 1 << 64), np.uint64)], dtype=np.uint64)

    def of_bytes(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(hashes of all words in order, number of words per text); ``offsets``
        bound the texts within ``data``."""
        n = len(data)
        if n > len(self.power):
            self._powers(1 << int(n).bit_length())
        word = ~self.blank[data]
        first = word.copy()
        first[1:] &= ~word[:-1]
        inner = offsets[(offsets > 0) & (offsets < n)]
        first[inner] = word[inner]                      # a text begins a word
        starts = np.flatnonzero(first)
        last = word.copy()
        last[:-1] &= ~word[1:]
        last[inner - 1] = word[inner - 1]
        ends = np.flatnonzero(last) + 1
        with np.errstate(over="ignore"):
            sums = np.zeros(n + 1, np.uint64)
            np.cumsum(self.value[data] * self.power[:n], out=sums[1:])
            h = mix((sums[ends] - sums[starts]) * self.inverse[starts] + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        return h, np.diff(np.searchsorted(starts, offsets))

    def texts(self, column: pa.Array) -> Iterator[np.ndarray]:
        """The word hashes of each text of a column; NULL has none. Rows go in
        runs of about RUN_BYTES; a longer text is cut at blanks."""
        column = column.cast(pa.large_binary())
        offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
        data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
        lo = 0
        while lo < len(column):
            hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + RUN_BYTES, side="right")) - 1)
            hi = min(hi, len(column))
            a, b = int(offsets[lo]), int(offsets[hi])
            if hi == lo + 1 and b - a > 2 * RUN_BYTES:
                parts = []
                while a < b:
                    stop = min(b, a + RUN_BYTES)
                    while stop < b and not self.blank[data[stop]]:
                        stop += 1
                    parts.append(self.of_bytes(data[a:stop], np.array([0, stop - a]))[0])
                    a = stop
                yield np.concatenate(parts)
            else:
                h, n = self.of_bytes(data[a:b], offsets[lo:hi + 1] - a)
                yield from np.split(h, np.cumsum(n)[:-1])
            lo = hi


def windows(hashes: np.ndarray, k: int) -> np.ndarray:
    """One hash per window of k neighbouring words, in order."""
    n = len(hashes) - k + 1
    with np.errstate(over="ignore"):
        h = np.full(n, k, np.uint64)
        for i in range(k):
            h = (h ^ (h >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + hashes[i:i + n]
    return mix(h)


def shingle_set(words: np.ndarray, k: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the k-word shingles of a text's word hashes;
    fewer words make one shingle, none an empty set."""
    return np.unique(windows(words, min(k, len(words)))) if len(words) else np.empty(0, np.uint64)


def signature(shingles: np.ndarray) -> int:
    """A signed 64-bit name of a shingle set."""
    with np.errstate(over="ignore"):
        return int(mix(mix(shingles).sum(dtype=np.uint64) + np.uint64(len(shingles))).view(np.int64))
