"""Words and lines of Arrow text columns, hashed in NumPy without a loop over words.

A word is a run of bytes other than blank and U+0009 to U+000D. Hashes are polynomial over the word's UTF-8 bytes and
mixed to 64 bits, so equal words have equal hashes in every batch, task and run.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

BASE = 0x9E3779B97F4A7C15
BASE_INVERSE = pow(BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """Scatters 64-bit values; one value always gives the same."""
    x = x.astype(np.uint64, copy=True)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def powers(base: int, n: int) -> np.ndarray:
    """The first ``n`` powers of ``base`` modulo 2**64."""
    return _powers(base, 1 << max(16, (n - 1).bit_length()))[:n]


@lru_cache(2)
def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class Words:
    """Words of a slice of texts: ``hash`` per word, ``offset`` of each text's first word (and one past the last)."""

    def __init__(self, texts: pa.Array, lower: bool = False):
        texts = texts.cast(pa.large_string()).fill_null("")
        _, offsets, data = texts.buffers()
        at = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
        raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
        self.bytes_at = at - at[0]
        self.raw = LOWER[raw] if lower else raw
        self.letter = ~SPACE[self.raw]
        before = np.zeros(len(raw), bool)
        before[1:] = self.letter[:-1]
        after = np.zeros(len(raw), bool)
        after[:-1] = self.letter[1:]
        full = self.bytes_at[:-1][np.diff(self.bytes_at) > 0]
        ends = self.bytes_at[1:][np.diff(self.bytes_at) > 0]
        before[full] = False
        after[ends - 1] = False
        self.start = np.flatnonzero(self.letter & ~before)
        self.end = np.flatnonzero(self.letter & ~after) + 1
        self.offset = np.searchsorted(self.start, self.bytes_at)
        self.sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum((self.raw.astype(np.uint64) + np.uint64(1)) * powers(BASE, len(raw)), out=self.sums[1:])
        self.hash = self.span_hash(self.start, self.end)

    def __len__(self) -> int:
        return len(self.bytes_at) - 1

    def span_hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hash of the bytes from ``start`` to ``end``, whatever their place."""
        inverse = powers(BASE_INVERSE, len(self.raw) + 1)
        return mix((self.sums[end] - self.sums[start]) * inverse[start] ^ (end - start).astype(np.uint64))

    def owner(self) -> np.ndarray:
        """Index of the text each word belongs to."""
        return np.repeat(np.arange(len(self)), np.diff(self.offset))

    def per_text(self, values: np.ndarray) -> np.ndarray:
        """Sums of a value per byte over each text."""
        total = np.zeros(len(self.raw) + 1, np.int64)
        np.cumsum(values, out=total[1:])
        return total[self.bytes_at[1:]] - total[self.bytes_at[:-1]]

    def runs(self, size: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """Position and hash of every run of ``size`` words that lies in one text."""
        n = len(self.hash) - size + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        left = np.repeat(self.offset[1:], np.diff(self.offset))  # words of the same text end here
        at = np.flatnonzero(np.arange(n) + size <= left[:n])
        scaled = np.zeros(len(self.hash) + 1, np.uint64)
        np.cumsum(mix(self.hash + np.uint64(seed)) * powers(BASE, len(self.hash)), out=scaled[1:])
        value = (scaled[at + size] - scaled[at]) * powers(BASE_INVERSE, len(self.hash) + 1)[at]
        return at, mix(value + np.uint64(size))


def slices(texts: pa.Array, most_bytes: int = 1 << 21) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``most_bytes`` of text, so that arrays per byte stay small; a longer text stands alone."""
    lengths = np.asarray(pa.compute.fill_null(pa.compute.binary_length(texts), 0).to_numpy(zero_copy_only=False))
    ends = np.cumsum(lengths, dtype=np.int64)
    first = 0
    while first < len(lengths):
        done = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, done + most_bytes, "right")))
        yield first, last
        first = last
