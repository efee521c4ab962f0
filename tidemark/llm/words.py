"""Words, their hashes and their windows over whole batches of texts, as numpy arrays.

A word is a run of bytes other than `[\\x20\\x09-\\x0D]`; those bytes never occur inside a UTF-8
sequence. Words are hashed by sums of random byte values times powers of an odd number modulo 2**64,
taken from running sums, so that a batch costs a few passes over its bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa

SEPARATOR = np.zeros(256, bool)
SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
CHUNK_BYTES = 1 << 19
_BITS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


@lru_cache(maxsize=None)
def _byte_values(seed: int) -> np.ndarray:
    return np.random.Generator(np.random.Philox(seed)).integers(0, 1 << 64, 256, dtype=np.uint64)


@lru_cache(maxsize=4)
def _powers(n: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers of an odd number and of its inverse, modulo 2**64."""
    odd = _BITS[seed] | 5
    inverse = pow(odd, -1, 1 << 64)
    out = []
    for base in (odd, inverse):
        steps = np.full(n, base, np.uint64)
        steps[0] = 1
        out.append(np.multiply.accumulate(steps))
    return out[0], out[1]


def powers(n: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    size = max(1 << 20, 1 << int(n).bit_length())
    return _powers(size, seed)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Words:
    """Words of some texts. Text i has the words first[i] to first[i + 1]."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    def hashes(self, seed: int = 0, lower: bool = False) -> np.ndarray:
        n = len(self.data)
        up, down = powers(n + 1, seed)
        values = _byte_values(seed)
        if lower:
            values = values[_LOWER]
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(values[self.data] * up[:n], out=sums[1:])
        return mix((sums[self.ends] - sums[self.starts]) * down[self.starts])

    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def split_words(data: np.ndarray, offsets: np.ndarray, separator: np.ndarray = SEPARATOR) -> Words:
    """Words of the texts data[offsets[i]:offsets[i + 1]]; offsets begin at 0."""
    n = len(data)
    space = separator[data]
    before = np.empty(n + 1, bool)
    before[0], before[1:] = True, space
    before[offsets] = True  # a text begins here, or one ends
    after = np.empty(n + 1, bool)
    after[:n], after[n] = space, True
    after[offsets] = True
    word = ~space
    starts = np.flatnonzero(word & before[:n])
    ends = np.flatnonzero(word & after[1:]) + 1
    return Words(data, starts, ends, np.searchsorted(starts, offsets))


def window_hashes(word_hashes: np.ndarray, size: int, seed: int = 0) -> np.ndarray:
    """Hash of each run of ``size`` words; windows over the end of a text are the caller's to leave out."""
    n = len(word_hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    odd = np.uint64(_BITS[1 - seed] | 3)
    out = word_hashes[:n].copy()
    for i in range(1, size):
        out *= odd
        out += word_hashes[i:i + n]
    return mix(out)


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw, bounds


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Slices of a batch of about ``limit`` bytes: first and last row, bytes, offsets from 0."""
    raw, bounds = text_buffers(column)
    i, n = 0, len(bounds) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(bounds, bounds[i] + limit, "right")) - 1)
        j = min(j, n)
        yield i, j, raw[bounds[i]:bounds[j]], bounds[i:j + 1] - bounds[i]
        i = j
