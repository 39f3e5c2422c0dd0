"""Vectorised text helpers for use inside tasks: words, rolling fingerprints, Arrow columns.

A word is a maximal run of bytes other than space, tab, LF, VT, FF and CR. All functions work on one
Arrow batch, or on a slice of it, so memory is bounded by the batch and by the longest single text.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Texts are handled in slices of about this many bytes; a longer text forms a slice of its own.
SLICE_BYTES = 1 << 20
#: A row without an id sorts behind all others.
NO_ID = np.int64(2**63 - 1)

U = np.uint64


def _inverse(odd: int) -> int:
    return pow(odd, -1, 1 << 64)


#: Odd bases of the rolling fingerprints, over bytes and twice over words.
BYTE_BASE, WORD_BASE, CHECK_BASE = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xC2B2AE3D27D4EB4F


class _Powers:
    """Powers of an odd base and of its inverse modulo 2**64, grown on demand."""

    def __init__(self, base: int):
        self.base, self.inverse = base, _inverse(base)
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) <= n:
            size = 1 << int(n + 1).bit_length()
            grown = []
            for base in (self.base, self.inverse):
                steps = np.full(size, base, dtype=np.uint64)
                steps[0] = 1
                grown.append(np.cumprod(steps, dtype=np.uint64))
            self.up, self.down = grown
        return self.up, self.down


POWERS = {base: _Powers(base) for base in (BYTE_BASE, WORD_BASE, CHECK_BASE)}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit over all output bits."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def prefix(values: np.ndarray, base: int) -> np.ndarray:
    """Running sums from which ``span`` derives the fingerprint of any stretch of ``values``."""
    up, _ = POWERS[base].upto(len(values))
    sums = np.empty(len(values) + 1, dtype=np.uint64)
    sums[0] = 0
    np.cumsum(values * up[: len(values)], out=sums[1:], dtype=np.uint64)
    return sums


def span(sums: np.ndarray, start: np.ndarray, end: np.ndarray, base: int) -> np.ndarray:
    """Fingerprint of the values in ``[start, end)``, the same wherever that stretch occurs."""
    _, down = POWERS[base].upto(len(sums))
    return mix((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64) * U(0x2545F4914F6CDD1D))


class Words(NamedTuple):
    """Words of several texts in order; ``bounds[i]:bounds[i + 1]`` are those of text ``i``."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray

    def hashes(self) -> np.ndarray:
        sums = prefix(self.data.astype(np.uint64) + U(1), BYTE_BASE)
        return span(sums, self.starts, self.ends, BYTE_BASE)

    def texts(self) -> np.ndarray:
        """The number of the text each word belongs to."""
        return np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts, one after the other, and the offset of each; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    column = column.cast(pa.large_binary()) if column.type != pa.large_binary() else column
    if column.null_count:
        column = column.fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    if len(offsets) == 0 or column.buffers()[2] is None:
        return np.empty(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    data = np.frombuffer(column.buffers()[2], dtype=np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def slices(offsets: np.ndarray, size: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``size`` bytes together, one text at least."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + size, side="right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def words_of(data: np.ndarray, offsets: np.ndarray, lower: bool = False) -> Words:
    """Split texts into words; no word runs across two texts."""
    if lower:
        data = LOWER[data]
    n = len(data)
    if n == 0:
        none = np.empty(0, np.int64)
        return Words(data, none, none, np.zeros(len(offsets), np.int64))
    solid = ~SPACE[data]
    breaks = np.zeros(n + 1, dtype=bool)
    breaks[offsets] = True
    before = np.empty(n, dtype=bool)
    before[0] = True
    np.logical_not(solid[:-1], out=before[1:])
    before |= breaks[:-1]
    after = np.empty(n, dtype=bool)
    after[-1] = True
    np.logical_not(solid[1:], out=after[:-1])
    after |= breaks[1:]
    starts = np.flatnonzero(solid & before)
    ends = np.flatnonzero(solid & after) + 1
    return Words(data, starts, ends, np.searchsorted(starts, offsets))


def ids_of(column: pa.Array) -> np.ndarray:
    """Document ids as int64; a missing id becomes ``NO_ID``."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.asarray(column.cast(pa.int64()).fill_null(int(NO_ID)))


def nullable_ids(ids: np.ndarray) -> pa.Array:
    return pa.array(ids, pa.int64(), mask=ids == NO_ID)


def runs(sorted_keys: np.ndarray) -> np.ndarray:
    """Start of each run of equal values in a sorted array."""
    if len(sorted_keys) == 0:
        return np.empty(0, np.int64)
    return np.flatnonzero(np.concatenate([[True], sorted_keys[1:] != sorted_keys[:-1]]))
