"""Texts of an Arrow batch as one run of bytes, cut into stretches of bounded size, and hashes of them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: An odd number and its inverse modulo 2^64: positions are weighted with powers of it.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets): row i is bytes[offsets[i] : offsets[i + 1]]; NULL is empty."""
    column = column.fill_null("") if column.null_count else column
    kind = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    _, places, data = column.buffers()
    offsets = np.frombuffer(places, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if data is None or not len(column):
        return np.empty(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def mixed(x: np.ndarray) -> np.ndarray:
    """A permutation of the 64-bit numbers that stirs all bits."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


#: A number for every byte.
BYTE = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE)) | np.uint64(1)


class Hasher:
    """64-bit hashes of any stretch of ``data``, by prefix sums: equal bytes, equal hash."""

    _powers = np.empty(0, np.uint64), np.empty(0, np.uint64)

    def __init__(self, data: np.ndarray):
        if len(Hasher._powers[0]) <= len(data):
            Hasher._powers = tuple(
                np.cumprod(np.r_[np.uint64(1), np.full(len(data), b, np.uint64)]) for b in (BASE, INVERSE)
            )
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(BYTE[data] * Hasher._powers[0][: len(data)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[start]) * Hasher._powers[1][start] + (end - start).astype(np.uint64))


def stretches(offsets: np.ndarray, size: int, breaks: np.ndarray) -> Iterator[tuple[int, int]]:
    """(from, to) ranges of bytes of about ``size``, cut between rows or, in a long row, after one of ``breaks``.

    ``breaks``: ascending places of the bytes that may end a stretch. A longer run without any of
    them stays in one piece.
    """
    start, end = 0, int(offsets[-1])
    while start < end:
        goal = start + size
        if goal >= end:
            yield start, end
            return
        cut = int(offsets[np.searchsorted(offsets, goal, "right") - 1])
        if cut <= start:
            i = np.searchsorted(breaks, goal)
            row_end = int(offsets[np.searchsorted(offsets, start, "right")])
            if i and breaks[i - 1] >= start:
                cut = int(breaks[i - 1]) + 1
            else:
                cut = min(row_end, int(breaks[i]) + 1 if i < len(breaks) else row_end)
        yield start, cut
        start = cut
