"""Vectorised word splitting and hashing of Arrow string batches.

A word is a maximal run of bytes other than space and 0x09-0x0D, which for
valid UTF-8 is the pattern ``[^\\x20\\x09-\\x0D]+``. Everything here works on one
slice of a batch at a time, so memory follows the slice, not the partition.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 4 << 20

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_C1, _C2, _C3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * _C2
    x = (x ^ (x >> np.uint64(27))) * _C3
    return x ^ (x >> np.uint64(31))


def combine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Order-sensitive hash of two hash arrays."""
    return mix(a * _C1 + b)


def text_buffer(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all rows end to end, and n + 1 offsets; null counts as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null("")
    wide = pa.types.is_large_string(col.type)
    _, offs, data = col.buffers()
    o = np.frombuffer(offs, dtype=np.int64 if wide else np.int32)[col.offset: col.offset + len(col) + 1]
    o = o.astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8)[o[0]: o[-1]] if data is not None and len(o) else np.zeros(0, np.uint8)
    return raw, (o - o[0] if len(o) else np.zeros(1, np.int64))


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes each; a longer text is a range of its own."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


@dataclass
class Words:
    """Words of a slice: byte range, row within the slice, and 64-bit hash."""

    start: np.ndarray
    end: np.ndarray
    row: np.ndarray
    hash: np.ndarray
    first: np.ndarray  # n_rows + 1: index of each row's first word

    @property
    def per_row(self) -> np.ndarray:
        return np.diff(self.first)


def split_words(buf: np.ndarray, offsets: np.ndarray, hashed: bool = True) -> Words:
    """Words of the rows ``buf[offsets[i]:offsets[i+1]]`` (offsets start at 0)."""
    n = len(buf)
    if n == 0:
        z = np.zeros(0, np.int64)
        return Words(z, z, z, z.astype(np.uint64), np.zeros(len(offsets), np.int64))
    ink = ~SPACE[buf]
    lead = ink.copy()
    lead[1:] &= ~ink[:-1]
    tail = ink.copy()
    tail[:-1] &= ~ink[1:]
    inner = offsets[1:-1]
    inner = inner[(inner > 0) & (inner < n)]
    lead[inner] = ink[inner]
    tail[inner - 1] = ink[inner - 1]
    start = np.flatnonzero(lead)
    end = np.flatnonzero(tail) + 1
    first = np.searchsorted(start, offsets)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    h = hash_spans(buf, start, end) if hashed else np.zeros(0, np.uint64)
    return Words(start, end, row, h, first)


def hash_spans(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span, eight bytes at a time."""
    padded = np.zeros(len(buf) + 8, np.uint8)
    padded[: len(buf)] = buf
    lanes = np.ndarray(shape=(len(buf) + 1,), dtype="<u8", buffer=padded.data, strides=(1,))
    keep = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [(1 << 64) - 1], dtype=np.uint64)
    at, left = start, end - start
    h = left.astype(np.uint64) * _C3
    live = np.arange(len(start))
    while len(live):
        h[live] = mix((h[live] ^ (lanes[at] & keep[np.minimum(left, 8)])) * _C1)
        more = left > 8
        live, at, left = live[more], at[more] + 8, left[more] - 8
    return h
