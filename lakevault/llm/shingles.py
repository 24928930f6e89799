"""Hashed words and word shingles of texts, worked out on the bytes of whole slices at once.

Words are runs of bytes other than blank, tab, line feed, vertical tab, form feed and carriage return; A-Z count
as a-z. Two different words or shingles share a 64-bit hash with a chance of about 2**-64.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa

CHUNK = 4 << 20
_random = np.random.default_rng(20_240_607)
VALUES = _random.integers(1, 2**64, 256, np.uint64)
VALUES[65:91] = VALUES[97:123]
BLANK = np.zeros(256, bool)
BLANK[[9, 10, 11, 12, 13, 32]] = True
BASE = np.uint64(0x9E3779B97F4A7C15)
STEP = np.uint64(0xD6E8FEB86659FD93)
# Stands for each word that a shorter sequence lacks.
LACKING = np.uint64(0xA0761D6478BD642F)


def mix(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    values = values ^ values >> np.uint64(33)
    values = values * np.uint64(0xFF51AFD7ED558CCD)
    values ^= values >> np.uint64(33)
    values *= np.uint64(0xC4CEB9FE1A85EC53)
    return values ^ values >> np.uint64(33)


def powers(base: np.uint64, size: int) -> np.ndarray:
    found = np.full(size, base, np.uint64)
    if size:
        found[0] = 1
    return np.multiply.accumulate(found)


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column, and the borders of its rows in them; null is empty."""
    column = column.cast(pa.large_binary())
    borders = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), borders


def words(data: np.ndarray) -> np.ndarray:
    """Hashes of the words of one stretch of bytes, in chunks that end between words."""
    found, start = [], 0
    while start < len(data):
        end = min(start + CHUNK, len(data))
        while end < len(data) and not BLANK[data[end]]:
            stop = np.flatnonzero(BLANK[data[end : end + CHUNK]])
            end = end + int(stop[0]) if len(stop) else min(end + CHUNK, len(data))
        part = data[start:end]
        inside = ~BLANK[part]
        first = np.flatnonzero(inside & np.concatenate([[True], ~inside[:-1]]))
        if len(first):
            at = np.arange(len(part)) - np.repeat(first, np.diff(first, append=len(part))) if first[0] == 0 else None
            if at is None:
                at = np.arange(len(part))
                at[first[0] :] -= np.repeat(first, np.diff(first, append=len(part)))
            size = int(at.max()) + 1
            values = VALUES[part] * powers(BASE, size)[at]
            values[~inside] = 0
            found.append(mix(np.add.reduceat(values, first)))
        start = end
    return np.concatenate(found) if found else np.zeros(0, np.uint64)


def by_row(column: pa.Array) -> list[np.ndarray]:
    """Word hashes of each row of a string column."""
    data, borders = bytes_of(column)
    return [words(data[start:end]) for start, end in zip(borders[:-1].tolist(), borders[1:].tolist())]


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` words; a shorter sequence is one run, an empty one has none."""
    if not len(hashes):
        return hashes
    if len(hashes) < size:
        hashes = np.concatenate([hashes, np.full(size - len(hashes), LACKING, np.uint64)])
    many = len(hashes) - size + 1
    total = hashes[:many].copy()
    for k in range(1, size):
        total *= STEP
        total += hashes[k : many + k]
    return mix(total)
