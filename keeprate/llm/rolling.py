"""Array helpers for rolling hashes over whole batches of texts (numpy, inside tasks)."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

WIDEST = 512  # values under one rolling hash; modulo 2^64 it is blind to some patterns of 1,024 and more
CHUNK_BYTES = 2_000_000  # of text hashed at a time; a longer text is a chunk of its own

# Odd multipliers of the polynomial hashes, modulo 2^64.
BYTE_BASE, WORD_BASE = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93


@lru_cache(maxsize=8)
def powers(base: int, count: int) -> np.ndarray:
    """base^0 .. base^(count-1) modulo 2^64."""
    out = np.full(count, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def powers_for(base: int, count: int) -> np.ndarray:
    size = 1 << max(16, (max(count, 1) - 1).bit_length())
    return powers(base, size)[:count]


def inverse(base: int) -> int:
    return pow(base, -1, 1 << 64)


def mixed(h: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit values (the splitmix finisher)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def rolling(values: np.ndarray, width: int, base: int) -> np.ndarray:
    """Rabin-Karp hash of every run of ``width`` consecutive values."""
    n = len(values)
    if n < width:
        return np.zeros(0, np.uint64)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(values * powers_for(base, n), out=sums[1:])
    return mixed((sums[width:] - sums[:-width]) * powers_for(inverse(base), n)[: n - width + 1])


def chunks(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of rows of about ``CHUNK_BYTES``; null is empty."""
    column = column.fill_null("").cast(pa.large_string()) if column.null_count else column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + CHUNK_BYTES, "right")) - 1)
        yield row, end, data[offsets[row]:offsets[end]], offsets[row:end + 1] - offsets[row]
        row = end


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, first word of each row and the total) of the words between ASCII blanks."""
    solid = ~((data == 32) | ((data >= 9) & (data <= 13)))
    before, after = np.zeros(len(data) + 1, bool), np.zeros(len(data) + 1, bool)
    before[1:-1], after[:-2] = solid[:-1], solid[1:]
    before[offsets[:-1]] = False
    after[offsets[1:] - 1] = False  # of an empty first row this is the spare last place
    starts = np.flatnonzero(solid & ~before[:-1])
    ends = np.flatnonzero(solid & ~after[:-1]) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes: the sum of a mixed value for each byte and its place.

    Not a polynomial: modulo 2^64 some patterns of a thousand letters collide for every odd base.
    """
    if not len(starts):
        return np.zeros(0, np.uint64)
    lengths = ends - starts
    first = np.cumsum(lengths) - lengths
    inside = np.arange(int(lengths.sum())) - np.repeat(first, lengths)
    values = mixed(data[np.repeat(starts, lengths) + inside].astype(np.uint64) + (inside.astype(np.uint64) << np.uint64(8)) + np.uint64(1))
    return mixed(np.add.reduceat(values, first) + lengths.astype(np.uint64))


def planes(values: np.ndarray) -> bytes:
    """Little-endian bytes, all lowest bytes first: mostly zero planes compress to nothing."""
    return np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.itemsize).T.tobytes()


def from_planes(data: bytes, kind: str) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.frombuffer(data, np.uint8).reshape(size, -1).T.copy().view(kind).reshape(-1)


def cover(starts: np.ndarray, width: int, n: int) -> np.ndarray:
    """Which of n places lie in a run of ``width`` from one of the starts."""
    edges = np.zeros(n + 1, np.int32)
    np.add.at(edges, starts, 1)
    np.add.at(edges, np.minimum(starts + width, n), -1)
    return np.cumsum(edges[:-1]) > 0


def runs(covered: np.ndarray) -> np.ndarray:
    """(start, end) of the maximal runs of true places."""
    edges = np.flatnonzero(np.diff(np.concatenate([[False], covered, [False]]).astype(np.int8)))
    return edges.reshape(-1, 2)
