"""Array helpers for texts inside tasks: bytes, words and hashes of Arrow columns."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 18

#: Word separators: the space and the bytes 0x09 to 0x0D.
SEPARATOR = np.zeros(256, dtype=bool)
SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20

BASE = 0x9E3779B97F4A7C15
_U = np.uint64


def byte_ranges(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string or binary column and its n + 1 offsets; a null has no bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    if len(column) == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64 if wide else np.int32)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return data, offsets


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets from 0) of runs of rows of about `limit` bytes.

    A row longer than the limit is a run of its own, so memory follows the longest text."""
    data, offsets = byte_ranges(column)
    n, first = len(offsets) - 1, 0
    while first < n:
        end = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        end = min(max(end, first + 1), n)
        yield first, end, data[offsets[first] : offsets[end]], offsets[first : end + 1] - offsets[first]
        first = end


def powers(n: int, base: int = BASE) -> np.ndarray:
    out = np.full(max(n, 1), base, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64 bits."""
    h = h ^ (h >> _U(33))
    h = h * _U(0xFF51AFD7ED558CCD)
    h = h ^ (h >> _U(33))
    h = h * _U(0xC4CEB9FE1A85EC53)
    return h ^ (h >> _U(33))


#: A hash of each byte.
BYTES = mixed(np.arange(256, dtype=np.uint64) + _U(1))


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words in the bytes, and per text the index of its first word (n + 1)."""
    if not len(data):
        none = np.empty(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    inside = ~SEPARATOR[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    edges = offsets[1:-1]
    edges = edges[edges < len(data)]
    begins[edges] = inside[edges]
    stops = inside.copy()
    stops[:-1] &= ~inside[1:]
    before = edges[edges > 0] - 1
    stops[before] = inside[before]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word."""
    if not len(starts):
        return np.empty(0, np.uint64)
    lengths = ends - starts
    first = np.cumsum(lengths) - lengths
    within = np.arange(int(lengths.sum())) - np.repeat(first, lengths)
    value = (data[within + np.repeat(starts, lengths)].astype(np.uint64) + _U(1)) * powers(int(lengths.max()))[within]
    return mixed(np.add.reduceat(value, first) + lengths.astype(np.uint64))


def shingle_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of n words; of the whole sequence where there are fewer words."""
    size = min(n, len(hashes))
    if not size:
        return hashes
    count = len(hashes) - size + 1
    total = np.full(count, _U(size), dtype=np.uint64)
    for i in range(size):
        total = mixed(total * _U(BASE) + hashes[i : i + count])
    return total


def texts_of(column: pa.Array, limit: int = 4096) -> Iterator[list[str | None]]:
    """Python texts of a column in slices, so that few are alive at once."""
    for first in range(0, len(column), limit):
        yield column.slice(first, limit).to_pylist()
