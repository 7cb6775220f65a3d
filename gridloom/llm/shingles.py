"""Vectorised word and shingle hashing over the byte buffers of Arrow string columns."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_RNG = np.random.default_rng(20240117)
_VALUE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_VALUE[65:91] = _VALUE[97:123]  # A-Z count as a-z
_POWER = np.multiply.accumulate(np.full(1 << 16, 0x9E3779B97F4A7C15, dtype=np.uint64))
_HIGH = np.uint64(0xD6E8FEB86659FD93)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_STEP = _RNG.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the offsets of its rows; null rows are empty."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


_CLASS = np.full(256, 5, dtype=np.uint64)  # punctuation and control bytes
_CLASS[48:58], _CLASS[65:91], _CLASS[97:123], _CLASS[128:] = 1, 2, 3, 4


def word_starts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First bytes of words and the places of all bytes inside words."""
    inside = ~_SPACE[data]
    first = np.zeros(len(data), dtype=bool)
    first[:1] = True
    first[offsets[:-1][offsets[:-1] < len(data)]] = True
    start = inside.copy()
    start[1:] &= ~inside[:-1] | first[1:]
    return np.flatnonzero(start), np.flatnonzero(inside)


def word_shapes(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """What kind of word each is: classes of its first, middle and last byte and its size up to 7, as a small number."""
    at, kept = word_starts(data, offsets)
    begin = np.searchsorted(kept, at)
    size = np.diff(np.append(begin, len(kept)))
    kinds = _CLASS[data]
    return kinds[at] | (kinds[at + size // 2] << np.uint64(3)) | (kinds[at + size - 1] << np.uint64(6)) | (np.minimum(size, 7).astype(np.uint64) << np.uint64(9))


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One hash a word (a run of bytes other than ASCII white space, A-Z lower-cased) and the rows' word offsets."""
    n = len(data)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    at, kept = word_starts(data, offsets)
    begin = np.searchsorted(kept, at)
    lengths = np.diff(np.append(begin, len(kept)))
    place = np.arange(len(kept)) - np.repeat(begin, lengths)
    value = _VALUE[data[kept]] * _POWER[place & 0xFFFF]
    if len(place) and place.max() > 0xFFFF:
        value *= mix((place >> 16).astype(np.uint64) * _HIGH) | np.uint64(1)
    sums = np.add.reduceat(value, begin) if len(begin) else np.zeros(0, np.uint64)
    return mix(sums + lengths.astype(np.uint64) * _HIGH), np.searchsorted(at, offsets)


def shingle_hashes(words: np.ndarray, offsets: np.ndarray, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """One hash for each run of ``k`` words of a row; a row of fewer words, but not none, is one shingle."""
    counts = np.diff(offsets)
    per_row = np.where(counts >= k, counts - k + 1, np.minimum(counts, 1))
    out_offsets = np.concatenate([[0], np.cumsum(per_row)])
    out = np.empty(out_offsets[-1], dtype=np.uint64)
    full = np.zeros(max(0, len(words) - k + 1), dtype=np.uint64)
    for i in range(k if len(full) else 0):
        full += words[i : i + len(full)] * _STEP[i]
    rows = np.repeat(np.arange(len(counts)), per_row)
    source = offsets[:-1][rows] + np.arange(len(rows)) - out_offsets[:-1][rows]
    long = counts[rows] >= k
    out[long] = full[source[long]]
    for i in np.flatnonzero((counts > 0) & (counts < k)):
        w = words[offsets[i] : offsets[i + 1]]
        out[out_offsets[i]] = np.sum(np.append(w * _STEP[: len(w)], np.uint64([len(w)]) * _HIGH), dtype=np.uint64)
    return mix(out), out_offsets


def bounded(texts: pa.Array, most: int = 500_000):
    """(first row, rows) pieces of a string column with at most ``most`` bytes each, or one row."""
    at, begin, size = 0, 0, 0
    lengths = np.asarray(pa.compute.fill_null(pa.compute.binary_length(texts), 0))
    for at, n in enumerate(lengths):
        if at > begin and size + n > most:
            yield begin, at - begin
            begin, size = at, 0
        size += int(n)
    if len(lengths):
        yield begin, len(lengths) - begin
