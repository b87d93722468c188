"""Words, lines and shingles of whole Arrow string columns, found and hashed on their UTF-8 bytes.

All helpers work on a column slice at once: a document is a range of bytes, a word a run of bytes that
are no white space. A null text is an empty one. Hashes are 64 bits wide and depend on the bytes only,
so they agree between tasks, runs and machines."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[list(SPACES)] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Bytes of text that are hashed at a time; a longer document is taken alone.
SLICE_BYTES = 2 << 20

_STEP = np.uint64(0x9E3779B97F4A7C15)
_PRIME = 0xD6E8FEB86659FD93  # odd, so that it has an inverse modulo 2**64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads each bit over all others."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def numbers(n: int, seed: int) -> np.ndarray:
    """``n`` fixed 64-bit numbers that look random."""
    with np.errstate(over="ignore"):
        return mix(np.arange(1, n + 1, dtype=np.uint64) * _STEP + np.uint64(seed))


BYTE_VALUE = numbers(256, 11)
BYTE_VALUE[list(SPACES)] = 0
LOWER_VALUE = BYTE_VALUE[LOWER]
#: Unlike the others, this one tells white space apart.
LINE_VALUE = numbers(256, 13)
LINE_VALUE[0x0A] = 0


_POWERS = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the multiplier and of its inverse; a worker keeps the longest that it needed."""
    if len(_POWERS[0]) < n:
        size = 1 << max(18, (n - 1).bit_length())
        for i, factor in enumerate((_PRIME, pow(_PRIME, -1, 1 << 64))):
            _POWERS[i] = np.full(size, factor, dtype=np.uint64)
            _POWERS[i][0] = 1
            np.multiply.accumulate(_POWERS[i], out=_POWERS[i])
    return _POWERS[0][:n], _POWERS[1][:n]


def buffers(column) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and where each row begins, with the end last."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    raw = column.buffers()
    offsets = np.frombuffer(raw[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(raw[2] or b"", dtype=np.uint8)
    if not len(offsets):
        return data[:0], np.zeros(1, dtype=np.int64)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows of at most ``most`` bytes together, or of one row."""
    low, n = 0, len(offsets) - 1
    while low < n:
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + most, side="right")) - 1)
        yield low, high
        low = high


@dataclass
class Words:
    """Words of a slice: where each starts and ends, its row, and the first word of each row."""

    data: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    row: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self, lower: bool = False) -> np.ndarray:
        if not len(self.starts):
            return np.zeros(0, dtype=np.uint64)
        return runs_hashed(self.data, self.starts, LOWER_VALUE if lower else BYTE_VALUE)


def runs_hashed(data: np.ndarray, starts: np.ndarray, value: np.ndarray) -> np.ndarray:
    """A hash of each run of bytes from one start to the next, wherever it stands. ``starts`` ascend
    strictly; bytes with value 0 are passed over."""
    up, down = powers(len(data))
    return mix(np.add.reduceat(value[data] * up, starts) * down[starts])


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true values, which end where a row ends."""
    n = len(inside)
    before, after = np.zeros(n, dtype=bool), np.zeros(n, dtype=bool)
    if n:
        before[1:], after[:-1] = inside[:-1], inside[1:]
        before[offsets[:-1][offsets[:-1] < n]] = False
        after[offsets[1:][offsets[1:] > 0] - 1] = False
    return np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1


def rows_of(offsets: np.ndarray, positions: np.ndarray) -> np.ndarray:
    return np.searchsorted(offsets, positions, side="right") - 1


def words(data: np.ndarray, offsets: np.ndarray) -> Words:
    starts, ends = runs(~IS_SPACE[data], offsets)
    row = rows_of(offsets, starts)
    return Words(data, offsets, starts, ends, row, np.searchsorted(row, np.arange(len(offsets))))


_PLACE = numbers(64, 17) | np.uint64(1)


def windows_hashed(hashes: np.ndarray, row: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each window of ``k`` words within a row, and the index of its first word."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    at = np.flatnonzero(row[:n] == row[k - 1 :])
    total = hashes[:n] * _PLACE[0]
    for j in range(1, k):
        total = total + hashes[j : j + n] * _PLACE[j]
    return mix(total[at] + np.uint64(k)), at


def shingles(found: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of ``k`` lower-cased words, sorted within each row, and where each row begins.

    A row of fewer words, but not none, has its whole sequence as its one shingle."""
    hashes, rows = found.hashes(lower=True), len(found.first) - 1
    value, at = windows_hashed(hashes, found.row, k)
    row = found.row[at]
    short = np.flatnonzero((found.counts > 0) & (found.counts < k))
    if len(short):
        extra = np.zeros(len(short), dtype=np.uint64)
        for j in range(k - 1):
            has = found.counts[short] > j
            extra[has] += hashes[found.first[short[has]] + j] * _PLACE[j]
        value = np.concatenate([value, mix(extra + found.counts[short].astype(np.uint64))])
        row = np.concatenate([row, short])
    order = np.lexsort((value, row))
    value, row = value[order], row[order]
    if len(value):
        new = np.ones(len(value), dtype=bool)
        new[1:] = (value[1:] != value[:-1]) | (row[1:] != row[:-1])
        value, row = value[new], row[new]
    return value, np.searchsorted(row, np.arange(rows + 1))


def code_points_before(data: np.ndarray) -> np.ndarray:
    """For each byte position, and the end, the code points that start before it."""
    total = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=total[1:])
    return total


def sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of each range of ``values`` between two offsets; ranges may be empty."""
    total = np.zeros(len(values) + 1, dtype=np.int64)
    np.cumsum(values, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]
