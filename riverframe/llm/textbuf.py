"""Vectorised reading of Arrow text columns: bytes, words, word hashes and shingles.

All functions work on the UTF-8 bytes of a whole column at once. Intermediate arrays are built for
pieces of about ``PIECE`` bytes, cut between words, so that a very long text costs no more memory per
byte than a short one. Null texts count as empty.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

PIECE = 1 << 21
_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX1 = np.uint64(0xBF58476D1CE4E5B9)
_MIX2 = np.uint64(0x94D049BB133111EB)

SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: equal inputs to equal outputs, all bits spread."""
    x = x ^ (x >> np.uint64(30))
    x = x * _MIX1
    x = x ^ (x >> np.uint64(27))
    x = x * _MIX2
    return x ^ (x >> np.uint64(31))


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the row offsets into them (one more than rows)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    if n == 0 or column.null_count == n:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    if column.null_count:
        column = column.fill_null("")
    width = np.int64 if pa.types.is_large_string(column.type) else np.int32
    offsets = np.frombuffer(column.buffers()[1], width)[column.offset : column.offset + n + 1].astype(np.int64)
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def row_slices(column: pa.Array, limit: int = 2 * PIECE) -> Iterator[pa.Array]:
    """The column in runs of whole rows of about ``limit`` bytes; a longer row is a run of its own."""
    offsets = column_bytes(column)[1]
    a = 0
    while a < len(column):
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + limit, side="right")) - 1)
        yield column.slice(a, b - a)
        a = b


class _Powers:
    """Powers of an odd base and of its inverse modulo 2^64, grown on demand."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n + 1:
            size = max(n + 1, PIECE + 1)
            inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
            self.up = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(size, _BASE)]))
            self.down = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(size, inverse)]))
        return self.up, self.down


_powers = _Powers()


@dataclass
class Words:
    """Words in row order: where they start and end in the bytes, their row and their hash."""

    start: np.ndarray
    end: np.ndarray
    row: np.ndarray
    hash: np.ndarray
    first: np.ndarray  # index of each row's first word, one more than rows


def _pieces(space: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Cuts of the bytes at row ends or before white space, each about PIECE long."""
    lo, total = 0, len(space)
    while lo < total:
        hi = min(lo + PIECE, total)
        if hi < total:
            row_end = int(offsets[np.searchsorted(offsets, hi, side="right") - 1])
            if row_end > lo:
                hi = row_end
            else:
                back = np.flatnonzero(space[lo + 1 : hi])
                if len(back):
                    hi = lo + 1 + int(back[-1])
                else:
                    limit = int(offsets[np.searchsorted(offsets, hi, side="left")])
                    ahead = np.flatnonzero(space[hi:limit])
                    hi = hi + int(ahead[0]) if len(ahead) else limit
        yield lo, hi
        lo = hi


def without(raw: np.ndarray, offsets: np.ndarray, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes and offsets without the bytes that ``marks`` marks."""
    keep = ~marks[raw]
    return raw[keep], np.concatenate([[0], np.cumsum(keep)])[offsets]


def split_words(raw: np.ndarray, offsets: np.ndarray, fold: np.ndarray = LOWER, space: np.ndarray = SPACE) -> Words:
    """Words of every row: maximal runs of bytes that are not ``space``. ``fold`` maps bytes before hashing."""
    is_space = space[raw]
    cuts = np.zeros(len(raw) + 1, bool)
    cuts[offsets] = True
    parts: list[tuple[np.ndarray, ...]] = []
    for lo, hi in _pieces(is_space, offsets):
        gap = is_space[lo:hi]
        edge = cuts[lo:hi].copy()
        edge[0] = True
        edge[1:] |= gap[:-1]
        start = np.flatnonzero(~gap & edge)
        if not len(start):
            continue
        after = np.ones(hi - lo, bool)
        after[:-1] = gap[1:] | cuts[lo + 1 : hi]
        end = np.flatnonzero(~gap & after) + 1
        value = fold[raw[lo:hi]].astype(np.uint64) + np.uint64(1)
        up, down = _powers.get(hi - lo)
        sums = np.zeros(hi - lo + 1, np.uint64)
        np.cumsum(value * up[: hi - lo], out=sums[1:])
        code = (sums[end] - sums[start]) * down[start]
        size = (end - start).astype(np.uint64)
        parts.append((start + lo, end + lo, mix(code + size * _MIX2)))
    if parts:
        start, end, code = (np.concatenate(x) for x in zip(*parts, strict=True))
    else:
        start, end, code = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    first = np.searchsorted(start, offsets)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    return Words(start, end, row, code, first)


def shingles(words: Words, n: int = 5) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all runs of ``n`` words of a row; rows with 1 to n-1 words give one whole run.

    Returns the hashes, their rows and the index of each row's first hash.
    """
    counts = np.diff(words.first)
    made = np.where(counts >= n, counts - n + 1, (counts > 0).astype(np.int64))
    first = np.zeros(len(made) + 1, np.int64)
    np.cumsum(made, out=first[1:])
    row = np.repeat(np.arange(len(made)), made)
    at = words.first[row] + (np.arange(first[-1]) - first[row])
    code = np.full(len(at), np.uint64(n))
    for k in range(n):
        inside = at + k < words.first[row + 1]
        if inside.all():
            code = mix(code * _BASE + words.hash[at + k])
        else:
            step = mix(code[inside] * _BASE + words.hash[at[inside] + k])
            code[inside] = step
    return code, row, first


def row_sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of ``values`` between successive offsets; 0 for empty rows."""
    sums = np.zeros(len(values) + 1, np.float64 if values.dtype.kind == "f" else np.int64)
    np.cumsum(values, out=sums[1:])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def distinct_per_row(code: np.ndarray, row: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (row, code) pairs sorted by row then code, with the index of each row's first."""
    order = np.lexsort((code, row))
    code, row = code[order], row[order]
    new = np.ones(len(code), bool)
    new[1:] = (code[1:] != code[:-1]) | (row[1:] != row[:-1])
    code, row = code[new], row[new]
    return code, row, np.searchsorted(row, np.arange(rows + 1))
