"""Words and their hashes for many documents at once, straight from Arrow's text buffers.

A word is ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z: as UTF-8 bytes, a run of
digits, a-z and bytes of 128 or more.  Hashes are 64-bit polynomial hashes from one running sum
for a slice of the buffer, so a word, a prefix or a byte string costs two look-ups.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_BYTE = np.random.default_rng(20240611).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IN_WORD = np.zeros(256, dtype=bool)
_IN_WORD[48:58] = _IN_WORD[97:123] = _IN_WORD[128:] = True
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]

#: Bytes of text worked on at once; one longer document makes a slice of its own.
SLICE_BYTES = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def first_of(row: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Where each distinct (row, hash) occurs first."""
    return np.unique(mix(h + row.astype(np.uint64) * _BASE), return_index=True)[1]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = max(n, SLICE_BYTES + 1)
        for i, base in enumerate((_BASE, _BASE_INVERSE)):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            _powers[i] = np.multiply.accumulate(p)
    return _powers[0], _powers[1]


class Hasher:
    """Hashes of any byte string ``[start, end)`` of a buffer."""

    def __init__(self, data: np.ndarray):
        up, self.down = powers(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE[data] * up[: len(data)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.down[start])


@dataclass
class Texts:
    """Some rows' texts: ``data[offsets[i]:offsets[i + 1]]`` are the UTF-8 bytes of row ``first + i``."""

    first: int
    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1


@dataclass
class Words:
    """``[starts, ends)`` in the lower-cased ``data``; row ``i`` has the words ``[rows[i], rows[i + 1])``."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    rows: np.ndarray
    hasher: Hasher

    @property
    def hashes(self) -> np.ndarray:
        return self.hasher.of(self.starts, self.ends)

    def prefix(self, n: int) -> np.ndarray:
        """Hashes of the first ``n`` bytes, 0 for words that aren't longer."""
        h = self.hasher.of(self.starts, np.minimum(self.starts + n, self.ends))
        h[self.ends - self.starts <= n] = 0
        return h


def slices(column: pa.Array, most: int = SLICE_BYTES) -> Iterator[Texts]:
    """The rows of a text column in slices of about ``most`` bytes; a null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("") if column.null_count else column
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    i = 0
    while i < len(column):
        j = max(i + 1, int(np.searchsorted(at, at[i] + most, "right")) - 1)
        yield Texts(i, data[at[i] : at[j]], at[i : j + 1] - at[i])
        i = j


def words(texts: Texts) -> Words:
    data = _LOWER[texts.data]
    inside = _IN_WORD[data]
    before = np.zeros(len(data), bool)
    before[1:] = inside[:-1]
    first = texts.offsets[:-1]
    first = first[first < len(data)]
    before[first] = False  # words end with their document
    starts = np.flatnonzero(inside & ~before)
    after = np.zeros(len(data), bool)
    after[:-1] = inside[1:]
    last = texts.offsets[1:] - 1
    after[last[last >= 0]] = False
    ends = np.flatnonzero(inside & ~after) + 1
    return Words(data, starts, ends, np.searchsorted(starts, texts.offsets), Hasher(data))
