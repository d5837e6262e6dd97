"""Words of whole Arrow columns at once: positions and 64-bit hashes, in numpy.

A word is a run of bytes other than blank and U+0009 to U+000D. All other white space
is part of words. UTF-8 never uses those bytes inside a character, so bytes will do.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SEPARATOR = np.zeros(256, bool)
SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
#: For words that are runs of ASCII letters and digits and of any other characters that aren't ASCII.
MARKS = np.ones(256, bool)
MARKS[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

#: Bytes of words hashed in one step; bounds the arrays of eight bytes for each byte of text.
STEP_BYTES = 1 << 22
_BASES = [(np.uint64(0x9E3779B97F4A7C15), 11), (np.uint64(0xC2B2AE3D27D4EB4F), 29)]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64 bits over 64 bits (the finalizer of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def unmix(x: np.ndarray) -> np.ndarray:
    """What `mix` made x of."""
    x = x ^ (x >> np.uint64(31)) ^ (x >> np.uint64(62))
    x = x * np.uint64(0x319642B2D24D8EC3)
    x = x ^ (x >> np.uint64(27)) ^ (x >> np.uint64(54))
    x = x * np.uint64(0x96DE1B173F119089)
    return x ^ (x >> np.uint64(30)) ^ (x >> np.uint64(60))


_TABLES = [mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(salt)) for _, salt in _BASES]


def buffer_of(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the n + 1 bounds of its rows; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    bounds = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    data = column.buffers()[2]
    data = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]]
    return data, bounds - bounds[0]


class Words:
    """Words of a column: start and end in bytes, row, and the words before each row."""

    def __init__(self, column, lower: bool = False, separator: np.ndarray = SEPARATOR):
        data, self.bounds = buffer_of(column)
        self.data = LOWER[data] if lower else data
        inside = ~separator[data]
        edge = np.zeros(len(data) + 1, bool)
        edge[self.bounds] = True
        before = np.empty(len(data), bool)
        before[:1] = False
        before[1:] = inside[:-1]
        before[edge[:-1]] = False
        self.start = np.flatnonzero(inside & ~before)
        after = np.empty(len(data), bool)
        after[-1:] = False
        after[:-1] = inside[1:]
        after[edge[1:]] = False
        self.end = np.flatnonzero(inside & ~after) + 1
        self.row = np.searchsorted(self.bounds, self.start, "right") - 1
        self.rows = len(self.bounds) - 1
        self.first = np.searchsorted(self.start, self.bounds)  # of each row, and the total
        self.count = np.diff(self.first)

    def hashes(self, which: int = 0) -> np.ndarray:
        """A 64-bit hash of each word; `which` 0 and 1 are independent of each other."""
        base, table = _BASES[which][0], _TABLES[which]
        length = self.end - self.start
        out = np.empty(len(length), np.uint64)
        upto = np.cumsum(length)
        power = np.ones(1, np.uint64)
        at = 0
        while at < len(length):
            done = upto[at] - length[at]
            to = max(at + 1, int(np.searchsorted(upto, done + STEP_BYTES, "right")))
            n = length[at:to]
            if n.max() > len(power):
                power = np.full(int(n.max()), base, np.uint64)
                power[0] = 1
                power = np.cumprod(power)
            begin = np.cumsum(n) - n
            place = np.arange(int(n.sum())) - np.repeat(begin, n)
            value = table[self.data[np.repeat(self.start[at:to], n) + place]] * power[place]
            out[at:to] = mix(np.add.reduceat(value, begin) + n.astype(np.uint64))
            at = to
        return out


def rolling(word_hash: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of `size` words, by its first word; runs may cross rows, callers leave those out."""
    n = len(word_hash) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for k in range(size):
        out = out * np.uint64(0xD6E8FEB86659FD93) + word_hash[k : k + n]
    return mix(out + np.uint64(size))


def within_row(words: Words, size: int) -> np.ndarray:
    """Whether the run of `size` words from each word on ends in the same row."""
    n = len(words.row) - size + 1
    return words.row[:n] == words.row[size - 1 :] if n > 0 else np.zeros(0, bool)


def lists(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list column out of flat values and the length of each row's list."""
    bounds = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=bounds[1:])
    return pa.ListArray.from_arrays(pa.array(bounds), pa.array(values, kind))
