"""Array helpers for the Arrow map stages of this subpackage.

Texts arrive as Arrow string columns.  They are cut into slices of about one
megabyte and scanned as byte arrays, so the cost is a few machine operations
per byte or per word instead of Python objects per word, and the memory of a
task is bounded by one slice (or by the longest single text).

Both word classes used here treat every byte above 0x7F as part of a word, so
a byte table is exact on UTF-8.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20

# word bytes of [^\x20\x09-\x0D]+
SPACE_WORD = np.ones(256, dtype=bool)
SPACE_WORD[[0x20, *range(0x09, 0x0E)]] = False

# word bytes of [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ once A-Z are lower-cased
ALNUM_WORD = np.zeros(256, dtype=bool)
ALNUM_WORD[list(range(0x30, 0x3A)) + list(range(0x61, 0x7B)) + list(range(0x80, 0x100))] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

_C1 = np.uint64(0xBF58476D1CE4E5B9)
_C2 = np.uint64(0x94D049BB133111EB)
_GOLD = np.uint64(0x9E3779B97F4A7C15)
_MASKS = np.array([(1 << (8 * i)) - 1 for i in range(8)] + [0xFFFFFFFFFFFFFFFF], dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer of a 64-bit hash (bijective)."""
    x = x ^ (x >> np.uint64(30))
    x = x * _C1
    x = x ^ (x >> np.uint64(27))
    x = x * _C2
    return x ^ (x >> np.uint64(31))


def mix_int(x: int) -> int:
    """The same finalizer for one Python int."""
    m = (1 << 64) - 1
    x &= m
    x = ((x ^ (x >> 30)) * int(_C1)) & m
    x = ((x ^ (x >> 27)) * int(_C2)) & m
    return x ^ (x >> 31)


class Slice:
    """Consecutive rows of one batch: ``data`` (bytes, zero padded by 8),
    ``off`` (row starts, length rows + 1) and ``row0`` (first row's index)."""

    def __init__(self, data: np.ndarray, off: np.ndarray, row0: int):
        self.n = int(off[-1])
        self.off, self.row0, self.rows = off, row0, len(off) - 1
        self.data = np.zeros(self.n + 8, dtype=np.uint8)
        self.data[: self.n] = data

    def lower(self) -> Slice:
        self.data[: self.n] = LOWER[self.data[: self.n]]
        return self

    def words(self, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, end (exclusive) of each word and, per row, the index of its
        first word (length rows + 1)."""
        inside = table[self.data[: self.n]]
        inner = self.off[:-1][self.off[:-1] < self.n]
        prev = np.empty_like(inside)
        prev[:1] = False
        prev[1:] = inside[:-1]
        prev[inner] = False
        after = np.empty_like(inside)
        after[-1:] = False
        after[:-1] = inside[1:]
        after[inner[inner > 0] - 1] = False
        s = np.flatnonzero(inside & ~prev)
        e = np.flatnonzero(inside & ~after) + 1
        return s, e, np.searchsorted(s, self.off)

    def lines(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, end (exclusive) of each line split at LF and, per row, the
        index of its first line; an empty text has one empty line."""
        nl = np.flatnonzero(self.data[: self.n] == 10)
        s = np.concatenate([self.off[:-1], nl + 1])
        e = np.concatenate([self.off[1:], nl])
        row_of = np.searchsorted(self.off[1:], nl, side="right")
        rows = np.concatenate([np.arange(self.rows), row_of])
        order = np.lexsort((s, rows))
        ends = np.lexsort((e, rows))
        return s[order], e[ends], np.searchsorted(rows[order], np.arange(self.rows + 1))

    def hash_spans(self, s: np.ndarray, e: np.ndarray, seed: int = 0) -> np.ndarray:
        """64-bit hash of the bytes of each span: a sum over its eight-byte
        blocks of a mix of block and place, mixed with the length."""
        loads = np.ndarray((self.n + 1,), dtype="<u8", buffer=self.data, strides=(1,))
        size = (e - s).astype(np.int64)
        h = (size + seed + 1).astype(np.uint64) * _GOLD
        # spans of one block (most words), then the longer ones block by block
        short = np.flatnonzero((size > 0) & (size <= 8))
        h[short] += mix((loads[s[short]] & _MASKS[size[short]]) + _C2)
        more = np.flatnonzero(size > 8)
        if len(more):
            n = (size[more] + 7) >> 3
            begin = np.cumsum(n) - n
            k = np.arange(int(n.sum())) - np.repeat(begin, n)
            v = loads[np.repeat(s[more], n) + 8 * k]
            last = begin + n - 1
            v[last] &= _MASKS[size[more] - 8 * (n - 1)]
            h[more] += np.add.reduceat(mix(v + (k + 1).astype(np.uint64) * _C2), begin)
        return mix(h)


def slices(col: pa.Array, slice_bytes: int = SLICE_BYTES) -> Iterator[Slice]:
    """The rows of an Arrow string column in slices; a null reads as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.type == pa.large_string():
        width = np.int64
    else:
        col, width = col.cast(pa.string()), np.int32
    if col.null_count:
        col = col.fill_null("")
    n = len(col)
    if n == 0:
        return
    _, off_buf, data_buf = col.buffers()
    off = np.frombuffer(off_buf, dtype=width)[col.offset: col.offset + n + 1].astype(np.int64)
    data = np.frombuffer(data_buf, dtype=np.uint8) if data_buf is not None else np.zeros(0, dtype=np.uint8)
    i = 0
    while i < n:
        j = int(np.searchsorted(off, off[i] + slice_bytes, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield Slice(data[off[i]: off[j]], off[i: j + 1] - off[i], i)
        i = j


def row_index(first: np.ndarray) -> np.ndarray:
    """For elements grouped by row (``first`` has each row's first element):
    the row of each element."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def grams(h: np.ndarray, k: int, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``k`` consecutive elements that stay inside one row, and the
    index of the first element of each."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    end = np.repeat(first[1:], np.diff(first))
    ok = np.flatnonzero(np.arange(n) + k <= end[:n])
    acc = np.zeros(n, dtype=np.uint64)
    for j in range(k):
        acc += h[j: j + n] * np.uint64((mix_int(j + 1) | 1))
    return mix(acc[ok]), ok


def sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of the values of each row (rows may be empty)."""
    c = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return c[first[1:]] - c[first[:-1]]
