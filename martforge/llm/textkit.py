"""Vectorised word splitting and hashing for Arrow batches inside Spark tasks.

Spark partitions and shuffles the rows; these helpers only turn the text
column of one bounded slice of a record batch into numpy arrays.  Every text
is taken whole: a slice always holds complete texts, at least one.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20

_U = np.uint64


def byte_table(separators: bytes) -> np.ndarray:
    """True for every byte that belongs to a word; non-ASCII bytes always do."""
    table = np.ones(256, dtype=bool)
    table[list(separators)] = False
    return table


SPACES = bytes([0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D])
SPACE_WORDS = byte_table(SPACES)
#: words of lower-cased text: digits, a-z and everything beyond ASCII
ALNUM_WORDS = byte_table(bytes(b for b in range(0x80)
                               if not (0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A)))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

# Odd multipliers (two independent families) and their inverses modulo 2^64.
_MULT = {0: (0x9E3779B97F4A7C15, 0xD1342543DE82EF95), 1: (0xC2B2AE3D27D4EB4F, 0xA0761D6478BD642F)}
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2^64, cached and grown as needed."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, min(2 * len(have), SLICE_BYTES + 1) if have is not None else 0)
        have = np.full(size, base, dtype=_U)
        have[0] = 1
        with np.errstate(over="ignore"):
            np.multiply.accumulate(have, out=have)
        _powers[base] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finalizer: spreads a polynomial hash over all bits."""
    x = x.astype(_U, copy=True)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def _range_hash(values: np.ndarray, base: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Polynomial hash of values[starts:ends] for every pair, by prefix sums."""
    n = len(values)
    prefix = np.zeros(n + 1, dtype=_U)
    np.cumsum(values * _power(base, n), dtype=_U, out=prefix[1:])
    inverse = pow(base, -1, 1 << 64)
    return mix((prefix[ends] - prefix[starts]) * _power(inverse, n + 1)[starts])


def text_hash(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, family: int = 0) -> np.ndarray:
    """64-bit hash of the bytes buf[starts:ends]."""
    return _range_hash(buf.astype(_U) + _U(1), _MULT[family][0], starts, ends)


def power(n: int) -> np.ndarray:
    """Powers of the base of ``polynomial``."""
    return _power(_MULT[0][0], n)


def polynomial(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Polynomials (not mixed, so they can be put together) of values[starts:ends]."""
    base, n = _MULT[0][0], len(values)
    prefix = np.zeros(n + 1, dtype=_U)
    np.cumsum(values * _power(base, n), dtype=_U, out=prefix[1:])
    return (prefix[ends] - prefix[starts]) * _power(pow(base, -1, 1 << 64), n + 1)[starts]


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES):
    """Row slices of a batch whose texts sum to at most ``limit`` bytes (or one row)."""
    if batch.num_rows == 0:
        return
    offsets = _offsets(batch.column(column))
    row, rows = 0, batch.num_rows
    while row < rows:
        end = int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1
        end = min(max(end, row + 1), rows)
        yield batch.slice(row, end - row)
        row = end


def _offsets(array: pa.Array) -> np.ndarray:
    kind = np.int64 if pa.types.is_large_string(array.type) or pa.types.is_large_binary(array.type) else np.int32
    return np.frombuffer(array.buffers()[1], dtype=kind)[array.offset:array.offset + len(array) + 1].astype(np.int64)


def text_bytes(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Concatenated UTF-8 bytes and the row offsets into them; null is empty."""
    if array.null_count:
        array = array.fill_null("")
    offsets = _offsets(array)
    data = array.buffers()[2]
    buf = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return buf[offsets[0]:offsets[-1]], offsets - offsets[0]


class Words:
    """Words of the texts of one slice.

    ``start``/``end`` are byte ranges in ``buf``; ``first[d]:first[d + 1]`` are
    the words of row ``d``; ``doc`` is the row of each word.
    """

    def __init__(self, array: pa.Array, table: np.ndarray = SPACE_WORDS, lower: bool = False):
        self.buf, self.offsets = text_bytes(array)
        if lower:
            self.buf = LOWER[self.buf]
        inside = table[self.buf]
        cut = np.zeros(len(self.buf) + 1, dtype=bool)
        cut[self.offsets] = True
        left = np.empty_like(inside)
        right = np.empty_like(inside)
        if len(inside):
            left[0], right[-1] = True, True
            left[1:] = ~inside[:-1] | cut[1:-1]
            right[:-1] = ~inside[1:] | cut[1:-1]
        self.start = np.flatnonzero(inside & left)
        self.end = np.flatnonzero(inside & right) + 1
        self.first = np.searchsorted(self.start, self.offsets)
        self.docs = len(self.offsets) - 1
        self.count = np.diff(self.first)
        self.doc = np.repeat(np.arange(self.docs), self.count)

    def hashes(self, family: int = 0) -> np.ndarray:
        """64-bit hash of every word."""
        return text_hash(self.buf, self.start, self.end, family)

    def strings(self) -> pa.Array:
        """Every word as text."""
        return pa.array([], pa.string()) if not len(self.start) else self.text_of(self.start, self.end)

    def text_of(self, start: np.ndarray, end: np.ndarray) -> pa.Array:
        size = end - start
        offsets = np.zeros(len(start) + 1, dtype=np.int32)
        np.cumsum(size, out=offsets[1:])
        data = self.buf[np.repeat((start - offsets[:-1]).astype(np.int32), size) + np.arange(offsets[-1], dtype=np.int32)]
        return pa.StringArray.from_buffers(len(start), pa.py_buffer(offsets), pa.py_buffer(data))

    def joined(self, keep: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Kept words of each row joined by one space: bytes and row offsets.

        Each row ends with one extra space that the offsets leave out, so row
        ``d`` is ``data[lo[d]:hi[d]]``; returned as (data, lo_hi of shape (docs, 2)).
        """
        start, end, doc = self.start, self.end, self.doc
        if keep is not None:
            start, end, doc = start[keep], end[keep], doc[keep]
        size = end - start + 1
        at = np.zeros(len(start) + 1, dtype=np.int64)
        np.cumsum(size, out=at[1:])
        source = np.repeat(start - at[:-1], size) + np.arange(at[-1])
        data = np.append(self.buf, np.uint8(32))[source] if len(source) else np.zeros(0, dtype=np.uint8)
        data[at[1:] - 1] = 32
        row = np.searchsorted(doc, np.arange(self.docs + 1))
        lo, hi = at[row[:-1]], at[row[1:]]
        return data, np.stack([lo, np.maximum(hi - 1, lo)], axis=1)

    def sha256(self, keep: np.ndarray | None = None) -> list[str]:
        """Lower-case hex SHA-256 of each row's kept words joined by one space."""
        data, spans = self.joined(keep)
        view = memoryview(np.ascontiguousarray(data))
        return [hashlib.sha256(view[a:b]).hexdigest() for a, b in spans.tolist()]

    def windows(self, words: np.ndarray, size: int) -> np.ndarray:
        """Start indexes of the ``size``-word windows that stay inside one row."""
        n = len(words)
        if n < size:
            return np.zeros(0, dtype=np.int64)
        at = np.arange(n - size + 1)
        return at[self.doc[at] == self.doc[at + size - 1]]


def sequence_hash(words: np.ndarray, starts: np.ndarray, ends: np.ndarray, family: int = 0) -> np.ndarray:
    """64-bit hash of the word sequences words[starts:ends]."""
    return _range_hash(words, _MULT[family][1], starts, ends)


def cover(n: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Boolean mask of length n: positions inside any [start, end)."""
    delta = np.bincount(starts, minlength=n + 1)[:n + 1].astype(np.int64)
    delta -= np.bincount(ends, minlength=n + 1)[:n + 1]
    return np.cumsum(delta[:n]) > 0


def row_ranges(lengths: np.ndarray) -> np.ndarray:
    """0..k-1 for each k in lengths, concatenated."""
    lengths = np.asarray(lengths, dtype=np.int64)
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, dtype=np.int64)
    begin = np.cumsum(lengths) - lengths
    return np.arange(total) - np.repeat(begin, lengths)


def list_array(values: np.ndarray, lengths: np.ndarray, kind: pa.DataType) -> pa.Array:
    """Arrow list column from flat values and the length of each row's list."""
    offsets = np.zeros(len(lengths) + 1, dtype=np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, type=kind))
