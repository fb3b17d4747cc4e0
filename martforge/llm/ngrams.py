"""Hashed character n-grams of words, and document counts of them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow
from .textkit import ALNUM_WORDS, Words, mix, slices

_U = np.uint64


def vocabulary(texts: pa.Array) -> tuple[Words, list[str], np.ndarray]:
    """Words of one slice (lower-cased; digits, letters, non-ASCII), the distinct
    ones as text, and the number of each word among them."""
    words = Words(texts, ALNUM_WORDS, lower=True)
    coded = words.strings().dictionary_encode()
    return words, coded.dictionary.to_pylist(), coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)


def word_ngrams(vocab: list[str], orders: tuple[int, ...], bits: int, whole: bool = False):
    """Hashed n-grams of each distinct word between boundary marks: (cell, word number)."""
    if not vocab:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    flat = " " + " ".join(w.lower().replace(" ", "_") for w in vocab) + " "
    code = np.frombuffer(flat.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(_U)
    space = code == 32
    word = np.cumsum(space) - 1  # a space counts for the word after it
    cells, owners = [], []
    for order in orders:
        n = len(code) - order + 1
        if n <= 0:
            continue
        value = np.full(n, order, dtype=_U)
        inner = np.zeros(n, dtype=bool)
        for j in range(order):
            value = value * _U(0x9E3779B97F4A7C15) + code[j:n + j]
            if 0 < j < order - 1:
                inner |= space[j:n + j]
        if order == 1:
            good = ~space
        else:
            good = ~inner & ~(space[:n] & space[order - 1:order - 1 + n])
        at = np.flatnonzero(good)
        cells.append((mix(value[at]) >> _U(64 - bits)).astype(np.int64))
        owners.append(word[at])  # the last mark of a word belongs to the next one only as its first
    if whole:
        start = np.flatnonzero(space)[:-1]
        total = np.zeros(len(code) + 1, dtype=_U)
        power = np.full(len(code), 0xC2B2AE3D27D4EB4F, dtype=_U)
        power[0] = 1
        power = np.multiply.accumulate(power)
        total[1:] = np.cumsum(code * power, dtype=_U)
        end = np.append(start[1:], len(code) - 1)
        inverse = np.full(len(code), pow(0xC2B2AE3D27D4EB4F, -1, 1 << 64), dtype=_U)
        inverse[0] = 1
        inverse = np.multiply.accumulate(inverse)
        cells.append((mix((total[end] - total[start]) * inverse[start] + _U(99)) >> _U(64 - bits)).astype(np.int64))
        owners.append(np.arange(len(start)))
    return np.concatenate(cells), np.concatenate(owners)


def by_word(cell: np.ndarray, owner: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """The cells in word order, and where each word's cells begin."""
    order = np.argsort(owner, kind="stable")
    return cell[order], np.searchsorted(owner[order], np.arange(words + 1))


def document_cells(texts: pa.Array, orders, bits: int, whole: bool):
    """Distinct (row, cell) pairs of one slice, with words used once per row."""
    words, vocab, index = vocabulary(texts)
    cells, begin = by_word(*word_ngrams(vocab, orders, bits, whole), len(vocab))
    pair = np.unique(words.doc * max(len(vocab), 1) + index)
    row, word = pair // max(len(vocab), 1), pair % max(len(vocab), 1)
    size = (begin[1:] - begin[:-1])[word]
    at = np.repeat(begin[word] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
    both = np.unique(np.repeat(row, size) << bits | cells[at]) if len(at) else np.zeros(0, dtype=np.int64)
    return both >> bits, both & ((1 << bits) - 1), words.docs


def cell_counts(docs: DataFrame, text: str, group: str, groups: int, orders, bits: int, whole: bool = False) -> np.ndarray:
    """Document counts (groups, 2**bits) of every cell over all rows, and the last
    column, index 2**bits: rows per group.  ``group`` is an int column from 0."""
    size = (1 << bits) + 1

    def count(batches):
        total = np.zeros(groups * size, dtype=np.int64)
        for batch in batches:
            for part in slices(batch, text):
                kind = part.column(group).to_numpy(zero_copy_only=False).astype(np.int64)
                row, cell, _ = document_cells(part.column(text), orders, bits, whole)
                total += np.bincount(kind[row] * size + cell, minlength=len(total))
                total += np.bincount(kind * size + size - 1, minlength=len(total))
        used = np.flatnonzero(total)
        for lo in range(0, len(used), 100_000):
            some = used[lo:lo + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], ["cell", "n"])

    rows = map_arrow(docs.select(text, group), count, "cell int, n bigint").groupBy("cell").agg(F.sum("n").alias("n"))
    got = rows.toPandas()  # at most groups x (2**bits + 1) rows, whatever the input
    out = np.zeros(groups * size)
    out[got["cell"].to_numpy(dtype=np.int64)] = got["n"].to_numpy(dtype=np.float64)
    return out.reshape(groups, size)
