"""Quality rules with suffix-array repetition.

The word-level suffix array of each text is built by prefix doubling (numpy,
many whole texts of one bounded slice at once, suffixes of different texts
never compare equal).  Longest-common-prefix values of neighbouring suffixes
give, for every word, the longest repeated substring that starts there; these
are the deepest LCP intervals, whose spans (from ``min_repeat`` words on) are
united.  A text is rejected when the union covers more than ``max_covered`` of
its words or one repeated substring is longer than ``max_longest`` words.

The base numbers (word characters, symbols, repeated lines, words in repeated
8-word windows) come from the same pass.  Null or empty texts have no words
and fail the base rule; equal rows get equal verdicts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import add_columns, clean
from .textkit import Words, cover, _range_hash

WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PCT = 30
MIN_REPEAT = 5
MAX_COVERED = 0.35
MAX_LONGEST = 50

SYMBOLS = np.zeros(256, dtype=bool)
SYMBOLS[list(b"#*$%&|<>")] = True

FIELDS = ("n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
          "covered_words bigint, longest_repeat bigint, n_repeats bigint")


def suffix_array(ids: np.ndarray, doc: np.ndarray, ends: np.ndarray):
    """Suffix array of many sequences and the rank tables of every doubling.

    ``ids`` are word numbers, ``doc`` the sequence of each word, ``ends`` the
    end of the sequence a word belongs to.  Returns (order, levels): level v
    ranks positions by their first 2**v words.
    """
    n = len(ids)
    order = np.lexsort((ids, doc))
    fresh = np.ones(n, dtype=bool)
    fresh[1:] = (ids[order][1:] != ids[order][:-1]) | (doc[order][1:] != doc[order][:-1])
    rank = np.empty(n, dtype=np.int64)
    rank[order] = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    levels, step = [rank], 1
    while True:
        size = np.bincount(rank, minlength=n)
        active = np.flatnonzero(size[rank] > 1)
        if not len(active):
            break
        after = active + step
        beyond = after >= ends[active]
        next_rank = np.where(beyond, -1, rank[np.minimum(after, n - 1)])
        key = rank[active] * (n + 1) + next_rank + 1
        by = np.argsort(key, kind="stable")
        active, key = active[by], key[by]
        head = np.ones(len(key), dtype=bool)
        head[1:] = key[1:] != key[:-1]
        group = rank[active]
        lead = np.ones(len(key), dtype=bool)
        lead[1:] = group[1:] != group[:-1]
        at = np.arange(len(key))
        place = group + at - np.maximum.accumulate(np.where(lead, at, 0))
        rank = rank.copy()
        rank[active] = place[np.maximum.accumulate(np.where(head, at, 0))]
        levels.append(rank)
        step *= 2
    order = np.empty(n, dtype=np.int64)
    order[rank] = np.arange(n)
    return order, levels


def neighbour_lcp(order: np.ndarray, levels: list[np.ndarray], ends: np.ndarray) -> np.ndarray:
    """lcp[j]: common words of the suffixes order[j] and order[j + 1]."""
    n = len(order)
    lcp = np.zeros(max(n - 1, 0), dtype=np.int64)
    a, b = order[:-1], order[1:]
    live = np.flatnonzero(levels[0][a] == levels[0][b]) if n > 1 else lcp
    for level in range(len(levels) - 1, -1, -1):
        x, y = a[live] + lcp[live], b[live] + lcp[live]
        inside = (x < ends[a[live]]) & (y < ends[b[live]])
        same = inside & (levels[level][np.minimum(x, n - 1)] == levels[level][np.minimum(y, n - 1)])
        lcp[live[same]] += 1 << level
    return lcp


def repeats(words: Words):
    """For every word: length of the longest repeated substring starting there,
    and whether it starts a maximal repeat (no longer one to its left)."""
    n = len(words.start)
    _, ids = np.unique(words.hashes(), return_inverse=True)
    ends = np.repeat(words.first[1:], words.count)
    order, levels = suffix_array(ids, words.doc, ends)
    lcp = neighbour_lcp(order, levels, ends)
    longest = np.zeros(n, dtype=np.int64)
    if n > 1:
        longest[order[:-1]] = lcp
        longest[order[1:]] = np.maximum(longest[order[1:]], lcp)
    left = np.concatenate([[0], longest[:-1]]) - 1
    if n:
        left[words.first[:-1][words.count > 0]] = -1
    return longest, longest > left


def _per_doc(words: Words, values: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values)])
    return total[words.first[1:]] - total[words.first[:-1]]


def _dup_lines(words: Words) -> np.ndarray:
    """Lines with a word that equal an earlier line of the same text."""
    cut = np.zeros(len(words.buf) + 1, dtype=bool)
    newline = np.flatnonzero(words.buf == 10)
    cut[newline + 1] = True
    cut[words.offsets] = True
    start = np.flatnonzero(cut[:-1]) if len(words.buf) else np.zeros(0, dtype=np.int64)
    end = np.append(start[1:], len(words.buf))
    doc = np.searchsorted(words.offsets, start, side="right") - 1
    end = np.where((end > start) & (words.buf[end - 1] == 10), end - 1, end) if len(start) else end
    has = np.searchsorted(words.start, end) > np.searchsorted(words.start, start)
    start, end, doc = start[has], end[has], doc[has]
    value = words.buf.astype(np.uint64) + np.uint64(1)
    key = np.stack([doc.astype(np.uint64), _range_hash(value, 0x9E3779B97F4A7C15, start, end),
                    _range_hash(value, 0xC2B2AE3D27D4EB4F, start, end)], axis=1)
    lines = np.bincount(doc, minlength=words.docs)
    distinct = np.unique(key, axis=0)[:, 0].astype(np.int64) if len(key) else doc
    return lines - np.bincount(distinct, minlength=words.docs)


def measure(texts: pa.Array, min_repeat: int = MIN_REPEAT) -> list[pa.Array]:
    """Arrow columns of FIELDS for one slice of whole texts."""
    words = Words(texts)
    n = len(words.start)
    lead = np.concatenate([[0], np.cumsum((words.buf & 0xC0) != 0x80)])
    chars = lead[words.end] - lead[words.start]
    marks = np.concatenate([[0], np.cumsum(SYMBOLS[words.buf])])
    longest, maximal = repeats(words)
    base = np.flatnonzero(longest >= WINDOW)
    in_window = cover(n, base, base + WINDOW)
    far = np.flatnonzero(longest >= min_repeat)
    covered = cover(n, far, far + longest[far])
    top = np.zeros(words.docs, dtype=np.int64)
    np.maximum.at(top, words.doc, longest)
    return [pa.array(x, pa.int64()) for x in (
        words.count, _per_doc(words, chars), marks[words.offsets[1:]] - marks[words.offsets[:-1]],
        _dup_lines(words), _per_doc(words, in_window), _per_doc(words, covered), top,
        _per_doc(words, maximal & (longest >= min_repeat)))]


def judge(docs: DataFrame, text: str = "text", min_repeat: int = MIN_REPEAT,
          max_covered: float = MAX_COVERED, max_longest: int = MAX_LONGEST) -> DataFrame:
    """Documents plus the measures, base_failed, covered_fraction and kept."""
    got = add_columns(docs, text, FIELDS, lambda texts: measure(texts, min_repeat))
    words = F.col("n_words")
    covered = F.col("covered_words") / F.greatest(words, F.lit(1))
    return (got
            .withColumn("base_failed", (words < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PCT * words))
            .withColumn("covered_fraction", covered)
            .withColumn("kept", ~F.col("base_failed") & (covered <= max_covered)
                        & (F.col("longest_repeat") <= max_longest)))


def report(docs: DataFrame) -> DataFrame:
    return judge(clean(docs, "doc_id", "text")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


ORACLE_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
pos AS (SELECT doc_id, k, i, array_to_string(list_slice(w, i, i + k - 1), ' ') AS win
        FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i
              FROM d, (SELECT unnest([5, 8, 51]) AS k) WHERE len(w) >= k)),
rep AS (SELECT doc_id, k, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, k, win) AS c FROM pos) WHERE c > 1),
cov AS (SELECT doc_id, count(DISTINCT j) FILTER (k = 8) AS c8, count(DISTINCT j) FILTER (k = 5) AS c5,
               count(DISTINCT j) FILTER (k = 51) AS c51
        FROM (SELECT doc_id, k, unnest(range(i, i + k)) AS j FROM rep) GROUP BY doc_id),
lines AS (SELECT doc_id, l, count(*) AS c FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS l FROM d)
          WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY doc_id, l),
dup AS (SELECT doc_id, sum(c - 1) AS n FROM lines GROUP BY doc_id),
m AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
             CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
             CAST(coalesce(n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(c8, 0) AS BIGINT) AS n_repeat_words,
             coalesce(c5, 0) AS c5, coalesce(c51, 0) AS c51
      FROM d LEFT JOIN dup USING (doc_id) LEFT JOIN cov USING (doc_id)),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND c5 / greatest(n_words, 1) <= 0.35 AND c51 = 0 AS kept
FROM b
"""
