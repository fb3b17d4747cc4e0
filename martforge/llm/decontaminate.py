"""Benchmark decontamination: one Aho-Corasick automaton over item windows.

Texts and items are normalised alike: A-Z lower-cased, words are runs of
digits, letters and non-ASCII characters.  A window is ``size`` consecutive
item words; an item with fewer words, but not none, is one window.  The words
of a document are joined by single spaces and scanned once; each match is
mapped back to word numbers and to offsets (code points) of the original text.

The benchmark is a stated query set.  It is split into blocks of at most
``block_bytes`` of text, each block is one automaton that is shipped to the
executors, and the documents pass the blocks one after the other, so the
shipped data is bounded however large the benchmark is.

Null or empty texts and items have no words; repeated items and items with
equal windows are all reported; an item without id marks words but is not
listed.  No items: every document is clean.
"""

from __future__ import annotations

import hashlib
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import add_columns, clean, map_arrow
from .textkit import ALNUM_WORDS, Words, cover, list_array

WINDOW = 10
BLOCK_BYTES = 256 << 10  # item text per automaton: about ten trie nodes a byte

KEPT_AUTOMATA = 8  # of one worker

FIELDS = ("n_words bigint, n_hit bigint, hit_words array<int>, hit_spans array<int>, "
          "hit_items array<string>")


def _patterns(items: list[tuple], size: int) -> dict[str, tuple[int, list[str]]]:
    """Window text -> (words in it, ids of the items that hold it)."""
    found: dict[str, tuple[int, list[str]]] = {}
    texts = pa.array([t for _, t in items], type=pa.string())
    words = Words(texts, ALNUM_WORDS, lower=True)
    data, spans = words.joined()
    rows = [bytes(data[a:b]).decode("latin-1").split(" ") if b > a else [] for a, b in spans.tolist()]
    for (item, _), row in zip(items, rows):
        for i in range(max(1, len(row) - size + 1) if row else 0):
            part = row[i:i + size]
            ids = found.setdefault(f" {' '.join(part)} ", (len(part), []))[1]
            if item is not None and item not in ids:
                ids.append(item)
    return found


def _scanner(shared):
    """Function for one slice; the automaton is built once per worker and block."""
    key = uuid.uuid4().hex

    def scan(texts: pa.Array):
        import ahocorasick

        state = _AUTOMATA.get(key)
        if state is None:
            state = ahocorasick.Automaton()
            for window, value in shared.value.items():
                state.add_word(window, value)
            state.make_automaton()
            while len(_AUTOMATA) >= KEPT_AUTOMATA:  # a reused worker forgets those of earlier queries
                del _AUTOMATA[next(iter(_AUTOMATA))]
            _AUTOMATA[key] = state
        words = Words(texts, ALNUM_WORDS, lower=True)
        data, spans = words.joined()
        # a space before each row: the one that ends the row before it
        line = " " + data.tobytes().decode("latin-1")
        size = words.end - words.start + 1
        ends = np.cumsum(size)  # place, in line, of the space after each word
        starts, stops, items = [], [], [set() for _ in range(words.docs)]
        if shared.value:
            for row in np.flatnonzero(words.count).tolist():
                lo, hi = spans[row]
                for at, (length, ids) in state.iter(line, int(lo), int(hi) + 2):
                    starts.append((at, length))
                    items[row].update(ids)
        if starts:
            at, length = np.array(starts, dtype=np.int64).T
            last = np.searchsorted(ends, at)
            starts, stops = last - length + 1, last + 1
        hit = cover(len(words.start), np.asarray(starts, dtype=np.int64), np.asarray(stops, dtype=np.int64))
        return words, hit, items

    return scan


_AUTOMATA: dict = {}


def _spans(words: Words, hit: np.ndarray):
    """Runs of hit words: word ranges, original code-point ranges, runs per row."""
    edge = np.ones(len(hit) + 1, dtype=bool)
    if len(hit):
        edge[1:-1] = (hit[1:] != hit[:-1]) | (words.doc[1:] != words.doc[:-1])
    cuts = np.flatnonzero(edge)
    runs = [(a, b) for a, b in zip(cuts[:-1], cuts[1:]) if hit[a]] if len(hit) else []
    begin = np.array([a for a, _ in runs], dtype=np.int64)
    end = np.array([b for _, b in runs], dtype=np.int64)
    rows = words.doc[begin] if len(begin) else begin
    chars = np.concatenate([[0], np.cumsum((words.buf & 0xC0) != 0x80)])
    origin = chars[words.offsets[rows]]
    word_pairs = np.stack([begin - words.first[rows], end - words.first[rows]], axis=1).ravel()
    text_pairs = (np.stack([chars[words.start[begin]] - origin, chars[words.end[end - 1]] - origin], axis=1).ravel()
                  if len(begin) else begin)
    return word_pairs, text_pairs, np.bincount(rows, minlength=words.docs) * 2


def _mark(docs: DataFrame, text: str, shared, again: bool) -> DataFrame:
    scan = _scanner(shared)

    def run(texts, before=None):
        words, hit, items = scan(texts)
        if before is not None:
            for row, (pairs, ids) in enumerate(zip(*before)):
                for a, b in zip(pairs[::2], pairs[1::2]):
                    hit[words.first[row] + a:words.first[row] + b] = True
                items[row].update(ids)
        pairs, spans, sizes = _spans(words, hit)
        total = np.concatenate([[0], np.cumsum(hit)])
        return [pa.array(words.count, pa.int64()), pa.array(total[words.first[1:]] - total[words.first[:-1]], pa.int64()),
                list_array(pairs, sizes, pa.int32()), list_array(spans, sizes, pa.int32()),
                pa.array([sorted(x) for x in items], pa.list_(pa.string()))]

    if not again:
        return add_columns(docs, text, FIELDS, run)
    from .textkit import slices
    names = docs.columns
    words_at, items_at = names.index("hit_words"), names.index("hit_items")
    new = ["n_words", "n_hit", "hit_words", "hit_spans", "hit_items"]

    def merge(batches):
        for batch in batches:
            for part in slices(batch, text):
                got = run(part.column(text), (part.column(words_at).to_pylist(), part.column(items_at).to_pylist()))
                columns = [got[new.index(n)] if n in new else part.column(n) for n in names]
                yield pa.RecordBatch.from_arrays(columns, names)

    return map_arrow(docs, merge, docs.schema)


def decontaminate(docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id",
                  item_text: str = "text", size: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Documents plus n_words, n_hit, hit_words (word ranges, flattened),
    hit_spans (code-point ranges of the original text, flattened) and hit_items."""
    items = items.select(F.col(item_id).cast("string").alias("item"), F.col(item_text).alias("body"))
    # equal rows add nothing, and all of them would be dealt to one block
    items = items.distinct()
    total = items.agg(F.sum(F.coalesce(F.octet_length("body"), F.lit(0)) + 16)).first()[0] or 0
    blocks = -(-total // block_bytes) if total else 1
    deal = F.pmod(F.xxhash64("item", "body"), F.lit(blocks))
    context = docs.sparkSession.sparkContext
    for block in range(blocks):
        rows = [(r.item, r.body) for r in items.where(deal == block).collect()]  # about block_bytes
        docs = _mark(docs, text, context.broadcast(_patterns(rows, size)), again=block > 0)
    return docs


def digest(ids: list[str]) -> str:
    return hashlib.sha256(",".join(ids).encode()).hexdigest()


def report(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The query's columns: one row per document."""
    marked = decontaminate(clean(docs, "doc_id", "text"), items)
    ids = F.array_sort("hit_items")
    return marked.select(
        "doc_id", "n_words", "n_hit", F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", ids), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"))


ORACLE_SQL = r"""
WITH b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS k,
         array_to_string(list_slice(w, i, i + 9), ' ') AS win
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
kinds AS (SELECT DISTINCT k FROM win),
pos AS (
  SELECT doc_id, k, i, array_to_string(list_slice(w, i, i + k - 1), ' ') AS win
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, kinds WHERE len(w) >= k)),
hits AS (SELECT doc_id, i, win.k AS k, item_id FROM pos JOIN win ON pos.win = win.win AND pos.k = win.k),
words AS (SELECT doc_id, count(DISTINCT j) AS n_hit
          FROM (SELECT doc_id, unnest(range(i, i + k)) AS j FROM hits) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS s
        FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(s, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN its USING (doc_id)
"""
