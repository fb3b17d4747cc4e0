"""Groups of spelling variants by an index of variable-length grams.

Words (runs of letters, counted over whole texts) are near if one inserted,
deleted or replaced code point makes the one the other.

1. Dictionary: all grams of two code points are counted over the words.  Those
   of more than ``PRUNE`` of the words are frequent and give way to their grams
   of three; the others stay as they are.  The alphabet has 90 letters, so at
   most 8,100 grams exist: the frequent ones travel with the tasks.
2. A word falls into variable grams: at every place the longest gram of the
   dictionary, left out where the one before it covers it.
3. A gram depends on its own code points, one of two also on the one before it
   (that could begin a covering gram).  So the word alone says how many of its
   grams one edit can affect at most, and how many, T, stay in any near word.
   T is at least 1 for words of 7 code points.
4. A gram that stays has the edit on one side and equal code points on the other.
   Near words therefore share the a-th gram from the left and all before it, or
   the b-th from the right and all after it, for a + b = T + 1.  The list of such a
   gram holds the words that agree up to there; only these two lists of a word
   are merged, instead of the lists of all its grams.  Since T and the number of
   grams differ by few between near words, a word stands in the lists of its
   gram a or b and of ``NEXT`` on either side.
5. Inside a list, members meet by their text without one code point; what meets
   is compared code point by code point.  A pair that both lists of a word hold
   counts in the left one only.

Lists are dealt to tasks in bundles of about ``BUNDLE`` entries.  A list longer
than ``LONG`` entries and a ten-thousandth of all is split: its entries go to
tasks by the text without one code point, where at most 90 words can meet.

Null texts have no words; words count only up to their own spelling, repeated
documents count again; an empty table gives no rows.  Ties of the most frequent
near word go to the smallest in code-point order.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import clean, map_arrow, scoped, ship, stored
from .textkit import LOWER, mix, polynomial, power, row_ranges, slices, text_bytes

LEAST_LENGTH, LEAST_COUNT = 7, 2
RATIO = 10  # a form is so many times as frequent as its variant
EDIT_ONE_IN = 31
LONG_RUN = 64  # bytes up to which runs go through the checksum together
PRUNE = 1 / 2000  # a gram in a greater share of the words is frequent
NEXT = 4
BUNDLE = 50_000
LONG, LISTS = 20_000, 10_000

_U = np.uint64
CRC = np.arange(256, dtype=np.uint32)
for _ in range(8):
    CRC = np.where(CRC & 1, (CRC >> 1) ^ np.uint32(0xEDB88320), CRC >> 1)
LETTER = np.zeros(256, dtype=bool)
LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B), 0xC3]] = True


class Runs:
    """Maximal runs of A-Z, a-z and U+00C0-U+00FF as one byte per code point, A-Z lower-cased."""

    def __init__(self, texts: pa.Array):
        buf, offsets = text_bytes(texts)
        lead = buf == 0xC3  # begins U+00C0 to U+00FF and nothing else
        inside = LETTER[buf]
        inside[1:] |= lead[:-1]
        cut = np.zeros(len(buf) + 1, dtype=bool)
        cut[offsets] = True
        start = inside.copy()
        start[1:] &= ~inside[:-1] | cut[1:-1]
        end = inside.copy()
        end[:-1] &= ~inside[1:] | cut[1:-1]
        start, end = np.flatnonzero(start), np.flatnonzero(end) + 1
        self.doc = np.searchsorted(offsets, start, side="right") - 1
        points = np.cumsum(~lead)
        before = np.concatenate([[0], points])
        self.length = before[end] - before[start]
        self.bytes_lo, self.bytes_hi = start, end
        self.raw = LOWER[buf]
        code = self.raw.copy()
        code[1:][lead[:-1]] += 0x40  # C3 80 is U+00C0
        self.code = code[~lead]
        self.lo = before[start]

    def keep(self, which: np.ndarray) -> None:
        for name in ("doc", "length", "bytes_lo", "bytes_hi", "lo"):
            setattr(self, name, getattr(self, name)[which])

    def checksums(self, doc_ids: list) -> np.ndarray:
        """CRC-32 of '<doc_id>:<run>' of every run."""
        prefix = np.array([zlib.crc32(f"{'' if d is None else d}:".encode()) for d in doc_ids], dtype=np.uint32)[self.doc]
        size = self.bytes_hi - self.bytes_lo
        order = np.argsort(-size, kind="stable")
        order = order[size[order] <= LONG_RUN]
        state, at, size_of = prefix[order] ^ np.uint32(0xFFFFFFFF), self.bytes_lo[order], size[order]
        for k in range(int(size_of[0]) if len(size_of) else 0):
            n = int(np.searchsorted(-size_of, -k))  # runs longer than k come first
            state[:n] = CRC[(state[:n] ^ self.raw[at[:n] + k]) & np.uint32(255)] ^ (state[:n] >> np.uint32(8))
        out = np.empty_like(prefix)
        out[order] = state ^ np.uint32(0xFFFFFFFF)
        for i in np.flatnonzero(size > LONG_RUN).tolist():
            out[i] = zlib.crc32(self.raw[self.bytes_lo[i]:self.bytes_hi[i]].tobytes(), int(prefix[i]))
        return out


def latin(code: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """UTF-8 strings of words given as one byte per code point."""
    wide = code >= 0x80
    at = np.arange(len(code)) + np.cumsum(wide)
    out = np.empty(len(code) + int(wide.sum()), dtype=np.uint8)
    out[at] = np.where(wide, code - 0x40, code)
    out[at[wide] - 1] = 0xC3
    more = np.concatenate([[0], np.cumsum(wide)])
    ends = np.concatenate([[0], np.cumsum(lengths)])
    return pa.StringArray.from_buffers(len(lengths), pa.py_buffer((ends + more[ends]).astype(np.int32)), pa.py_buffer(out))


def coded(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """One byte per code point, and the offsets of the words."""
    buf, offsets = text_bytes(words)
    lead = buf == 0xC3
    code = buf.copy()
    code[1:][lead[:-1]] += 0x40
    return code[~lead], offsets - np.concatenate([[0], np.cumsum(lead)])[offsets]


def _counted(texts: pa.Array, doc_ids: list) -> pa.RecordBatch:
    """word, n of the words of one slice."""
    runs = Runs(texts)
    runs.keep(runs.length >= LEAST_LENGTH)
    check = runs.checksums(doc_ids)
    edit = check % EDIT_ONE_IN == 0
    runs_length = runs.length
    source = np.repeat(runs.lo - (np.cumsum(runs_length) - runs_length), runs_length) + np.arange(runs_length.sum())
    gone = np.full(len(check), -1, dtype=np.int64)
    gone[edit] = check[edit] % runs_length[edit]
    stay = row_ranges(runs_length) != np.repeat(gone, runs_length)
    length = runs_length - edit
    code = runs.code[source[stay]]
    enough = length >= LEAST_LENGTH
    code, length = code[np.repeat(enough, length)], length[enough]
    found = latin(code, length).value_counts()
    return pa.RecordBatch.from_arrays([found.field("values"), found.field("counts")], ["word", "n"])


def words(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """word, n: all words of at least ``LEAST_LENGTH`` code points that occur ``LEAST_COUNT`` times."""
    docs = clean(docs, doc_id, text).toDF("doc_id", "text")

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                yield _counted(part.column("text"), part.column("doc_id").to_pylist())

    partial = map_arrow(docs, run, "word string, n bigint")
    return partial.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


def frequent_grams(found: DataFrame) -> np.ndarray:
    """256 x 256 flags: the grams of two code points that more than ``PRUNE`` of the words hold."""
    def run(batches):
        total = np.zeros(1 << 16, dtype=np.int64)
        for batch in batches:
            code, offsets = coded(batch.column(0))
            if len(code) < 2:
                continue
            gram = code[:-1].astype(np.int64) << 8 | code[1:]
            inside = np.ones(len(code), dtype=bool)
            inside[offsets[1:] - 1] = False  # last code points
            total += np.bincount(gram[inside[:-1]], minlength=1 << 16)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(total[seen])], ["gram", "n"])

    counts = map_arrow(found.select("word"), run, "gram bigint, n bigint").groupBy("gram").agg(F.sum("n").alias("n"))
    least = found.count() * PRUNE
    flags = np.zeros(1 << 16, dtype=bool)
    flags[[r["gram"] for r in counts.where(F.col("n") > least).select("gram").collect()]] = True  # at most 90 x 90
    return flags


def grams(code: np.ndarray, offsets: np.ndarray, frequent: np.ndarray):
    """Variable grams of the words: place in ``code``, size and word; and T of each word."""
    n = len(code)
    word = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    place = np.arange(n)
    last = offsets[1:][word] - 1
    pair = np.zeros(n, dtype=bool)
    pair[:-1] = place[:-1] < last[:-1]
    often = np.zeros(n, dtype=bool)
    often[:-1] = frequent[code[:-1].astype(np.int64) << 8 | code[1:]]
    three = pair & often & (place + 1 < last)
    covered = np.zeros(n, dtype=bool)
    covered[1:] = three[:-1] & ~three[1:]
    kept = np.flatnonzero(pair & ~covered)
    size = 2 + three[kept]
    # How many grams an edit affects.  A replaced or deleted code point: those of three that
    # hold it, those of two that hold it or begin behind it.  An insertion before it: those of
    # three it splits, those of two it splits or stands before; and at the end the one of two
    # that only the end had kept from being longer.
    long, w = size == 3, word[kept]
    low = np.where(long, kept, np.maximum(kept - 1, offsets[:-1][w]))
    change = np.cumsum(np.bincount(low, minlength=n + 3) - np.bincount(kept + size, minlength=n + 3))[:n]
    insert = np.cumsum(np.bincount(kept + long, minlength=n + 3) - np.bincount(kept + size, minlength=n + 3))[:n]
    tail = often[kept] & ~long  # frequent, yet of two: at the end of the word
    worst = np.zeros(len(offsets) - 1, dtype=np.int64)
    np.maximum.at(worst, word, np.maximum(change, insert))
    np.maximum.at(worst, w[tail], 1)
    count = np.bincount(w, minlength=len(offsets) - 1)
    return kept, size, w, count - worst


ENTRY = "key bigint, kind int, word string, id bigint, n bigint, side int, shared int, probe boolean, prefix int, first int, ends bigint"
_NAMES = [x.split()[0] for x in ENTRY.split(", ")]
BOTH, SAME_LENGTH, OTHER_LENGTH = 0, 1, 2  # which pairs a list is for


def _entries(found: DataFrame, frequent: np.ndarray) -> DataFrame:
    """The lists a word stands in, one row each.

    All words of a list have the first (side 0) or last (1) ``shared`` code points in common;
    ``probe`` marks the two lists that are merged for the word, ``prefix`` is the shared length
    of the left one.  Bit i of ``ends`` says that it stands in the left list of first + i code points.
    """
    def run(batches):
        for batch in batches:
            for part in slices(batch, "word"):
                code, offsets = coded(part.column("word"))
                kept, size, w, t = grams(code, offsets, frequent)
                count = np.bincount(w, minlength=len(t))
                a = (t + 1) // 2
                b = t + 1 - a
                rank = row_ranges(count) + 1
                back = count[w] - rank + 1
                left = (np.abs(rank - a[w]) <= NEXT) & (rank <= (count[w] + 1) // 2)
                right = (np.abs(back - b[w]) <= NEXT) & (back <= count[w] // 2 + 1)
                end = kept + size - offsets[:-1][w]
                first, prefix = np.full(len(t), np.iinfo(np.int32).max), np.zeros(len(t), dtype=np.int64)
                np.minimum.at(first, w[left], end[left])
                prefix[w[rank == a[w]]] = end[rank == a[w]]
                ends = np.zeros(len(t), dtype=np.int64)
                np.bitwise_or.at(ends, w[left], np.int64(1) << (end[left] - first[w[left]]))
                values, rows = code.astype(_U) + _U(1), []
                for side, which, lo, hi, merged in ((0, left, offsets[:-1][w], kept + size, rank == a[w]),
                                                    (1, right, kept, offsets[1:][w], back == b[w])):
                    i = np.flatnonzero(which)
                    key = mix(mix(polynomial(values, lo[i], hi[i])) + _U(side))
                    rows.append((key.view(np.int64), w[i], np.full(len(i), side), (hi - lo)[i], merged[i]))
                key, word, side, shared, probe = (np.concatenate(x) for x in zip(*rows))
                take = pa.array(word)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key), pa.array(np.full(len(key), BOTH), pa.int32()), *[part.column(c).take(take) for c in ("word", "id", "n")],
                     pa.array(side, pa.int32()), pa.array(shared, pa.int32()), pa.array(probe), pa.array(prefix[word], pa.int32()),
                     pa.array(first[word], pa.int32()), pa.array(ends[word])], _NAMES)

    return map_arrow(found, run, ENTRY)


class _Open:
    """The places of the entries' words that a list leaves open, and what is left without each."""

    def __init__(self, code, offsets, side, shared):
        size = np.diff(offsets)
        count = size - shared
        self.entry = np.repeat(np.arange(len(size)), count)
        self.spot = row_ranges(count) + np.where(side == 0, shared, 0)[self.entry]
        self.size = size[self.entry]
        values = code.astype(_U) + _U(1)
        lo, hi = offsets[:-1], offsets[1:]
        at, lo_of, hi_of = lo[self.entry] + self.spot, lo[self.entry], hi[self.entry]
        self.whole = mix(polynomial(values, lo, hi))
        self.without = mix(polynomial(values, lo_of, at) + polynomial(values, at + 1, hi_of) * power(len(code) + 1)[at - lo_of])

    def same_length(self, key):
        """Equal for words of equal length that differ at this place only."""
        return mix(self.without ^ key[self.entry] ^ mix((self.spot << 32 | self.size).astype(_U)))

    def shorter(self, key):
        return mix(self.without ^ key[self.entry] ^ mix((self.size - 1).astype(_U)))

    def plain(self, key, size):
        """Equal to ``shorter`` of a word that has one code point more."""
        return mix(self.whole ^ key ^ mix(size.astype(_U)))


def _split(entries: DataFrame) -> DataFrame:
    """Entries of long lists, dealt to lists of what is left without one code point."""
    def run(batches):
        for batch in batches:
            for part in slices(batch, "word", 1 << 17):
                code, offsets = coded(part.column("word"))
                key = mix(part.column("key").to_numpy().view(_U))
                opened = _Open(code, offsets, part.column("side").to_numpy(), part.column("shared").to_numpy())
                rows = np.arange(part.num_rows)
                once = np.unique(np.stack([opened.entry, opened.shorter(key).view(np.int64)], axis=1), axis=0)
                other = np.concatenate([once, np.stack([rows, opened.plain(key, np.diff(offsets)).view(np.int64)], axis=1)])
                entry = np.concatenate([opened.entry, other[:, 0]])
                dealt = np.concatenate([opened.same_length(key).view(np.int64), other[:, 1]])
                kind = np.repeat([SAME_LENGTH, OTHER_LENGTH], [len(opened.entry), len(other)])
                take = pa.array(entry)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(dealt), pa.array(kind, pa.int32()), *[part.column(c).take(take) for c in _NAMES[2:]]], _NAMES)

    return map_arrow(entries, run, ENTRY)


def _meeting(code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places i, j with equal codes, each pair once; few share a code."""
    order = np.argsort(code, kind="stable")
    same = code[order]
    left, right = [order[:0]], [order[:0]]
    alive = np.arange(len(order))
    for step in range(1, len(order)):
        alive = alive[alive < len(order) - step]
        alive = alive[same[alive] == same[alive + step]]
        if not len(alive):
            break
        left.append(order[alive])
        right.append(order[alive + step])
    return np.concatenate(left), np.concatenate(right)


def one_edit(code: np.ndarray, offsets: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether words i and j (i not shorter) are one edit apart, and how many code points both begin with."""
    if not len(i):
        return np.zeros(0, dtype=bool), i
    size = np.diff(offsets)
    n, short = size[i], size[j]
    step, top = row_ranges(n), np.cumsum(n) - n
    x, y = np.repeat(offsets[:-1][i], n) + step, np.repeat(offsets[:-1][j], n) + step
    differs = (step >= np.repeat(short, n)) | (code[x] != code[np.minimum(y, len(code) - 1)])
    first = np.minimum.reduceat(np.where(differs, step, len(code) + 1), top)
    # behind the first difference the longer word runs one code point late
    wrong = (step > np.repeat(first, n)) & (code[x] != code[np.minimum(y - np.repeat(n - short, n), len(code) - 1)])
    return (first < n) & (n - short <= 1) & (np.add.reduceat(wrong.astype(np.int64), top) == 0), first


MATCH = "id bigint, n_near bigint, form_n bigint, form string"


def _match(table: pa.Table) -> pa.Table:
    """id, number of near words and best form of the probing entries of a bundle of whole lists."""
    table = table.combine_chunks()
    column = {c: table.column(c).chunk(0) for c in _NAMES}
    key, kind, side, shared, probe, prefix, first, ends, n, ident = (
        column[c].to_numpy(zero_copy_only=False) for c in ("key", "kind", "side", "shared", "probe", "prefix", "first", "ends", "n", "id"))
    code, offsets = coded(column["word"])
    size = np.diff(offsets)
    opened = _Open(code, offsets, side, shared)
    mixed = mix(key.view(_U))
    use = np.flatnonzero(kind[opened.entry] != OTHER_LENGTH)
    i, j = _meeting(opened.same_length(mixed)[use])
    i, j = opened.entry[use[i]], opened.entry[use[j]]
    plain = opened.plain(mixed, size)
    order = np.argsort(plain, kind="stable")
    use = np.flatnonzero(kind[opened.entry] != SAME_LENGTH)
    shorter = opened.shorter(mixed)[use]
    if kind.any():  # a split list: its key is already what is left
        split = kind == OTHER_LENGTH
        plain = np.where(split, key.view(_U), plain)
        order = np.argsort(plain, kind="stable")
        shorter = np.where(split[opened.entry[use]], key.view(_U)[opened.entry[use]], shorter)
    lo = np.searchsorted(plain[order], shorter, side="left")
    times = np.searchsorted(plain[order], shorter, side="right") - lo
    pairs = np.stack([np.repeat(opened.entry[use], times), order[np.repeat(lo, times) + row_ranges(times)]], axis=1)
    pairs = np.unique(pairs, axis=0)  # one of several equal code points may go
    pairs = pairs[size[pairs[:, 0]] == size[pairs[:, 1]] + 1]
    i, j = np.concatenate([i, pairs[:, 0]]), np.concatenate([j, pairs[:, 1]])
    near, common = one_edit(code, offsets, i, j)
    near &= key[i] == key[j]
    i, j, common = (np.concatenate(x) for x in ((i[near], j[near]), (j[near], i[near]), (common[near], common[near])))
    bit = prefix[i] - first[j]
    in_left = (common >= prefix[i]) & (bit >= 0) & (bit < 64) & ((ends[j] >> np.clip(bit, 0, 63)) & 1 == 1)
    use = probe[i] & ((side[i] == 0) | ~in_left)
    i, j = i[use], j[use]
    found, times = np.unique(ident[i], return_counts=True)
    best = {}
    form = np.flatnonzero(n[j] >= RATIO * n[i])
    for who, often, word in zip(ident[i[form]].tolist(), n[j[form]].tolist(), column["word"].take(pa.array(j[form])).to_pylist()):
        best[who] = min(best.get(who, (0, "")), (-often, word))
    chosen = [best.get(who, (None, None)) for who in found.tolist()]
    return pa.table([pa.array(found, pa.int64()), pa.array(times, pa.int64()), pa.array([c[0] and -c[0] for c in chosen], pa.int64()),
                     pa.array([c[1] for c in chosen], pa.string())], ["id", "n_near", "form_n", "form"])


def near_words(found: DataFrame) -> DataFrame:
    """id, n_near, form_n and form (null if none is frequent enough) of the words that have near words.

    ``found`` has word, id (unique) and n and must be stored.
    """
    entries = stored(_entries(found, frequent_grams(found)), "gram-lists", compression="zstd")
    total = entries.count()
    long = entries.groupBy("key").agg(F.count(F.lit(1)).alias("_entries")).where(F.col("_entries") > max(LONG, total // LISTS))
    marked = entries.join(F.broadcast(long), "key", "left")  # at most LISTS of them
    lists = marked.where(F.col("_entries").isNull()).select(*_NAMES)
    lists = lists.unionByName(_split(marked.where(F.col("_entries").isNotNull()).select(*_NAMES)))
    bundles = max(1, -(-total // BUNDLE))
    lists = lists.withColumn("bundle", F.pmod(F.xxhash64("key"), F.lit(bundles)).cast("int"))
    ship(found.sparkSession)
    rows = lists.groupBy("bundle").applyInArrow(lambda table: _match(table), MATCH)
    best = F.min(F.when(F.col("form").isNotNull(), F.struct((-F.col("form_n")).alias("m"), "form")))
    rows = rows.groupBy("id").agg(F.sum("n_near").alias("n_near"), best.alias("best"))
    return rows.select("id", "n_near", (-F.col("best.m")).alias("form_n"), F.col("best.form").alias("form"))


def roots(forms: DataFrame) -> DataFrame:
    """word, root: the last form on the way from each word of (word, form); counts grow
    tenfold with every step, so the ways are short and few doublings end them."""
    ways = stored(forms.select("word", F.col("form").alias("root")), "ways")
    while True:
        step = ways.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        if ways.join(step, "root", "left_semi").isEmpty():
            return ways
        ways = stored(ways.join(step, "root", "left").select("word", F.coalesce("_next", "root").alias("root")), "ways")


@scoped
def variants(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """word, form, root, n, n_near, form_n of every word."""
    found = stored(words(docs, text, doc_id).withColumn("id", F.monotonically_increasing_id()), "words")
    near = found.join(near_words(found), "id", "left")
    near = stored(near.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form", "form_n"), "near-words")
    way = roots(near.where(F.col("form").isNotNull()).select("word", "form"))
    return near.join(way, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def report(docs: DataFrame) -> DataFrame:
    return variants(docs)


ORACLE_SQL = r"""
WITH RECURSIVE bits AS (SELECT list(c ORDER BY n) AS t FROM (
    SELECT n, list_reduce(list_prepend(n, range(8)), lambda c, _: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS c
    FROM (SELECT unnest(range(256)) AS n))),
runs AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+')) AS u FROM documents),
low AS (SELECT id, translate(u, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w, count(*) AS n FROM runs WHERE length(u) >= 7 GROUP BY ALL),
crc AS (SELECT w, n, xor(4294967295, list_reduce(list_prepend(4294967295, flatten(list_transform(string_split(concat(id, ':', w), ''),
    lambda ch: CASE WHEN unicode(ch) < 128 THEN [CAST(unicode(ch) AS BIGINT)] ELSE [CAST(195 AS BIGINT), CAST(unicode(ch) - 64 AS BIGINT)] END))),
    lambda v, y: xor(v // 256, t[(xor(v, y) & 255) + 1]))) AS h FROM low, bits),
edited AS (SELECT CASE WHEN h % 31 = 0 THEN concat(substr(w, 1, h % length(w)), substr(w, h % length(w) + 2)) ELSE w END AS w, n FROM crc),
v AS (SELECT w, CAST(sum(n) AS BIGINT) AS n FROM edited WHERE length(w) >= 7 GROUP BY w HAVING sum(n) >= 2),
less AS (SELECT w, n, i, concat(substr(w, 1, i), substr(w, i + 2)) AS x FROM (SELECT w, n, unnest(range(length(w))) AS i FROM v)),
near AS (SELECT DISTINCT a.w, a.n, b.w AS u, b.n AS m FROM less a JOIN less b ON a.x = b.x AND a.i = b.i AND a.w <> b.w
    UNION SELECT a.w, a.n, b.w, b.n FROM less a JOIN v b ON a.x = b.w
    UNION SELECT b.w, b.n, a.w, a.n FROM less a JOIN v b ON a.x = b.w),
top AS (SELECT w, any_value(n) AS n, count(*) AS n_near, max(m) AS m FROM near GROUP BY w),
form AS (SELECT top.w, min(encode(u)) AS f, any_value(top.m) AS form_n FROM top JOIN near ON near.w = top.w AND near.m = top.m
    WHERE top.m >= 10 * top.n GROUP BY top.w),
forms AS (SELECT w, decode(f) AS form, form_n FROM form),
r(w, f, d) AS (SELECT w, w, 0 FROM v UNION ALL SELECT r.w, forms.form, d + 1 FROM r JOIN forms ON forms.w = r.f),
way AS (SELECT w, arg_max(f, d) AS root FROM r GROUP BY w)
SELECT v.w AS word, form, root, v.n, coalesce(n_near, 0) AS n_near, form_n
FROM v JOIN way ON way.w = v.w LEFT JOIN top ON top.w = v.w LEFT JOIN forms ON forms.w = v.w
"""
