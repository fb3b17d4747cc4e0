"""Best-fit packing of tokenised documents by linear grouping.

Only the histogram of piece lengths (at most ``capacity`` numbers) meets on
the driver; documents stay distributed.  There, (1) large lengths are sorted
and cut into groups of equal cardinality, each rounded up to its longest
member; (2) the few rounded sizes are packed by configurations: the
configuration program is solved by column generation and rounded down; (3)
actual lengths take the places of the rounded ones, group by group, and what
is left over, then all small pieces, longest first, go by best fit into the
room that is really left.  The plan says which ranks of a length go where; its
size depends on the capacity and the number of groups only.  Ranks are given
to the pieces by Spark, and the plan is joined to them.  The token ids of each
piece travel to its sequence and are written with it.

A null or empty text is one piece that holds the end token alone.  Texts of any
length are cut whole; ties and repeated rows are separate pieces; an empty
table gives no pieces.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import work_path
from .common import clean, collect_garbage, map_arrow, own_tables, ranked, stored
from .textkit import Words, row_ranges, slices, text_bytes, text_hash

CAPACITY = 2048
END_ID = 0
GROUPS = 64
LARGE = (CAPACITY // 2 + 1, CAPACITY // 3 + 1, CAPACITY // 4 + 1)  # cuts between large and small that are tried
SLICE = 4 << 20  # bytes of text at a time: fewer distinct pieces to look up
CACHE_WORDS = 1_500_000  # distinct pieces whose ids a worker keeps, about 60 bytes each


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


#: ASCII marks that end a run of letters or digits; the tokenizer always cuts there
MARKS = np.zeros(256, dtype=bool)
MARKS[list(b'.,;:!?"()*%&$#')] = True
ALNUM = np.zeros(256, dtype=bool)
ALNUM[list(b"abcdefghijklmnopqrstuvwxyz0123456789")] = True


class _Tokens:
    """Ids of pieces of text that the tokenizer never joins with their neighbours.

    Pieces are known by 128 bits of hash, in arrays sorted by the first 64.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.clear()

    def clear(self) -> None:
        self.first, self.second = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.uint64)
        self.number = np.zeros(0, dtype=np.int64)  # of the piece; ids of number k: flat[begin[k]:begin[k + 1]]
        self.flat = np.zeros(1 << 16, dtype=np.uint32)
        self.begin = np.zeros(1 << 16, dtype=np.int64)
        self.size = 0
        self.ends: dict[int, int] = {}

    def add(self, ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Numbers of new pieces whose ids follow each other in ``ids``."""
        at = self.begin[self.size]
        while len(self.begin) <= self.size + len(sizes):
            self.begin = np.concatenate([self.begin, np.zeros_like(self.begin)])
        while len(self.flat) < at + len(ids):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.flat[at:at + len(ids)] = ids
        self.begin[self.size + 1:self.size + 1 + len(sizes)] = at + np.cumsum(sizes)
        self.size += len(sizes)
        return np.arange(self.size - len(sizes), self.size)

    def of(self, chunks: pa.StringArray) -> np.ndarray:
        """Numbers of distinct pieces, encoded now where they are new."""
        buf, offsets = text_bytes(chunks)
        first, second = (text_hash(buf, offsets[:-1], offsets[1:], family) for family in (0, 1))
        place = np.searchsorted(self.first, first)
        near = np.minimum(place, max(len(self.first) - 1, 0))
        known = (self.first[near] == first) & (self.second[near] == second) if len(self.first) else np.zeros(len(first), dtype=bool)
        new = np.flatnonzero(~known)
        if self.size + len(new) > CACHE_WORDS and self.size:
            self.clear()
            return self.of(chunks)
        out = np.empty(len(first), dtype=np.int64)
        out[known] = self.number[near[known]]
        for lo in range(0, len(new), 2000):
            group = new[lo:lo + 2000]
            coded = [c.ids for c in self.model.encode_batch_fast(chunks.take(pa.array(group)).to_pylist(), add_special_tokens=False)]
            sizes = np.fromiter(map(len, coded), dtype=np.int64, count=len(group))
            out[group] = self.add(np.fromiter(chain.from_iterable(coded), dtype=np.uint32, count=int(sizes.sum())), sizes)
        new = new[np.argsort(first[new])]
        self.first = np.insert(self.first, place[new], first[new])
        self.second = np.insert(self.second, place[new], second[new])
        self.number = np.insert(self.number, place[new], out[new])
        return out

    def end(self, end_id: int) -> int:
        """Number of the piece that is the end id alone."""
        if end_id not in self.ends:
            self.ends[end_id] = int(self.add(np.array([end_id], dtype=np.uint32), np.ones(1, dtype=np.int64))[0])
        return self.ends[end_id]


_TOKENS: dict[str, _Tokens] = {}


def _pieces_of_words(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Byte ranges of the words, cut further between letters or digits and marks."""
    starts, ends = (np.zeros(len(words.buf) + 1, dtype=bool) for _ in range(2))
    starts[words.start], ends[words.end] = True, True
    if len(words.buf):
        mark, alnum = MARKS[words.buf], ALNUM[words.buf]
        cuts = (mark[1:] & alnum[:-1]) | (alnum[1:] & mark[:-1])
        cuts &= ~starts[1:-1]
        # a cut lies strictly inside a word, so it ends one piece and starts the next
        starts[1:-1] |= cuts
        ends[1:-1] |= cuts
    return np.flatnonzero(starts), np.flatnonzero(ends)


def token_ids(texts: pa.Array, path: str, end_id: int = END_ID) -> tuple[np.ndarray, np.ndarray]:
    """Ids of each text followed by the end id: flat values and row offsets."""
    if path not in _TOKENS:
        _TOKENS[path] = _Tokens(path)
    words = Words(texts, lower=True)
    start, end = _pieces_of_words(words)
    if b"<|" in words.buf.tobytes():  # special tokens: their case counts, and their marks
        words = Words(texts)
        start, end = words.start, words.end
    coded = words.text_of(start, end).dictionary_encode()
    store = _TOKENS[path]
    number = store.of(coded.dictionary)[coded.indices.to_numpy(zero_copy_only=False)]
    last = np.searchsorted(start, words.offsets)[1:]
    number = np.insert(number, last, store.end(end_id))  # after the last piece of each text
    begin = store.begin[number]
    count = store.begin[number + 1] - begin
    total = np.concatenate([[0], np.cumsum(count)])
    at = np.arange(total[-1], dtype=np.int32) + np.repeat((begin - total[:-1]).astype(np.int32), count)
    return store.flat[at], np.concatenate([[0], total[last + np.arange(1, words.docs + 1)]])


PIECE_FIELDS = "piece int, start bigint, length bigint, ids binary"


def pieces(docs: DataFrame, text: str = "text", path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece, with its token ids and the columns of ``docs`` but the text.

    Ids are little-endian, of 2 bytes each where those of the slice fit in, else
    of 4; ``_widened`` makes 4 of all.
    """
    path = path or tokenizer_path()
    new = T.StructType.fromDDL(PIECE_FIELDS)
    docs = docs.drop(*new.names)
    keep = [f for f in docs.schema.fields if f.name != text]
    at = [docs.columns.index(f.name) for f in keep]

    def run(batches):
        for batch in batches:
            for part in slices(batch, text, SLICE):
                ids, offsets = token_ids(part.column(text), path)
                size = np.diff(offsets)
                count = -(-size // capacity)
                row = np.repeat(np.arange(len(size)), count)
                piece = row_ranges(count)
                start = piece * capacity
                length = np.minimum(size[row] - start, capacity)
                if not len(ids) or ids.max() < 1 << 16:
                    ids = ids.astype("<u2")
                # pieces follow each other in ``ids`` without gaps
                ends = np.concatenate([[0], np.cumsum(length * ids.itemsize)]).astype(np.int32)
                cut = pa.Array.from_buffers(pa.binary(), len(row), [None, pa.py_buffer(ends), pa.py_buffer(ids)])
                rows = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [part.column(i).take(rows) for i in at]
                    + [pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()),
                       cut], [f.name for f in keep] + new.names)

    return map_arrow(docs, run, T.StructType(keep + new.fields))


def runs_of(ends: np.ndarray, flags: np.ndarray):
    """(first byte, last byte, flag) of every stretch of neighbouring values with one flag."""
    edge = np.flatnonzero(np.concatenate([[True], flags[1:] != flags[:-1], [True]])) if len(flags) else [0]
    return [(ends[a], ends[b], flags[a]) for a, b in zip(edge[:-1], edge[1:])]


def _widened(placed: DataFrame) -> DataFrame:
    """``placed`` with ids of 4 bytes, rows in their order."""
    names = placed.columns

    def run(batches):
        for batch in batches:
            for part in slices(batch, "ids", SLICE):
                _, ends, data = part.column("ids").buffers()
                ends = np.frombuffer(ends, dtype=np.int32)[part.column("ids").offset:][:part.num_rows + 1]
                length = part.column("length").to_numpy()
                short = np.diff(ends) < 4 * length
                raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
                ids = [raw[a:b].view("<u2" if s else "<u4") for a, b, s in runs_of(ends, short)]
                flat = np.concatenate([x.astype("<u4") for x in ids]) if ids else np.zeros(0, dtype="<u4")
                at = np.concatenate([[0], np.cumsum(4 * length)]).astype(np.int32)
                wide = pa.Array.from_buffers(pa.binary(), part.num_rows, [None, pa.py_buffer(at), pa.py_buffer(flat)])
                yield part.set_column(names.index("ids"), "ids", wide)

    return map_arrow(placed, run, placed.schema)


def linear_groups(counts: np.ndarray, large: int, groups: int) -> list[tuple[int, int, list]]:
    """(rounded size, members, [(length, count), ...] longest first) of equal-cardinality groups."""
    lengths = [l for l in range(len(counts) - 1, large - 1, -1) if counts[l]]
    total = int(sum(counts[l] for l in lengths))
    share = max(1, -(-total // groups))
    out, members, room = [], [], share
    for length in lengths:
        left = int(counts[length])
        while left:
            take = min(left, room)
            members.append((length, take))
            left, room = left - take, room - take
            if not room:
                out.append(members)
                members, room = [], share
    if members:
        out.append(members)
    return [(m[0][0], sum(c for _, c in m), m) for m in out]


def configurations(sizes: list[int], demand: list[int], capacity: int, rounds: int = 4000) -> list[tuple[tuple, int]]:
    """Whole uses of configurations: column generation on the covering program, rounded down."""
    k = len(sizes)
    if not k:
        return []
    columns = [tuple((capacity // s) * (i == j) for j in range(k)) for i, s in enumerate(sizes)]
    inverse = np.diag([1.0 / (capacity // s) for s in sizes])
    amount = inverse @ np.array(demand, dtype=float)
    for _ in range(rounds):
        price = np.ones(k) @ inverse
        column, value = _best_configuration(sizes, price, capacity)
        if value <= 1 + 1e-9:
            break
        way = inverse @ column
        ratio = np.where(way > 1e-9, amount / np.where(way > 1e-9, way, 1), np.inf)
        out = int(np.argmin(ratio))
        if not np.isfinite(ratio[out]):
            break
        step = ratio[out]
        amount = amount - step * way
        amount[out] = step
        pivot = inverse[out] / way[out]
        inverse = inverse - np.outer(way, pivot)
        inverse[out] = pivot
        columns[out] = tuple(int(c) for c in column)
    return [(c, int(np.floor(a + 1e-7))) for c, a in zip(columns, amount) if a >= 1 - 1e-7]


def _best_configuration(sizes: list[int], price: np.ndarray, capacity: int):
    """The most valuable configuration under ``price``: unbounded knapsack over the few sizes."""
    best = np.zeros(capacity + 1)
    choice = np.full(capacity + 1, -1, dtype=np.int32)
    for j, size in enumerate(sizes):
        if price[j] <= 1e-12:
            continue
        for _ in range(capacity // size):
            with_one = best[:-size] + price[j]
            better = with_one > best[size:] + 1e-12
            if not better.any():
                break
            best[size:][better] = with_one[better]
            choice[size:][better] = j
    column = np.zeros(len(sizes))
    room = int(np.argmax(best))
    value = best[room]
    while room > 0 and choice[room] >= 0:
        column[choice[room]] += 1
        room -= sizes[choice[room]]
    return column, float(column @ price) if value else 0.0


class _Plan:
    """Rows (length, first rank, end rank, first sequence, pieces per sequence, offset)."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.rows: list[tuple] = []
        self.used = [0] * (capacity + 1)  # ranks given out per length
        self.sequences = 0
        self.runs: dict[int, list] = {}  # room left -> [(first sequence, count)]
        self.rooms: list[int] = []  # sorted keys of runs

    def place(self, length: int, count: int, first: int, per: int, offset: int) -> None:
        lo = self.used[length]
        self.rows.append((length, lo, lo + count, first, per, offset))
        self.used[length] = lo + count

    def add_run(self, room: int, first: int, count: int) -> None:
        if count and room:
            if room not in self.runs:
                self.runs[room] = []
                insort(self.rooms, room)
            self.runs[room].append((first, count))

    def open(self, count: int) -> int:
        first, self.sequences = self.sequences, self.sequences + count
        return first

    def best_fit(self, length: int, count: int) -> None:
        """Put ``count`` pieces of one length where least room is left over."""
        while count:
            at = bisect_left(self.rooms, length)
            if at == len(self.rooms):
                per = self.capacity // length
                new = -(-count // per)
                room, first, bins = self.capacity, self.open(new), new
            else:
                room = self.rooms[at]
                first, bins = self.runs[room].pop()
                if not self.runs[room]:
                    del self.runs[room], self.rooms[at]
            per = room // length
            full = min(bins, count // per)
            if full:
                self.place(length, full * per, first, per, self.capacity - room)
                self.add_run(room - per * length, first, full)
                count -= full * per
            if full < bins:
                rest = min(count, per) if count else 0
                if rest:
                    self.place(length, rest, first + full, rest, self.capacity - room)
                    self.add_run(room - rest * length, first + full, 1)
                    count -= rest
                    self.add_run(room, first + full + 1, bins - full - 1)
                else:
                    self.add_run(room, first + full, bins - full)


def plan(counts: np.ndarray, capacity: int = CAPACITY, large: tuple = LARGE, groups: int = GROUPS) -> _Plan:
    """Packing plan from the histogram counts[length]: the cut with the fewest sequences."""
    plans = [_plan(counts, capacity, cut, groups) for cut in large]
    return min(plans, key=lambda p: p.sequences)


def _plan(counts: np.ndarray, capacity: int, large: int, groups: int) -> _Plan:
    out = _Plan(capacity)
    counts = np.asarray(counts, dtype=np.int64).copy()
    if counts[capacity]:  # whole pieces are sequences of their own
        out.place(capacity, int(counts[capacity]), out.open(int(counts[capacity])), 1, 0)
        counts[capacity] = 0
    grouped = linear_groups(counts, large, groups)
    merged: dict[int, list] = {}
    for size, _, members in grouped:
        merged.setdefault(size, []).extend(members)
    sizes = list(merged)
    queue = [merged[s][::-1] for s in sizes]  # longest last
    demand = [sum(c for _, c in merged[s]) for s in sizes]
    for column, times in configurations(sizes, demand, capacity):
        slots = [j for j, n in enumerate(column) for _ in range(n)]
        taken = [_take(queue[j], times) for j in slots]
        _substitute(out, taken, times)
    for members in queue:
        for length, count in members[::-1]:
            out.best_fit(length, count)
    for length in range(large - 1, 0, -1):
        if counts[length]:
            out.best_fit(length, int(counts[length]))
    return out


def _take(members: list, count: int) -> list:
    """The ``count`` longest members, as (length, count); fewer if they run out."""
    got = []
    while count and members:
        length, have = members.pop()
        use = min(have, count)
        got.append((length, use))
        if have > use:
            members.append((length, have - use))
        count -= use
    return got


def _substitute(out: _Plan, taken: list[list], times: int) -> None:
    """Fill ``times`` sequences: place j of sequence i gets the i-th piece of taken[j]."""
    first = out.open(times)
    cuts = sorted({0, times, *(int(x) for t in taken for x in np.cumsum([c for _, c in t]))})
    cursor = [list(t[::-1]) for t in taken]
    for lo, hi in zip(cuts, cuts[1:]):
        offset = 0
        for stack in cursor:
            if not stack:
                continue
            length, have = stack.pop()
            if have > hi - lo:
                stack.append((length, have - (hi - lo)))
            out.place(length, hi - lo, first + lo, 1, offset)
            offset += length
        out.add_run(out.capacity - offset, first + lo, hi - lo)


def pack(docs: DataFrame, text: str = "text", path: str | None = None, capacity: int = CAPACITY,
         out: str | None = None) -> DataFrame:
    """Pieces with their token ids, sequence_id and offset, written under ``out``
    (a new folder if None): all pieces of a sequence in one file, in their order."""
    spark = docs.sparkSession
    with own_tables() as mine:
        cut = stored(pieces(docs, text, path, capacity).withColumn("_uid", F.monotonically_increasing_id()), "pieces",
                     compression="zstd")
        counts = np.zeros(capacity + 1, dtype=np.int64)
        for row in cut.groupBy("length").count().collect():  # at most ``capacity`` rows
            counts[row["length"]] = row["count"]
        rows = plan(counts, capacity).rows
        placed = spark.createDataFrame(
            rows, "length bigint, _lo bigint, _hi bigint, _first bigint, _per bigint, _offset bigint")
        # the plan's size is bounded by the capacity and the number of groups; ranks need lengths only
        ranks = ranked(cut.select("_uid", "length"), ["length"], "_uid", [F.col("_uid")], "_rank")
        inside = (F.col("_rank") >= F.col("_lo")) & (F.col("_rank") < F.col("_hi"))
        step = F.col("_rank") - F.col("_lo")
        places = (ranks.join(F.broadcast(placed), "length").where(inside)
                  .select("_uid", (F.col("_first") + F.expr("(_rank - _lo) div _per")).alias("sequence_id"),
                          (F.col("_offset") + (step % F.col("_per")) * F.col("length")).alias("offset")))
        places = stored(places, "places")
        # pieces grow with the documents: the same join at every size, never a broadcast
        whole = stored(cut.drop("sequence_id", "offset").hint("merge").join(places, "_uid").drop("_uid"), "placed", compression="zstd")
        if whole.count() != int(counts.sum()):
            raise RuntimeError("the plan did not place every piece once")
        mine.drop(0)  # the pieces without places
        collect_garbage(spark)  # once more, now that the last job no longer holds the join's shuffle
        out = out or work_path(spark, "sequences")
        (_widened(whole.repartition("sequence_id").sortWithinPartitions("sequence_id", "offset"))
         .write.option("compression", "zstd").parquet(out))
        return spark.read.schema(whole.schema).parquet(out)


def report(docs: DataFrame, out: str | None = None) -> DataFrame:
    """The query's columns, taken from the written sequences."""
    return pack(clean(docs, "doc_id", "text"), out=out).select(
        "doc_id", "piece", "start", "length", F.crc32("ids").cast("long").alias("ids_crc32"), "sequence_id", "offset")
