"""N-gram Jaccard join by T-occurrence search, and its components.

A text's set is its distinct word shingles; two sets link when their Jaccard
similarity reaches ``percent``.  Linked sets of sizes a and b share at least
T = ceil(percent (a + b) / (100 + percent)) shingles.

1. Equal sets are folded into one class (smallest document id represents it).
2. Shingles get one global order: frequent ones last, else by hash.  Linked
   sets share a shingle of their prefixes (the first a - ceil(percent a / 100)
   + 1 in that order), whatever the order; a good one keeps lists short.  Very
   frequent shingles show in a count sketch of fixed size; of the others the
   prefixes are counted, and the most frequent (at most ``FREQUENT``) moved
   back.  Inverted lists of prefix shingles with one member are dropped.
3. Each list's member with fewest rare shingles is its pivot.  Every member is
   checked against the pivots of its lists, if the shingles that the prefixes
   share leave room for T.  The links found give provisional components.
4. Lists whose members are not yet one component are searched again, for
   every pair of members of different components that sizes and positions in
   the order allow.  So no pair that could join two components is left out;
   pairs within a component need no search, as the class id does not change.
5. A check is a T-occurrence search: of one query set against an inverted
   index of a block of sets, the short lists are merged and counted, the
   longest are probed by binary search only for sets whose count leaves T in
   reach (DivideSkip).  It is exact.

Null texts and texts without words have an empty set and link with nothing;
texts of fewer words than a shingle have their whole sequence as one shingle;
repeated rows fall into one class; an empty table gives no rows.  Rows are told
apart by a number of their own: ids may be null or shared; a component of rows
without ids has a null id.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import add_columns, clean, looked_up, map_arrow, numbered, scoped, ship, stored
from .components import components
from .textkit import Words, list_array, mix, sequence_hash, slices

SIZE = 4
PERCENT = 85
SKETCH_BITS = 18  # counters of the frequency sketch: 2**18, whatever the input
FREQUENT = 1 << 20  # shingles that are moved back by their counts, whatever the input
LEAST_FREQUENT = 8  # lists up to here are short
BLOCK = 64  # sets per index block
_U = np.uint64


def shingles(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Hash and row of every shingle (with repeats) of one slice, and its rows."""
    words = Words(texts, lower=True)
    hashes = words.hashes()
    at = words.windows(hashes, size)
    short = np.flatnonzero((words.count > 0) & (words.count < size))
    start = np.concatenate([at, words.first[short]])
    end = np.concatenate([at + size, words.first[short + 1]])
    row = np.concatenate([words.doc[at], short])
    return sequence_hash(hashes, start, end), row, words.docs


def _sketch(docs: DataFrame, text: str, size: int, bits: int) -> np.ndarray:
    """Level of each sketch counter: 0 below twice the mean count, else the logarithm of its count."""
    def count(batches):
        total = np.zeros(1 << bits, dtype=np.int64)
        for batch in batches:
            for part in slices(batch, text):
                value, _, _ = shingles(part.column(text), size)
                total += np.bincount((value & _U((1 << bits) - 1)).astype(np.int64), minlength=1 << bits)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(total[used])], ["cell", "n"])

    cells = map_arrow(docs.select(text), count, "cell int, n bigint").groupBy("cell").agg(F.sum("n").alias("n"))
    got = cells.toPandas()  # at most 2**bits rows
    counts = np.zeros(1 << bits, dtype=np.float64)
    counts[got["cell"].to_numpy(dtype=np.int64)] = got["n"].to_numpy(dtype=np.float64)
    mean = max(counts.mean(), 1.0)
    return np.where(counts >= 2 * mean, np.floor(np.log2(np.maximum(counts, 1.0))), 0).astype(np.uint8)


class Order:
    """Level of every shingle: about the logarithm of how often it occurs, 0 if it is rare.

    ``cells`` are the levels by sketch counter, ``frequent`` the sorted keys of
    shingles that counting showed to be frequent, with their levels.
    """

    def __init__(self, cells: np.ndarray, frequent: np.ndarray, levels: np.ndarray):
        self.cells, self.frequent, self.levels = cells, frequent, levels
        self.bits = np.zeros(1 << 24, dtype=bool)
        self.bits[(frequent & _U((1 << 24) - 1)).astype(np.int64)] = True

    def keys(self, value: np.ndarray) -> np.ndarray:
        """Sort keys of shingle hashes: level, then hash."""
        level = self.cells[(value & _U(len(self.cells) - 1)).astype(np.int64)].astype(_U)
        short = value >> _U(7)
        if len(self.frequent):
            maybe = np.flatnonzero(self.bits[(short & _U((1 << 24) - 1)).astype(np.int64)])
            at = np.minimum(np.searchsorted(self.frequent, short[maybe]), len(self.frequent) - 1)
            hit = self.frequent[at] == short[maybe]
            level[maybe[hit]] = np.maximum(level[maybe[hit]], self.levels[at[hit]])
        return (level << _U(57)) | short


PLAIN = Order(np.zeros(2, dtype=np.uint8), np.zeros(0, dtype=_U), np.zeros(0, dtype=_U))


def ordered_sets(texts: pa.Array, size: int, order: Order) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each row in the global order: flat keys, sizes."""
    value, row, docs = shingles(texts, size)
    key = order.keys(value)
    by = np.lexsort((key, row))
    key, row = key[by], row[by]
    fresh = np.ones(len(key), dtype=bool)
    fresh[1:] = (key[1:] != key[:-1]) | (row[1:] != row[:-1])
    key, row = key[fresh], row[fresh]
    return key, np.bincount(row, minlength=docs)


def prefixes(key: np.ndarray, n: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Which keys are in the prefix of their row, and the prefix length of each row."""
    first = np.cumsum(n) - n
    take = np.where(n > 0, n - _least(n, percent) + 1, 0)
    return np.arange(len(key)) - np.repeat(first, n) < np.repeat(take, n), take


def _frequent(docs: DataFrame, text: str, size: int, percent: int, cells: np.ndarray) -> Order:
    """The order by sketch, refined by counting the prefixes that it gives."""
    first = docs.sparkSession.sparkContext.broadcast(Order(cells, np.zeros(0, dtype=_U), np.zeros(0, dtype=_U)))

    def count(batches):
        for batch in batches:
            for part in slices(batch, text):
                key, n = ordered_sets(part.column(text), size, first.value)
                token, times = np.unique(key[prefixes(key, n, percent)[0]], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(token.view(np.int64)), pa.array(times)], ["token", "n"])

    rows = map_arrow(docs.select(text), count, "token bigint, n bigint")
    often = stored(rows.groupBy("token").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_FREQUENT)
                   .select("token", F.floor(F.log2("n")).cast("int").alias("level")), "frequent")
    sizes = {r["level"]: r["count"] for r in often.groupBy("level").count().collect()}  # at most 63 rows
    least, total = 64, 0
    for level in sorted(sizes, reverse=True):
        total += sizes[level]
        if total > FREQUENT:
            break
        least = level
    got = often.where(F.col("level") >= least).toPandas().sort_values("token")  # at most FREQUENT rows
    short = got["token"].to_numpy(dtype=np.int64).view(_U) & _U((1 << 57) - 1)
    levels = got["level"].to_numpy().astype(_U)
    by = np.argsort(short, kind="stable")
    return Order(cells, short[by], levels[by])


def _least(n, percent):
    """ceil(percent n / 100): shingles that a linked set shares at least."""
    return -(-(n * percent) // 100)


def needed(a, b, percent):
    """Shared shingles at which sets of sizes a and b link."""
    return -(-(percent * (a + b)) // (100 + percent))


SET_FIELDS = "n_shingles bigint, d1 bigint, d2 bigint, prefix array<bigint>"


def _sets(docs: DataFrame, text: str, size: int, percent: int, order) -> DataFrame:
    def run(texts):
        key, n = ordered_sets(texts, size, order.value)
        first = np.concatenate([[0], np.cumsum(n)])
        sums = []
        for salt in (0x51, 0xA7):
            total = np.concatenate([np.zeros(1, dtype=_U), np.cumsum(mix(key ^ _U(salt << 48)), dtype=_U)])
            sums.append((total[first[1:]] - total[first[:-1]]).view(np.int64))
        head, take = prefixes(key, n, percent)
        return [pa.array(n, pa.int64()), pa.array(sums[0]), pa.array(sums[1]),
                list_array(key[head].view(np.int64), take, pa.int64())]

    return add_columns(docs, text, SET_FIELDS, run).drop(text)


def t_occurrence(query: np.ndarray, keys: np.ndarray, owner: np.ndarray, sizes: np.ndarray, percent: int) -> np.ndarray:
    """Which of the indexed sets link with the query set.

    ``keys``/``owner`` is the index of a block (distinct keys per owner).
    DivideSkip: the longest lists are probed, the others merged and counted.
    """
    by = np.argsort(keys, kind="stable")
    keys, owner = keys[by], owner[by]
    query = np.unique(query)
    lo, hi = np.searchsorted(keys, query, "left"), np.searchsorted(keys, query, "right")
    length = hi - lo
    want = needed(len(query), sizes, percent)
    least = int(want.min()) if len(want) else 0
    # number of long lists: T / (mu log2 M + 1), as many as may be skipped at least T
    skip = min(max(least - 1, 0), int(least / (0.01 * np.log2(max(int(length.max(initial=1)), 2)) + 1) * 0.5))
    rank = np.argsort(length, kind="stable")
    short, long = rank[:len(rank) - skip], rank[len(rank) - skip:]
    count = length[short]
    at = np.repeat(lo[short] - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
    found = np.bincount(owner[at], minlength=len(sizes)) if len(at) else np.zeros(len(sizes), dtype=np.int64)
    alive = np.flatnonzero(found + len(long) >= want)
    for token in long.tolist():
        part = owner[lo[token]:hi[token]]  # ascending: the sort is stable and owners came in order
        if not len(part):
            continue
        spot = np.searchsorted(part, alive)
        found[alive] += part[np.minimum(spot, len(part) - 1)] == alive
    return found >= want


def _verify(pairs: DataFrame, docs: DataFrame, text: str, size: int, percent: int) -> DataFrame:
    """Links (u, v) among candidate ``pairs`` (q, x) of document ids.

    A block is a query document and up to about ``BLOCK`` of its candidates;
    one join takes every text to the blocks that need it.
    """
    ship(docs.sparkSession)
    pairs = stored(pairs, "pairs")
    counts = stored(pairs.groupBy("q").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks")), "blocks")
    dealt = (pairs.join(counts, "q")
             .select("q", F.pmod(F.xxhash64(F.lit(5), "x"), F.col("blocks")).cast("int").alias("block"), "x"))
    asked = counts.select("q", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.col("q").alias("x"))
    uses = stored(dealt.unionByName(asked), "uses")
    # the pairs grow with the documents: the same join at every size, never a broadcast
    rows = uses.hint("merge").join(docs.select(F.col("_id").alias("x"), F.col(text).alias("body")), "x")
    def search(block: pa.Table) -> pa.Table:
        q = block.column("q")[0].as_py()
        is_query = np.asarray(block.column("x")) == q
        body = block.column("body").combine_chunks()
        keys, sizes = ordered_sets(body, size, PLAIN)  # any one order serves inside a block
        owner = np.repeat(np.arange(len(sizes)), sizes)
        query = np.flatnonzero(is_query)[:1]
        links = np.zeros(len(sizes), dtype=bool)
        if len(query):
            links = t_occurrence(keys[owner == query[0]], keys, owner, sizes, percent) & ~is_query
        x = block.column("x").combine_chunks().filter(pa.array(links))
        return pa.table({"u": pa.array(np.full(len(x), q), pa.int64()), "v": x})

    return rows.groupBy("q", "block").applyInArrow(search, "u bigint, v bigint")


def _postings(sets: DataFrame, classes: DataFrame) -> DataFrame:
    """Stored postings (token, rep, n, i, pivot, members) of the lists with two members or more.

    Shingles that occur once are found by their counts alone, before anything
    else is exchanged; copies still count there, which keeps a list too many.
    """
    often = (sets.select(F.explode("prefix").alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("c"))
             .where("c > 1").select("token"))
    often = stored(often, "tokens")
    own = sets.join(classes.select(F.col("rep").alias("_id")), "_id", "left_semi")
    rows = own.select(F.col("_id").alias("rep"), F.col("n_shingles").alias("n"), F.posexplode("prefix").alias("i", "token"))
    rows = stored(rows.join(often, "token", "left_semi"), "shared")
    # the pivot stands earliest in the list's own order: fewest rarer shingles before it
    key = F.shiftleft(F.col("i").cast("long"), 40).bitwiseOR(F.xxhash64("rep").bitwiseAND(F.lit((1 << 40) - 1)))
    lists = (rows.withColumn("_k", key).groupBy("token")
             .agg(F.count(F.lit(1)).alias("members"), F.min_by("rep", "_k").alias("pivot"),
                  F.min_by("n", "_k").alias("pivot_n"), F.shiftright(F.min("_k"), 40).alias("pivot_i"))
             .where("members > 1"))
    return stored(rows.join(stored(lists, "lists"), "token"), "postings")


def _first_pairs(postings: DataFrame, percent: int) -> DataFrame:
    """(pivot, member) pairs whose sizes and positions leave room for T.

    Holds at the first shingle that a linked pair has in common: nothing
    before its positions is shared.
    """
    need = F.expr(f"({percent} * (n + pivot_n) + {99 + percent}) div {100 + percent}")
    room = F.least(F.col("n") - F.col("i"), F.col("pivot_n") - F.col("pivot_i"))
    near = 100 * F.least("n", "pivot_n") >= percent * F.greatest("n", "pivot_n")
    return (postings.where((F.col("pivot") != F.col("rep")) & near & (room >= need))
            .select(F.col("pivot").alias("q"), F.col("rep").alias("x")).distinct())


def _more_pairs(postings: DataFrame, joined: DataFrame, percent: int) -> DataFrame:
    """Pairs of members of different provisional components, one side not the pivot's."""
    label = stored(joined.select(F.col("node").alias("rep"), F.col("component").alias("c")), "labels")
    rows = (postings.where("members > 2").join(label, "rep", "left")
            .withColumn("c", F.coalesce("c", "rep")))
    rows = (rows.join(label.select(F.col("rep").alias("pivot"), F.col("c").alias("pc")), "pivot", "left")
            .withColumn("pc", F.coalesce("pc", "pivot")))
    # a list of one component is settled; the others keep the members of all components
    mixed = stored(rows.where("c <> pc").groupBy("token").agg(F.count(F.lit(1)).alias("apart")), "mixed")
    rows = stored(rows.join(mixed, "token").drop("apart", "members"), "mixed-postings")
    # sizes a partner may have, by size and by position (nothing rarer is shared)
    lo = F.expr(f"({percent} * n + 99) div 100")
    hi = F.least(F.expr(f"(100 * n) div {percent}"), F.expr(f"(({100 + percent}) * (n - i)) div {percent} - n"))
    step = F.lit(0.02)  # size classes of two per cent: the join's second key
    classes_of = F.sequence(F.floor(F.ln(F.greatest(lo, F.lit(1))) / step), F.floor(F.ln(F.greatest(hi, F.lit(1))) / step))
    out = (rows.where((F.col("c") != F.col("pc")) & (F.col("rep") != F.col("pivot")) & (hi >= lo))
           .select("token", F.explode(classes_of).alias("size_class"), F.col("rep").alias("x"), F.col("n").alias("xn"),
                   F.col("c").alias("xc"), lo.alias("lo"), hi.alias("hi")))
    other = (rows.where(F.col("rep") != F.col("pivot"))
             .select("token", F.floor(F.ln(F.col("n")) / step).alias("size_class"), F.col("n").alias("m"),
                     F.col("rep").alias("y"), F.col("i").alias("j"), F.col("c").alias("yc"), F.col("pc")))
    need = F.expr(f"({percent} * (m + xn) + {99 + percent}) div {100 + percent}")
    twice = (F.col("yc") != F.col("pc")) & (F.col("x") > F.col("y"))  # both apart: found once
    return (out.join(other, ["token", "size_class"])
            .where(F.col("m").between(F.col("lo"), F.col("hi")) & (F.col("xc") != F.col("yc")) & ~twice & (F.col("m") - F.col("j") >= need))
            .select(F.col("x").alias("q"), F.col("y").alias("x")).distinct())


@scoped
def row_classes(docs: DataFrame, text: str = "text", number: str = "_id", size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """number, n_shingles, class (number of a row of the component; null without shingles) of stored
    rows with a number each."""
    spark = docs.sparkSession
    docs = clean(docs, number, text).withColumnRenamed(number, "_id")
    order = _frequent(docs, text, size, percent, _sketch(docs, text, size, SKETCH_BITS))
    sets = stored(_sets(docs, text, size, percent, spark.sparkContext.broadcast(order)), "sets")
    keys = ["n_shingles", "d1", "d2"]
    filled = sets.where("n_shingles > 0")
    folded = stored(filled.groupBy(*keys).agg(F.min("_id").alias("rep"), F.count(F.lit(1)).alias("_n")), "classes")
    postings = _postings(filled, folded)
    links = stored(_verify(_first_pairs(postings, percent), docs, text, size, percent), "first-links")
    more = stored(_more_pairs(postings, components(links), percent), "more-pairs")
    if not more.isEmpty():
        links = links.unionByName(_verify(more, docs, text, size, percent))
    joined = stored(components(links).select(F.col("node").alias("rep"), "component"), "components")
    named = stored(folded.join(joined, "rep", "left").select(*keys, "_n", F.coalesce("component", "rep").alias("class")), "named")
    rows = sets.select("_id", *keys)
    none = rows.where("n_shingles = 0").withColumn("class", F.lit(None).cast("long"))
    return (looked_up(rows.where("n_shingles > 0"), named, keys).unionByName(none)
            .select(F.col("_id").alias(number), "n_shingles", "class"))


@scoped
def classes(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", size: int = SIZE,
            percent: int = PERCENT) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (the smallest id of the component's rows)."""
    rows = numbered(docs, "_id", _doc=doc_id, text=text)
    found = row_classes(rows, "text", "_id", size, percent)
    found = stored(found.join(rows.select("_id", "_doc"), "_id"), "labelled")
    least = found.where(F.col("class").isNotNull()).groupBy("class").agg(F.min("_doc").alias("least"), F.count(F.lit(1)).alias("_n"))
    return looked_up(found, stored(least, "least-ids"), ["class"]).select(
        F.col("_doc").alias(doc_id), "n_shingles", F.when(F.col("class").isNotNull(), F.col("least")).otherwise(F.col("_doc")).alias("component_id"))


def report(docs: DataFrame) -> DataFrame:
    return classes(docs)


ORACLE_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + 3), ' ') AS g
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM o JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
r(doc_id, other) AS (SELECT doc_id, doc_id FROM d UNION SELECT r.doc_id, l.b FROM r JOIN l ON l.a = r.other)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, m.c AS component_id
FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT doc_id, min(other) AS c FROM r GROUP BY doc_id) m USING (doc_id)
"""
