"""Substring dedup on a compacted de Bruijn graph of word k-mers.

The edges of the graph are the windows of ``WINDOW`` words, its nodes their
overlaps.  A window is removed where its word sequence starts at another place
of any text too.  Writing one row per edge would be one row per word, so paths
are compacted before anything is exchanged:

1. The ``K``-word k-mer with the least hash inside a window is its anchor.
   Equal windows have equal anchors at equal places, and consecutive windows
   mostly share theirs: such a run is a path of edges (a zone), one row.
2. Anchors that occur once cannot lie in a repeated window: their paths go.
3. A path is hashed as a whole.  If all places of an anchor have the same
   path, or several have, the path does not branch there and stays one edge:
   a repeated one marks all its windows.  Only where the paths of an anchor
   differ (branches, at the ends of repeats) are they opened again, once per
   distinct path, and their single windows counted.
4. The marks are joined back to their source coordinates (document, first
   word), united to spans, and the texts are cut there.

Equality is decided by 128 bits (anchor and path or window hash are
independent).  Equal word sequences are folded to one first: all windows of a
text that has copies repeat.  Null or empty texts have no words; texts of
fewer words than a window are left alone; repeated rows are copies; an empty
table gives no rows.  Rows are told apart by a number of their own: ids may be
null or shared, and every row is judged by its words alone.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import add_columns, looked_up, map_arrow, numbered, scoped, stored
from .textkit import Words, cover, list_array, row_ranges, sequence_hash, slices

WINDOW = 35
K = 8
PLACE_BITS = 28  # word places inside one slice
PART_BYTES = 1 << 18  # texts of one slice: a worker holds some 100 times that in arrays

_U = np.uint64


def zones(words: Words, window: int = WINDOW, k: int = K):
    """Paths of one slice: anchor hash, first and last window start, row; and word hashes."""
    first_hash, second_hash = words.hashes(0), words.hashes(1)
    n = len(first_hash)
    starts = words.windows(first_hash, window)
    if not len(starts):
        empty = np.zeros(0, dtype=np.int64)
        return empty.astype(_U), empty, empty, empty, second_hash
    at = np.arange(n - k + 1)
    kmer = sequence_hash(first_hash, at, at + k)
    least = ((kmer >> _U(PLACE_BITS)) << _U(PLACE_BITS)) | at.astype(_U)  # ties: leftmost
    width, span = 1, window - k + 1
    while width * 2 <= span:  # minimum over ``span`` k-mers by doubling
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    least = np.minimum(least[starts], least[starts + span - width])
    place = (least & _U((1 << PLACE_BITS) - 1)).astype(np.int64)
    fresh = np.ones(len(starts), dtype=bool)
    fresh[1:] = (place[1:] != place[:-1]) | (words.doc[starts[1:]] != words.doc[starts[:-1]])
    head = np.flatnonzero(fresh)
    tail = np.append(head[1:], len(starts)) - 1
    return kmer[place[head]], starts[head], starts[tail], words.doc[starts[head]], second_hash


SCAN_FIELDS = "n_words bigint, d1 bigint, d2 bigint, whole_sha256 string, anchors array<bigint>"


def _scan(texts: pa.Array) -> list[pa.Array]:
    words = Words(texts)
    anchor, _, _, row, _ = zones(words)
    digests = [sequence_hash(words.hashes(f), words.first[:-1], words.first[1:], f).view(np.int64) for f in (0, 1)]
    return [pa.array(words.count, pa.int64()), pa.array(digests[0]), pa.array(digests[1]), pa.array(words.sha256()),
            list_array(anchor.view(np.int64), np.bincount(row, minlength=words.docs), pa.int64())]


def _paths(docs: DataFrame) -> DataFrame:
    """Rows (rep, weight, h, z, lo, ladder) of the paths whose anchor is in the row's ``wanted``;
    ladder holds the hashes of the path's windows."""
    def run(batches):
        for batch in batches:
            for part in slices(batch, "text", PART_BYTES):
                words = Words(part.column("text"))
                anchor, lo, hi, row, second = zones(words)
                wanted = part.column("wanted")
                offsets = np.asarray(wanted.offsets)
                flat = np.asarray(wanted.values)[offsets[0]:offsets[-1]]
                owner = np.repeat(np.arange(len(wanted)), np.diff(offsets))
                value = anchor.view(np.int64)
                # membership of (row, anchor) by one sorted search over both parts of the key
                both = np.concatenate([flat, value])
                _, code = np.unique(both, return_inverse=True)
                known = np.unique(owner * (len(both) + 1) + code[:len(flat)])
                keep = np.isin(row * (len(both) + 1) + code[len(flat):], known)
                value, lo, hi, row = value[keep], lo[keep], hi[keep], row[keep]
                path = sequence_hash(second, lo, hi + WINDOW, 1).view(np.int64)
                size = hi - lo + 1
                start = np.repeat(lo, size) + row_ranges(size)
                ladder = sequence_hash(second, start, start + WINDOW, 1).view(np.int64)
                take = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [part.column("rep").take(take), part.column("weight").take(take), pa.array(value), pa.array(path),
                     pa.array(lo - words.first[row], pa.int64()), list_array(ladder, size, pa.int64())],
                    ["rep", "weight", "h", "z", "lo", "ladder"])

    return map_arrow(docs, run, "rep bigint, weight int, h bigint, z bigint, lo bigint, ladder array<bigint>")


def _spans(marked: DataFrame) -> DataFrame:
    """Documents with text, ``los`` and ``masks`` -> n_removed, kept_sha256, spans (word ranges, flattened)."""
    def run(batches):
        for batch in batches:
            for part in slices(batch, "text", PART_BYTES):
                words = Words(part.column("text"))
                lo, mask = (part.column(c).flatten().to_numpy(zero_copy_only=False) for c in ("los", "masks"))
                row = np.repeat(np.arange(words.docs), part.column("los").value_lengths().to_numpy(zero_copy_only=False))
                lo = lo + words.first[row]
                start = [lo[(mask >> b) & 1 == 1] + b for b in range(WINDOW - K + 1)]
                start = np.concatenate(start) if start else lo
                gone = cover(len(words.start), start, start + WINDOW)
                total = np.concatenate([[0], np.cumsum(gone)])
                edge = np.ones(len(gone) + 1, dtype=bool)
                edge[1:-1] = (gone[1:] != gone[:-1]) | (words.doc[1:] != words.doc[:-1])
                cuts = np.flatnonzero(edge)
                runs = np.stack([cuts[:-1], cuts[1:]], axis=1)[gone[cuts[:-1]]]
                of = words.doc[runs[:, 0]]
                yield pa.RecordBatch.from_arrays(
                    [part.column("rep"), pa.array(total[words.first[1:]] - total[words.first[:-1]], pa.int64()),
                     pa.array(words.sha256(~gone)),
                     list_array((runs - words.first[of][:, None]).ravel(), np.bincount(of, minlength=words.docs) * 2, pa.int64())],
                    ["rep", "n_removed", "kept_sha256", "spans"])

    return map_arrow(marked, run, "rep bigint, n_removed bigint, kept_sha256 string, spans array<bigint>")


def _marks(docs: DataFrame, groups: DataFrame) -> DataFrame:
    """(rep, los, masks): repeated windows of the texts without copies; bit b of a
    mask is the window that starts b words after lo."""
    places = groups.select("rep", F.explode("anchors").alias("h"))
    often = stored(places.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h"), "anchors")
    wanted = (places.join(often, "h", "left_semi").groupBy("rep").agg(F.collect_set("h").alias("wanted")))
    wanted = stored(wanted.join(groups.select("rep", F.least("copies", F.lit(2)).cast("int").alias("weight")), "rep"), "wanted")
    paths = stored(_paths(docs.withColumnRenamed("_id", "rep").join(wanted, "rep"))
                   .withColumn("uid", F.monotonically_increasing_id()), "paths")
    kinds = stored(paths.groupBy("h", "z").agg(F.sum("weight").alias("c"), F.min("uid").alias("uid")), "kinds")
    branching = stored(kinds.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h"), "branching")
    opened = kinds.join(branching, "h", "left_semi").select("uid", "c")
    single = F.col("c") == 1
    edges = stored(paths.join(opened, "uid").select("uid", "rep", "weight", "lo", "h", "c", F.posexplode("ladder").alias("b", "w")), "edges")
    again = stored(edges.groupBy("h", "w").agg(F.sum("c").alias("n")).where("n > 1").select("h", "w"), "repeated-edges")
    whole = (paths.where("weight = 1").join(kinds.where("c > 1").select("h", "z"), ["h", "z"])
             .select("rep", "lo", F.expr("(1L << size(ladder)) - 1").alias("mask")))
    partly = (edges.where(single & (F.col("weight") == 1)).join(again, ["h", "w"], "left_semi")
              .groupBy("uid", "rep", "lo").agg(F.sum(F.expr("1L << b")).alias("mask")).select("rep", "lo", "mask"))
    every = stored(whole.unionByName(partly), "marks")
    return every.groupBy("rep").agg(F.collect_list(F.struct("lo", "mask")).alias("m")).select(
        "rep", F.col("m.lo").alias("los"), F.col("m.mask").alias("masks"))


@scoped
def find_repeats(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per document: id, n_words, n_removed, kept_sha256 and spans (removed word ranges, flattened)."""
    docs = numbered(docs, "_id", _doc=doc_id, text=text)
    scanned = stored(add_columns(docs, "text", SCAN_FIELDS, _scan, PART_BYTES).drop("text"), "scan")
    keys = ["n_words", "d1", "d2"]
    long = F.col("n_words") >= WINDOW
    groups = stored(scanned.where(long).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("copies"), F.min("_id").alias("rep"), F.first("anchors").alias("anchors")), "groups")
    marks = _marks(docs.drop("_doc"), groups)
    cut = stored(_spans(docs.drop("_doc").withColumnRenamed("_id", "rep").join(stored(marks, "marked"), "rep")), "cut")
    # only texts without copies have marks, so a cut row belongs to one document
    rows = scanned.drop("anchors")
    copies = groups.select(*keys, "copies", F.col("copies").alias("_n"))
    known = looked_up(rows.where(long), copies, keys).unionByName(rows.where(~long).withColumn("copies", F.lit(None).cast("long")))
    known = known.join(cut.withColumnRenamed("rep", "_id"), "_id", "left")
    copied = F.coalesce(F.col("copies"), F.lit(1)) > 1
    return known.select(
        F.col("_doc").alias(doc_id), "n_words",
        F.when(copied, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(copied, F.sha2(F.lit("").cast("binary"), 256)).otherwise(F.coalesce("kept_sha256", "whole_sha256")).alias("kept_sha256"),
        F.when(copied, F.array(F.lit(0).cast("long"), F.col("n_words")))
        .otherwise(F.coalesce("spans", F.array().cast("array<bigint>"))).alias("spans"))


def report(docs: DataFrame) -> DataFrame:
    return find_repeats(docs).drop("spans")


ORACLE_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
pos AS (SELECT doc_id, i, md5(array_to_string(list_slice(w, i, i + 34), ' ')) AS win
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM d WHERE len(w) >= 35)),
rep AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY win) AS c FROM pos) WHERE c > 1),
gone AS (SELECT DISTINCT doc_id, j FROM (SELECT doc_id, unnest(range(i, i + 35)) AS j FROM rep)),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS j FROM d),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY j) AS t, count(*) AS n
         FROM words LEFT JOIN gone USING (doc_id, j) WHERE gone.doc_id IS NULL GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""
