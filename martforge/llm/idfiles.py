"""Token ids of documents in files of byte-aligned variable-length codes.

Ids are replaced by their rank of frequency over the whole corpus, so that the
frequent ones take one byte.  A rank takes 1 to 4 bytes; the lengths of four
ranks share one control byte, and the control bytes of a block stand apart
from its data bytes.  Decoding looks the lengths of a control byte up in a
table of 256 rows and the ids in the table of ranks.

Texts are tokenised once and their ids stored; the counts of all ids (at most
one row per id of the vocabulary) meet on the driver.  Documents are coded
where they are, sorted by id over all partitions and written by Spark as files
of a few blocks each, so no file and no block grows with the table.  A file is
a row of blocks, each followed by a line feed:

    magic, partition and number of the block in it, documents, ids, control
    bytes, data bytes, then document ids, flags of null ids, ids per document,
    control bytes (those of a document start at a byte), data bytes, CRC-32

``dictionary`` beside the files holds id and count of every rank.

A null or empty text has the end id alone; null ids come first.  Rows that
share an id stand in the order of their ids' checksums, equal rows in any.
An empty table gives no blocks.  Texts of any length are coded whole.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import work_path
from .common import clean, map_arrow, stored
from .packing import SLICE, token_ids, tokenizer_path
from .textkit import row_ranges, slices

END_ID = 1
BLOCK_IDS = 1 << 21  # a block ends with the document that reaches so many ids
BLOCKS_PER_FILE = 8
FILES, DICTIONARY = "ids", "dictionary"

MAGIC = b"RVB1"
HEADER = struct.Struct("<4sIIIQQQ")  # magic, partition, number, documents, ids, control bytes, data bytes
#: bytes of each of the four ranks of a control byte
LENGTHS = (((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3) + 1).astype(np.uint8)


def encode(ranks: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Control bytes, data bytes and, per document, how many it has of either."""
    more = (ranks >= 1 << 8).astype(np.uint8)  # bytes beyond the first
    for bits in (16, 24):
        if len(ranks) and ranks.max() >= 1 << bits:
            more += ranks >= 1 << bits
    first = np.concatenate([[0], np.cumsum(counts)])
    code = np.insert(more, np.repeat(first[1:], -counts % 4), 0)  # documents fill their last control byte
    control = code[0::4] | code[1::4] << 2 | code[2::4] << 4 | code[3::4] << 6
    at = np.arange(len(ranks) + 1)
    at[1:] += np.cumsum(more, dtype=np.int64)
    data = np.empty(int(at[-1]), dtype=np.uint8)
    data[at[:-1]] = ranks & 255
    for k in range(1, 4):
        has = np.flatnonzero(more >= k)
        data[at[has] + k] = ranks[has] >> 8 * k & 255
    return control, data, -(-counts // 4), at[first[1:]] - at[first[:-1]]


def decode(control: np.ndarray, data: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Ranks of all documents of a block, one after the other."""
    pad = -counts % 4
    end = np.cumsum(counts + pad)
    size = np.delete(LENGTHS[control].ravel(), np.repeat(end - pad, pad) + row_ranges(pad))
    start = np.cumsum(size, dtype=np.int64) - size
    ranks = data[start].astype(np.uint32)
    for k in range(1, 4):
        has = np.flatnonzero(size > k)
        ranks[has] |= data[start[has] + k].astype(np.uint32) << np.uint32(8 * k)
    return ranks


def pack_block(part: int, number: int, doc_ids: np.ndarray, null: np.ndarray, counts: np.ndarray,
               control: bytes, data: bytes) -> bytes:
    head = HEADER.pack(MAGIC, part, number, len(counts), int(counts.sum()), len(control), len(data))
    body = b"".join([head, doc_ids.astype("<i8").tobytes(), null.astype("u1").tobytes(),
                     counts.astype("<u8").tobytes(), control, data])
    return body + struct.pack("<I", zlib.crc32(body))


def blocks(content: memoryview):
    """(partition, number, document ids, null flags, counts, control bytes, data bytes) of a file's blocks."""
    at = 0
    while at < len(content):
        magic, part, number, docs, _, controls, size = HEADER.unpack_from(content, at)
        end = at + HEADER.size + docs * 17 + controls + size
        if magic != MAGIC or zlib.crc32(content[at:end]) != struct.unpack_from("<I", content, end)[0]:
            raise ValueError("a block of token ids is damaged")
        at += HEADER.size
        arrays = []
        for kind, n in (("<i8", docs), ("u1", docs), ("<u8", docs), ("u1", controls), ("u1", size)):
            arrays.append(np.frombuffer(content, dtype=kind, count=n, offset=at))
            at += arrays[-1].nbytes
        at += 5  # checksum and line feed
        yield part, number, arrays[0], arrays[1].astype(bool), arrays[2].astype(np.int64), arrays[3], arrays[4]


def _binary(buffer: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """Binary column whose values follow each other in ``buffer``."""
    ends = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(buffer))])


def tokenised(docs: DataFrame, path: str, end_id: int, width: str) -> DataFrame:
    """doc_id, n_tokens, ids_crc32 and ids (``width`` per id) of every document, stored."""
    def run(batches):
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                ids, offsets = token_ids(part.column("text"), path, end_id)
                counts = np.diff(offsets)
                raw = memoryview(ids.astype("<u4").tobytes())
                check = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
                short = ids.astype(width)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(counts, pa.int64()), pa.array(check, pa.int64()),
                     _binary(short, counts * short.itemsize)], ["doc_id", "n_tokens", "ids_crc32", "ids"])

    rows = map_arrow(docs, run, "doc_id bigint, n_tokens bigint, ids_crc32 bigint, ids binary")
    return stored(rows.withColumn("_row", F.monotonically_increasing_id()), "token-ids", compression="zstd")


def frequencies(tokens: DataFrame, width: str, vocabulary: int) -> DataFrame:
    """id, n of every id that occurs: one partial count per task and id."""
    def run(batches):
        total = np.zeros(vocabulary, dtype=np.int64)
        for batch in batches:
            _, ends, data = batch.column(0).buffers()
            lo, hi = np.frombuffer(ends, dtype=np.int32)[[batch.column(0).offset, batch.column(0).offset + batch.num_rows]]
            ids = np.frombuffer(data, dtype=np.uint8)[lo:hi].view(width) if data is not None else np.zeros(0, dtype=width)
            total += np.bincount(ids, minlength=vocabulary)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), pa.array(total[found])], ["id", "n"])

    return map_arrow(tokens.select("ids"), run, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n"))


def _coded(tokens: DataFrame, rank_of: np.ndarray, width: str) -> DataFrame:
    """The stored documents with control and data bytes in place of ids."""
    def run(batches):
        for batch in batches:
            for part in slices(batch, "ids"):
                counts = part.column("n_tokens").to_numpy()
                _, ends, data = part.column("ids").buffers()
                lo, hi = np.frombuffer(ends, dtype=np.int32)[[part.column("ids").offset, part.column("ids").offset + part.num_rows]]
                control, coded, quads, size = encode(rank_of[np.frombuffer(data, dtype=np.uint8)[lo:hi].view(width)], counts)
                yield pa.RecordBatch.from_arrays(
                    [part.column(c) for c in ("doc_id", "ids_crc32", "_row", "n_tokens")]
                    + [_binary(control, quads), _binary(coded, size)],
                    ["doc_id", "ids_crc32", "_row", "n_tokens", "control", "data"])

    return map_arrow(tokens, run, "doc_id bigint, ids_crc32 bigint, _row bigint, n_tokens bigint, control binary, data binary")


def _blocked(coded: DataFrame) -> DataFrame:
    """One row per block of the sorted partitions."""
    limit = BLOCK_IDS

    def run(batches):
        from pyspark import TaskContext

        part, number, rows, have = TaskContext.get().partitionId(), 0, [], 0

        def packed():
            docs, null, counts = (np.array([r[k] for r in rows]) for k in (0, 1, 2))
            body = pack_block(part, number, docs, null, counts, b"".join(r[3] for r in rows), b"".join(r[4] for r in rows))
            return pa.RecordBatch.from_arrays([pa.array([body], pa.binary())], ["block"])

        for batch in batches:
            ids, counts, control, data = (batch.column(c) for c in ("doc_id", "n_tokens", "control", "data"))
            for k in range(batch.num_rows):
                doc, n = ids[k].as_py(), counts[k].as_py()
                rows.append((doc or 0, doc is None, n, control[k].as_py(), data[k].as_py()))
                have += n
                if have >= limit:
                    yield packed()
                    number, rows, have = number + 1, [], 0
        if rows:
            yield packed()

    return map_arrow(coded, run, "block binary")


def write_ids(docs: DataFrame, out: str, text: str = "text", doc_id: str = "doc_id", path: str | None = None,
              end_id: int = END_ID) -> None:
    """Write the token ids of all documents under ``out``, in ascending order of their ids."""
    from tokenizers import Tokenizer

    spark = docs.sparkSession
    path = path or tokenizer_path()
    vocabulary = max(Tokenizer.from_file(path).get_vocab_size(), end_id + 1)
    width = "<u2" if vocabulary <= 1 << 16 else "<u4"
    docs = clean(docs, doc_id, text).toDF("doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    tokens = tokenised(docs, path, end_id, width)
    ranked = frequencies(tokens, width, vocabulary).orderBy(F.desc("n"), "id").collect()  # at most the vocabulary
    rank_of = np.zeros(vocabulary, dtype=np.uint32)
    rank_of[[r["id"] for r in ranked]] = np.arange(len(ranked))
    (spark.createDataFrame([(k, r["id"], r["n"]) for k, r in enumerate(ranked)], "rank bigint, id bigint, n bigint")
     .coalesce(1).write.parquet(f"{out}/{DICTIONARY}"))
    total = sum(r["n"] for r in ranked)
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // (BLOCK_IDS * BLOCKS_PER_FILE)))
    order = [F.col("doc_id").asc_nulls_first(), F.col("ids_crc32").asc(), F.col("_row").asc()]
    ordered = _coded(tokens, rank_of, width).repartitionByRange(parts, *order).sortWithinPartitions(*order)
    (_blocked(ordered).select(F.col("block").cast("string").alias("value"))
     .write.option("maxRecordsPerFile", BLOCKS_PER_FILE).text(f"{out}/{FILES}"))


def _files(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.format("binaryFile").load(f"{out}/{FILES}").select("content")


def read_ids(spark: SparkSession, out: str) -> DataFrame:
    """Every document of the files: _part, _number and _before (its block and the ids before it
    there), doc_id, n_tokens and ids (little-endian, 4 bytes each)."""
    rows = spark.read.parquet(f"{out}/{DICTIONARY}").orderBy("rank").collect()  # at most the vocabulary
    id_of = np.array([r["id"] for r in rows], dtype="<u4")
    names = ["_part", "_number", "_before", "doc_id", "n_tokens", "ids"]

    def run(batches):
        for batch in batches:
            for content in batch.column(0):
                for part, number, docs, null, counts, control, data in blocks(memoryview(content.as_buffer())):
                    ids = id_of[decode(control, data, counts)]
                    n = len(docs)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(n, part), pa.int64()), pa.array(np.full(n, number), pa.int64()),
                         pa.array(np.cumsum(counts) - counts, pa.int64()), pa.array(docs, pa.int64(), mask=null),
                         pa.array(counts, pa.int64()), _binary(ids, counts * 4)], names)

    return map_arrow(_files(spark, out), run, "_part bigint, _number bigint, _before bigint, doc_id bigint, n_tokens bigint, ids binary")


def add_starts(found: DataFrame, out: str) -> DataFrame:
    """``start`` in place of the block's columns: the ids of all documents before a row of ``read_ids``."""
    def run(batches):
        for batch in batches:
            for content in batch.column(0):
                heads = [(b[0], b[1], int(b[4].sum())) for b in blocks(memoryview(content.as_buffer()))]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*heads)] if heads
                                                 else [pa.array([], pa.int64())] * 3, ["_part", "_number", "n"])

    heads = map_arrow(_files(found.sparkSession, out), run, "_part bigint, _number bigint, n bigint")
    heads = stored(heads, "id-blocks")  # one row per block
    parts = heads.groupBy("_part").agg(F.sum("n").alias("n"))
    parts = parts.select("_part", F.coalesce(F.sum("n").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)),
                                             F.lit(0)).alias("_earlier"))
    inside = W.partitionBy("_part").orderBy("_number").rowsBetween(W.unboundedPreceding, -1)
    starts = heads.join(parts, "_part").select(
        "_part", "_number", (F.col("_earlier") + F.coalesce(F.sum("n").over(inside), F.lit(0))).alias("_start"))
    return (found.join(starts, ["_part", "_number"])
            .withColumn("start", F.col("_start") + F.col("_before")).drop("_part", "_number", "_before", "_start"))


def report(docs: DataFrame) -> DataFrame:
    spark = docs.sparkSession
    out = work_path(spark, "id-files")
    write_ids(docs, out)
    found = read_ids(spark, out).withColumn("ids_crc32", F.crc32("ids").cast("long")).drop("ids")
    return add_starts(found, out).select("doc_id", "start", "n_tokens", "ids_crc32")
