"""Sharding by a hypergeometric communication matrix.

A uniform shuffle of all rows into shards whose row counts differ by at most
one: (1) every input partition's row count is known; (2) how many rows each
partition sends to each shard is drawn exactly, from the multivariate
hypergeometric law, so that row sums are the partition sizes and column sums
the shard sizes; (3) each partition is permuted locally and cut by its row of
the matrix; (4) whole rows are exchanged and (5) permuted again inside the shard,
which is a folder of the written result; digests are taken from its rows.

Only partition counts meet on the driver.  Partitions and the second
permutation are worked on in blocks of bounded size, so neither a large shard
nor repeated rows gather in one task.  The input is stored first: partitions
and row numbers stay the same when a task is run again.

Null text counts as empty.  Repeated rows are separate rows; an empty table
gives no rows; more shards than rows leaves shards empty.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import clean, own_tables, ranked, ship, stored

SHARDS = 8
SEED = 20260104
BLOCK_ROWS = 200_000
PART_BITS = 33  # bits of monotonically_increasing_id that number the rows of a partition


def draw_matrix(sizes: np.ndarray, shards: int, seed: int) -> np.ndarray:
    """Partition x shard counts with exact row sums and near-equal column sums."""
    rng = np.random.default_rng(seed)
    total = int(sizes.sum())
    room = np.full(shards, total // shards, dtype=np.int64)
    room[rng.permutation(shards)[:total % shards]] += 1
    matrix = np.zeros((len(sizes), shards), dtype=np.int64)
    for i, size in enumerate(sizes):
        matrix[i] = _draw(rng, room, int(size))
        room -= matrix[i]
    return matrix


def _draw(rng, room: np.ndarray, size: int) -> np.ndarray:
    """One multivariate hypergeometric row, shard by shard (any population size)."""
    out = np.zeros(len(room), dtype=np.int64)
    rest = int(room.sum())
    for j, have in enumerate(room.tolist()):
        rest -= have
        if size:
            out[j] = _hypergeometric(rng, have, rest, size)
            size -= int(out[j])
    return out


def _hypergeometric(rng, good: int, bad: int, size: int) -> int:
    if max(good, bad) < 10**9:
        return int(rng.hypergeometric(good, bad, size))
    # beyond the generator's range: invert the distribution around its mode, from
    # the ratios of neighbouring probabilities; 50 deviations each way hold all mass
    lo, hi = max(0, size - bad), min(size, good)
    mean = size * good / (good + bad)
    reach = int(50 * max(1.0, mean * bad / (good + bad)) ** 0.5) + 1
    k = np.arange(max(lo, int(mean) - reach), min(hi, int(mean) + reach) + 1, dtype=np.float64)
    step = (np.log(good - k[:-1]) + np.log(size - k[:-1]) - np.log(k[1:]) - np.log(bad - size + k[1:]))
    log_p = np.concatenate([[0.0], np.cumsum(step)])
    total = np.cumsum(np.exp(log_p - log_p.max()))
    return int(k[np.searchsorted(total, rng.random() * total[-1])])


def _placed(kept: DataFrame, blocks: list[tuple], ends: np.ndarray, seed: int) -> DataFrame:
    """``kept`` plus ``shard``: each block (part, chunk, rows) is permuted and cut by its row of the matrix."""
    spark = kept.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(({(p, c): i for i, (p, c, _) in enumerate(blocks)}, [n for _, _, n in blocks], ends))

    def place(uid: pd.Series) -> pd.Series:
        number, sizes, cuts = shared.value
        value = uid.to_numpy()
        part, at = value >> PART_BITS, value & ((1 << PART_BITS) - 1)
        chunk = at // BLOCK_ROWS
        out = np.zeros(len(value), dtype=np.int32)
        for p, c in sorted(set(zip(part.tolist(), chunk.tolist()))):
            i = number[p, c]
            mine = np.flatnonzero((part == p) & (chunk == c))
            order = np.random.default_rng([seed, p, c]).permutation(sizes[i])
            out[mine] = np.searchsorted(cuts[i], order[at[mine] - c * BLOCK_ROWS], side="right")
        return pd.Series(out)

    return kept.withColumn("shard", F.pandas_udf(place, "int")("_uid"))


def shuffle_to_shards(rows: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """Whole rows plus ``shard`` and ``slot`` (gapless from 0 in its shard), written to a folder per shard."""
    with own_tables() as mine:
        kept = stored(rows.withColumn("_uid", F.monotonically_increasing_id()), "shard-rows", compression="zstd")
        # blocks of a partition: one task's worth of rows, however large the partition is
        row = F.col("_uid").bitwiseAND(F.lit((1 << PART_BITS) - 1))
        sizes = (kept.groupBy(F.shiftright("_uid", PART_BITS).alias("part"), F.floor(row / BLOCK_ROWS).alias("chunk"))
                 .count().orderBy("part", "chunk").collect())
        blocks = [tuple(r) for r in sizes]
        matrix = draw_matrix(np.array([n for _, _, n in blocks], dtype=np.int64), shards, seed)
        sent = _placed(kept, blocks, matrix.cumsum(axis=1), seed)
        order = [F.xxhash64(F.lit(seed + 1), F.col("_uid")), F.col("_uid")]
        done = ranked(sent, ["shard"], "_uid", order, "slot").drop("_uid")
        return mine.result(done, "shards", by=("shard",), compression="zstd")


def report(docs: DataFrame) -> DataFrame:
    """The query's columns, taken from the documents that lie in the shards."""
    sharded = shuffle_to_shards(clean(docs, "doc_id", "text"))
    body = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return sharded.select(
        "doc_id", (F.octet_length(body) + 1).cast("long").alias("size"), F.crc32(body).cast("long").alias("text_crc32"),
        F.lit("rows").alias("law"), "shard", F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))
