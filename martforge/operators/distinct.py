"""Exact distinct counts that add up: numbered keys and bitmaps.

Keys (text of any length) get dense numbers once, kept in folders by a hash of
the key.  A set of keys is then a few bitmaps of 32,768 bits, one per range of
numbers, built map-side; the sets of months, regions or batches are joined by OR
and counted by their bits.  Partial results are small whatever the keys look
like, and a new month adds its own bitmaps without reading the others' rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.publish import Folders, read_table, recover, stage, switch
from .sizing import materialize

NUMBERS = T.StructType([T.StructField("key", T.StringType()), T.StructField("number", T.LongType()),
                        T.StructField("bucket", T.IntegerType())])
BUCKETS = 64


def _bucket(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key)), F.lit(buckets)).cast("int")


def number_keys(spark: SparkSession, path: str, rows: DataFrame, column: str, buckets: int = BUCKETS) -> DataFrame:
    """Give every new key in ``column`` (NULL is none) a number; returns the kept (key, number, bucket).

    The numbers of a folder follow each other in steps of ``buckets``, so that all numbers together
    are about as dense as the keys are many.  Known keys keep theirs.  Only folders with new keys
    are written again (``sources.publish``); their number must not change between calls.
    """
    recover(spark, path)
    keys = (rows.select(F.col(f"`{column}`").cast("string").alias("key")).where(F.col("key").isNotNull()).distinct()
            .withColumn("bucket", _bucket("key", buckets)))
    stored = Folders(spark, path).exists(path)
    if stored:
        known = read_table(spark, path, NUMBERS)
        keys = keys.join(known.select("key"), "key", "left_anti")
    keys = materialize(keys.select("key", "bucket"), "new-keys")
    order = F.row_number().over(Window.partitionBy("bucket").orderBy("key")).cast("long") - 1
    if not stored:
        new, touched = keys.withColumn("place", order), None
    else:
        touched = sorted(r["bucket"] for r in keys.select("bucket").distinct().collect())  # at most ``buckets``
        have = known.groupBy("bucket").agg(F.count(F.lit(1)).alias("have"))
        new = keys.withColumn("place", order).join(F.broadcast(have), "bucket", "left")  # a row per bucket
        new = new.withColumn("place", F.col("place") + F.coalesce("have", F.lit(0)))
    new = new.select("key", (F.col("place") * buckets + F.col("bucket")).alias("number"), "bucket")
    if stored:
        new = new.unionByName(known.where(F.col("bucket").isin(touched)))
    staging, _ = stage(new.repartition("bucket"), path, ["bucket"])
    switch(spark, staging, path, None if touched is None else [f"bucket={b}" for b in touched])
    return read_table(spark, path, NUMBERS)


def bitmaps(rows: DataFrame, column: str, numbers: DataFrame, by: list[str]) -> DataFrame:
    """(by..., slot, bits): the set of keys of each group, keys without number left out.

    Keys are distinct per group before they meet their numbers, and a hot key is one row a group.
    """
    keys = rows.select(*by, F.col(f"`{column}`").cast("string").alias("key")).where(F.col("key").isNotNull()).distinct()
    number = F.col("number") + 1  # bits are counted from 1
    return keys.join(numbers.select("key", "number"), "key").groupBy(*by, F.bitmap_bucket_number(number).alias("slot")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("bits"))


def merge(parts: DataFrame, by: list[str]) -> DataFrame:
    """Bitmaps of coarser groups (or the same, of several loads)."""
    return parts.groupBy(*by, "slot").agg(F.bitmap_or_agg("bits").alias("bits"))


def distinct_count(parts: DataFrame, by: list[str], name: str) -> DataFrame:
    """The number of keys of each group, from bitmaps of that or a finer grouping."""
    counted = merge(parts, by).withColumn("n", F.bitmap_count("bits"))
    return counted.groupBy(*by).agg(F.coalesce(F.sum("n"), F.lit(0)).alias(name))
