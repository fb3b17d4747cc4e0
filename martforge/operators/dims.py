"""Customer dimension build, upsert and merge in place."""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import rename_positional
from ..schemas import CUSTOMER_DIM, CUSTOMER_EXTRACT_COLUMNS, CUSTOMER_STAGING_COLUMNS
from ..sources.publish import Folders, missing, read_table, recover, stage, switch
from .sizing import materialize

DIM_VALUE_COLUMNS = [f.name for f in CUSTOMER_DIM.fields[1:]]


def extract_customers(ledger: DataFrame) -> DataFrame:
    """Distinct customer listings (8 columns); one id may have several rows."""
    return ledger.select(*CUSTOMER_EXTRACT_COLUMNS).dropDuplicates()


def staging_customers(extract: DataFrame) -> DataFrame:
    """Positional rename of the extract to the staging table's names."""
    return rename_positional(extract, CUSTOMER_STAGING_COLUMNS)


def customer_dim_build(staging: DataFrame, key: str = "customer_id") -> DataFrame:
    """One row per non-NULL key: the smallest row in column order (NULLs first).

    Duplicates go first, in a hash aggregate (one row per task and listing),
    so the sort aggregate of the minimum sees few rows, however hot a key is.
    """
    return _least_row(staging.where(F.col(key).isNotNull()).select(key, *DIM_VALUE_COLUMNS).distinct(), key)


def _least_row(rows: DataFrame, key: str, first: tuple[str, ...] = ()) -> DataFrame:
    pick = F.min(F.struct(*[F.col(c) for c in (*first, *DIM_VALUE_COLUMNS)])).alias("__v")
    return rows.groupBy(key).agg(pick).select(key, *[F.col(f"__v.{c}").alias(c) for c in DIM_VALUE_COLUMNS])


def upsert_by_key(target: DataFrame, source: DataFrame, key: str = "customer_id") -> DataFrame:
    """INSERT ... ON CONFLICT (key) DO UPDATE: source rows replace target rows
    (all value columns, NULLs included); target keys absent from source stay.

    One union and one group by key: source rows rank before target rows.
    """
    columns = [key, *DIM_VALUE_COLUMNS]
    new = source.where(F.col(key).isNotNull()).select(*columns).distinct().withColumn("__rank", F.lit(0))
    old = target.where(F.col(key).isNotNull()).select(*columns).withColumn("__rank", F.lit(1))
    return _least_row(new.unionByName(old), key, ("__rank",))


def ensure_dimension(spark: SparkSession, path: str) -> DataFrame:
    """K6: the stored dimension, created empty if there is none; its key is checked."""
    try:
        found = spark.read.schema(CUSTOMER_DIM).parquet(path)
    except AnalysisException as exc:
        if not missing(exc):
            raise
        spark.createDataFrame([], CUSTOMER_DIM).write.parquet(path)
        found = spark.read.schema(CUSTOMER_DIM).parquet(path)
    broken = key_violations(found).first()
    if broken["null_keys"] or broken["duplicate_keys"]:
        raise ValueError(f"{path}: {broken['null_keys']} rows without key, {broken['duplicate_keys']} repeated keys")
    return found


BUCKETS = 64  # folders of a stored dimension; a merge rewrites those that its rows fall into
LAYOUT = "_layout"  # hidden from table readers


def _bucket(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key)), F.lit(buckets)).cast("int")


def merge_dimension(spark: SparkSession, path: str, source: DataFrame, buckets: int = BUCKETS,
                    key: str = "customer_id") -> list[int]:
    """Upsert ``source`` into the dimension stored at ``path``, made with the first load.

    Rows lie in folders by a hash of their key.  Only the folders that the source's
    keys fall into are read, merged, written beside the table and switched in when
    they are complete (``sources.publish``); the files of all others stay as they
    are.  A key is in one folder and a merge groups by key, so the keys of the whole
    table stay unique; the number of folders is kept with the table.  Returns the
    numbers of the rewritten folders.
    """
    recover(spark, path)
    folders, note = Folders(spark, path), f"{path}/{LAYOUT}"
    stored = folders.exists(note)
    if stored:
        layout = json.loads(folders.text(note))
        if layout["key"] != key:
            raise ValueError(f"{path} is kept by {layout['key']}, not {key}")
        buckets = layout["buckets"]
    elif folders.exists(path) and folders.children(path):
        raise ValueError(f"{path} holds a table that is not a dimension in folders by key")
    columns = CUSTOMER_DIM.fieldNames()
    rows = materialize(customer_dim_build(source, key).withColumn("bucket", _bucket(key, buckets)), "dimension-rows")
    touched = sorted(r["bucket"] for r in rows.select("bucket").distinct().collect())  # at most ``buckets``
    new = rows
    if stored:
        old = read_dimension(spark, path, with_bucket=True).where(F.col("bucket").isin(touched))
        new = upsert_by_key(old, rows, key).withColumn("bucket", _bucket(key, buckets))
    staging, _ = stage(new.select(*columns, "bucket").repartition("bucket"), path, ["bucket"])
    if not stored:
        Folders(spark, staging).write(f"{staging}/{LAYOUT}", json.dumps({"key": key, "buckets": buckets}))
        switch(spark, staging, path)
    else:
        switch(spark, staging, path, [f"bucket={b}" for b in touched])
    return touched


def stored_key(spark: SparkSession, path: str) -> str | None:
    """The key that the dimension at ``path`` holds once: every merge groups by it, and equal
    keys share a folder.  None for a table that ``merge_dimension`` did not make."""
    folders, note = Folders(spark, path), f"{path}/{LAYOUT}"
    return json.loads(folders.text(note))["key"] if folders.exists(note) else None


def read_dimension(spark: SparkSession, path: str, with_bucket: bool = False) -> DataFrame:
    """The dimension stored by ``merge_dimension`` as its last complete merge left it."""
    schema = T.StructType([*CUSTOMER_DIM.fields, T.StructField("bucket", T.IntegerType())])
    table = read_table(spark, path, schema)
    return table if with_bucket else table.drop("bucket")


def key_violations(df: DataFrame, key: str = "customer_id") -> DataFrame:
    """Primary-key check: rows, NULL keys, keys seen more than once."""
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
        F.coalesce(F.sum(F.when(F.col(key).isNull(), F.col("n"))), F.lit(0)).alias("null_keys"),
        F.count_if(F.col(key).isNotNull() & (F.col("n") > 1)).alias("duplicate_keys"),
        F.count_if(F.col(key).isNotNull()).alias("distinct_keys"))
