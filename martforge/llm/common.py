"""Shared Spark steps of the training-data operators."""

from __future__ import annotations

import gc
import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import wraps
from pathlib import Path

from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import work_path
from .textkit import SLICE_BYTES, slices


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


class Tables:
    """Tables that an operator has stored: its own, and those handed to its caller."""

    def __init__(self) -> None:
        self.own: list[str] = []
        self.handed: list[str] = []

    def result(self, df: DataFrame, name: str, **options) -> DataFrame:
        """``stored``, for a table that outlives the operator."""
        table = stored(df, name, **options)
        self.handed.append(self.own.pop())
        return table

    def drop(self, k: int) -> None:
        """Delete the ``k``-th of the own tables now."""
        delete(self.own.pop(k))


_running: ContextVar[Tables | None] = ContextVar("tables of the operator that runs in this thread", default=None)


@contextmanager
def own_tables() -> Iterator[Tables]:
    """Tables stored inside are deleted at the end, but for results.

    A result belongs to the operator around this one, if there is one in this
    thread, and else stays until ``session.clean_work``.  Other threads and
    operators keep theirs.
    """
    mine, outer = Tables(), _running.get()
    token = _running.set(mine)
    try:
        yield mine
    finally:
        _running.reset(token)
        for path in mine.own:
            delete(path)
        if outer is not None:
            outer.own += mine.handed


def scoped(operator: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """An operator whose result is written and whose other tables go with it."""
    @wraps(operator)
    def run(*args, **kwargs):
        with own_tables() as mine:
            return mine.result(operator(*args, **kwargs), operator.__name__)

    return run


def delete(name: str) -> None:
    context = SparkContext._active_spark_context
    path = context._jvm.org.apache.hadoop.fs.Path(name)
    path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def stored(df: DataFrame, name: str, by: tuple = (), **options) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back.

    ``by`` names the columns that become folders, ``options`` go to the writer.

    Cuts the lineage: a lost executor rereads files instead of recomputing,
    and every later use sees the same rows in the same files.  The shuffle
    files behind it are garbage then; a collection on the driver lets Spark's
    cleaner delete them now and not whenever the driver's heap next fills.
    """
    spark = df.sparkSession
    path = work_path(spark, name)
    writer = df.write.options(**options)
    (writer.partitionBy(*by) if by else writer).parquet(path)
    if _running.get() is not None:
        _running.get().own.append(path)
    collect_garbage(spark)
    return spark.read.schema(df.schema).parquet(path).select(*[F.col(f"`{c}`") for c in df.columns])


def collect_garbage(spark: SparkSession) -> None:
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def clean(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns, so that extra columns cannot clash."""
    return df.select(*[F.col(f"`{n}`") for n in names])


def numbered(docs: DataFrame, number: str, **columns: str) -> DataFrame:
    """The columns named by ``columns`` (new name = old one) with a number per row, stored: ids
    may be null or shared, rows stay apart."""
    rows = docs.select(*[F.col(f"`{old}`").alias(new) for new, old in columns.items()])
    return stored(rows.withColumn(number, F.monotonically_increasing_id()), "numbered", compression="zstd")


def fold(doc_id) -> F.Column:
    """crc32 of the id as text, modulo 4; remainder 2 is the held-out fold."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 4


def ranked(df: DataFrame, keys: list[str], uid: str, order: list, name: str,
           per_block: int = 20_000) -> DataFrame:
    """Add ``name``: the 0-based rank of each row within its key, gapless.

    A key may hold any share of the rows: rows of a key are dealt to blocks by
    a hash of ``uid`` (unique per row), counted per block, and ranked inside
    the block only; block offsets come from the small table of counts.  With
    ``order`` led by a hash the rank is a uniform permutation of the key.
    ``df`` must be stored (it is read twice).
    """
    total = df.count()
    blocks = max(1, -(-total // per_block))
    dealt = df.withColumn("_block", F.pmod(F.xxhash64(F.lit(77), F.col(uid)), F.lit(blocks)).cast("int"))
    counts = dealt.groupBy(*keys, "_block").agg(F.count(F.lit(1)).alias("_n"))
    before = (W.partitionBy(*keys).orderBy("_block").rowsBetween(W.unboundedPreceding, -1))
    offsets = counts.select(*keys, "_block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = W.partitionBy(*keys, "_block").orderBy(*order)
    local = dealt.withColumn("_local", F.row_number().over(inside) - 1)
    return (local.join(offsets, [*keys, "_block"])
            .withColumn(name, F.col("_before") + F.col("_local"))
            .drop("_block", "_before", "_local"))


#: a key is hot if more rows than the first and than one in so many of all rows have it
HOT_ROWS, HOT_KEYS = 10_000, 10_000


def looked_up(rows: DataFrame, table: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` joined with ``table`` (left), whose keys are unique; its column ``_n``
    says how many rows have a key.

    Rows of hot keys meet a broadcast: at most ``HOT_KEYS`` keys can be hot.  All
    others meet by a shuffle, where none of their keys can fill a task.  ``rows``
    and ``table`` are read more than once if there are hot keys.
    """
    total = table.agg(F.sum("_n")).first()[0] or 0
    hot = F.col("_n") > max(HOT_ROWS, total // HOT_KEYS)
    few = table.where(hot).drop("_n")
    if few.isEmpty():
        return rows.join(table.drop("_n"), keys, "left")
    marked = rows.join(F.broadcast(few.withColumn("_hot", F.lit(True))), keys, "left")
    rest = marked.where(F.col("_hot").isNull()).select(*rows.columns).join(table.where(~hot).drop("_n"), keys, "left")
    return marked.where("_hot").drop("_hot").unionByName(rest)


_shipped: dict[str, str] = {}


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once per application (``addPyFile``),
    so that tasks can import it where it is not installed."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parent.parent
    path = os.path.join(tempfile.mkdtemp(prefix="martforge-code-"), "martforge_code.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for file in sorted(root.rglob("*.py")):
            archive.write(file, file.relative_to(root.parent))
    context.addPyFile(path)
    _shipped[context.applicationId] = path


def map_arrow(df: DataFrame, run, schema) -> DataFrame:
    """``mapInArrow`` with this package at hand in the tasks."""
    ship(df.sparkSession)
    return df.mapInArrow(run, schema)


def add_columns(df: DataFrame, text: str, fields: str, func, limit: int = SLICE_BYTES) -> DataFrame:
    """Append columns computed from whole texts, slice by slice, inside tasks.

    ``fields`` is the DDL of the new columns, ``func`` maps the text column of
    one bounded slice (``limit`` bytes or one text) to their Arrow arrays.  Columns of ``df`` that clash with
    a new name are replaced.
    """
    import pyarrow as pa

    new = T.StructType.fromDDL(fields)
    base = df.drop(*[f.name for f in new.fields])
    schema = T.StructType(base.schema.fields + new.fields)
    names = schema.names

    def run(batches):
        for batch in batches:
            for part in slices(batch, text, limit):
                yield pa.RecordBatch.from_arrays([*part.columns, *func(part.column(text))], names)

    return map_arrow(base, run, schema)
