"""File sources and sinks."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.cleaning import to_timestamp_tolerant
from ..functions.columns import normalize_columns
from ..operators.reshape import union_all
from .headers import align, header_groups
from .publish import missing, publish

LATIN_1 = "ISO-8859-1"  # encoding of the sales extract
COMPRESSED_ROWS = 1_000_000  # rows of a compressed CSV part, which cannot be split


def read_csv(spark: SparkSession, path: str | list[str], schema: T.StructType | None,
             encoding: str = "UTF-8", null_value: str | None = None) -> DataFrame:
    """Header CSV, columns taken by name; '"' escapes quotes inside fields.

    ``path`` may be a glob (``dir/part-*.csv``), a folder or a list.  Parts whose
    headers are equal are one distributed scan.  A part may have its columns in any
    order; those that ``schema`` does not name are left out, those that a part lacks
    are NULL, empty files have no rows.  Without a schema the types are inferred per
    header and widened to hold all parts.
    """
    groups = header_groups(spark, path, encoding)
    options = {"header": True, "encoding": encoding, "escape": '"', "mode": "PERMISSIVE"}
    if null_value is not None:
        options["nullValue"] = null_value
    if not groups:
        return spark.createDataFrame([], schema or T.StructType([]))
    parts = []
    for header, members in groups.items():
        reader = spark.read.options(**options)
        if schema is None:
            reader = reader.option("inferSchema", True)
        else:
            typed = {f.name: f.dataType for f in schema.fields}
            reader = reader.schema(T.StructType([T.StructField(n, typed.get(n, T.StringType())) for n in header]))
        if len(groups) == 1:
            parts.append(reader.csv(path))
        else:
            root = path if isinstance(path, str) and "=" in members[0] and not set(path) & set("*?[{") else None
            parts.append((reader.option("basePath", root) if root else reader).csv(members))
    if schema is None:
        return align(parts)

    def shaped(part):
        have = set(part.columns)
        return part.select(*[(F.col(f"`{f.name}`") if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
                             for f in schema.fields])

    return reduce(DataFrame.unionByName, [shaped(p) for p in parts])


def write_csv(df: DataFrame, path: str, mode: str = "overwrite",
              partition_by: list[str] | None = None, encoding: str = "UTF-8", compression: str | None = None) -> None:
    """Header CSV, NULL written as ``null`` (empty text stays ``""``, blanks at
    the ends of a value stay).

    No ``coalesce(1)``: every task writes its own part file.  ``compression``
    (``gzip``) writes each part compressed; ``read_csv`` tells by the file's
    name.  A compressed part is read by one task, so parts end after
    ``COMPRESSED_ROWS`` rows.
    """
    writer = (df.write.mode(mode).option("header", True).option("nullValue", "null")
              .option("escape", '"').option("encoding", encoding)
              .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False))
    if compression:
        writer = writer.option("compression", compression).option("maxRecordsPerFile", COMPRESSED_ROWS)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.csv(path)


def read_json(spark: SparkSession, path: str | list[str], schema: T.StructType,
              multiline: bool = False) -> DataFrame:
    """JSON with an explicit schema.  JSON-lines (the default) is splittable;
    ``multiline=True`` reads one document (or top-level array) per file."""
    return spark.read.schema(schema).option("multiLine", multiline).json(path)


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).json(path)


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None,
                fmt: str = "parquet", cluster_by: list[str] | None = None,
                files_per_partition: int = 16, keep_others: bool = False, metrics: dict | None = None,
                **options) -> dict:
    """Publish a table in place of the one at ``path``: partitions that ``df``
    does not hold are gone afterwards.  ``keep_others`` replaces only the
    partitions present in ``df`` instead.  The old table stays readable until
    the new one is written and its rows are counted (``sources.publish``).
    Returns ``rows`` and the aggregates in ``metrics``, counted while writing;
    ``options`` go to the writer.

    With ``cluster_by`` the rows are hash-partitioned on (partition columns,
    hash(cluster columns) mod ``files_per_partition``) before writing: every
    partition value is written by at most ``files_per_partition`` tasks (few
    files), and a hot partition value is still spread over that many tasks.
    One shuffle, no sampling pass over the input.
    """
    if partition_by and cluster_by:
        df = clustered(df, [F.col(f"`{c}`") for c in partition_by], cluster_by, files_per_partition)
    return publish(df, path, partition_by, fmt, keep_others, metrics, **options)


def clustered(df: DataFrame, parts: list[Column], cluster_by: list[str], files_per_partition: int = 16) -> DataFrame:
    """Rows of equal ``parts`` in at most ``files_per_partition`` tasks, by a hash of ``cluster_by``.

    A table that gets most of its columns from broadcast joins can be placed before them and
    written without ``cluster_by``: narrower rows are exchanged, the files are the same.
    """
    return df.repartition(*parts, _salt(cluster_by, files_per_partition))


def clustered_task(parts: list[Column], cluster_by: list[str], tasks: int, files_per_partition: int = 16) -> Column:
    """The number of the task, of ``tasks``, that ``clustered`` rows go to when a join places them
    (``joins.join_sales_customers_in_place``)."""
    return F.pmod(F.xxhash64(*parts, _salt(cluster_by, files_per_partition)), F.lit(tasks)).cast("int")


def _salt(cluster_by: list[str], files_per_partition: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in cluster_by]), F.lit(files_per_partition))


def write_bucketed(df: DataFrame, table: str, path: str, key: str, buckets: int) -> None:
    """Save ``df`` as an external parquet table bucketed and sorted by ``key``.

    When the ledger and the customer dimension are both stored this way with
    the same bucket count, the customer join (J1) reads bucket i of both
    sides in one task: no shuffle of either side on every run.
    """
    (df.write.mode("overwrite").format("parquet").option("path", path)
     .bucketBy(buckets, key).sortBy(key).saveAsTable(table))


def read_or_empty(spark: SparkSession, load: Callable[[], DataFrame],
                  schema: T.StructType) -> DataFrame:
    """Run ``load``; if its path does not exist return an empty typed relation.

    Only a missing path falls back; any other error propagates.
    """
    try:
        return load()
    except AnalysisException as exc:
        if missing(exc):
            return spark.createDataFrame([], schema)
        raise


def load_published(spark: SparkSession, path: str | list[str], schema: T.StructType, date_columns: list[str],
                   encoding: str = "UTF-8", null_value: str | None = "null") -> DataFrame:
    """Published part files -> one table: multi-part read, folded column
    names, the date columns that are present as timestamps (bad text is NULL)."""
    table = normalize_columns(read_csv(spark, path, schema, encoding, null_value))
    types = {f.name: f.dataType for f in table.schema.fields}
    return table.withColumns({c: to_timestamp_tolerant(c, types[c]) for c in date_columns if c in types})


def union_available(spark: SparkSession, loads: list[Callable[[], DataFrame]], schema: T.StructType) -> DataFrame:
    """Union of the parts that can be loaded; a part whose path is missing is skipped."""
    return union_all([read_or_empty(spark, load, schema) for load in loads])
