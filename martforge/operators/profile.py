"""Dataset profile (X10): row count, missing values per column, duplicate rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .sizing import materialize


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def missing_by_column(df: DataFrame) -> DataFrame:
    """(position, column_name, missing_count) from ONE aggregate pass (NULL only)."""
    names = df.columns
    counts = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(f"m{i}")
                      for i, c in enumerate(names)])
    pairs = F.array(*[F.struct(F.lit(i).alias("position"), F.lit(c).alias("column_name"),
                               F.col(f"m{i}").alias("missing_count"))
                      for i, c in enumerate(names)])
    return counts.select(F.inline(pairs))


def fingerprint(df: DataFrame) -> list[Column]:
    """Two independent 64-bit digests of a whole row; equal rows (NULLs and zeros of either
    sign compare equal) have equal ones."""
    def value(f):
        c = F.col(f"`{f.name}`")
        return c + F.lit(0.0).cast(f.dataType) if isinstance(f.dataType, (T.FloatType, T.DoubleType)) else c

    # a NULL does not change a digest, so where they stand is digested too
    nulls = F.concat(F.lit(""), *[F.when(F.col(f"`{c}`").isNull(), "1").otherwise("0") for c in df.columns])
    values = [value(f) for f in df.schema.fields]
    return [F.xxhash64(F.lit(1), nulls, *values).alias("__h1"), F.xxhash64(F.lit(2), *values, nulls).alias("__h2")]


def duplicate_rows(df: DataFrame, digests: Callable[[DataFrame], list[Column]] = fingerprint) -> DataFrame:
    """rows - distinct rows (NULLs compare equal).

    Digests of 16 bytes are exchanged and counted, not rows.  Rows whose digest no
    other row has are no duplicates; the others are compared whole, so a shared
    digest alone counts for nothing.  The digests that repeat are written, and the
    planner brings them to the rows by a broadcast or a shuffle, as their bytes say.
    """
    keys = [c.alias(f"__h{i}") for i, c in enumerate(digests(df))]
    names = [f"__h{i}" for i in range(len(keys))]
    met = materialize(df.select(*keys).groupBy(*names).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(*names), "row-digests")
    rows = df.select("*", *keys).join(met, names, "left_semi")
    per_row = rows.groupBy(*names, *[F.col(f"`{c}`") for c in df.columns]).agg(F.count(F.lit(1)).alias("n"))
    return per_row.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("long")
                       .alias("duplicate_rows"))


def profile(df: DataFrame) -> DataFrame:
    """Long form (metric, column_name, value): one aggregate for the row and missing
    counts, and the passes of ``duplicate_rows``."""
    names = df.columns
    counts = df.agg(F.count(F.lit(1)).alias("n"),
                    *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"m{i}") for i, c in enumerate(names)])
    none = F.lit(None).cast("string")
    rows = F.array(F.struct(F.lit("row_count").alias("metric"), none.alias("column_name"), F.col("n").alias("value")),
                   *[F.struct(F.lit("missing").alias("metric"), F.lit(c).alias("column_name"),
                              F.col(f"m{i}").alias("value")) for i, c in enumerate(names)])
    dup = duplicate_rows(df).select(F.lit("duplicate_rows").alias("metric"), none.alias("column_name"),
                                    F.col("duplicate_rows").alias("value"))
    return counts.select(F.inline(rows)).unionByName(dup)
