"""Small derived tables, written once and read by every later use."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..session import work_path


COPY_CODEC = "zstd"  # of tables that only Spark reads


def materialize(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` once as parquet under the shared checkpoint folder and read it back.

    The written copy cuts the lineage, and its file sizes are known: the
    planner broadcasts it below ``spark.sql.autoBroadcastJoinThreshold`` bytes
    and joins by shuffle beyond that.  The rows read back are counted against
    the rows written, so a folder that not every machine sees is an error and
    not an empty table.
    """
    return materialize_counted(df, {}, name)[0]


def materialize_counted(df: DataFrame, metrics: dict[str, Column], name: str = "table",
                        columns: list[str] | None = None) -> tuple[DataFrame, dict]:
    """``materialize`` (of ``columns`` only, if given), and aggregates over the rows counted while
    they were written, ``rows`` among them."""
    obs = Observation(f"rows_{uuid.uuid4().hex}")
    path = work_path(df.sparkSession, name)
    seen = df.observe(obs, F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in metrics.items()])
    df = seen if columns is None else seen.select(*columns)
    df.write.option("compression", COPY_CODEC).parquet(path)
    got = dict(obs.get)
    # the schema is known: read back without a footer-inference job
    return verified(df.sparkSession.read.schema(df.schema).parquet(path), int(got["rows"]), path), got


def broadcasts(df: DataFrame) -> bool:
    """Whether the planner expects ``df`` to be small enough to be broadcast (of a stored table: by its files)."""
    expected = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(str(expected)) <= df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()


def verified(df: DataFrame, rows: int, path: str) -> DataFrame:
    """``df`` if it has ``rows`` rows, else an error."""
    found = df.count()
    if found != rows:
        raise RuntimeError(f"{path}: {rows} rows written, {found} read back; is the folder shared?")
    return df
