"""JDBC source and sink.

Reads are partitioned by a numeric/date column so every executor pulls a
slice; writes go out from every task in batches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_jdbc(spark: SparkSession, url: str, table: str | None = None,
              query: str | None = None, partition_column: str | None = None,
              lower_bound=None, upper_bound=None, num_partitions: int | None = None,
              fetch_size: int = 10_000, **options) -> DataFrame:
    if (table is None) == (query is None):
        raise ValueError("give exactly one of table or query")
    reader = spark.read.format("jdbc").option("url", url).option("fetchsize", fetch_size)
    if table is not None:
        reader = reader.option("dbtable", table)
    else:
        if partition_column is not None:
            # partitioned reads need a derived table, not the 'query' option
            reader = reader.option("dbtable", f"({query}) q")
        else:
            reader = reader.option("query", query)
    if partition_column is not None:
        reader = (reader.option("partitionColumn", partition_column)
                  .option("lowerBound", str(lower_bound)).option("upperBound", str(upper_bound))
                  .option("numPartitions", num_partitions or 8))
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.load()


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "overwrite",
               truncate: bool = False, batch_size: int = 10_000, **options) -> None:
    """Replace-load by default: the table is recreated with the frame's schema."""
    writer = (df.write.format("jdbc").mode(mode).option("url", url).option("dbtable", table)
              .option("truncate", truncate).option("batchsize", batch_size))
    for k, v in options.items():
        writer = writer.option(k, v)
    writer.save()
