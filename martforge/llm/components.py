"""Connected components of a link table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

SALTS = 16


def _with_least(edges: DataFrame) -> DataFrame:
    """Edges (u, v) plus m, the least neighbour of u; a hub's edges are dealt to salts."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    spread = least.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = edges.withColumn("_salt", F.pmod(F.xxhash64("v"), F.lit(SALTS)).cast("int"))
    return salted.join(spread, ["u", "_salt"]).drop("_salt")


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def components(links: DataFrame) -> DataFrame:
    """(u, v) links -> (node, component): the least node reachable, for every linked node.

    Each round is written to the shared folder; only a count and a checksum
    reach the driver.
    """
    low, high = F.least("u", "v"), F.greatest("u", "v")
    edges = links.where(F.col("u") != F.col("v")).select(high.alias("u"), low.alias("v")).distinct()
    edges = stored(edges, "links")
    mark = _mark(edges)
    while mark[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (_with_least(both).where(F.col("v") > F.col("u"))
                 .select(F.col("v").alias("u"), F.least("m", "u").alias("v")).distinct())
        near = _with_least(large)
        small = (near.where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(large.groupBy("u").agg(F.min("v").alias("v"))).distinct())
        edges = stored(small, "links")
        after = _mark(edges)
        if after == mark:
            break
        mark = after
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return nodes.unionByName(roots)
