"""Dashboard aggregates over the normalized wide table.

Money is summed with ``money_sum`` (exact, order-independent); every
result is sorted the way the sheet shows it (checks ignore order).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.measures import merged_avg, merged_sum, money_avg, money_parts, money_sum
from .sizing import materialize, materialize_counted


def kpis(w: DataFrame) -> DataFrame:
    """B1-B5, ``w`` run once: money is summed while the two id columns are written, and each
    distinct count reads its own column back (one row per id and task is exchanged, and no row
    is repeated per count)."""
    ids, sums = materialize_counted(w, {
        "total_sales": money_sum("sales"), "total_profit": money_sum("profit"), "avg_profit_margin": money_avg("profit_margin")},
        "kpi-ids", ["order_id", "customer_id"])

    def distinct(column, name):
        counted = ids.groupBy(column).agg(F.count(F.lit(1)).alias("n")).agg(F.count(column).alias(name))
        other = "total_customers" if name == "total_orders" else "total_orders"
        return counted.withColumn(other, F.lit(None).cast("long"))

    both = distinct("order_id", "total_orders").unionByName(distinct("customer_id", "total_customers"))
    return both.agg(
        F.max(F.lit(sums["total_sales"]).cast("double")).alias("total_sales"), F.max(F.lit(sums["total_profit"]).cast("double")).alias("total_profit"),
        F.max("total_orders").alias("total_orders"), F.max(F.lit(sums["avg_profit_margin"]).cast("double")).alias("avg_profit_margin"),
        F.max("total_customers").alias("total_customers"))


def measure_by(w: DataFrame, dim: str, measure: str, how: str = "sum",
               alias: str | None = None, by_measure: bool = True) -> DataFrame:
    """SUM / AVG of a money measure per dimension member, ascending by the
    measure, or (``by_measure=False``) in the order of the dimension."""
    alias = alias or f"{how}_{measure}"
    agg = money_sum(measure) if how == "sum" else money_avg(measure)
    order = [F.col(c).asc_nulls_first() for c in ([alias, dim] if by_measure else [dim])]
    return w.groupBy(dim).agg(agg.alias(alias)).orderBy(*order)


def profit_trend_by_year(w: DataFrame, exclude_year: int = 2016) -> DataFrame:
    """SUM(profit) by year without one year (NULL years are kept), in time order."""
    kept = w.where((F.col("year") != exclude_year) | F.col("year").isNull())
    return measure_by(kept, "year", "profit", by_measure=False)


def top_n(w: DataFrame, dim: str, measure: str, how: str, n: int, alias: str) -> DataFrame:
    """Top ``n`` members by the aggregate (ties: member ascending); a top-k
    after the grouped aggregate, so only ``n`` rows per partition move."""
    agg = money_sum(measure) if how == "sum" else money_avg(measure)
    return (w.groupBy(dim).agg(agg.alias(alias))
            .orderBy(F.col(alias).desc(), F.col(dim).asc_nulls_first()).limit(n))


def top_products(w: DataFrame, n: int = 10) -> DataFrame:
    """Top products by SUM(sales), shown ascending."""
    return top_n(w, "product_name", "sales", "sum", n, "sum_sales").orderBy("sum_sales")


def top_customers(w: DataFrame, n: int = 10) -> DataFrame:
    """Rows of the top ``n`` customer ids by AVG(profit); per customer *name*
    the order lines, SUM(profit) and SUM(sales) (ids may share a name).

    ``w`` runs once: its rows are folded to one per id and name, with sums that
    can be added up; both the top set and the sheet come from those.
    """
    folded = materialize(w.groupBy("customer_id", "customer_name").agg(
        F.count("order_id").alias("orders"), *money_parts("profit", "p"), *money_parts("sales", "s")), "customers")
    means = folded.where(F.col("customer_id").isNotNull()).groupBy("customer_id").agg(merged_avg("p").alias("__m"))
    top = means.orderBy(F.col("__m").desc(), F.col("customer_id").asc_nulls_first()).limit(n).select("customer_id")
    return (folded.join(F.broadcast(top), "customer_id", "left_semi").groupBy("customer_name").agg(
        F.sum("orders").alias("order_count"), merged_sum("p").alias("sum_profit"), merged_sum("s").alias("sum_sales"))
        .orderBy("sum_profit", "customer_name"))


def rows_in_top(w: DataFrame, dim: str, measure: str, how: str = "avg", n: int = 10, columns: list[str] | None = None) -> DataFrame:
    """The rows whose ``dim`` member is in the top ``n`` by the aggregate
    (left-semi join with the top set, which is broadcast: its size is ``n``).
    NULL is no member.

    With ``columns`` only those are returned and ``w`` runs once: they, the member
    and the measure are kept, and the top set and the rows are read from there.
    """
    if columns is not None:
        w = materialize(w.select(*dict.fromkeys([*columns, dim, measure])), "top-rows")
    known = w.where(F.col(dim).isNotNull())
    top = F.broadcast(top_n(known, dim, measure, how, n, "__m").select(dim))
    kept = w.join(top, on=dim, how="left_semi")
    return kept if columns is None else kept.select(*columns)


def customers_by_segment(w: DataFrame) -> DataFrame:
    """COUNT DISTINCT customer_id by segment, ascending."""
    return (w.groupBy("segment").agg(F.count_distinct("customer_id").alias("customers"))
            .orderBy("customers", "segment"))
