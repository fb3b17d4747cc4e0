"""Enrichment joins of the ledger."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import pack_texts, unpack_texts
from ..schemas import WEATHER_COLUMNS

DIM_COLUMNS = {
    "customer_name": "db_customer_name",
    "segment": "db_segment",
    "city": "db_city",
    "state": "db_state",
    "region": "db_region",
}

HASHED_CUSTOMERS = 500_000  # of one task: about 100 MB


def join_sales_customers(sales: DataFrame, customers: DataFrame,
                         sales_key: str = "Customer ID", dim_key: str = "customer_id") -> DataFrame:
    """Ledger ⟕ customer dimension; dimension columns get a ``db_`` prefix.

    The dimension is not force-broadcast (it grows with the customer base):
    the planner picks broadcast under its threshold, else a sort-merge join,
    and AQE splits skewed (hot or NULL) customer partitions.
    """
    dim = customers.select(F.col(dim_key).alias("__dim_key"),
                           *[F.col(k).alias(v) for k, v in DIM_COLUMNS.items()])
    return sales.join(dim, sales[sales_key] == dim["__dim_key"], "left").drop("__dim_key")


def join_sales_customers_in_place(sales: DataFrame, customers: DataFrame, task: Column, tasks: int,
                                  sales_key: str = "Customer ID", dim_key: str = "customer_id") -> DataFrame:
    """``join_sales_customers`` of rows that are to go to the tasks numbered ``task``: the ledger rows
    are exchanged once, to their place, and the customers follow them there.

    A customer is sent once to each task that has rows of it; the list of these tasks has no more
    than ``tasks`` numbers, however many rows the customer has.  Rows without a customer id are
    placed like the others.  The texts of a row travel as one (``pack_texts``).  Both sides are
    dealt by the number itself (``repartitionById``), so that the planner does not deal them again
    by all keys of the join.  Ledger rows are not sorted for the join, unless a task gets more than
    ``HASHED_CUSTOMERS`` (one scan tells).
    """
    key = F.col(f"`{sales_key}`")
    at_task = sales.groupBy(task.alias("__task")).agg(F.approx_count_distinct(key).alias("n"))
    most = at_task.agg(F.max("n")).first()[0] or 0
    seen = sales.select(key, task.alias("__task")).where(key.isNotNull())
    seen = seen.groupBy(key).agg(F.collect_set("__task").alias("__tasks"))
    known = join_sales_customers(seen, customers, sales_key, dim_key)
    known = known.select(F.explode("__tasks").alias("__at"), key.alias("__key"), *DIM_COLUMNS.values())
    known = known.repartitionById(tasks, F.col("__at"))
    texts = [f.name for f in sales.schema.fields if f.dataType == T.StringType() and f.name != sales_key]
    rest = [F.col(f"`{c}`") for c in sales.columns if c not in texts]
    placed = sales.select(*rest, pack_texts(texts).alias("__packed"), task.alias("__task"))
    placed = placed.repartitionById(tasks, F.col("__task"))
    same = (placed["__task"] == known["__at"]) & (placed[sales_key] == known["__key"])
    known = known.hint("shuffle_hash") if most <= HASHED_CUSTOMERS else known
    joined = unpack_texts(placed.join(known, same, "left"), "__packed", texts)
    return joined.select(*[F.col(f"`{c}`") for c in sales.columns], *DIM_COLUMNS.values())


def join_sales_holidays(sales: DataFrame, holidays: DataFrame,
                        date_col: str = "Order Date") -> DataFrame:
    """Ledger ⟕ holidays on date; two holidays on one date give two rows."""
    h = holidays.select("holiday_name", "holiday_date")
    return sales.join(h, sales[date_col] == h["holiday_date"], "left")


def clean_weather(weather: DataFrame) -> DataFrame:
    return weather.select(
        F.try_to_date(F.col("weather_date")).alias("__w_date"),
        F.col("weather_region").alias("__w_region"),
        *[F.col(c).cast("double").alias(c) for c in WEATHER_COLUMNS])


def join_sales_weather(sales: DataFrame, weather: DataFrame, date_col: str = "Order Date",
                       dim_region: str = "db_region", ledger_region: str = "Region") -> DataFrame:
    """Ledger ⟕ weather on (date, COALESCE(dimension region, ledger region))."""
    w = clean_weather(weather)
    region = F.coalesce(sales[dim_region], sales[ledger_region])
    cond = (sales[date_col] == w["__w_date"]) & (region == w["__w_region"])
    return sales.join(w, cond, "left").drop("__w_date", "__w_region")
