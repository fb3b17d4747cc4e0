"""Daily totals kept between runs and the rolling averages that a batch changes.

The state is one row per date, in folders by month: the exact total in
mergeable parts.  A batch is summed by date, only the months it has dates in
are read, merged and switched in, and only its own dates and the days after
them, as far as the longest frame reaches, get new averages.  The ledger behind
the state is not read again.  Holidays repeat days when averages are made, so a
changed calendar needs no new state.  Dates unknown (NULL) are kept in the
state; they have no averages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.measures import EXACT, exact_total
from ..sources.publish import Folders, read_table, recover, stage, switch
from .days import rolling_sales
from .sizing import materialize

STATE = T.StructType([T.StructField("day", T.DateType()), T.StructField("total", T.DecimalType(38, 18)),
                      T.StructField("special", T.DoubleType()), T.StructField("lines", T.LongType()),
                      T.StructField("month", T.StringType())])
REACH = 30  # days of the longest frame
UNDATED = "undated"


def _month(day) -> F.Column:
    return F.coalesce(F.date_format(day, "yyyy-MM"), F.lit(UNDATED))


def batch_totals(rows: DataFrame, date_col: str = "Order Date", sales_col: str = "Sales") -> DataFrame:
    """The batch's rows of the state: one per date."""
    total, special = exact_total(F.col(f"`{sales_col}`"))
    return rows.groupBy(F.col(f"`{date_col}`").alias("day")).agg(
        total.cast(EXACT).alias("total"), special.alias("special"), F.count(F.lit(1)).alias("lines")
    ).withColumn("month", _month(F.col("day")))


def merged(parts: DataFrame) -> DataFrame:
    """Rows of the same date added up."""
    return parts.groupBy("day").agg(
        F.try_sum("total").cast(EXACT).alias("total"), F.sum("special").alias("special"), F.sum("lines").alias("lines")
    ).withColumn("month", _month(F.col("day")))


def add_batch(spark: SparkSession, path: str, rows: DataFrame, date_col: str = "Order Date", sales_col: str = "Sales") -> DataFrame:
    """Add a batch of ledger rows to the state at ``path`` (made with the first one); returns the
    rows of the batch's own state, one per date."""
    recover(spark, path)
    batch = materialize(batch_totals(rows, date_col, sales_col), "day-batch")
    months = sorted(r["month"] for r in batch.select("month").distinct().collect())  # calendar months
    stored = Folders(spark, path).exists(path)
    new = batch
    if stored:
        old = read_state(spark, path).where(F.col("month").isin(months))
        new = merged(old.unionByName(batch.select(*STATE.fieldNames())))
    staging, _ = stage(new.select(*STATE.fieldNames()).repartition("month"), path, ["month"])
    switch(spark, staging, path, [f"month={m}" for m in months] if stored else None)
    return batch


def read_state(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, STATE)


def _averages(state: DataFrame, holidays: DataFrame | None) -> DataFrame:
    """``rolling_sales``; k holidays on a date count its lines k times, as in the joined ledger."""
    if holidays is not None:
        fan = holidays.where(F.col("holiday_date").isNotNull()).select(F.col("holiday_date").alias("day"))
        state = merged(state.join(fan, "day", "left"))
    return rolling_sales(state.select("day", "total", "special"), "day")


def rolling_from_state(spark: SparkSession, path: str, holidays: DataFrame | None = None) -> DataFrame:
    """day and its rolling averages, for all dates of the state; ``holidays`` as in the wide plan."""
    return _averages(read_state(spark, path), holidays)


def changed_averages(spark: SparkSession, path: str, batch: DataFrame, holidays: DataFrame | None = None,
                     reach: int = REACH) -> DataFrame:
    """The rolling averages that ``batch`` (from ``add_batch``) changed: its dates and the
    ``reach`` - 1 days after each; reads the months around them only."""
    near = batch.where(F.col("day").isNotNull()).select(
        F.explode(F.sequence(F.col("day"), F.date_add("day", reach - 1))).alias("day")).distinct()
    # a frame reaches back over three months at most; its ends and middle lie in all of them
    around = F.array("day", F.date_sub("day", reach // 2), F.date_sub("day", reach - 1))
    wanted = [r["m"] for r in near.select(F.explode(around).alias("day")).select(_month(F.col("day")).alias("m")).distinct().collect()]
    state = read_state(spark, path).where(F.col("month").isin(wanted))  # calendar months
    return _averages(state, holidays).join(near, "day", "left_semi")
