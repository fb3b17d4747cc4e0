"""Day-grain tables: daily sales, rolling averages, holiday proximity.

Everything here is computed per calendar day, never per ledger row.  Holiday
proximity and the shopping season come from the holidays alone; the rolling
averages from one aggregate of the ledger.  Each is attached to the rows by an
equi-join on a day-grain table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.measures import EXACT, as_double, exact_total
from ..sources.lookups import THANKSGIVING


def holiday_calendar(holidays: DataFrame) -> DataFrame:
    """Distinct known holiday dates, ascending."""
    return (holidays.select("holiday_date").where(F.col("holiday_date").isNotNull())
            .distinct().orderBy("holiday_date"))


def thanksgiving_by_year(holidays: DataFrame, name: str = THANKSGIVING) -> DataFrame:
    """year -> Thanksgiving date (the latest one if a year lists several)."""
    h = holidays.where((F.col("holiday_name") == name) & F.col("holiday_date").isNotNull())
    return h.groupBy(F.year("holiday_date").alias("year")).agg(
        F.max("holiday_date").alias("thanksgiving_date"))


def daily_totals(rows: DataFrame, date_col: str = "Order Date", sales_col: str = "Sales",
                 partition_by: tuple[str, ...] = ()) -> DataFrame:
    """One row per date (and ``partition_by``): the two parts of the exact total."""
    total, special = exact_total(sales_col)
    return rows.groupBy(*partition_by, date_col).agg(total.alias("total"), special.alias("special"))


def daily_sales(rows: DataFrame, date_col: str = "Order Date", sales_col: str = "Sales") -> DataFrame:
    """A1: one row per date (NULL date is its own group): total of Sales."""
    return daily_totals(rows, date_col, sales_col).select(
        date_col, as_double(F.col("total"), F.col("special")).alias("total_daily_sales"))


def daily_totals_from_text(rows: DataFrame, holidays: DataFrame, parse,
                           date_col: str = "Order Date", sales_col: str = "Sales",
                           partition_by: tuple[str, ...] = ()) -> DataFrame:
    """``daily_totals`` over (ledger ⟕ holidays) without parsing or joining every row.

    Sales are summed per distinct date *text* (partial aggregation, so a hot
    date collapses map-side), only the distinct texts are parsed with
    ``parse``, and the holiday fan-out (k holidays on a date repeat each of
    its rows k times) repeats the sums instead of the rows.
    """
    text = F.col(date_col)
    total, special = exact_total(sales_col)
    per_text = rows.groupBy(*partition_by, text.alias("__t")).agg(total.alias("total"), special.alias("special"))
    dated = per_text.select(*partition_by, parse(F.col("__t")).alias(date_col), "total", "special")
    fanout = holidays.where(F.col("holiday_date").isNotNull()).select(F.col("holiday_date").alias("__h"))
    repeated = dated.join(fanout, dated[date_col] == fanout["__h"], "left")
    return repeated.groupBy(*partition_by, date_col).agg(
        F.try_sum("total").cast(EXACT).alias("total"), F.sum("special").alias("special"))


def rolling_sales(totals: DataFrame, date_col: str = "Order Date", partition_by: tuple[str, ...] = (),
                  frames: dict[str, int] | None = None) -> DataFrame:
    """round(average of the daily totals of the days *with sales* in the
    frame, 2), per date and ``partition_by``; frames end at the date itself."""
    frames = frames or {"rolling_sales_7d": 7, "rolling_sales_30d": 30}
    dated = totals.where(F.col(date_col).isNotNull())
    order = Window.partitionBy(*partition_by).orderBy(F.unix_date(date_col))
    both = F.col("total").isNotNull() | F.col("special").isNotNull()

    def average(days: int) -> Column:
        w = order.rangeBetween(1 - days, 0)
        value = as_double(F.try_sum("total").over(w), F.sum("special").over(w))
        return F.round(F.try_divide(value, F.count(F.when(both, 1)).over(w)), 2)

    return dated.select(*partition_by, date_col, *[average(n).alias(c) for c, n in frames.items()])


def holiday_proximity(holidays: DataFrame) -> DataFrame:
    """(day, next, last) for every day from the first to the last holiday.

    Neighbouring holidays span an interval of days; no ledger row is read.
    """
    days = holidays.select(F.col("holiday_date").alias("last")).where(F.col("last").isNotNull()).distinct()
    following = F.lead("last").over(Window.orderBy("last"))
    spans = days.select("last", following.alias("next"))
    until = F.coalesce(F.date_sub("next", 1), F.col("last"))
    return spans.select("last", "next", F.explode(F.sequence(F.col("last"), until)).alias("day")).select(
        "day", F.when(F.col("day") == F.col("last"), F.col("day")).otherwise(F.col("next")).alias("next"), "last")


def add_proximity(rows: DataFrame, holidays: DataFrame, date_col: str = "Order Date") -> DataFrame:
    """Days until the next and since the last holiday (0 on a holiday,
    NULL beyond the last and before the first one)."""
    known = holidays.where(F.col("holiday_date").isNotNull())
    first = known.agg(F.min("holiday_date")).scalar()
    last = known.agg(F.max("holiday_date")).scalar()
    d = F.col(date_col)
    near = holiday_proximity(holidays).select(
        F.col("day").alias("__day"), F.col("next").alias("__next"), F.col("last").alias("__last"))
    joined = rows.join(near, d == F.col("__day"), "left")
    ahead = F.coalesce("__next", F.when(d < first, first))
    behind = F.coalesce("__last", F.when(d > last, last))
    return joined.withColumns({
        "days_until_next_holiday": F.datediff(ahead, d).cast("int"),
        "days_since_last_holiday": F.datediff(d, behind).cast("int"),
    }).drop("__day", "__next", "__last")


def add_season(rows: DataFrame, holidays: DataFrame, date_col: str = "Order Date") -> DataFrame:
    """1 from Thanksgiving through December 25 of its year, else 0."""
    d = F.col(date_col)
    tg = thanksgiving_by_year(holidays).select(F.col("year").alias("__ty"), F.col("thanksgiving_date").alias("__tg"))
    joined = rows.join(tg, F.year(d) == F.col("__ty"), "left")
    flag = F.when(d.between(F.col("__tg"), F.make_date(F.col("__ty"), F.lit(12), F.lit(25))), 1).otherwise(0)
    return joined.withColumn("holiday_shopping_season_flag", flag).drop("__ty", "__tg")
