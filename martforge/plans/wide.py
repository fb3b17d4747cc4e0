"""The wide analytics table (X4) and the early holiday-only pipeline (X11)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.cleaning import clean_text, iso_to_date, parse_text_date
from ..functions.measures import holiday_flag
from ..operators.days import daily_totals_from_text
from ..operators.features import engineer_features
from ..operators.joins import DIM_COLUMNS, join_sales_customers, join_sales_holidays, join_sales_weather
from ..operators.reshape import filter_dedup_holidays
from ..operators.sizing import materialize
from ..schemas import LINE_COLUMNS


def clean_sales(raw: DataFrame, date_col: str = "Order Date",
                name_col: str = "Product Name") -> DataFrame:
    """Order Date text -> date (NULL when unparsable); Product Name cleaned."""
    return raw.withColumns({date_col: parse_text_date(date_col), name_col: clean_text(name_col)})


def holidays_from_documents(documents: DataFrame, names: list[str] | None = None) -> DataFrame:
    """X8 then X2: retail holidays, filtered and de-duplicated, flat."""
    kept = filter_dedup_holidays(documents, names)
    return kept.select(F.col("record.name").alias("holiday_name"),
                       iso_to_date(F.col("record.date.iso")).alias("holiday_date"))


def build_wide(clean: DataFrame, customers: DataFrame, holidays: DataFrame,
               weather: DataFrame | None = None, raw: DataFrame | None = None, kept_by: str | None = None,
               join_customers: Callable[[DataFrame, DataFrame], DataFrame] | None = None) -> DataFrame:
    """Clean ledger ⟕ customers ⟕ holidays ⟕ weather, then features.

    * customers: left join, shuffle or broadcast chosen by the planner/AQE; a stored
      dimension that is kept by its key (``kept_by``, see ``dims.stored_key``) is not
      grouped again to see that each key is there once;
    * holidays and weather: day-grain tables, written once; the planner
      broadcasts them by their bytes;
    * the rolling table is summed from the ledger joined with holidays only:
      the customer dimension is keyed and weather is one row per region-day
      (``unique_key`` checks say so), so those joins cannot change the daily
      totals; given the ``raw`` ledger ``clean`` was made from, the totals are
      pre-aggregated per date text, so the day job parses distinct texts only;
    * ``join_customers`` may also place the rows as their files will want them
      (``files.clustered``), before the broadcast joins and the features make them wide.
    """
    h = materialize(holidays.select("holiday_name", "holiday_date"), "holidays")
    customers = customers if kept_by == "customer_id" else unique_key(customers, ["customer_id"])
    rows = (join_customers or join_sales_customers)(line_columns_last(clean), customers)
    rows = rows.select(*[F.col(f"`{c}`") for c in [*clean.columns, *DIM_COLUMNS.values()]])
    rows = join_sales_holidays(rows, h)
    if weather is not None:
        w = materialize(weather, "weather")
        rows = join_sales_weather(rows, unique_key(w, ["weather_region", "weather_date"]))
    if raw is not None:
        daily = daily_totals_from_text(raw.select("Order Date", "Sales"), h, parse_text_date)
        return engineer_features(rows, h, daily=daily)
    daily_source = join_sales_holidays(clean.select("Order Date", "Sales"), h)
    return engineer_features(rows, h, daily_source=daily_source)


def line_columns_last(df: DataFrame) -> DataFrame:
    """Columns that lines of one order share first: neighbouring rows then begin alike, and
    exchanged blocks compress better."""
    last = [c for c in LINE_COLUMNS if c in df.columns]
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c not in last], *[F.col(f"`{c}`") for c in last])


def unique_key(df: DataFrame, keys: list[str]) -> DataFrame:
    """``df``, checked to hold each non-NULL key once (one small aggregate); else an error."""
    present = df.where(F.concat(*[F.col(k).cast("string") for k in keys]).isNotNull())
    twice = present.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    if not twice.isEmpty():
        raise ValueError(f"more than one row for a key {keys}: the join would repeat ledger rows")
    return df


def sales_with_holidays(clean: DataFrame, holidays: DataFrame) -> DataFrame:
    """X11: ledger ⟕ holidays with holiday_flag (no customers, no weather)."""
    h = materialize(holidays.select("holiday_name", "holiday_date"), "holidays")
    return join_sales_holidays(clean, h).withColumn("holiday_flag", holiday_flag())
