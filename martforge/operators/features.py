"""Feature engineering (X3): calendar, margin, holiday, rolling and weather columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import back_to_school_flag, weekend_flag
from ..functions.columns import add_missing_columns
from ..functions.measures import extreme_weather_flag, holiday_flag, positive_flag, profit_margin
from ..schemas import HOLIDAYS, WEATHER_COLUMNS
from .days import add_proximity, add_season, daily_totals, rolling_sales
from .sizing import materialize

ROW_FEATURES = ["holiday_flag", "month", "year", "quarter", "weekend_flag", "profit_margin",
                "back_to_school_flag"]
DAY_FEATURES = ["days_until_next_holiday", "days_since_last_holiday",
                "holiday_shopping_season_flag", "rolling_sales_7d", "rolling_sales_30d"]
WEATHER_FLAGS = ["is_raining", "is_snowing", "extreme_weather_flag"]


def row_features(df: DataFrame, date_col: str = "Order Date", sales_col: str = "Sales",
                 profit_col: str = "Profit") -> DataFrame:
    """The features that need the row alone (after the holiday join)."""
    d = F.col(date_col)
    return df.withColumns({
        "holiday_flag": holiday_flag("holiday_name"),
        "month": F.month(d),
        "year": F.year(d),
        "quarter": F.quarter(d),
        "weekend_flag": weekend_flag(d),
        "profit_margin": profit_margin(profit_col, sales_col),
        "back_to_school_flag": back_to_school_flag(d),
    })


def engineer_features(df: DataFrame, holidays: DataFrame | None = None, *,
                      daily_source: DataFrame | None = None, daily: DataFrame | None = None,
                      date_col: str = "Order Date", sales_col: str = "Sales",
                      profit_col: str = "Profit") -> DataFrame:
    """Add the engineered columns to ``df`` (rows already joined with holidays).

    ``daily_source`` holds the rows whose Sales are summed per day for the
    rolling averages (default ``df`` itself).  Passing the ledger joined with
    holidays only gives the same totals whenever the other joins are on
    unique keys, and avoids recomputing them for the day table.  ``daily``
    passes ready daily totals (``daily_totals``) instead.  The rolling table is
    written once (one row per date); the rest is lazy.
    """
    spark = df.sparkSession
    if holidays is None:
        holidays = spark.createDataFrame([], HOLIDAYS)
    rows = row_features(df, date_col, sales_col, profit_col)
    if daily is None:
        daily = daily_totals(daily_source if daily_source is not None else df, date_col, sales_col)
    rolling = materialize(rolling_sales(daily, date_col), "days")
    out = add_season(add_proximity(rows, holidays, date_col), holidays, date_col)
    out = out.join(rolling, on=date_col, how="left")
    had_weather = [c for c in WEATHER_COLUMNS if c in df.columns]
    out = add_missing_columns(out, WEATHER_COLUMNS)
    out = out.withColumns({
        "is_raining": positive_flag("precipitation_mm"),
        "is_snowing": positive_flag("snowfall_cm"),
        "extreme_weather_flag": extreme_weather_flag(),
    })
    base = [date_col] + [c for c in df.columns if c != date_col]
    added_weather = [c for c in WEATHER_COLUMNS if c not in had_weather]
    return out.select(*base, *ROW_FEATURES, *DAY_FEATURES, *added_weather, *WEATHER_FLAGS)
