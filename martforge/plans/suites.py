"""The four quality suites (Q11-Q14) and the multi-dataset run (Q15)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from ..operators import quality as Q
from ..schemas import RAW_LEDGER_COLUMNS
from ..sources.lookups import REGION_NAMES

# Years covered, accepted sizes, columns and bounds of the four rule lists.
FIRST_YEAR, LAST_YEAR = 2014, 2017
FINAL_COLUMNS = [
    "Order Date", "Customer ID", "Sales", "Profit", "holiday_name", "holiday_flag",
    "month", "year", "quarter", "weekend_flag", "profit_margin", "temp_c",
    "precipitation_mm", "snowfall_cm", "wind_speed_kmh", "is_raining", "is_snowing",
    "extreme_weather_flag", "days_until_next_holiday", "days_since_last_holiday",
    "holiday_shopping_season_flag", "rolling_sales_7d", "rolling_sales_30d",
]
FLAG_COLUMNS = ["holiday_flag", "weekend_flag", "is_raining", "is_snowing",
                "extreme_weather_flag", "holiday_shopping_season_flag"]


def sales_rules(first_year=FIRST_YEAR, last_year=LAST_YEAR, min_rows=5000, max_rows=15000):
    return [
        Q.columns_match(RAW_LEDGER_COLUMNS),
        Q.row_count_between(min_rows, max_rows),
        Q.not_null("Order ID"), Q.not_null("Customer ID"), Q.not_null("Order Date"),
        Q.not_null("Sales"),
        Q.gte("Sales", 0.0), Q.gte("Quantity", 1),
        Q.between("Order Date", f"{first_year}-01-01", f"{last_year}-12-31", parse_date=True),
    ]


def holiday_rules(first_year=FIRST_YEAR, last_year=LAST_YEAR, min_rows=10, max_rows=150):
    return [
        Q.columns_match(["holiday_name", "holiday_date"]),
        Q.not_null("holiday_name"), Q.not_null("holiday_date"),
        Q.between("holiday_date", f"{first_year}-01-01", f"{last_year}-12-31", parse_date=True),
        Q.row_count_between(min_rows, max_rows),
    ]


def weather_rules(regions=None):
    return [
        Q.columns_match(["weather_region", "weather_date", "temp_c", "precipitation_mm",
                         "snowfall_cm", "wind_speed_kmh"]),
        Q.not_null("weather_date"), Q.not_null("weather_region"),
        Q.in_set("weather_region", REGION_NAMES if regions is None else regions),
        Q.between("temp_c", -50.0, 50.0),
        Q.gte("precipitation_mm", 0.0), Q.gte("snowfall_cm", 0.0),
    ]


def final_rules(first_year=FIRST_YEAR, last_year=LAST_YEAR):
    return [
        Q.columns_match(FINAL_COLUMNS),
        Q.of_type("Sales", "numeric"), Q.of_type("Profit", "numeric"),
        Q.of_type("holiday_flag", "integer"),
        *[Q.in_set(c, [0, 1]) for c in FLAG_COLUMNS],
        Q.between("month", 1, 12), Q.between("quarter", 1, 4),
        Q.between("year", first_year, last_year),
        Q.between("profit_margin", -1000.0, 100.0),
        Q.gte("days_until_next_holiday", 0), Q.gte("days_since_last_holiday", 0),
        Q.not_null("rolling_sales_7d"),
    ]


def _error_row(dataset: str, exc: Exception) -> DataFrame:
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    row = (dataset, -1, "suite_error", None, {}, False, None, None, None, None, None,
           f"{type(exc).__name__}: {exc}")
    return spark.createDataFrame([row], Q.RESULT_SCHEMA)


def run_suites(datasets: dict[str, tuple[Callable[[], DataFrame | None], list, list[str] | None]],
               write: Callable[[str], Q.Writer | None] = lambda name: None) -> DataFrame | None:
    """Validate every dataset that is present; absent ones (loader returns
    None) are skipped, and a dataset whose load or validation raises is
    recorded as one failed ``suite_error`` row.  Returns the union of result
    rows, or None if no dataset ran.  ``write`` gives the writer of a dataset
    that is to run once (``quality.validate``)."""
    results = []
    for name, (load, rules, order) in datasets.items():
        try:
            df = load()
            if df is None:
                continue
            results.append(Q.validate(df, rules, name, sample_order=order, write=write(name)))
        except Exception as exc:  # noqa: BLE001 - a failing dataset becomes a failed row
            results.append(_error_row(name, exc))
    if not results:
        return None
    out = results[0]
    for r in results[1:]:
        out = out.unionByName(r)
    return out
