"""Nested-document reshaping."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.cleaning import iso_to_date
from ..schemas import WEATHER_METRICS
from ..sources.lookups import RETAIL_HOLIDAYS


def flatten_holidays(documents: DataFrame, holidays_col: str = "holidays") -> DataFrame:
    """array<struct<name, date.iso>> -> (holiday_name, holiday_date); empty/NULL arrays give no rows."""
    h = documents.select(F.explode(holidays_col).alias("h"))
    return h.select(F.col("h.name").alias("holiday_name"),
                    iso_to_date(F.col("h.date.iso")).alias("holiday_date"))


def holiday_types(documents: DataFrame, holidays_col: str = "holidays") -> DataFrame:
    """Holiday list with its type; the date is kept as the document's text."""
    h = documents.select(F.explode(holidays_col).alias("h"))
    return h.select(F.col("h.name").alias("holiday_name"),
                    F.col("h.date.iso").alias("holiday_date"),
                    F.col("h.primary_type").alias("holiday_type"))


def filter_dedup_holidays(documents: DataFrame, names: list[str] | None = None,
                          holidays_col: str = "holidays", order_col: str = "year") -> DataFrame:
    """Keep listed names with a non-empty name and date; one record per (name, iso).

    The first record (by document, then position in the document) wins.  The
    choice is an aggregate (``min_by``), so a hot (name, iso) key is reduced
    map-side instead of landing in one task.
    """
    names = RETAIL_HOLIDAYS if names is None else names
    e = documents.select(F.col(order_col).alias("__doc"),
                         F.posexplode(holidays_col).alias("__pos", "h"))
    name, iso = F.col("h.name"), F.col("h.date.iso")
    kept = e.where(name.isin(names) & name.isNotNull() & (name != "")
                   & iso.isNotNull() & (iso != ""))
    first = kept.groupBy(name.alias("name"), iso.alias("iso")).agg(
        F.min_by(F.struct(F.col("__doc"), F.col("__pos"), F.col("h")),
                 F.struct(F.col("__doc"), F.col("__pos"))).alias("w"))
    return first.select(F.col("w.__doc").alias(order_col), F.col("w.__pos").alias("position"),
                        F.col("w.h").alias("record"))


def to_documents(records: DataFrame, order_col: str = "year") -> DataFrame:
    """Re-wrap filtered records as one document per ``order_col`` (JSON file shape)."""
    return records.groupBy(order_col).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("position", "record"))),
                    lambda x: x["record"]).alias("holidays"))


def flatten_weather(payloads: DataFrame, region_col: str = "region",
                    payload_col: str = "payload") -> DataFrame:
    """Parallel daily arrays -> one row per ``time`` entry, tagged with the region.

    A metric array shorter than ``time`` yields NULLs, a longer one is cut;
    a payload without ``daily`` yields no rows.  The rows are built with one
    ``transform`` per payload and ``inline``, so no array is copied per row.
    """
    daily = F.col(f"{payload_col}.daily")
    x = payloads.select(F.col(region_col).alias("weather_region"), daily.alias("d"))
    out = ["temp_c", "precipitation_mm", "snowfall_cm", "wind_speed_kmh"]

    def row(t, i):
        return F.struct(t.alias("weather_date"),
                        *[F.get(F.col(f"d.{m}"), i).alias(o) for m, o in zip(WEATHER_METRICS, out)])

    rows = x.select("weather_region", F.inline(F.transform(F.col("d.time"), row)))
    return rows.select("weather_region", "weather_date", *out)


def union_all(frames: list[DataFrame]) -> DataFrame:
    """Union by column name; columns missing in a frame are NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
