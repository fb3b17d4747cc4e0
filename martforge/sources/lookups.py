"""Small fixed lookups (always broadcast: their size is fixed here)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The holidays that drive retail sales (names match exactly).
RETAIL_HOLIDAYS = [
    "New Year's Day",
    "Martin Luther King Jr. Day",
    "Presidents' Day",
    "Memorial Day",
    "Independence Day",
    "Labor Day",
    "Columbus Day",
    "Veterans Day",
    "Thanksgiving Day",
    "Christmas Day",
    "Valentine's Day",
    "Mother's Day",
    "Father's Day",
]
THANKSGIVING = "Thanksgiving Day"

# Sales regions and the city whose weather stands for each.
REGIONS = [
    ("Central", 41.8781, -87.6298, "Chicago"),
    ("East", 40.7128, -74.0060, "New York"),
    ("South", 33.7490, -84.3880, "Atlanta"),
    ("West", 34.0522, -118.2437, "Los Angeles"),
]
REGION_NAMES = [r[0] for r in REGIONS]


def region_lookup(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(REGIONS, "region string, lat double, lon double, city string")
