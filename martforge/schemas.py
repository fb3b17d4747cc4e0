"""Explicit schemas for every input (no inference pass at read time)."""

from pyspark.sql import types as T

S, D, I, L, DT = T.StringType(), T.DoubleType(), T.IntegerType(), T.LongType(), T.DateType()


def _struct(*fields):
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# Raw order-line ledger as it arrives in the CSV extract (dates still text).
RAW_LEDGER = _struct(
    ("Row ID", L), ("Order ID", S), ("Order Date", S), ("Ship Date", S),
    ("Ship Mode", S), ("Customer ID", S), ("Customer Name", S), ("Segment", S),
    ("Country", S), ("City", S), ("State", S), ("Postal Code", L), ("Region", S),
    ("Product ID", S), ("Category", S), ("Sub-Category", S), ("Product Name", S),
    ("Sales", D), ("Quantity", I), ("Discount", D), ("Profit", D),
)
RAW_LEDGER_COLUMNS = RAW_LEDGER.fieldNames()
# Columns in which the lines of one order differ.
LINE_COLUMNS = ["Row ID", "Sales", "Quantity", "Discount", "Profit", "Ship Date", "Product ID",
                "Category", "Sub-Category", "Product Name"]

# Customer staging extract (8 columns) and the keyed dimension (6 columns).
CUSTOMER_EXTRACT_COLUMNS = [
    "Customer ID", "Customer Name", "Segment", "Country", "City", "State",
    "Postal Code", "Region",
]
CUSTOMER_STAGING_COLUMNS = [
    "customer_id", "customer_name", "segment", "country", "city", "state",
    "postal_code", "region",
]
CUSTOMER_DIM = _struct(
    ("customer_id", S), ("customer_name", S), ("segment", S), ("city", S),
    ("state", S), ("region", S),
)

# Holidays: nested API document and its flat form.
HOLIDAY_RECORD = _struct(
    ("name", S), ("date", _struct(("iso", S))), ("primary_type", S),
)
HOLIDAY_DOCUMENT = _struct(("year", I), ("holidays", T.ArrayType(HOLIDAY_RECORD)))
HOLIDAYS = _struct(("holiday_name", S), ("holiday_date", DT))

# Weather: one payload per region (parallel arrays) and flat records.
WEATHER_METRICS = ["temperature_2m_mean", "precipitation_sum", "snowfall_sum",
                   "wind_speed_10m_max"]
WEATHER_DAILY = _struct(("time", T.ArrayType(S)),
                        *[(m, T.ArrayType(D)) for m in WEATHER_METRICS])
WEATHER_PAYLOAD = _struct(("region", S), ("payload", _struct(("daily", WEATHER_DAILY))))
WEATHER = _struct(
    ("weather_region", S), ("weather_date", S), ("temp_c", D),
    ("precipitation_mm", D), ("snowfall_cm", D), ("wind_speed_kmh", D),
)
WEATHER_COLUMNS = ["temp_c", "precipitation_mm", "snowfall_cm", "wind_speed_kmh"]
