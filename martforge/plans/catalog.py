"""Every implemented operator as a query over the test tables.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame built from the
tables in ``sf_dir`` (see ``sources.derived``).  Most are lazy; day-grain
inputs are written once while the plan is built (``operators.sizing``), quality
suites count then, and the publishing keys write what they read back.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.calendar import back_to_school_flag, weekend_flag
from ..functions.cleaning import parse_text_date, to_number, to_timestamp_tolerant
from ..functions.columns import normalize_columns
from ..functions.measures import extreme_weather_flag, holiday_flag, positive_flag, profit_margin
from ..operators import bi, daystate, dims, distinct, profile
from ..operators import quality as Q
from ..operators import days
from ..operators.days import add_proximity, add_season, daily_sales, holiday_calendar, thanksgiving_by_year
from ..operators.features import engineer_features, row_features
from ..operators.joins import (join_sales_customers, join_sales_customers_in_place, join_sales_holidays,
                               join_sales_weather)
from ..operators.reshape import (filter_dedup_holidays, flatten_holidays, flatten_weather,
                                 holiday_types, to_documents, union_all)
from ..operators.sizing import broadcasts, materialize, materialize_counted
from ..schemas import CUSTOMER_DIM, CUSTOMER_EXTRACT_COLUMNS, HOLIDAYS, HOLIDAY_DOCUMENT, RAW_LEDGER, WEATHER
from ..session import work_path
from ..sources import derived as D
from ..sources import files, payloads
from ..sources.lookups import region_lookup
from ..sources.publish import read_table
from . import suites
from .wide import build_wide, clean_sales, holidays_from_documents, line_columns_last, sales_with_holidays

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

# Year span of the test tables (the suites' defaults are the reference's years).
DATA_FIRST_YEAR, DATA_LAST_YEAR = 1995, 2001
DQ_COLUMNS = ["dataset", "rule_id", "expectation_type", "column", "success", "element_count",
              "unexpected_count", "unexpected_percent", "observed", "error"]


def query(fn: Query) -> Query:
    REGISTRY[fn.__name__] = fn
    return fn


# ---------------------------------------------------------------- inputs
def raw(spark, sf):
    return D.raw_ledger(spark, sf)


def clean(spark, sf):
    return clean_sales(raw(spark, sf))


def holidays(spark, sf):
    return holidays_from_documents(D.holiday_documents(spark, sf))


def weather(spark, sf):
    return flatten_weather(D.weather_payloads(spark, sf))


def small_holidays(spark, sf):
    return materialize(holidays(spark, sf), "holidays")


def wide(spark, sf, r=None, customers=None, w=None, **how):
    r = raw(spark, sf) if r is None else r
    customers = D.customer_dimension(spark, sf) if customers is None else customers
    return build_wide(clean_sales(r), customers, holidays(spark, sf), weather(spark, sf) if w is None else w, raw=r, **how)


def features(spark, sf):
    """Ledger ⟕ holidays with the engineered columns (no customer/weather joins)."""
    h = small_holidays(spark, sf)
    r = raw(spark, sf)
    daily = days.daily_totals_from_text(r.select("Order Date", "Sales"), h, parse_text_date)
    return engineer_features(join_sales_holidays(clean_sales(r), h), h, daily=daily)


def bi_table(spark, sf):
    """The wide table's rows with the columns the sheets read.  The customer and
    weather joins are on unique keys and the day table is one row per date:
    none of them adds or drops rows, so the sheets do without them."""
    return normalize_columns(row_features(join_sales_holidays(clean(spark, sf), small_holidays(spark, sf))))


def proximity(spark, sf):
    """Ledger ⟕ holidays with holiday distances and season; no sales totals."""
    h = small_holidays(spark, sf)
    return add_season(add_proximity(join_sales_holidays(clean(spark, sf), h), h), h)


# ---------------------------------------------------------------- sources / sinks
@query
def csv_roundtrip(spark, sf):
    path = work_path(spark, "ledger-csv")
    files.write_csv(raw(spark, sf), path, encoding=files.LATIN_1, compression="gzip")
    return files.read_csv(spark, f"{path}/part-*", RAW_LEDGER, encoding=files.LATIN_1, null_value="null")


@query
def load_published(spark, sf):
    """The published CSV parts back as one table with folded names and typed dates."""
    table = sales_with_holidays(clean(spark, sf), holidays(spark, sf))
    path = work_path(spark, "published-csv")
    files.write_csv(table, path, compression="gzip")
    text = T.StructType([T.StructField(f.name, T.StringType() if isinstance(f.dataType, T.DateType) else f.dataType)
                         for f in table.schema.fields])
    dates = ["order_date", "ship_date", "holiday_date"]
    back = files.load_published(spark, f"{path}/part-*", text, dates)
    return back.withColumns({c: F.col(c).cast("timestamp_ntz") for c in dates})


@query
def publish_replaces(spark, sf):
    """K2: a second publish leaves no partition of the first behind."""
    path = work_path(spark, "published")
    table = clean(spark, sf).select("Row ID", "Sales", F.year("Order Date").alias("year"))
    files.write_table(table, path, partition_by=["year"])
    files.write_table(table.where(F.col("year") >= 1997), path, partition_by=["year"])
    return spark.read.parquet(path).groupBy("year").agg(F.count(F.lit(1)).alias("line_count"))


@query
def csv_misordered_parts(spark, sf):
    """Parts of one extract with their columns in another order, one without Postal Code
    and with a column more."""
    ledger, root = materialize(raw(spark, sf), "ledger"), work_path(spark, "ledger-parts")  # three parts, one run of the joins
    air, mail = F.col("Ship Mode") == "1-URGENT", F.col("Ship Mode") == "2-HIGH"
    air, mail = F.coalesce(air, F.lit(False)), F.coalesce(mail, F.lit(False))
    files.write_csv(ledger.where(~air & ~mail), f"{root}/a", encoding=files.LATIN_1, compression="gzip")
    files.write_csv(ledger.where(air).select(*[F.col(f"`{c}`") for c in reversed(ledger.columns)]), f"{root}/b", encoding=files.LATIN_1, compression="gzip")
    files.write_csv(ledger.where(mail).drop("Postal Code").withColumn("Carrier", F.lit("M")), f"{root}/c", encoding=files.LATIN_1, compression="gzip")
    return files.read_csv(spark, f"{root}/*/part-*", RAW_LEDGER, encoding=files.LATIN_1, null_value="null")


@query
def publish_keeps_old(spark, sf):
    """K2: a publish whose rows cannot all be made leaves the table before it; the next one replaces it."""
    path = work_path(spark, "published")
    table = clean(spark, sf).select("Row ID", "Sales", F.year("Order Date").alias("year"))
    files.write_table(table, path, partition_by=["year"])
    broken = F.when(F.col("year") == 1997, F.raise_error(F.lit("bad line")).cast("double")).otherwise(F.col("Sales"))
    try:
        files.write_table(table.withColumn("Sales", broken), path, partition_by=["year"])
        raise AssertionError("a broken publish ended well")
    except PySparkException:
        kept = read_table(spark, path).groupBy("year").agg(F.count(F.lit(1)).alias("first_lines"))
        kept = materialize(kept, "kept")
    files.write_table(table.where(F.col("year") >= 1997), path, partition_by=["year"])
    now = read_table(spark, path).groupBy("year").agg(F.count(F.lit(1)).alias("second_lines"))
    return kept.join(now, "year", "left")


@query
def dim_merge_in_place(spark, sf):
    """Two loads onto one stored dimension; the second rewrites the folders its keys fall into."""
    path, r = work_path(spark, "customer-dim-folders"), raw(spark, sf)
    early = F.coalesce(F.col("Ship Mode").isin("1-URGENT", "2-HIGH"), F.lit(False))  # NULL: late
    dims.merge_dimension(spark, path, _staging_rows(r.where(early)))
    dims.merge_dimension(spark, path, _staging_rows(r.where(~early)))
    return dims.read_dimension(spark, path)


@query
def union_weather_partial(spark, sf):
    """Weather of two regions, one part that is missing, weather of the rest."""
    w, parts = weather(spark, sf), [work_path(spark, f"weather-{k}") for k in ("a", "none", "b")]
    some = F.col("weather_region").isin("East", "West")
    files.write_json(w.where(some), parts[0])
    files.write_json(w.where(~some), parts[2])
    return files.union_available(spark, [lambda p=p: files.read_json(spark, p, WEATHER) for p in parts], WEATHER)


def _holiday_payloads(spark, sf):
    """Holiday documents as files of JSON text, one a year: 1995 is cut off, 1997 has no list of
    holidays, 1999 comes wrapped and with entries that are no records."""
    path = work_path(spark, "holiday-payloads")
    whole = F.to_json(F.struct("holidays"))
    wrapped = F.concat(F.lit('{"response": {"holidays": [7, null, '), F.expr("substring(to_json(holidays), 2)"), F.lit("}}"))
    text = (F.when(F.col("year") == 1995, F.expr("left(to_json(struct(holidays)), 40)"))
            .when(F.col("year") == 1997, F.to_json(F.struct(F.lit("moved").alias("holidays")))).when(F.col("year") == 1999, wrapped).otherwise(whole))
    D.holiday_documents(spark, sf).select(text.alias("value"), "year").write.partitionBy("year").text(path)
    found = payloads.read_payloads(spark, f"{path}/year=*")
    year = F.regexp_extract("source", "year=([0-9]+)", 1)
    return payloads.holiday_documents(found.select(year.cast("int").alias("year"), year.alias("source"), "payload"))


@query
def holidays_tolerant(spark, sf):
    """Retail holidays of the payloads that can be read; the bad years are left out."""
    return holidays_from_documents(payloads.accepted(_holiday_payloads(spark, sf)))


@query
def payload_report(spark, sf):
    """Payloads left out and why, entries skipped."""
    weather_docs = _weather_payloads(spark, sf)
    return payloads.report(_holiday_payloads(spark, sf)).unionByName(payloads.report(weather_docs, "region"))


def _weather_payloads(spark, sf):
    """Weather payloads as text: East answers with an error page, West has words among its temperatures."""
    daily = F.col("payload.daily")
    odd = F.transform(daily["temperature_2m_mean"].cast("array<string>"),
                      lambda x, i: F.when(i % 10 == 3, "calm").otherwise(x))
    text = (F.when(F.col("region") == "East", "<html>busy</html>")
            .when(F.col("region") == "West", F.to_json(F.struct(daily.withField("temperature_2m_mean", odd).alias("daily"))))
            .otherwise(F.to_json(F.struct(daily.alias("daily")))))
    return payloads.weather_payloads(D.weather_payloads(spark, sf).select("region", text.alias("payload")))


@query
def weather_tolerant(spark, sf):
    """Daily rows of the payloads that can be read."""
    return flatten_weather(payloads.accepted(_weather_payloads(spark, sf)))


def _day_state(spark, sf):
    """The day state after two batches: all lines but the low-priority ones of March, then those, late."""
    path, lines = work_path(spark, "day-state"), clean(spark, sf).select("Order Date", "Sales", "Ship Mode")
    late = F.coalesce(F.col("Ship Mode") == "5-LOW", F.lit(False)) & (F.month("Order Date") == 3)
    daystate.add_batch(spark, path, lines.where(~F.coalesce(late, F.lit(False))))
    return path, daystate.add_batch(spark, path, lines.where(late))


@query
def rolling_sales_from_state(spark, sf):
    """Averages of all days from the kept daily totals, after a late batch."""
    path, _ = _day_state(spark, sf)
    return daystate.rolling_from_state(spark, path, small_holidays(spark, sf))


@query
def rolling_sales_changed(spark, sf):
    """The averages that the late batch changed."""
    path, batch = _day_state(spark, sf)
    return daystate.changed_averages(spark, path, batch, small_holidays(spark, sf))


@query
def dim_first_load(spark, sf):
    """Create the dimension table if missing, upsert the extract, store, check the key."""
    path = work_path(spark, "customer-dim")
    old = dims.ensure_dimension(spark, path)
    new = dims.upsert_by_key(old, dims.staging_customers(dims.extract_customers(raw(spark, sf))))
    loaded = work_path(spark, "customer-dim")
    files.write_table(new.select(*CUSTOMER_DIM.fieldNames()), loaded)
    return dims.ensure_dimension(spark, loaded)


@query
def json_holidays_scan(spark, sf):
    path = work_path(spark, "holidays-json")
    files.write_json(to_documents(filter_dedup_holidays(D.holiday_documents(spark, sf))), path)
    return flatten_holidays(files.read_json(spark, path, HOLIDAY_DOCUMENT))


@query
def json_weather_scan(spark, sf):
    path = work_path(spark, "weather-json")
    files.write_json(weather(spark, sf), path)
    return files.read_json(spark, path, WEATHER)


@query
def holiday_join_missing_source(spark, sf):
    missing = work_path(spark, "no-such-holidays")
    docs = files.read_or_empty(spark, lambda: files.read_json(spark, missing, HOLIDAY_DOCUMENT),
                               HOLIDAY_DOCUMENT)
    h = flatten_holidays(docs)
    f = add_season(add_proximity(row_features(join_sales_holidays(clean(spark, sf), h)), h), h)
    return f.select("Row ID", "Order Date", "holiday_name", "holiday_date", "holiday_flag",
                    "days_until_next_holiday", "days_since_last_holiday",
                    "holiday_shopping_season_flag")


@query
def region_lookup_join(spark, sf):
    lines = raw(spark, sf).groupBy("Region").agg(F.count(F.lit(1)).alias("line_count"))
    lk = F.broadcast(region_lookup(spark).withColumnRenamed("region", "__lk_region"))
    return lines.join(lk, lines["Region"] == lk["__lk_region"], "left").select(
        "Region", "line_count", "lat", "lon", "city")


@query
def dim_key_unique(spark, sf):
    return dims.key_violations(D.customer_dimension(spark, sf))


# ---------------------------------------------------------------- joins
@query
def join_sales_customers_q(spark, sf):
    return join_sales_customers(clean(spark, sf), D.customer_dimension(spark, sf))


@query
def join_sales_holidays_q(spark, sf):
    j = join_sales_holidays(clean(spark, sf), small_holidays(spark, sf))
    return j.select("Row ID", "Order Date", "holiday_name", "holiday_date")


@query
def join_sales_weather_q(spark, sf):
    j = join_sales_customers(clean(spark, sf), D.customer_dimension(spark, sf))
    j = join_sales_weather(j, materialize(weather(spark, sf), "weather"))
    return j.select("Row ID", "Order Date", "Customer ID", "Region", "db_region", "temp_c",
                    "precipitation_mm", "snowfall_cm", "wind_speed_kmh")


@query
def sales_with_holidays_q(spark, sf):
    return sales_with_holidays(clean(spark, sf), holidays(spark, sf)).select(
        "Row ID", "Order Date", "holiday_name", "holiday_date", "holiday_flag")


# ---------------------------------------------------------------- reshape
@query
def flatten_holidays_q(spark, sf):
    return flatten_holidays(D.holiday_documents(spark, sf))


@query
def holiday_types_q(spark, sf):
    return holiday_types(D.holiday_documents(spark, sf))


@query
def filter_dedup_holidays_q(spark, sf):
    r = filter_dedup_holidays(D.holiday_documents(spark, sf))
    return r.select("year", "position", F.col("record.name").alias("name"),
                    F.col("record.date.iso").alias("iso"),
                    F.col("record.primary_type").alias("primary_type"))


@query
def flatten_weather_q(spark, sf):
    return weather(spark, sf)


@query
def union_weather(spark, sf):
    w = weather(spark, sf)
    a = w.select("weather_region", "weather_date", "temp_c", "precipitation_mm")
    b = w.select("weather_region", "weather_date", "snowfall_cm", "wind_speed_kmh")
    return union_all([a, b])


# ---------------------------------------------------------------- columns / cleaning
@query
def clean_sales_q(spark, sf):
    return clean(spark, sf)


@query
def clean_sales_typed(spark, sf):
    text = raw(spark, sf).select(*[F.col(f"`{c}`").cast("string").alias(c) for c in RAW_LEDGER.fieldNames()])
    # bad text: a unit in one number, no number in another
    text = text.withColumns({
        "Quantity": F.when(F.col("Ship Mode") == "1-URGENT", F.concat("Quantity", F.lit(" pcs"))).otherwise(F.col("Quantity")),
        "Sales": F.when(F.col("Ship Mode") == "2-HIGH", F.lit("n/a")).otherwise(F.col("Sales"))})
    return text.select(*[to_number(f.name, f.dataType.simpleString()).alias(f.name)
                         if f.dataType.simpleString() != "string" else F.col(f"`{f.name}`")
                         for f in RAW_LEDGER.fields])


@query
def normalize_columns_q(spark, sf):
    return normalize_columns(clean(spark, sf))


@query
def rename_positional(spark, sf):
    return dims.staging_customers(dims.extract_customers(raw(spark, sf)))


@query
def coerce_dates(spark, sf):
    n = normalize_columns(clean(spark, sf))
    types = dict((f.name, f.dataType) for f in n.schema.fields)
    return n.select("row_id", *[to_timestamp_tolerant(c, types[c]).cast("timestamp_ntz").alias(c)
                                for c in ("order_date", "ship_date")])


@query
def weather_flags_missing_cols(spark, sf):
    return features(spark, sf).select("Row ID", "temp_c", "precipitation_mm", "snowfall_cm",
                                      "wind_speed_kmh", "is_raining", "is_snowing",
                                      "extreme_weather_flag")


# ---------------------------------------------------------------- row features
@query
def date_parts(spark, sf):
    c = clean(spark, sf)
    d = F.col("Order Date")
    return c.select("Row ID", "Order Date", F.month(d).alias("month"), F.year(d).alias("year"),
                    F.quarter(d).alias("quarter"), F.dayofmonth(d).alias("day_of_month"),
                    F.dayofweek(d).alias("day_of_week"))


@query
def weekend_flag_q(spark, sf):
    return clean(spark, sf).select("Row ID", "Order Date",
                                   weekend_flag("Order Date").alias("weekend_flag"))


@query
def back_to_school_flag_q(spark, sf):
    return clean(spark, sf).select("Row ID", "Order Date",
                                   back_to_school_flag("Order Date").alias("back_to_school_flag"))


@query
def profit_margin_q(spark, sf):
    return clean(spark, sf).select("Row ID", "Sales", "Profit",
                                   profit_margin("Profit", "Sales").alias("profit_margin"))


@query
def holiday_flag_q(spark, sf):
    j = join_sales_holidays(clean(spark, sf), small_holidays(spark, sf))
    return j.select("Row ID", "Order Date", "holiday_name", holiday_flag().alias("holiday_flag"))


@query
def weather_flags(spark, sf):
    j = join_sales_customers(clean(spark, sf), D.customer_dimension(spark, sf))
    j = join_sales_weather(join_sales_holidays(j, small_holidays(spark, sf)), materialize(weather(spark, sf), "weather"))
    return j.select("Row ID", "Order Date", "precipitation_mm", "snowfall_cm", "wind_speed_kmh",
                    positive_flag("precipitation_mm").alias("is_raining"),
                    positive_flag("snowfall_cm").alias("is_snowing"),
                    extreme_weather_flag().alias("extreme_weather_flag"))


# ---------------------------------------------------------------- day-grain features
@query
def daily_sales_q(spark, sf):
    return daily_sales(join_sales_holidays(clean(spark, sf).select("Order Date", "Sales"),
                                           small_holidays(spark, sf)))


@query
def rolling_sales(spark, sf):
    return features(spark, sf).select("Row ID", "Order Date", "rolling_sales_7d",
                                      "rolling_sales_30d")


@query
def rolling_sales_by_region(spark, sf):
    """W1, W2 within each region: one row per region and date with sales."""
    lines = raw(spark, sf).select("Region", "Order Date", "Sales")
    totals = days.daily_totals_from_text(lines, small_holidays(spark, sf), parse_text_date, partition_by=("Region",))
    return days.rolling_sales(totals, partition_by=("Region",))


@query
def days_until_next_holiday(spark, sf):
    return proximity(spark, sf).select("Row ID", "Order Date", "days_until_next_holiday")


@query
def days_since_last_holiday(spark, sf):
    return proximity(spark, sf).select("Row ID", "Order Date", "days_since_last_holiday")


@query
def holiday_shopping_season(spark, sf):
    return proximity(spark, sf).select("Row ID", "Order Date", "holiday_shopping_season_flag")


@query
def holiday_proximity_empty(spark, sf):
    h = spark.createDataFrame([], HOLIDAYS)
    f = add_season(add_proximity(join_sales_holidays(clean(spark, sf), h), h), h)
    return f.select("Row ID", "Order Date", "days_until_next_holiday", "days_since_last_holiday",
                    "holiday_shopping_season_flag")


@query
def holiday_calendar_q(spark, sf):
    return holiday_calendar(holidays(spark, sf))


@query
def thanksgiving_by_year_q(spark, sf):
    return thanksgiving_by_year(holidays(spark, sf))


@query
def engineer_features_q(spark, sf):
    return features(spark, sf)


@query
def wide_analytics(spark, sf):
    return wide(spark, sf)


@query
def wide_from_stored_dimension(spark, sf):
    """X4 on X6: the wide table over the stored dimension, whose key the store vouches for."""
    path, r = work_path(spark, "customer-dim-wide"), raw(spark, sf)
    dims.merge_dimension(spark, path, D.customer_dimension(spark, sf))
    return build_wide(clean_sales(r), dims.read_dimension(spark, path), holidays(spark, sf), weather(spark, sf), raw=r,
                      kept_by=dims.stored_key(spark, path))


@query
def holiday_order_count(spark, sf):
    return bi_table(spark, sf).agg(F.count_if(F.col("holiday_flag") == 1).alias("holiday_order_lines"))


# ---------------------------------------------------------------- profile / dims
@query
def row_count(spark, sf):
    return profile.row_count(raw(spark, sf))


@query
def missing_by_column(spark, sf):
    return profile.missing_by_column(clean(spark, sf))


@query
def duplicate_rows(spark, sf):
    return profile.duplicate_rows(clean(spark, sf))


@query
def profile_sales(spark, sf):
    return profile.profile(clean(spark, sf).withColumn("Ship Date", parse_text_date("Ship Date")))


@query
def sample_rows(spark, sf, n: int = 10):
    c = clean(spark, sf)
    return c.orderBy(*[F.col(f"`{x}`").asc_nulls_first() for x in c.columns]).limit(n)


@query
def extract_customers(spark, sf):
    return dims.extract_customers(raw(spark, sf))


def _staging_rows(ledger):
    """Customer columns of every ledger row, under the staging names.  The
    dimension build picks a minimum per key, which duplicates cannot change,
    so the extract's DISTINCT (a second shuffle) is not needed here."""
    return dims.staging_customers(ledger.select(*CUSTOMER_EXTRACT_COLUMNS))


@query
def customer_dim_build(spark, sf):
    return dims.customer_dim_build(_staging_rows(raw(spark, sf)))


@query
def customer_dim_upsert(spark, sf):
    r = raw(spark, sf)
    early = F.coalesce(F.col("Ship Mode").isin("1-URGENT", "2-HIGH"), F.lit(False))  # NULL: late
    target = dims.customer_dim_build(_staging_rows(r.where(early)))
    return dims.upsert_by_key(target, _staging_rows(r.where(~early)))


# ---------------------------------------------------------------- quality
def _dq(results: DataFrame) -> DataFrame:
    return results.select(*DQ_COLUMNS)


# Rule sets run on the clean ledger, one key each (a passing and a failing case).
DQ_LEDGER_RULES = {
    "dq_not_null": [Q.not_null("Order ID"), Q.not_null("Order Date"), Q.not_null("missing")],
    "dq_between": [Q.between("Quantity", 1, 50), Q.between("Quantity", 10, 40),
                   Q.between("Discount", 0.0, 0.05)],
    "dq_between_date": [Q.between("Order Date", "1995-01-01", "2001-12-31", parse_date=True),
                        Q.between("Order Date", "1996-01-01", "1999-12-31", parse_date=True),
                        Q.between("Ship Date", "1995-01-01", "2001-06-30", parse_date=True)],
    "dq_in_set": [Q.in_set("Segment", ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD",
                                       "MACHINERY"]),
                  Q.in_set("Segment", ["AUTOMOBILE", "BUILDING"])],
    "dq_gte": [Q.gte("Sales", 0.0), Q.gte("Profit", 0.0), Q.gte("Quantity", 25)],
    "dq_row_count": [Q.row_count_between(1, 10 ** 12), Q.row_count_between(5000, 15000)],
}


def _ledger_rules(key):
    def run(spark, sf):
        return _dq(Q.validate(clean(spark, sf), DQ_LEDGER_RULES[key], "ledger",
                              sample_order=["Row ID"], samples=False))
    return run


for _key in DQ_LEDGER_RULES:
    REGISTRY[_key] = _ledger_rules(_key)

@query
def dq_in_table(spark, sf):
    """Q6 against a table: customer ids of the ledger that a part of the dimension lacks."""
    allowed = D.customer_dimension(spark, sf).where(F.col("region") != "South")
    return Q.not_in_table(raw(spark, sf), "Customer ID", allowed, "customer_id")


SUITE_YEARS = dict(first_year=DATA_FIRST_YEAR, last_year=DATA_LAST_YEAR)
SUITE_RULES = {
    "raw_sales": suites.sales_rules(**SUITE_YEARS),
    "raw_holidays": suites.holiday_rules(**SUITE_YEARS),
    "raw_weather": suites.weather_rules(),
    "final_analytics": suites.final_rules(**SUITE_YEARS),
}


def _suite_inputs(spark, sf, name=None):
    """Dataset -> (loader, rules, sample order).  What several suites read is stored once for all of
    them: the ledger and the weather (a suite of one of them alone reads it once), and the customers."""
    copies = {}

    def stored(key, make):
        if key not in copies:
            copies[key] = materialize(make(spark, sf), key)
        return copies[key]

    def ledger():
        return raw(spark, sf) if name == "raw_sales" else stored("ledger", raw)

    def days_weather():
        return weather(spark, sf) if name else stored("weather", weather)

    def final():
        return wide(spark, sf, ledger(), stored("customers", D.customer_dimension), days_weather(), join_customers=_by_month)

    return {
        "raw_sales": (ledger, SUITE_RULES["raw_sales"], ["Row ID"]),
        "raw_holidays": (lambda: holidays(spark, sf), SUITE_RULES["raw_holidays"],
                         ["holiday_date", "holiday_name"]),
        "raw_weather": (days_weather, SUITE_RULES["raw_weather"],
                        ["weather_region", "weather_date"]),
        "final_analytics": (final, SUITE_RULES["final_analytics"], ["Row ID"]),
    }


def _by_month(sales, customers):
    """The sales with their customers, placed for a table in folders of ``year`` and ``month``, each
    written by few tasks; the lines of an order stay together.  Customers too many for a broadcast
    are sent to that place, so that the order lines need not move to them first."""
    month, order = [F.year("Order Date"), F.month("Order Date")], ["Order ID"]
    if broadcasts(customers):
        return files.clustered(line_columns_last(join_sales_customers(sales, customers)), month, order)
    tasks = int(sales.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return join_sales_customers_in_place(sales, customers, files.clustered_task(month, order, tasks), tasks)


def _writer(spark, name, rules, order):
    """How a suite's dataset is written while it is checked: the final table is published
    as dashboards read it (``_by_month`` has placed its rows), of the others a copy of the
    checked columns is kept."""
    if name == "final_analytics":
        def publish(df, metrics):
            path = work_path(spark, "final-analytics")
            counted = files.write_table(df, path, partition_by=["year", "month"], metrics=metrics, compression="zstd")
            return read_table(spark, path, df.schema), counted
        return publish
    return lambda df, metrics: materialize_counted(Q.rule_columns(df, rules, order), metrics, f"checked-{name}")


def _suite(spark, sf, name):
    load, rules, order = _suite_inputs(spark, sf, name)[name]
    return Q.validate(load(), rules, name, sample_order=order, write=_writer(spark, name, rules, order))


def _suites(spark, sf):
    inputs = _suite_inputs(spark, sf)  # the ledger and the weather are stored already
    return suites.run_suites(inputs, lambda name: None if name in ("raw_sales", "raw_weather") else _writer(spark, name, *inputs[name][1:]))


@query
def dq_suite_sales(spark, sf):
    return _dq(_suite(spark, sf, "raw_sales"))


@query
def dq_suite_holidays(spark, sf):
    return _dq(_suite(spark, sf, "raw_holidays"))


@query
def dq_suite_weather(spark, sf):
    return _dq(_suite(spark, sf, "raw_weather"))


@query
def dq_suite_final(spark, sf):
    return _dq(_suite(spark, sf, "final_analytics"))


@query
def dq_results(spark, sf):
    return _dq(_suites(spark, sf))


@query
def dq_summary(spark, sf):
    return Q.summary(_suites(spark, sf))


@query
def dq_samples(spark, sf):
    res = _suite(spark, sf, "raw_sales").unionByName(_suite(spark, sf, "raw_weather"))
    return res.select("dataset", "rule_id", F.posexplode("unexpected_values").alias("sample_pos", "value"))


# ---------------------------------------------------------------- BI sheets
@query
def bi_kpis(spark, sf):
    return bi.kpis(bi_table(spark, sf))


@query
def bi_distinct_by_month(spark, sf):
    """Orders and customers per month and over all (year and month 0), from bitmaps of
    two loads that were numbered and kept one after the other."""
    w = bi_table(spark, sf).select("order_id", "customer_id", "year", "month", "ship_mode")
    w = materialize(w, "bi-ids")
    late = F.coalesce(F.col("ship_mode") == "5-LOW", F.lit(False))
    out = None
    for column, name in (("order_id", "orders"), ("customer_id", "customers")):
        path, parts = work_path(spark, f"{name}-numbers"), []
        for load in (w.where(~late), w.where(late)):
            numbers = distinct.number_keys(spark, path, load, column)
            parts.append(materialize(distinct.bitmaps(load, column, numbers, ["year", "month"]), f"{name}-bitmaps"))
        kept = parts[0].unionByName(parts[1])
        months = distinct.distinct_count(kept.where("year is not null"), ["year", "month"], name)
        whole = distinct.distinct_count(kept.withColumns({c: F.lit(None).cast("int") for c in ("year", "month")}), ["year", "month"], name)
        found = months.unionByName(whole).select(F.coalesce("year", F.lit(0)).alias("year"), F.coalesce("month", F.lit(0)).alias("month"), name)
        out = found if out is None else out.join(found, ["year", "month"], "full")
    return out


def _bi_measure(dim, measure, how, by_measure):
    def run(spark, sf):
        return bi.measure_by(bi_table(spark, sf), dim, measure, how, by_measure=by_measure)
    return run


# (key, dimension, measure, aggregate, sorted by the measure as on its sheet)
for _name, _dim, _measure, _how, _by in [
    ("bi_sales_trend_by_year", "year", "sales", "sum", False),
    ("bi_sales_by_category", "category", "sales", "sum", True),
    ("bi_profit_by_category", "category", "profit", "sum", True),
    ("bi_sales_by_sub_category", "sub_category", "sales", "sum", False),
    ("bi_sales_by_segment", "segment", "sales", "sum", True),
    ("bi_profit_by_segment", "segment", "profit", "sum", True),
    ("bi_sales_by_region", "region", "sales", "sum", True),
    ("bi_profit_by_region", "region", "profit", "sum", True),
    ("bi_sales_by_state", "state", "sales", "sum", False),
    ("bi_profit_by_state", "state", "profit", "sum", False),
    ("bi_avg_sales_by_holiday", "holiday_flag", "sales", "avg", False),
    ("bi_avg_profit_by_holiday", "holiday_flag", "profit", "avg", False),
    ("bi_sales_by_month", "month", "sales", "sum", False),
    ("bi_sales_by_weekend", "weekend_flag", "sales", "sum", False),
]:
    REGISTRY[_name] = _bi_measure(_dim, _measure, _how, _by)


@query
def bi_rows_in_top(spark, sf):
    """Order lines of the five products with the greatest sales."""
    return bi.rows_in_top(bi_table(spark, sf), "product_name", "sales", "sum", 5, ["row_id", "product_name", "sales"])


@query
def bi_profit_trend_by_year(spark, sf):
    return bi.profit_trend_by_year(bi_table(spark, sf))


@query
def bi_top_products(spark, sf):
    return bi.top_products(bi_table(spark, sf))


@query
def bi_top_customers(spark, sf):
    return bi.top_customers(bi_table(spark, sf))


@query
def bi_customers_by_segment(spark, sf):
    return bi.customers_by_segment(bi_table(spark, sf))


def queries() -> dict[str, Query]:
    """Registered queries under their inventory keys."""
    out = {}
    for k, v in REGISTRY.items():
        key = k[:-2] if k.endswith("_q") else k
        out[key] = v
    out["region_lookup"] = out.pop("region_lookup_join")
    return out
