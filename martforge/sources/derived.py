"""Retail inputs derived by Spark from the TPC-H-style test tables.

The engine's inputs are a sales ledger, a customer dimension, holiday API
documents and weather API payloads.  The test tables hold none of these,
so this module derives each one, lazily and at the tables' scale, from
``lineitem ⋈ orders ⋈ customer ⋈ nation ⋈ region ⋈ part``.  Derivation
rules are plain data-driven expressions (no sampling, no id filters):

* Order Date is the order's date as ``M/d/yyyy`` text; low-priority pending
  orders carry no date yet (NULL).
* Profit is an invented margin: price * (0.25 - 3 * discount), in double.
* Pending orders of unspecified priority come without a customer id, so the
  ledger has rows that match no dimension row; every customer is in the
  dimension, and two neighbouring ids share a customer name.
* The lines of one order in 500 arrive twice (duplicate rows).
* Product names carry the odd characters of a Latin-1 extract.
* Four regions get the names the lookups know; the fifth keeps its own.
* Holidays: the calendar rules below for every year that has orders.
* Weather: one payload per region over the days that region has orders.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Table regions that stand for the sales regions.
REGION_OF = {"EUROPE": "Central", "ASIA": "East", "AFRICA": "South", "AMERICA": "West"}

_SCHEMAS: dict[str, object] = {}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet table; its schema is read from the footer once per process and
    then passed explicitly (no footer-reading job on every plan)."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    schema = _SCHEMAS.get(path)
    df = (spark.read.schema(schema) if schema is not None else spark.read).parquet(path)
    _SCHEMAS.setdefault(path, df.schema)
    return df


def _customer_geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer").select(
        "c_custkey", "c_nationkey", "c_mktsegment")
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    named = F.coalesce(*[F.when(F.col("r_name") == k, v) for k, v in REGION_OF.items()], F.col("r_name"))
    r = read_table(spark, sf_dir, "region").select("r_regionkey", named.alias("r_name"))
    c = c.withColumn("c_name", F.concat(F.lit("Customer "), (F.col("c_custkey") - F.col("c_custkey") % 2).cast("string")))
    # nation and region are tiny files: Spark broadcasts them by file size
    return (c.join(n, c.c_nationkey == n.n_nationkey)
             .join(r, n.n_regionkey == r.r_regionkey))


def _text_date(c: Column) -> Column:
    """``M/d/yyyy`` text (what the CSV extract holds), built from date parts."""
    d = c.cast("date")
    return F.concat_ws("/", F.month(d), F.dayofmonth(d), F.year(d))


def raw_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 21-column order-line ledger, dates still text (as the CSV has them)."""
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice",
        "l_discount", "l_shipdate")
    o = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority")
    p = read_table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type")
    # products meet the lines and customers the orders before lines and orders are joined: two exchanges
    # of lines instead of three, and the lines of an order come out side by side
    lines = li.join(p, li.l_partkey == p.p_partkey)
    geo = _customer_geo(spark, sf_dir)
    orders = o.join(geo, o.o_custkey == geo.c_custkey)
    j = lines.join(orders, li.l_orderkey == o.o_orderkey)
    undated = (F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "5-LOW")
    nobody = (F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "4-NOT SPECIFIED")
    twice = F.when(F.col("l_orderkey") % 500 == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return j.withColumn("copy", F.explode(twice)).select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("Row ID"),
        F.concat(F.lit("ORD-"), F.col("o_orderkey").cast("string")).alias("Order ID"),
        F.when(~undated, _text_date(F.col("o_orderdate"))).alias("Order Date"),
        _text_date(F.col("l_shipdate")).alias("Ship Date"),
        F.col("o_orderpriority").alias("Ship Mode"),
        F.when(~nobody, F.concat(F.lit("CUST-"), F.col("c_custkey").cast("string"))).alias("Customer ID"),
        F.col("c_name").alias("Customer Name"),
        F.col("c_mktsegment").alias("Segment"),
        F.lit("United States").alias("Country"),
        F.concat(F.lit("City "), F.col("c_nationkey").cast("string"), F.lit("-"),
                 (F.col("o_orderkey") % 4).cast("string")).alias("City"),
        F.col("n_name").alias("State"),
        (F.col("c_nationkey").cast("long") * 100 + F.col("o_orderkey") % 4).alias("Postal Code"),
        F.col("r_name").alias("Region"),
        F.concat(F.lit("PART-"), F.col("l_partkey").cast("string")).alias("Product ID"),
        F.col("p_type").alias("Category"),
        F.col("p_brand").alias("Sub-Category"),
        F.concat(F.col("p_name"), F.lit(", \u0093"), F.col("p_brand"), F.lit("\u0094\u00a0")).alias("Product Name"),
        F.col("l_extendedprice").alias("Sales"),
        F.col("l_quantity").cast("int").alias("Quantity"),
        F.col("l_discount").alias("Discount"),
        (F.col("l_extendedprice") * (F.lit(0.25) - F.col("l_discount") * F.lit(3.0))).alias("Profit"),
    )


def customer_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer_dim (6 columns), one row per customer."""
    g = _customer_geo(spark, sf_dir)
    return g.select(
        F.concat(F.lit("CUST-"), F.col("c_custkey").cast("string")).alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        F.col("c_mktsegment").alias("segment"),
        F.concat(F.lit("City "), F.col("c_nationkey").cast("string"), F.lit("-0")).alias("city"),
        F.col("n_name").alias("state"),
        F.col("r_name").alias("region"),
    )


# Holiday calendar rules used to build the API documents.
# (name, primary_type, rule, month, a, b, iso_suffix)
#   fixed: day a of the month; nth: b-th weekday a (Sunday=1 .. Saturday=7);
#   last: last weekday a of the month; none: the record carries no date.
HOLIDAY_RULES = [
    ("New Year's Day", "National holiday", "fixed", 1, 1, 0, ""),
    ("Martin Luther King Jr. Day", "National holiday", "nth", 1, 2, 3, ""),
    ("Valentine's Day", "Observance", "fixed", 2, 14, 0, ""),
    ("Presidents' Day", "National holiday", "nth", 2, 2, 3, ""),
    ("Tax Day", "Observance", "fixed", 4, 15, 0, ""),
    ("Mother's Day", "Observance", "nth", 5, 1, 2, ""),
    ("Memorial Day", "National holiday", "last", 5, 2, 0, ""),
    ("Father's Day", "Observance", "nth", 6, 1, 3, "T00:00:00-04:00"),
    ("Independence Day", "National holiday", "fixed", 7, 4, 0, ""),
    ("Labor Day", "National holiday", "nth", 9, 2, 1, ""),
    ("Columbus Day", "National holiday", "nth", 10, 2, 2, ""),
    ("Halloween", "Observance", "fixed", 10, 31, 0, ""),
    ("Veterans Day", "National holiday", "fixed", 11, 11, 0, ""),
    ("Thanksgiving Day", "National holiday", "nth", 11, 5, 4, ""),
    ("Christmas Eve", "Observance", "fixed", 12, 24, 0, ""),
    ("Christmas Day", "National holiday", "fixed", 12, 25, 0, ""),
    ("Christmas Day", "Christian", "fixed", 12, 25, 0, ""),
    ("Valentine's Day", "Observance", "none", 2, 0, 0, ""),
    ("Mother's Day", "Observance", "fixed", 7, 4, 0, ""),  # two holidays on one date
]


def _rule_date(year: Column, r: Column) -> Column:
    """Date of one rule (a struct of HOLIDAY_RULES fields) in ``year``."""
    first = F.make_date(year, r["month"], F.lit(1))
    last = F.last_day(first)
    return (F.when(r["rule"] == "fixed", F.make_date(year, r["month"], r["a"]))
            .when(r["rule"] == "nth", F.date_add(
                first, (r["a"] - F.dayofweek(first) + 7) % 7 + (r["b"] - 1) * 7))
            .when(r["rule"] == "last", F.date_sub(last, (F.dayofweek(last) - r["a"] + 7) % 7)))


def holiday_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One holiday API document per year that has orders: (year, holidays[])."""
    years = (read_table(spark, sf_dir, "orders")
             .select(F.year(F.col("o_orderdate").cast("date")).alias("year"))
             .where(F.col("year").isNotNull()).distinct())
    rules = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(t).alias("ptype"),
                               F.lit(r).alias("rule"), F.lit(m).alias("month"),
                               F.lit(a).alias("a"), F.lit(b).alias("b"), F.lit(x).alias("suffix"))
                      for n, t, r, m, a, b, x in HOLIDAY_RULES])
    entries = years.select(F.col("year").cast("int").alias("year"),
                           F.posexplode(rules).alias("pos", "r"))
    r = F.col("r")
    iso = F.concat(F.date_format(_rule_date(F.col("year"), r), "yyyy-MM-dd"), r["suffix"])
    record = F.struct(r["name"].alias("name"), F.struct(iso.alias("iso")).alias("date"),
                      r["ptype"].alias("primary_type"))
    # re-assembled by an aggregate (one group per year, bounded by the rule
    # list), so later explodes of the document are never pushed below it
    return entries.groupBy("year").agg(F.transform(
        F.array_sort(F.collect_list(F.struct(F.col("pos"), record.alias("h")))),
        lambda e: e["h"]).alias("holidays"))


def _weather_metrics(day: Column, region_key: Column) -> dict[str, Column]:
    """Deterministic stand-in readings for one region-day."""
    dn = F.unix_date(day)
    rk = region_key
    return {
        "temperature_2m_mean": ((dn * 7 + rk * 13) % 61 - 20).cast("double"),
        "precipitation_sum": F.greatest((dn * 11 + rk * 5) % 37 - 10, F.lit(0)).cast("double"),
        "snowfall_sum": F.when(F.month(day).isin(12, 1, 2), (dn * 3 + rk) % 8)
                         .otherwise(0).cast("double"),
        "wind_speed_10m_max": ((dn * 5 + rk * 7) % 47).cast("double"),
    }


def weather_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One weather API payload per region: parallel daily arrays.

    Each region's wind series ends ``r_regionkey`` days early and its
    precipitation series has one extra trailing value, like real payloads
    whose metric arrays differ in length from ``time``.
    """
    o = read_table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate")
    days = (o.join(_customer_geo(spark, sf_dir), o.o_custkey == F.col("c_custkey"))
             .select(F.col("o_orderdate").cast("date").alias("day"), "r_name", "r_regionkey")
             .where(F.col("day").isNotNull())
             .distinct())
    m = _weather_metrics(F.col("day"), F.col("r_regionkey"))
    per_day = days.select("r_name", "r_regionkey", F.struct(
        F.col("day"), F.date_format("day", "yyyy-MM-dd").alias("time"),
        *[v.alias(k) for k, v in m.items()]).alias("x"))
    # one group per region, holding at most one entry per calendar day
    series = per_day.groupBy("r_name", "r_regionkey").agg(
        F.array_sort(F.collect_list("x")).alias("s"))
    s = F.col("s")
    wind = F.transform(s, lambda e: e["wind_speed_10m_max"])
    daily = F.struct(
        F.transform(s, lambda e: e["time"]).alias("time"),
        F.transform(s, lambda e: e["temperature_2m_mean"]).alias("temperature_2m_mean"),
        F.concat(F.transform(s, lambda e: e["precipitation_sum"]),
                 F.array(F.lit(0.0))).alias("precipitation_sum"),
        F.transform(s, lambda e: e["snowfall_sum"]).alias("snowfall_sum"),
        F.slice(wind, 1, F.greatest(F.size(wind) - F.col("r_regionkey"), F.lit(0)))
         .alias("wind_speed_10m_max"),
    )
    return series.select(F.col("r_name").alias("region"),
                         F.struct(daily.alias("daily")).alias("payload"))
