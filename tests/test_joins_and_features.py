"""Joins (J1-J3) and engineered features (X3) on literal rows."""

import datetime as dt


import pytest
from pyspark.sql import functions as F

from martforge.operators.days import daily_sales, thanksgiving_by_year
from martforge.operators.features import engineer_features
from martforge.operators.joins import join_sales_customers, join_sales_holidays, join_sales_weather
from martforge.schemas import HOLIDAYS

D = dt.date


def test_join_customers_prefix_and_unmatched(spark):
    sales = spark.createDataFrame([("C1", "O1"), ("C2", "O2"), (None, "O3")], "`Customer ID` string, `Order ID` string")
    dim = spark.createDataFrame([("C1", "Ann", "Consumer", "NYC", "NY", "East")],
                                "customer_id string, customer_name string, segment string, city string, state string, region string")
    out = join_sales_customers(sales, dim)
    assert "customer_id" not in out.columns
    got = {r["Order ID"]: (r.db_customer_name, r.db_region) for r in out.collect()}
    assert got == {"O1": ("Ann", "East"), "O2": (None, None), "O3": (None, None)}


def test_join_holidays_match_and_fanout(spark):
    sales = spark.createDataFrame([(D(2014, 11, 27), 100.0), (D(2014, 11, 28), 50.0)], "`Order Date` date, Sales double")
    h = spark.createDataFrame([("Thanksgiving Day", D(2014, 11, 27))], HOLIDAYS)
    got = sorted((r["Order Date"], r.holiday_name) for r in join_sales_holidays(sales, h).collect())
    assert got == [(D(2014, 11, 27), "Thanksgiving Day"), (D(2014, 11, 28), None)]
    h2 = h.unionByName(spark.createDataFrame([("Other Day", D(2014, 11, 27))], HOLIDAYS))
    assert join_sales_holidays(sales, h2).where("`Order Date` = date'2014-11-27'").count() == 2


def test_join_weather_region_precedence(spark):
    sales = spark.createDataFrame([(D(2014, 11, 27), "Central", "East"), (D(2014, 11, 28), "West", None),
                                   (D(2014, 11, 29), "South", "South")],
                                  "`Order Date` date, Region string, db_region string")
    w = spark.createDataFrame([("2014-11-27", "East", 1.5, 0.0, 0.0, 5.0), ("2014-11-27", "Central", 9.9, 0.0, 0.0, 5.0),
                               ("2014-11-28", "West", 15.0, 0.0, 0.0, 5.0), ("2014-11-29", "East", 3.0, 0.0, 0.0, 5.0)],
                              "weather_date string, weather_region string, temp_c double, precipitation_mm double, snowfall_cm double, wind_speed_kmh double")
    out = join_sales_weather(sales, w)
    assert not any(c.startswith("__") for c in out.columns)
    got = sorted((r["Order Date"], r.temp_c) for r in out.collect())
    assert got == [(D(2014, 11, 27), 1.5), (D(2014, 11, 28), 15.0), (D(2014, 11, 29), None)]


def _features(spark, rows, holidays):
    df = spark.createDataFrame(rows, "holiday_name string, `Order Date` date, Sales double, Profit double")
    h = spark.createDataFrame(holidays, HOLIDAYS)
    return engineer_features(df, h)


def test_engineer_features_reference_rows(spark):
    holidays = [("Thanksgiving Day", D(2014, 11, 27)), ("Christmas Day", D(2014, 12, 25))]
    rows = [(None, D(2014, 8, 15), 80.0, 20.0), ("Thanksgiving Day", D(2014, 11, 27), 100.0, 25.0),
            (None, D(2014, 11, 28), 200.0, -10.0), (None, D(2014, 11, 30), 50.0, 10.15)]
    out = {r["Order Date"]: r for r in _features(spark, rows, holidays).collect()}
    a, b, c, d = (out[D(2014, 8, 15)], out[D(2014, 11, 27)], out[D(2014, 11, 28)], out[D(2014, 11, 30)])
    assert (a.holiday_flag, a.weekend_flag, a.profit_margin, a.back_to_school_flag) == (0, 0, 25.0, 1)
    assert (a.holiday_shopping_season_flag, a.days_until_next_holiday, a.days_since_last_holiday) == (0, 104, None)
    assert (a.rolling_sales_7d, a.rolling_sales_30d) == (80.0, 80.0)
    assert (b.holiday_flag, b.profit_margin, b.holiday_shopping_season_flag) == (1, 25.0, 1)
    assert (b.days_until_next_holiday, b.days_since_last_holiday, b.rolling_sales_7d) == (0, 0, 100.0)
    assert (c.days_until_next_holiday, c.days_since_last_holiday, c.rolling_sales_7d) == (27, 1, 150.0)
    assert (d.weekend_flag, d.days_until_next_holiday, d.days_since_last_holiday) == (1, 25, 3)
    assert (d.rolling_sales_7d, d.rolling_sales_30d, d.holiday_shopping_season_flag) == (116.67, 116.67, 1)
    assert (d.temp_c, d.is_raining, d.is_snowing, d.extreme_weather_flag) == (None, 0, 0, 0)
    assert (d.month, d.year, d.quarter) == (11, 2014, 4)


def test_engineer_features_edges(spark):
    holidays = [("Thanksgiving Day", D(2014, 11, 27)), ("Christmas Day", D(2014, 12, 25))]
    rows = [(None, None, 10.0, 1.0), (None, D(2014, 12, 26), 0.0, 1.0), (None, D(2014, 12, 25), 1.0, 1.0),
            (None, D(2015, 12, 1), 1.0, 1.0), (None, D(2014, 7, 14), 1.0, 1.0), (None, D(2014, 7, 15), 1.0, 1.0),
            (None, D(2014, 8, 31), 1.0, 1.0), (None, D(2014, 9, 1), 1.0, 1.0)]
    out = {r["Order Date"]: r for r in _features(spark, rows, holidays).collect()}
    n = out[None]
    assert (n.rolling_sales_7d, n.days_until_next_holiday, n.holiday_shopping_season_flag, n.weekend_flag) == (None, None, 0, 0)
    assert out[D(2014, 12, 26)].profit_margin is None                      # Sales = 0
    assert out[D(2014, 12, 26)].days_until_next_holiday is None            # after the last holiday
    assert out[D(2014, 12, 26)].holiday_shopping_season_flag == 0
    assert out[D(2014, 12, 25)].holiday_shopping_season_flag == 1
    assert out[D(2015, 12, 1)].holiday_shopping_season_flag == 0           # year without Thanksgiving
    assert [out[D(2014, m, d)].back_to_school_flag for m, d in [(7, 14), (7, 15), (8, 31), (9, 1)]] == [0, 1, 1, 0]


def test_engineer_features_empty_holidays_and_weather(spark):
    df = spark.createDataFrame(
        [(None, D(2014, 1, 1), 1.0, 1.0, 5.0, 0.0, 12.0), (None, D(2014, 1, 2), 1.0, 1.0, 0.0, 0.0, 45.0),
         (None, D(2014, 1, 3), 1.0, 1.0, 0.0, 6.0, 15.0), (None, D(2014, 1, 4), 1.0, 1.0, 0.0, 0.0, 10.0),
         (None, D(2014, 1, 5), 1.0, 1.0, 25.0, 5.0, 40.0), (None, D(2014, 1, 6), 1.0, 1.0, None, None, None)],
        "holiday_name string, `Order Date` date, Sales double, Profit double, precipitation_mm double, snowfall_cm double, wind_speed_kmh double")
    out = {r["Order Date"].day: r for r in engineer_features(df, spark.createDataFrame([], HOLIDAYS)).collect()}
    flags = [(out[i].is_raining, out[i].is_snowing, out[i].extreme_weather_flag) for i in range(1, 7)]
    assert flags == [(1, 0, 0), (0, 0, 1), (0, 1, 1), (0, 0, 0), (1, 1, 0), (0, 0, 0)]
    assert all(out[i].days_until_next_holiday is None and out[i].days_since_last_holiday is None
               and out[i].holiday_shopping_season_flag == 0 for i in out)


def test_rolling_uses_day_numbers_not_local_seconds(spark):
    rows = [(None, D(2017, 11, 1) + dt.timedelta(days=i), 10.0 * (i + 1), 1.0) for i in range(12)]
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        results = []
        for tz in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            results.append(sorted((r["Order Date"], r.rolling_sales_7d) for r in _features(spark, rows, []).collect()))
        assert results[0] == results[1]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_daily_sales_and_thanksgiving(spark):
    df = spark.createDataFrame([(D(2014, 1, 1), 1.25), (D(2014, 1, 1), 2.5), (None, 4.0)], "`Order Date` date, Sales double")
    got = {r["Order Date"]: r.total_daily_sales for r in daily_sales(df).collect()}
    assert got == {D(2014, 1, 1): 3.75, None: 4.0}
    h = spark.createDataFrame([("Thanksgiving Day", D(2014, 11, 27)), ("Thanksgiving Day", D(2015, 11, 26)),
                               ("Christmas Day", D(2014, 12, 25))], HOLIDAYS)
    assert sorted(tuple(r) for r in thanksgiving_by_year(h).collect()) == [(2014, D(2014, 11, 27)), (2015, D(2015, 11, 26))]


def test_day_with_only_null_sales_keeps_proximity(spark):
    rows = [(None, D(2014, 11, 20), None, 1.0), (None, D(2014, 11, 21), 10.0, 1.0)]
    out = {r["Order Date"]: r for r in _features(spark, rows, [("Thanksgiving Day", D(2014, 11, 27))]).collect()}
    a = out[D(2014, 11, 20)]
    assert (a.days_until_next_holiday, a.rolling_sales_7d) == (7, None)
    assert out[D(2014, 11, 21)].rolling_sales_7d == 10.0


def test_daily_totals_from_text_match_row_level(spark):
    from martforge.functions.cleaning import parse_text_date
    from martforge.functions.measures import as_double
    from martforge.operators.days import daily_totals_from_text
    raw = spark.createDataFrame(
        [("1/5/2014", 10.25), ("01/05/2014", 1.5), ("1/6/2014", 2.0), ("", 4.0), (None, 1.0),
         ("13/45/2014", 3.0), ("12/25/2014", 7.0), ("12/25/2014", None)], "`Order Date` string, Sales double")
    h = spark.createDataFrame([("Christmas Day", D(2014, 12, 25)), ("Other", D(2014, 12, 25)),
                               ("New Day", D(2014, 1, 6))], HOLIDAYS)
    from martforge.plans.wide import clean_sales
    rowwise = {r["Order Date"]: r.total_daily_sales
               for r in daily_sales(join_sales_holidays(clean_sales(raw.withColumn("Product Name", F.lit("x"))), h)).collect()}
    totals = daily_totals_from_text(raw, h, parse_text_date)
    fast = {r[0]: r[1] for r in totals.select("Order Date", as_double(F.col("total"), F.col("special"))).collect()}
    assert fast == rowwise
    assert fast[D(2014, 1, 5)] == 11.75 and fast[D(2014, 12, 25)] == 14.0 and fast[None] == 8.0


def test_rolling_within_groups_and_nan(spark):
    from martforge.operators.days import daily_totals, rolling_sales
    import math
    rows = [("a", D(2014, 1, 1), 10.0), ("a", D(2014, 1, 3), 20.0), ("b", D(2014, 1, 2), 7.0),
            ("b", D(2014, 1, 20), float("nan")), ("b", D(2014, 2, 25), 3.0)]
    df = spark.createDataFrame(rows, "r string, `Order Date` date, Sales double")
    got = {(x.r, x["Order Date"].day): x for x in
           rolling_sales(daily_totals(df, partition_by=("r",)), partition_by=("r",)).collect()}
    assert got["a", 3].rolling_sales_7d == 15.0 and got["b", 2].rolling_sales_7d == 7.0
    assert math.isnan(got["b", 20].rolling_sales_30d) and got["b", 25].rolling_sales_30d == 3.0


def test_distances_beyond_and_between_holidays(spark):
    from martforge.operators.days import add_proximity
    h = spark.createDataFrame([("x", D(2014, 3, 1)), ("y", D(2014, 3, 1)), ("z", D(2014, 3, 5)), (None, None)], HOLIDAYS)
    days = [D(2010, 1, 1), D(2014, 2, 28), D(2014, 3, 1), D(2014, 3, 3), D(2014, 3, 5), D(2014, 3, 9), None]
    rows = spark.createDataFrame([(d,) for d in days], "`Order Date` date")
    got = {r[0]: (r[1], r[2]) for r in add_proximity(rows, h).collect()}
    assert got == {D(2010, 1, 1): (1520, None), D(2014, 2, 28): (1, None), D(2014, 3, 1): (0, 0), D(2014, 3, 3): (2, 2),
                   D(2014, 3, 5): (0, 0), D(2014, 3, 9): (None, 4), None: (None, None)}


def _lines_and_customers(spark):
    """Lines of a hot customer, of one without id, of ids that no customer has, without date or order id; customers of one name."""
    lines = spark.range(0, 600).select(
        F.col("id").alias("Row ID"), F.when(F.col("id") % 17 > 0, (F.col("id") / 3).cast("int").cast("string")).alias("Order ID"),
        F.when(F.col("id") % 11 > 0, F.date_add(F.lit("1996-01-30").cast("date"), (F.col("id") % 90).cast("int"))).alias("Order Date"),
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 7 > 0, F.concat(F.lit("C"), (F.col("id") % 40).cast("string")))
        .alias("Customer ID"))
    dim = spark.range(0, 30).select(
        F.when(F.col("id") == 0, "hot").otherwise(F.concat(F.lit("C"), F.col("id").cast("string"))).alias("customer_id"),
        F.concat(F.lit("name-"), (F.col("id") % 4).cast("string")).alias("customer_name"), F.lit("S").alias("segment"),
        F.when(F.col("id") % 5 > 0, "c").alias("city"), F.lit("t").alias("state"), F.lit("r").alias("region"))
    return lines, dim


@pytest.mark.parametrize("hashed", [500_000, 0])
def test_customers_follow_the_lines_to_their_place(spark, monkeypatch, hashed):
    """The rows are those of the plain join; lines are exchanged once and lie where ``clustered_task`` says."""
    from martforge.operators import joins
    from martforge.sources import files
    monkeypatch.setattr(joins, "HASHED_CUSTOMERS", hashed)
    lines, dim = _lines_and_customers(spark)
    task = files.clustered_task([F.year("Order Date"), F.month("Order Date")], ["Order ID"], 5, 2)
    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        placed = joins.join_sales_customers_in_place(lines, dim, task, 5)
        plain = joins.join_sales_customers(lines, dim)
        plan = placed._jdf.queryExecution().executedPlan().toString()
        assert ("ShuffledHashJoin [__task" in plan) == (hashed > 0) and ("SortMergeJoin [__task" in plan) == (hashed == 0)
        assert plan.count("Exchange shufflepartitionidpassthrough") == 2  # of the lines and of the customers
        assert plan.count("Exchange") == 4  # and by customer: of the ids with their tasks, and of the dimension
        assert placed.columns == plain.columns and placed.count() == 600
        assert placed.exceptAll(plain).isEmpty() and plain.exceptAll(placed).isEmpty()
        assert placed.where("db_customer_name is not null").count() > 300
        where = placed.select(F.spark_partition_id().alias("at"), task.alias("task"), F.year("Order Date").alias("y"), F.month("Order Date").alias("m"))
        assert where.where("at != task").isEmpty()
        assert where.groupBy("y", "m").agg(F.count_distinct("at").alias("n")).where("n > 2").isEmpty()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)
