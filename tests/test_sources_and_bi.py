"""Derived holiday calendar against known dates; BI sheet ordering and top-N."""

import datetime as dt
import math

from pyspark.sql import functions as F

from martforge.operators import bi
from martforge.plans.wide import holidays_from_documents
from martforge.session import work_path
from martforge.sources import derived as D

D_ = dt.date


def test_holiday_rules_give_known_2014_dates(spark):
    base = work_path(spark, "orders-2014")
    spark.createDataFrame([(1, dt.datetime(2014, 3, 3)), (2, dt.datetime(2014, 9, 9))],
                          "o_orderkey long, o_orderdate timestamp_ntz").write.parquet(f"{base}/orders.parquet")
    got = sorted((r.holiday_date, r.holiday_name) for r in holidays_from_documents(D.holiday_documents(spark, base)).collect())
    assert got == [
        (D_(2014, 1, 1), "New Year's Day"), (D_(2014, 1, 20), "Martin Luther King Jr. Day"),
        (D_(2014, 2, 14), "Valentine's Day"), (D_(2014, 2, 17), "Presidents' Day"),
        (D_(2014, 5, 11), "Mother's Day"), (D_(2014, 5, 26), "Memorial Day"), (D_(2014, 6, 15), "Father's Day"),
        (D_(2014, 7, 4), "Independence Day"), (D_(2014, 7, 4), "Mother's Day"), (D_(2014, 9, 1), "Labor Day"),
        (D_(2014, 10, 13), "Columbus Day"), (D_(2014, 11, 11), "Veterans Day"),
        (D_(2014, 11, 27), "Thanksgiving Day"), (D_(2014, 12, 25), "Christmas Day"),
    ]


def _wide(spark):
    rows = [("O1", "C1", "Ann", "A", "East", "NY", "Tech", "Phones", "P1", 100.0, 10.0, 10.0, 1, 1, 2014, 0),
            ("O1", "C1", "Ann", "A", "East", "NY", "Tech", "Phones", "P2", 50.0, -5.0, -10.0, 1, 1, 2014, 0),
            ("O2", "C2", "Bob", "B", "West", "CA", "Office", "Paper", "P3", 20.0, 8.0, 40.0, 0, 2, 2016, 1),
            ("O3", "C3", "Cy", "B", "West", "CA", "Office", "Paper", "P3", 30.0, 3.0, 10.0, 0, 3, None, 1)]
    return spark.createDataFrame(rows, "order_id string, customer_id string, customer_name string, "
                                 "segment string, region string, state string, category string, "
                                 "sub_category string, product_name string, sales double, profit double, "
                                 "profit_margin double, holiday_flag int, month int, year int, weekend_flag int")


def test_kpis_and_ordering(spark):
    w = _wide(spark)
    k = bi.kpis(w).collect()[0]
    assert (k.total_sales, k.total_profit, k.total_orders, k.avg_profit_margin, k.total_customers) == (200.0, 16.0, 3, 12.5, 3)
    assert [tuple(r) for r in bi.measure_by(w, "category", "sales").collect()] == [("Office", 50.0), ("Tech", 150.0)]
    assert [tuple(r) for r in bi.measure_by(w, "holiday_flag", "sales", "avg").collect()] == [(0, 25.0), (1, 75.0)]
    assert [tuple(r) for r in bi.profit_trend_by_year(w).collect()] == [(None, 3.0), (2014, 5.0)]


def test_top_n_and_semi_join(spark):
    w = _wide(spark)
    assert [tuple(r) for r in bi.top_products(w, 2).collect()] == [("P2", 50.0), ("P1", 100.0)]  # tie: name order
    got = [tuple(r) for r in bi.top_customers(w, 2).collect()]
    assert got == [("Cy", 1, 3.0, 30.0), ("Bob", 1, 8.0, 20.0)]  # top-2 by AVG(profit): Bob 8, Cy 3
    assert [tuple(r) for r in bi.customers_by_segment(w).collect()] == [("A", 1), ("B", 2)]


def test_top_customers_rank_ids_not_names(spark):
    rows = [("c1", "Ann", 10.0), ("c2", "Ann", -10.0), ("c3", "Bob", 1.0), (None, "Eve", 99.0)]
    w = spark.createDataFrame(rows, "customer_id string, customer_name string, profit double").withColumns(
        {"order_id": F.lit("o"), "sales": F.lit(1.0)})
    assert [tuple(r) for r in bi.top_customers(w, 1).collect()] == [("Ann", 1, 10.0, 1.0)]
    assert [tuple(r) for r in bi.top_customers(w, 3).collect()] == [("Ann", 2, 0.0, 2.0), ("Bob", 1, 1.0, 1.0)]


def test_sheets_in_dimension_order(spark):
    w = _wide(spark)
    assert [r.month for r in bi.measure_by(w, "month", "sales", by_measure=False).collect()] == [1, 2, 3]
    assert [r.month for r in bi.measure_by(w, "month", "sales").collect()] == [2, 3, 1]


def test_money_is_exact_and_unbounded(spark):
    from martforge.functions.measures import money_avg, money_sum

    def total(values):
        df = spark.createDataFrame([(v,) for v in values], "x double").repartition(3)
        return tuple(df.agg(money_sum("x").alias("s"), money_avg("x").alias("a")).first())

    assert total([0.00004] * 10_000) == (0.4, 0.00004)  # five decimals stay
    big = 9.0e17  # far past 2**63 units of 1e-4
    assert total([big] * 40) == (3.6e19, big)
    assert total([1e30, 1.0]) == (1e30, 5e29)  # beyond the decimals
    assert all(math.isnan(v) for v in total([1.0, float("nan")]))
    assert total([0.1, 0.2, None]) == (0.3, 0.15)
    assert total([None]) == (None, None)
    df = spark.range(0, 300).select(F.lit(9.9e17).alias("x"))  # the total overflows the decimals
    assert df.agg(money_sum("x")).first()[0] == 9.9e17 * 300


def test_rows_in_top_semi_join(spark):
    w = _wide(spark)
    got = sorted(r.order_id for r in bi.rows_in_top(w, "customer_name", "profit", "avg", 2).collect())
    assert got == ["O2", "O3"]
