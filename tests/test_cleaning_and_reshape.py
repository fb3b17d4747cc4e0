"""Cleaning (X1), holiday/weather reshaping (X2, X8, G2), column operators."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martforge.functions.cleaning import clean_text
from martforge.functions.columns import add_missing_columns, normalize_columns, rename_positional, schema_table
from martforge.operators.reshape import (filter_dedup_holidays, flatten_holidays, flatten_weather,
                                         holiday_types, union_all)
from martforge.plans.wide import clean_sales
from martforge.schemas import WEATHER_PAYLOAD

HOL = T.StructType([T.StructField("holidays", T.ArrayType(T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("date", T.StructType([T.StructField("iso", T.StringType())])),
    T.StructField("primary_type", T.StringType())])))])


def test_clean_sales_dates_and_names(spark):
    rows = [("11/27/2014", "Staples, Bulk"), ("12/25/2017", "\u0093Quoted\u0094"),
            ("01/01/2015", "No break"), ("13/45/2014", "x"), ("11/27/2014 x", "y"),
            (None, None), ("", "z")]
    df = spark.createDataFrame(rows, "`Order Date` string, `Product Name` string")
    got = [tuple(r) for r in clean_sales(df).collect()]
    assert got == [(dt.date(2014, 11, 27), "Staples - Bulk"), (dt.date(2017, 12, 25), '"Quoted"'),
                   (dt.date(2015, 1, 1), "No break"), (None, "x"), (None, "y"), (None, None),
                   (None, "z")]
    assert clean_sales(df).columns == ["Order Date", "Product Name"]


def test_names_are_cleaned_without_taking_texts_apart(spark):
    rows = [("a,b,,c",), ("\u0093\u0094\u00a0,\u00a0é\u0093x\U0001F600",), ("",), (None,), ("plain",)]
    out = spark.createDataFrame(rows, "name string").select(clean_text("name").alias("name"))
    assert [r.name for r in out.collect()] == ["a -b - -c", '""  - é"x\U0001F600', "", None, "plain"]
    assert "translate(" not in out._jdf.queryExecution().toString()


def test_flatten_holidays_and_edge_arrays(spark):
    doc = [([("New Year's Day", ("2014-01-01",), "National"), ("Christmas Day", ("2014-12-25",), "National")],),
           ([],), (None,), ([("Equinox", ("2014-03-20T12:57:00-04:00",), "Season")],)]
    df = spark.createDataFrame(doc, HOL)
    got = sorted(tuple(r) for r in flatten_holidays(df).collect())
    assert got == [("Christmas Day", dt.date(2014, 12, 25)), ("Equinox", dt.date(2014, 3, 20)),
                   ("New Year's Day", dt.date(2014, 1, 1))]
    types = holiday_types(df).where("holiday_name = 'Equinox'").collect()[0]
    assert types.holiday_date == "2014-03-20T12:57:00-04:00" and types.holiday_type == "Season"


def test_filter_dedup_holidays(spark):
    recs = [("New Year's Day", ("2014-01-01",), "a"), ("New Year's Day", ("2014-01-01",), "b"),
            ("Christmas Day", ("2014-12-25",), "c"), ("Random Day", ("2014-05-05",), "d"),
            ("Independence Day", None, "e"), (None, ("2014-07-04",), "f"),
            ("Labor Day", ("",), "g"), ("", ("2014-09-01",), "h")]
    df = spark.createDataFrame([(2014, recs)], T.StructType([T.StructField("year", T.IntegerType())] + HOL.fields))
    out = filter_dedup_holidays(df, ["New Year's Day", "Christmas Day", "Independence Day", "Labor Day", ""])
    got = sorted((r.record.name, r.record.date.iso, r.record.primary_type) for r in out.collect())
    assert got == [("Christmas Day", "2014-12-25", "c"), ("New Year's Day", "2014-01-01", "a")]


def test_flatten_weather_lengths(spark):
    rows = [("East", (( ["2014-01-01", "2014-01-02"], [1.5, 2.5], [5.0, 0.0], [0.0, 6.0], [12.0, 45.0]),)),
            ("West", ((["2014-01-01", "2014-01-02", "2014-01-03"], [1.0], [0.0, 1.0, 2.0, 3.0], None, [1.0, 2.0, 3.0]),)),
            ("South", None), ("North", (None,))]
    df = spark.createDataFrame(rows, WEATHER_PAYLOAD)
    out = flatten_weather(df)
    assert out.columns == ["weather_region", "weather_date", "temp_c", "precipitation_mm",
                           "snowfall_cm", "wind_speed_kmh"]
    got = sorted(tuple(r) for r in out.collect())
    assert got == [("East", "2014-01-01", 1.5, 5.0, 0.0, 12.0), ("East", "2014-01-02", 2.5, 0.0, 6.0, 45.0),
                   ("West", "2014-01-01", 1.0, 0.0, None, 1.0), ("West", "2014-01-02", None, 1.0, None, 2.0),
                   ("West", "2014-01-03", None, 2.0, None, 3.0)]


def test_column_operators(spark):
    df = spark.createDataFrame([(1, "a")], "`Sub-Category` int, ` Order Date ` string")
    assert normalize_columns(df).columns == ["sub_category", "order_date"]
    clash = spark.createDataFrame([(1, 2)], "`A B` int, `a-b` int")
    with pytest.raises(ValueError):
        normalize_columns(clash)
    assert rename_positional(df, ["x", "y"]).columns == ["x", "y"]
    with pytest.raises(ValueError):
        rename_positional(df, ["x"])
    added = add_missing_columns(df, ["temp_c", "sub-x"])
    assert added.columns[-2:] == ["temp_c", "sub-x"] and added.schema["temp_c"].dataType == T.DoubleType()
    st = schema_table(df).collect()
    assert [(r.column_name, r.data_type) for r in st] == [("Sub-Category", "int"), (" Order Date ", "string")]


def test_union_all_fills_missing(spark):
    a = spark.createDataFrame([(1, 2.0)], "k int, x double")
    b = spark.createDataFrame([(2, "s")], "k int, y string")
    got = sorted(tuple(r) for r in union_all([a, b]).collect())
    assert got == [(1, 2.0, None), (2, None, "s")]


def test_packed_texts_come_back_as_they_were(spark):
    """Empty texts, NULL, the marks themselves and bytes that are no UTF-8."""
    from martforge.functions.columns import pack_texts, unpack_texts
    texts = ["", None, "plain", "\u0001", "\u0002", "\u0002n", "\u0002e", "\u0002x41", "a\u0001\u0002m\u0002\u0002b\u0001",
             "\u0093é\u0094 ", "bad"]
    rows = [(i, a, b) for i, (a, b) in enumerate((a, b) for a in texts for b in texts)]
    df = spark.createDataFrame(rows, "id int, `a b` string, b string")
    bad = F.when(F.col("b") == "bad", F.unhex(F.lit("41FFC30201")).cast("string")).otherwise(F.col("b"))
    df = df.withColumn("b", bad)
    back = unpack_texts(df.select("id", pack_texts(["a b", "b"]).alias("p")).repartition(3), "p", ["a b", "b"])
    assert back.columns == ["id", "a b", "b"]
    hexed = [F.hex(F.col(f"`{c}`").cast("binary")).alias(c) for c in ("a b", "b")]
    assert sorted(map(str, back.select("id", *hexed).collect())) == sorted(map(str, df.select("id", *hexed).collect()))
    none = df.select("id", pack_texts([]).alias("p"))
    assert unpack_texts(none, "p", []).columns == ["id"]
