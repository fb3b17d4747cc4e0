"""Quality rules (Q1-Q10), dimension build/upsert, profile, IO round trips."""

import datetime as dt
import math
import os

from pyspark.sql import functions as F

from martforge.operators import dims, profile
from martforge.operators import quality as Q
from martforge.session import work_path
from martforge.sources import files, jdbc

SCHEMA = ("line int, sku string, pieces int, weight double, grade string, "
          "packed_at timestamp, discount double")
ROWS = [(71, "bolt", 12, 4.25, "low", dt.datetime(2019, 3, 5), 0.1),
        (72, "nut", 40, 1.5, "mid", dt.datetime(2019, 7, 9), math.nan),
        (73, "gear", 7, 90.0, "high", dt.datetime(2020, 2, 29), 0.0),
        (74, "belt", 25, 11.75, "top", dt.datetime(2021, 11, 1), 0.3)]


def _run(spark, rules):
    df = spark.createDataFrame(ROWS, SCHEMA)
    return [r.asDict() for r in Q.validate(df, rules, "t", sample_order=["line"]).orderBy("rule_id").collect()]


def test_rules_pass_and_fail(spark):
    names = ["line", "sku", "pieces", "weight", "grade", "packed_at", "discount"]
    cases = [  # (rule, success)
        (Q.columns_match(["sku", "line"]), True), (Q.columns_match(["line", "absent"]), False),
        (Q.columns_match(["line", "sku"], ordered=True), False), (Q.columns_match(names, ordered=True), True),
        (Q.column_exists("weight"), True), (Q.column_exists("absent"), False),
        (Q.not_null("line"), True), (Q.not_null("discount"), False), (Q.not_null("absent"), False),
        (Q.of_type("pieces", "integer"), True), (Q.of_type("weight", "numeric"), True),
        (Q.of_type("sku", "string"), True), (Q.of_type("packed_at", "datetime"), True), (Q.of_type("sku", "integer"), False),
        (Q.between("pieces", 5, 40), True), (Q.between("pieces", 10, 40), False), (Q.between("weight", 1.5, 90.0), True),
        (Q.between("packed_at", "2019-01-01", "2022-01-01", parse_date=True), True),
        (Q.in_set("grade", ["low", "mid", "high", "top"]), True), (Q.in_set("grade", ["low", "mid"]), False),
        (Q.gte("pieces", 7), True), (Q.gte("pieces", 8), False),
        (Q.row_count_between(4, 9), True), (Q.row_count_between(5, 9), False)]
    res = _run(spark, [rule for rule, _ in cases])
    assert [r["success"] for r in res] == [ok for _, ok in cases]
    assert res[8]["error"] == "Column not found"
    assert res[7]["unexpected_count"] == 1 and res[7]["unexpected_percent"] == 25.0
    assert res[15]["unexpected_values"] == ["7"] and res[21]["unexpected_values"] == ["7"]
    assert res[19]["unexpected_values"] == ["high", "top"] and res[19]["unexpected_percent"] == 50.0
    assert res[22]["observed"] == "4"


def test_text_blank_and_bad_rules(spark):
    df = spark.createDataFrame([(1, "5", "x"), (2, "", ""), (3, "12", None), (4, "many", "y")], "k int, n string, t string")
    rules = [Q.not_null("t"), Q.gte("n", 6), Q.between("n", 0, 10), Q.gte("k", 2), Q.in_set("k", [[1]]), Q.not_null("k")]
    res = {r["rule_id"]: r for r in Q.validate(df, rules, "t", sample_order=["k"]).collect()}
    assert res[0]["unexpected_count"] == 2  # blank text is missing
    assert res[1]["unexpected_values"] == ["5", "", "many"] and res[1]["error"] is None
    assert res[2]["unexpected_values"] == ["", "12", "many"]
    assert res[3]["unexpected_count"] == 1
    assert not res[4]["success"] and res[4]["error"]  # one rule that cannot run ...
    assert res[5]["success"]  # ... leaves the others


def test_samples_keep_the_first_of_each_rule(spark):
    df = spark.range(0, 500).select((F.col("id") * 7 % 500).cast("int").alias("k"), F.col("id").alias("v")).repartition(5)
    res = {r["rule_id"]: r for r in Q.validate(df, [Q.gte("v", 400), Q.between("k", 0, 20), Q.gte("k", 0)], "t",
                                               sample_order=["k"]).collect()}
    order = sorted((int(i) * 7 % 500, int(i)) for i in range(500))
    assert res[0]["unexpected_values"] == [str(v) for k, v in order if v < 400][:10]
    assert res[1]["unexpected_values"] == [str(k) for k, v in order if k > 20][:10]
    assert res[2]["unexpected_values"] == []


def test_values_against_a_table(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,), ("z",), ("z",)], "c string")
    allowed = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "id string")
    assert tuple(Q.not_in_table(df, "c", allowed, "id").first()) == (6, 2)
    assert tuple(Q.not_in_table(df.limit(0), "c", allowed, "id").first()) == (0, 0)


def test_between_dates_midnight_and_unparsable(spark):
    df = spark.createDataFrame([("2017-12-31",), ("2017-12-31 10:00:00",), ("garbage",), (None,), ("2013-12-31",)], "d string")
    r = Q.validate(df, [Q.between("d", "2014-01-01", "2017-12-31", parse_date=True)], "t").collect()[0]
    assert r.unexpected_count == 2 and r.element_count == 5
    assert sorted(r.unexpected_values) == ["2013-12-31 00:00:00", "2017-12-31 10:00:00"]


def test_summary_status(spark):
    res = Q.validate(spark.createDataFrame(ROWS, SCHEMA), [Q.column_exists("sku")] * 9 + [Q.column_exists("x")], "t")
    s = Q.summary(res).collect()[0]
    assert (s.total_checks, s.passed_checks, s.failed_checks, s.pass_percent, s.status) == (10, 9, 1, 90.0, "Healthy")


def test_customer_dim_build_and_upsert(spark):
    staging = spark.createDataFrame(
        [("1", "a", "S", "X", "c2", "st", 1, "r"), ("1", "a", "S", "X", "c1", "st", 1, "r"),
         ("2", "b", "S", "X", "c", "st", 2, "r"), (None, "n", "S", "X", "c", "st", 3, "r")],
        "customer_id string, customer_name string, segment string, country string, city string, state string, postal_code int, region string")
    built = {r.customer_id: r.city for r in dims.customer_dim_build(staging).collect()}
    assert built == {"1": "c1", "2": "c"}
    cols = "customer_id string, customer_name string, segment string, city string, state string, region string"
    target = spark.createDataFrame([("1", "a", "S", "c", "s", "r"), ("2", "b", "S", "c", "s", "r")], cols)
    incoming = spark.createDataFrame([("2", None, None, None, None, None, None, None),
                                      ("3", "c", "S", "X", "c", "s", 1, "r")],
                                     "customer_id string, customer_name string, segment string, country string, city string, state string, postal_code int, region string")
    got = {r.customer_id: r.customer_name for r in dims.upsert_by_key(target, incoming).collect()}
    assert got == {"1": "a", "2": None, "3": "c"}
    kv = dims.key_violations(spark.createDataFrame([("1",), ("1",), (None,), ("2",)], "customer_id string")).collect()[0]
    assert (kv.row_count, kv.null_keys, kv.duplicate_keys, kv.distinct_keys) == (4, 1, 1, 2)


def test_profile(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (2, None), (3, "c")], "k int, v string")
    assert profile.duplicate_rows(df).collect()[0][0] == 2
    assert {r.column_name: r.missing_count for r in profile.missing_by_column(df).collect()} == {"k": 0, "v": 2}


def test_csv_roundtrip_latin1_nulls(spark):
    df = spark.createDataFrame([(1, "Café, \u0093best\u0094", None), (2, 'say "hi"', "")], "`Row ID` int, name string, note string")
    path = work_path(spark, "test-csv")
    files.write_csv(df, path, encoding=files.LATIN_1)
    back = files.read_csv(spark, f"{path}/part-*", df.schema, encoding=files.LATIN_1, null_value="null")
    assert sorted(tuple(r) for r in back.collect()) == sorted(tuple(r) for r in df.collect())


def test_missing_source_gives_empty(spark):
    from martforge.schemas import HOLIDAY_DOCUMENT
    path = work_path(spark, "absent")
    df = files.read_or_empty(spark, lambda: files.read_json(spark, path, HOLIDAY_DOCUMENT), HOLIDAY_DOCUMENT)
    assert df.count() == 0 and df.schema == HOLIDAY_DOCUMENT


def test_jdbc_roundtrip_in_process_derby(spark):
    url = "jdbc:derby:memory:martforge_test;create=true"
    df = spark.range(0, 100).select(F.col("id").cast("int").alias("k"), (F.col("id") * 2).cast("int").alias("v"))
    jdbc.write_jdbc(df, url, "T_DIM", driver="org.apache.derby.jdbc.EmbeddedDriver")
    back = jdbc.read_jdbc(spark, url, table="T_DIM", partition_column="K", lower_bound=0, upper_bound=100,
                          num_partitions=4, driver="org.apache.derby.jdbc.EmbeddedDriver")
    assert back.rdd.getNumPartitions() == 4
    assert sorted(tuple(r) for r in back.collect()) == [(i, 2 * i) for i in range(100)]
    q = jdbc.read_jdbc(spark, url, query='SELECT "k", "v" FROM T_DIM WHERE "k" < 5',
                       driver="org.apache.derby.jdbc.EmbeddedDriver")
    assert q.count() == 5


def test_run_suites_skips_absent_and_records_errors(spark):
    from martforge.plans.suites import run_suites
    df = spark.createDataFrame(ROWS, SCHEMA)

    def boom():
        raise RuntimeError("unreadable")

    out = run_suites({"present": (lambda: df, [Q.column_exists("sku")], None),
                      "absent": (lambda: None, [Q.column_exists("sku")], None),
                      "broken": (boom, [Q.column_exists("sku")], None)})
    got = sorted((r.dataset, r.success, r.error) for r in out.collect())
    assert got == [("broken", False, "RuntimeError: unreadable"), ("present", True, None)]
    assert run_suites({"absent": (lambda: None, [], None)}) is None


def test_write_table_partitioned_and_clustered(spark):
    df = spark.range(0, 1000).select((F.col("id") % 3).alias("year"), (F.col("id") % 2).alias("month"),
                                    F.col("id").alias("row_id"))
    path = work_path(spark, "test-publish")
    files.write_table(df, path, partition_by=["year", "month"], cluster_by=["row_id"])
    back = spark.read.parquet(path)
    assert back.count() == 1000 and back.where("year = 2 AND month = 1").count() == df.where("year = 2 AND month = 1").count()
    files.write_table(df.where("year = 0"), path, partition_by=["year", "month"], keep_others=True)
    assert spark.read.parquet(path).count() == 1000
    files.write_table(df.where("year = 0"), path, partition_by=["year", "month"])
    assert {r.year for r in spark.read.parquet(path).select("year").distinct().collect()} == {0}  # no stale partition


def test_plain_csv_round_trip_keeps_other_scripts(spark):
    df = spark.createDataFrame([(1, " naïve – 東京 ")], "k int, v string")
    path = work_path(spark, "utf8-csv")
    files.write_csv(df, path)
    assert files.read_csv(spark, f"{path}/part-*", df.schema).first().v == " naïve – 東京 "


def test_compressed_csv_parts_read_back(spark, tmp_path, monkeypatch):
    """Compressed parts hold the same rows in fewer bytes and end after a bounded number of rows."""
    monkeypatch.setattr(files, "COMPRESSED_ROWS", 300)
    df = spark.range(0, 1000, 1, 1).select("id", F.when(F.col("id") % 3 > 0, F.concat(F.lit('two\u00e9, "x" '), F.col("id") % 5)).alias("name"))
    plain, packed = f"{tmp_path}/plain", f"{tmp_path}/packed"
    files.write_csv(df, plain, encoding=files.LATIN_1)
    files.write_csv(df, packed, encoding=files.LATIN_1, compression="gzip")
    parts = [p for p in os.listdir(packed) if p.startswith("part-")]
    assert len(parts) == 4 and all(p.endswith(".csv.gz") for p in parts)

    def size(folder):
        return sum(os.path.getsize(f"{folder}/{p}") for p in os.listdir(folder) if p.startswith("part-"))

    assert 3 * size(packed) < size(plain)
    back = files.read_csv(spark, f"{packed}/part-*", df.schema, encoding=files.LATIN_1, null_value="null")
    assert sorted(back.collect()) == sorted(df.collect())


def test_load_published_parts(spark):
    df = spark.createDataFrame([(1, "2014-01-05", "1/6/2014", None), (2, "bad", None, "x")],
                               "`Row ID` int, `Order Date` string, `Ship Date` string, `Sub-Category` string")
    path = work_path(spark, "published")
    files.write_csv(df.repartition(2), path)
    back = files.load_published(spark, f"{path}/part-*", df.schema, ["order_date", "ship_date", "holiday_date"])
    assert back.columns == ["row_id", "order_date", "ship_date", "sub_category"]
    got = {r.row_id: (r.order_date, r.ship_date) for r in back.collect()}
    assert got == {1: (dt.datetime(2014, 1, 5), dt.datetime(2014, 1, 6)), 2: (None, None)}


def test_union_skips_missing_parts(spark):
    from martforge.schemas import WEATHER
    path = work_path(spark, "weather-part")
    files.write_json(spark.createDataFrame([("East", "2014-01-01", 1.0, 0.0, 0.0, 2.0)], WEATHER), path)
    gone = work_path(spark, "weather-gone")
    got = files.union_available(spark, [lambda p=p: files.read_json(spark, p, WEATHER) for p in (gone, path, gone)], WEATHER)
    assert got.count() == 1 and got.schema == WEATHER


def test_dimension_is_created_once_and_checked(spark):
    import pytest
    path = work_path(spark, "dimension")
    assert dims.ensure_dimension(spark, path).count() == 0
    row = ("1", "a", "S", "c", "s", "r")
    files.write_table(spark.createDataFrame([row], dims.CUSTOMER_DIM), path)
    assert dims.ensure_dimension(spark, path).count() == 1
    files.write_table(spark.createDataFrame([row, row], dims.CUSTOMER_DIM), path)
    with pytest.raises(ValueError):
        dims.ensure_dimension(spark, path)


def test_json_document_and_record_array_reads(spark):
    import json
    import os
    from martforge.schemas import HOLIDAY_DOCUMENT, WEATHER
    base = work_path(spark, "json-docs")
    local = base.replace("file:", "")
    os.makedirs(local, exist_ok=True)
    with open(f"{local}/holidays.json", "w", encoding="utf-8") as f:
        json.dump({"year": 2014, "holidays": [
            {"name": "New Year's Day", "date": {"iso": "2014-01-01"}, "primary_type": "National"},
            {"name": "Christmas Day", "date": {"iso": "2014-12-25T00:00:00-05:00"}}]}, f, indent=4)
    with open(f"{local}/weather.json", "w", encoding="utf-8") as f:
        json.dump([{"weather_region": "East", "weather_date": "2014-01-01", "temp_c": 1.5,
                    "precipitation_mm": 0.0, "snowfall_cm": 0.0, "wind_speed_kmh": 12.0},
                   {"weather_region": "West", "weather_date": "2014-01-01", "temp_c": 15.0}], f, indent=4)
    from martforge.operators.reshape import flatten_holidays
    doc = files.read_json(spark, f"{base}/holidays.json", HOLIDAY_DOCUMENT, multiline=True)
    assert sorted(tuple(r) for r in flatten_holidays(doc).collect()) == [
        ("Christmas Day", dt.date(2014, 12, 25)), ("New Year's Day", dt.date(2014, 1, 1))]
    w = files.read_json(spark, f"{base}/weather.json", WEATHER, multiline=True)
    assert sorted((r.weather_region, r.wind_speed_kmh) for r in w.collect()) == [("East", 12.0), ("West", None)]


def test_multi_part_csv_glob(spark):
    df = spark.range(0, 100).select(F.col("id").cast("int").alias("k"), F.lit("x, y").alias("v"))
    path = work_path(spark, "parts")
    files.write_csv(df.repartition(4), path)
    back = files.read_csv(spark, f"{path}/part-*.csv", df.schema)
    assert back.count() == 100 and back.where("v = 'x, y'").count() == 100
    missing = files.read_or_empty(spark, lambda: files.read_csv(spark, f"{path}/nothing-*.csv", df.schema), df.schema)
    assert missing.count() == 0
