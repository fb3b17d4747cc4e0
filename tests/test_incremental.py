"""Tolerant payloads, day state, duplicates by digest, one-pass top customers."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from martforge.functions.measures import merged_avg, merged_sum, money_avg, money_parts, money_sum
from martforge.operators import bi, daystate, profile
from martforge.operators.days import daily_totals, rolling_sales
from martforge.operators.reshape import flatten_holidays, flatten_weather
from martforge.session import work_path
from martforge.sources import payloads


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


# ---------------------------------------------------------------- payloads
HOLIDAYS = [
    ("good", '{"holidays": [{"name": "A", "date": {"iso": "2014-01-01", "x": 1}, "primary_type": "t"}]}'),
    ("wrapped", '{"response": {"holidays": [{"name": "B", "date": {"iso": "2015-01-01T00:00:00-04:00"}}]}}'),
    ("odd", '{"holidays": [7, null, "text", [1], {"name": {"en": "C"}, "date": "2014-05-05"}, {"name": "D"}]}'),
    ("empty", '{"holidays": []}'), ("cut", '{"holidays": [{"name": "E"'), ("shape", '{"holidays": {"name": "F"}}'),
    ("other", '[1, 2]'), ("number", "5"), ("blank", "  "), ("null", None), ("page", "<html></html>"), ("nothing", '{"holidays": null}')]


def test_holiday_payloads(spark):
    docs = payloads.holiday_documents(spark.createDataFrame(HOLIDAYS, "source string, payload string"))
    assert rows(flatten_holidays(payloads.accepted(docs))) == sorted(
        [("A", dt.date(2014, 1, 1)), ("B", dt.date(2015, 1, 1)), (None, None), ("D", None)], key=str)
    assert {r[0]: r[1:] for r in rows(payloads.report(docs))} == {
        "odd": (None, 4), "cut": ("not JSON", 0), "shape": ("no entries", 0), "other": ("no entries", 0), "number": ("no entries", 0),
        "blank": ("no text", 0), "null": ("no text", 0), "page": ("not JSON", 0), "nothing": ("no entries", 0)}


def test_weather_payloads(spark):
    found = [("a", '{"daily": {"time": ["2014-01-01", 5, "2014-01-03"], "temperature_2m_mean": [1, "x", "2.5", 9], "snowfall_sum": "none"}}'),
             ("b", '{"daily": {}}'), ("c", '{"daily": {"time": []}}'), ("d", "{}}")]
    docs = payloads.weather_payloads(spark.createDataFrame(found, "region string, payload string"))
    assert rows(flatten_weather(payloads.accepted(docs))) == sorted(
        [("a", "2014-01-01", 1.0, None, None, None), ("a", None, None, None, None, None), ("a", "2014-01-03", 2.5, None, None, None)], key=str)
    got = {r[0]: r[1:] for r in rows(payloads.report(docs, "region"))}
    assert got["a"] == (None, 1) and got["b"] == ("no entries", 0) and "c" not in got


def test_payload_files(spark, tmp_path):
    for name, text in [("x", '{"holidays":\n [\n]}'), ("y", "{")]:
        (tmp_path / f"{name}.json").write_text(text)
    docs = payloads.holiday_documents(payloads.read_payloads(spark, str(tmp_path)))
    assert docs.count() == 2 and payloads.accepted(docs).count() == 1
    (bad,) = payloads.report(docs).collect()
    assert bad.source.endswith("y.json") and bad.reason == "not JSON"
    assert payloads.holiday_documents(spark.createDataFrame([], "source string, payload string")).count() == 0


# ---------------------------------------------------------------- day state
def ledger(spark, lines):
    return spark.createDataFrame(lines, "`Order Date` date, Sales double")


def test_batches_give_the_averages_of_the_whole(spark):
    rng = random.Random(5)
    days = [dt.date(2015, 1, 20) + dt.timedelta(days=d) for d in rng.sample(range(120), 60)]
    first = [(rng.choice(days), rng.choice([0.1, 0.7, -2.25, None, 1e6])) for _ in range(300)] + [(None, 4.0)]
    late = [(dt.date(2015, 1, 31), 5.5), (dt.date(2015, 3, 1), 0.3), (dt.date(2015, 3, 1), 0.3), (None, 1.0), (dt.date(2016, 1, 1), 2.0)]
    holidays = spark.createDataFrame([("a", days[0]), ("b", days[0]), ("c", dt.date(2015, 3, 1)), ("d", None)], "holiday_name string, holiday_date date")
    path = work_path(spark, "day-state-test")
    daystate.add_batch(spark, path, ledger(spark, first))
    before = {r.day: tuple(r) for r in daystate.rolling_from_state(spark, path, holidays).collect()}
    batch = daystate.add_batch(spark, path, ledger(spark, late))
    joined = ledger(spark, first + late).join(holidays, F.col("Order Date") == F.col("holiday_date"), "left")
    want = {r[0]: tuple(r) for r in rolling_sales(daily_totals(joined)).collect()}
    got = {r.day: tuple(r) for r in daystate.rolling_from_state(spark, path, holidays).collect()}
    assert got == want
    changed = {r.day: tuple(r) for r in daystate.changed_averages(spark, path, batch, holidays).collect()}
    assert changed == {d: want[d] for d in changed}
    assert {d for d in want if want[d] != before.get(d)} <= set(changed) < set(want)
    assert daystate.read_state(spark, path).agg(F.sum("lines")).first()[0] == len(first + late)


def test_a_batch_rewrites_its_months_only(spark, tmp_path):
    path = str(tmp_path / "state")
    daystate.add_batch(spark, path, ledger(spark, [(dt.date(2015, m, 3), 1.0) for m in range(1, 10)]))
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "state").rglob("*.parquet")}
    daystate.add_batch(spark, path, ledger(spark, [(dt.date(2015, 4, 9), 1.0)]))
    after = {p: p.stat().st_mtime_ns for p in (tmp_path / "state").rglob("*.parquet")}
    assert {p for p in before if "2015-04" not in str(p)} == {p for p in before if before[p] == after.get(p)}
    daystate.add_batch(spark, path, ledger(spark, []))
    assert daystate.read_state(spark, path).count() == 10


# ---------------------------------------------------------------- duplicates
ROWS = [(1, None, 0.0, "a"), (1, None, -0.0, "a"), (None, 1, 0.0, "a"), (1, 1, float("nan"), None), (1, 1, float("nan"), None),
        (1, 1, float("nan"), None), (2, 1, None, "a"), (2, 1, None, ""), (2, None, None, None), (None, 2, None, None)]


@pytest.mark.parametrize("digests", [profile.fingerprint, lambda df: [F.lit(7).cast("long")], lambda df: [F.xxhash64("s"), F.lit(0)]],
                         ids=["digests", "all collide", "some collide"])
def test_duplicates(spark, digests):
    df = spark.createDataFrame(ROWS, "a int, b int, x double, s string")
    plain = df.groupBy(*df.columns).count().agg(F.sum(F.col("count") - 1)).first()[0]
    assert profile.duplicate_rows(df, digests).first()[0] == plain == 3
    assert profile.duplicate_rows(df.where("a = 9"), digests).first()[0] == 0


def test_few_bytes_are_exchanged_for_duplicates(spark):
    wide = spark.range(3000).select("id", F.repeat(F.sha2(F.col("id").cast("string"), 256), 40).alias("text"))
    plan = profile.duplicate_rows(wide)._jdf.queryExecution().optimizedPlan().toString()
    assert "row-digests" in plan or "LeftSemi" in plan
    assert profile.duplicate_rows(wide).first()[0] == 0


# ---------------------------------------------------------------- sheets
def test_parts_of_money_add_up(spark):
    values = [(k % 3, v) for k, v in enumerate([0.1, 0.2, None, 1e25, -1e25, float("nan"), 5.5, None, 0.3, 1e19, 9e19, 9e19, 9e19])]
    df = spark.createDataFrame(values, "g int, v double")
    for part in (df, df.where("g = 0"), df.where("v < 1"), df.where("v is null"), df.where("v > 1e18 and v < 1e21")):
        want = part.agg(money_sum("v").alias("s"), money_avg("v").alias("a")).first()
        got = part.groupBy("g").agg(*money_parts("v", "m")).agg(merged_sum("m").alias("s"), merged_avg("m").alias("a")).first()
        assert str(want) == str(got)


def sheet(spark, n=400):
    rng = random.Random(3)
    ids = [f"c{i}" for i in range(30)]
    return spark.createDataFrame(
        [(i, rng.choice([*ids, None]), rng.choice(["x", "y", None]), rng.choice([f"o{i}", None]), round(rng.uniform(-50, 50), 2),
          rng.choice([1.5, None, 3.25])) for i in range(n)],
        "row_id int, customer_id string, customer_name string, order_id string, profit double, sales double")


def test_top_customers_in_one_pass(spark):
    w = sheet(spark)
    kept = bi.rows_in_top(w, "customer_id", "profit", "avg", 5)
    want = kept.groupBy("customer_name").agg(F.count("order_id"), money_sum("profit"), money_sum("sales"))
    assert rows(bi.top_customers(w, 5)) == rows(want)
    runs = spark.sparkContext.accumulator(0)

    @F.udf("int")
    def counted(v):
        runs.add(1)
        return v

    bi.top_customers(w.withColumn("row_id", counted("row_id")).where("row_id >= 0"), 5).collect()
    assert runs.value == 400
    once = bi.rows_in_top(w.withColumn("row_id", counted("row_id")), "customer_id", "profit", "avg", 5, ["row_id", "profit"])
    assert rows(once) == rows(kept.select("row_id", "profit")) and runs.value == 800


def test_kpis_run_once_and_repeat_no_row(spark):
    w = sheet(spark).withColumn("profit_margin", F.col("profit") / 3)
    want = w.agg(money_sum("sales"), money_sum("profit"), F.count_distinct("order_id"), money_avg("profit_margin"),
                 F.count_distinct("customer_id")).first()
    got = bi.kpis(w)
    assert tuple(got.first()) == tuple(want)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan
    none = bi.kpis(w.where("row_id < 0")).first()
    assert tuple(none) == (None, None, 0, None, 0)


# ---------------------------------------------------------------- distinct counts
def test_numbers_are_dense_and_stay(spark, tmp_path):
    from martforge.operators import distinct

    path = str(tmp_path / "numbers")
    loads = [[f"k{i}" for i in range(500)] + [None, "k1"], ["k7", "x", "x"], [], [f"y{i}" for i in range(300)]]
    seen = {}
    for load in loads:
        rows = spark.createDataFrame([(k,) for k in load], "id string")
        numbers = {r.key: r.number for r in distinct.number_keys(spark, path, rows, "id", buckets=8).collect()}
        assert {k: n for k, n in numbers.items() if k in seen} == seen
        assert len(set(numbers.values())) == len(numbers) and set(numbers) == set(seen) | {k for k in load if k}
        seen = numbers
    assert max(seen.values()) < 2 * len(seen)


def test_bitmaps_add_up(spark, tmp_path):
    from martforge.operators import distinct

    rng = random.Random(1)
    rows = spark.createDataFrame([(rng.choice("abc"), rng.randrange(3), None if rng.random() < 0.1 else f"k{rng.randrange(300_000)}") for _ in range(60_000)],
                                 "g string, load int, id string")
    path, parts = str(tmp_path / "numbers"), []
    for load in range(3):
        one = rows.where(F.col("load") == load)
        numbers = distinct.number_keys(spark, path, one, "id")
        parts.append(distinct.bitmaps(one, "id", numbers, ["g"]).cache())
        parts[-1].count()
    kept = parts[0].unionByName(parts[1]).unionByName(parts[2])
    want = {r.g: r.n for r in rows.groupBy("g").agg(F.count_distinct("id").alias("n")).collect()}
    assert {r.g: r.n for r in distinct.distinct_count(kept, ["g"], "n").collect()} == want
    assert distinct.distinct_count(kept, [], "n").first().n == rows.agg(F.count_distinct("id")).first()[0]
    assert kept.agg(F.max("slot")).first()[0] > 1  # several bitmaps a set
    assert distinct.distinct_count(kept.where("g = 'z'"), [], "n").first().n == 0
