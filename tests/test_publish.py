"""Parts read by name, staged publishes, merges in place, quality counted while publishing."""

import gzip
import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martforge.operators import dims
from martforge.operators import quality as Q
from martforge.operators.sizing import materialize_counted
from martforge.session import work_path
from martforge.sources import files, headers, publish

AB = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType())])


def write(folder, **parts):
    os.makedirs(folder, exist_ok=True)
    for name, text in parts.items():
        with open(f"{folder}/{name}.csv", "w", encoding="utf-8", newline="") as f:
            f.write(text)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


# ---------------------------------------------------------------- parts by name
def test_parts_in_any_column_order(spark, tmp_path):
    write(tmp_path, p0="a,b\n1,x\n", p1="b,a\ny,2\n", p2="b,c,a\nz,7,3\n", p3="b\nw\n", p4="", p5="a,b\n")
    want = sorted([(1, "x"), (2, "y"), (3, "z"), (None, "w")], key=str)
    for path in (str(tmp_path), f"{tmp_path}/p*.csv", [f"{tmp_path}/p{i}.csv" for i in range(6)]):
        got = files.read_csv(spark, path, AB)
        assert got.schema.simpleString() == "struct<a:int,b:string>" and rows(got) == want


def test_odd_headers(spark, tmp_path):
    write(tmp_path, p0='﻿a,"b, ""c""\nd"\n1,x\n', p1='"b, ""c""\nd",a\ny,2\n')
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField('b, "c"\nd', T.StringType())])
    assert headers.header_groups(spark, str(tmp_path), "UTF-8").keys() == {("a", 'b, "c"\nd'), ('b, "c"\nd', "a")}
    packed = tmp_path / "packed"
    packed.mkdir()
    with gzip.open(packed / "q.csv.gz", "wt") as f:
        f.write("b,a\nz,3\n")
    write(packed, r="a,b\n4,u\n")
    assert rows(files.read_csv(spark, str(packed), AB)) == [(3, "z"), (4, "u")]
    assert schema.fieldNames()[1] in files.read_csv(spark, str(tmp_path / "p1.csv"), schema).columns
    write(tmp_path / "twice", p="a,a\n1,2\n")
    with pytest.raises(ValueError, match="twice"):
        files.read_csv(spark, str(tmp_path / "twice"), AB)
    write(tmp_path / "none", p="")
    assert rows(files.read_csv(spark, str(tmp_path / "none"), AB)) == []


def test_types_are_widened_without_a_schema(spark, tmp_path):
    write(tmp_path, p0="a,b,c\n1,2,3\n", p1="c,a\nx,2.5\n", p2="b\n5000000000\n")
    got = files.read_csv(spark, str(tmp_path), None)
    assert {f.name: f.dataType.simpleString() for f in got.schema.fields} == {"a": "double", "b": "bigint", "c": "string"}
    assert rows(got.select("a", "b", "c")) == sorted([(1.0, 2, "3"), (2.5, None, "x"), (None, 5000000000, None)], key=str)


@pytest.mark.parametrize("a, b, wide", [("int", "bigint", "bigint"), ("bigint", "float", "double"), ("int", "string", "string"),
                                        ("date", "timestamp", "timestamp"), ("boolean", "int", "string"), ("void", "date", "date"),
                                        ("float", "double", "double"), ("timestamp", "timestamp_ntz", "string")])
def test_wider(spark, a, b, wide):
    parts = [spark.sql(f"SELECT CAST(NULL AS {t}) AS v") for t in (a, b)]
    assert headers.align(parts).dtypes == [("v", wide)] == headers.align(parts[::-1]).dtypes


def test_partition_folders_keep_their_columns(spark, tmp_path):
    df = spark.createDataFrame([(1, "x", 2014), (2, "y", 2015), (3, None, 2015)], "a int, b string, year int")
    path = str(tmp_path / "t")
    files.write_csv(df, path, partition_by=["year"])
    write(f"{path}/year=2016", p="b,a\nz,4\n")
    schema = T.StructType([*AB.fields, T.StructField("year", T.IntegerType())])
    assert rows(files.read_csv(spark, path, schema, null_value="null")) == [(1, "x", 2014), (2, "y", 2015), (3, None, 2015), (4, "z", 2016)]


def test_published_parts_in_other_order(spark, tmp_path):
    write(tmp_path, p0="Row ID,Order Date\n1,2014-01-05\n", p1="Order Date,Row ID,Sub-Category\n1/6/2014,2,x\n")
    schema = T.StructType([T.StructField(n, t) for n, t in (("Row ID", T.IntegerType()), ("Order Date", T.StringType()),
                                                           ("Sub-Category", T.StringType()))])
    got = files.load_published(spark, str(tmp_path), schema, ["order_date"])
    assert [(r.row_id, str(r.order_date)[:10], r.sub_category) for r in got.orderBy("row_id").collect()] == [
        (1, "2014-01-05", None), (2, "2014-01-06", "x")]


# ---------------------------------------------------------------- publish
def numbers(spark, n, bad=None):
    df = spark.range(n).select("id", (F.col("id") % 3).cast("int").alias("part"))
    return df if bad is None else df.withColumn("id", F.when(F.col("id") == bad, F.raise_error(F.lit("bad")).cast("long")).otherwise(F.col("id")))


def beside(path):
    parent, name = os.path.split(path)
    return [f for f in os.listdir(parent) if name in f and f != name and not f.endswith(".crc")]


@pytest.mark.parametrize("by", [None, ["part"]])
def test_failing_publish_leaves_the_table(spark, tmp_path, by):
    path = str(tmp_path / "t")
    files.write_table(numbers(spark, 10), path, by)
    with pytest.raises(PySparkException):
        files.write_table(numbers(spark, 20, bad=17), path, by)
    assert publish.read_table(spark, path).count() == 10 and beside(path) == []
    assert files.write_table(numbers(spark, 20), path, by, metrics={"odd": F.count_if(F.col("id") % 2 == 1)}) == {"rows": 20, "odd": 10}
    assert spark.read.parquet(path).count() == 20 and beside(path) == []


def test_lost_rows_stop_the_publish(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    files.write_table(numbers(spark, 10), path)
    monkeypatch.setattr(publish, "dict", lambda got: {"rows": got["rows"] + 1}, raising=False)
    with pytest.raises(RuntimeError, match="read back"):
        files.write_table(numbers(spark, 5), path)
    assert spark.read.parquet(path).count() == 10 and beside(path) == []


@pytest.mark.parametrize("keep", [True, False])
@pytest.mark.parametrize("steps", range(1, 6))
def test_a_cut_off_switch_is_finished(spark, tmp_path, monkeypatch, keep, steps):
    path = str(tmp_path / "t")
    files.write_table(numbers(spark, 10), path, ["part"])  # 4, 3 and 3 rows
    new = numbers(spark, 11).where("part < 2")  # 4 and 4 rows
    real, calls = publish.Folders.rename, []

    def rename(self, old, to):
        calls.append(old)
        if len(calls) > steps:
            raise KeyboardInterrupt
        real(self, old, to)

    monkeypatch.setattr(publish.Folders, "rename", rename)
    try:
        files.write_table(new, path, ["part"], keep_others=keep)
        done = True
    except KeyboardInterrupt:
        done = False
    monkeypatch.undo()
    got = publish.read_table(spark, path)
    expected = (11 if keep else 8)
    assert got.count() == expected and got.where("part = 2").count() == (3 if keep else 0)
    assert got.where("id = 10").count() == 1 and beside(path) == []
    assert done == (len(calls) <= steps)


def test_empty_publish_and_first_publish(spark, tmp_path):
    path = str(tmp_path / "t")
    files.write_table(numbers(spark, 0), path)
    assert publish.read_table(spark, path).count() == 0
    files.write_table(numbers(spark, 4), path, keep_others=True)
    assert publish.read_table(spark, path).count() == 4
    files.write_table(numbers(spark, 0), path, ["part"])
    assert publish.read_table(spark, path, numbers(spark, 0).schema).count() == 0


# ---------------------------------------------------------------- dimension
STAGING = "customer_id string, customer_name string, segment string, country string, city string, state string, postal_code bigint, region string"


def listing(spark, *pairs):
    return spark.createDataFrame([(k, v, "s", "c", "t", "u", 1, "r") for k, v in pairs], STAGING)


def contents(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}


def test_merge_rewrites_only_touched_folders(spark, tmp_path):
    path = str(tmp_path / "dim")
    first = [(f"k{i}", f"name {i}") for i in range(200)]
    touched = dims.merge_dimension(spark, path, listing(spark, *first, ("k1", "another"), (None, "nobody")), buckets=16)
    assert touched == list(range(16))
    before = contents(path)
    touched = dims.merge_dimension(spark, path, listing(spark, ("k3", None), ("new", "n")), buckets=99)
    after = contents(path)
    kept = {f for f in before if before[f] == after.get(f)}
    assert len(touched) <= 2 and {f for f in before if int(f.split("bucket=")[1].split("/")[0]) not in touched} == kept
    got = {r.customer_id: r.customer_name for r in dims.read_dimension(spark, path).collect()}
    assert got == {**dict(first), "k1": "another", "k3": None, "new": "n"}
    assert dims.key_violations(dims.read_dimension(spark, path)).first()["duplicate_keys"] == 0


def test_merge_equals_upsert(spark, tmp_path):
    path = str(tmp_path / "dim")
    loads = [listing(spark, *[(f"k{i % 50}", f"{n}-{i}") for i in range(n * 17, 40 * n + 20)]) for n in (1, 2, 3)]
    want = dims.customer_dim_build(loads[0])
    for load in loads:
        dims.merge_dimension(spark, path, load, buckets=8)
        want = dims.upsert_by_key(want, dims.customer_dim_build(load))
    assert rows(dims.read_dimension(spark, path)) == rows(want.select(*dims.CUSTOMER_DIM.fieldNames()))


def test_a_stored_key_spares_the_check(spark, tmp_path, monkeypatch):
    from martforge.plans import wide

    path = str(tmp_path / "dim")
    dims.merge_dimension(spark, path, listing(spark, ("a", "x"), ("b", "y")), buckets=4)
    assert dims.stored_key(spark, path) == "customer_id" and dims.stored_key(spark, str(tmp_path / "none")) is None
    asked = []
    monkeypatch.setattr(wide, "unique_key", lambda df, keys: asked.append(keys) or df)
    ledger = spark.createDataFrame([("a", None, "r", 1.0, 1.0, "p")], "`Customer ID` string, `Order Date` date, Region string, Sales double, Profit double, `Product Name` string")
    none = spark.createDataFrame([], "holiday_name string, holiday_date date")
    for kept_by, checks in ((dims.stored_key(spark, path), 0), (None, 1), ("other", 1)):
        asked.clear()
        got = wide.build_wide(ledger, dims.read_dimension(spark, path), none, kept_by=kept_by)
        assert got.select("db_customer_name").first()[0] == "x" and len(asked) == checks


def test_failing_merge_leaves_the_dimension(spark, tmp_path):
    path = str(tmp_path / "dim")
    dims.merge_dimension(spark, path, listing(spark, ("a", "x"), ("b", "y")), buckets=4)
    bad = listing(spark, ("a", "z")).withColumn("city", F.raise_error(F.lit("bad")).cast("string"))
    with pytest.raises(PySparkException):
        dims.merge_dimension(spark, path, bad)
    assert {r.customer_name for r in dims.read_dimension(spark, path).collect()} == {"x", "y"}
    assert dims.merge_dimension(spark, path, listing(spark)) == []
    files.write_table(numbers(spark, 3), str(tmp_path / "other"), ["part"])
    with pytest.raises(ValueError, match="not a dimension"):
        dims.merge_dimension(spark, str(tmp_path / "other"), listing(spark, ("a", "z")))


# ---------------------------------------------------------------- quality while writing
RULES = [Q.row_count_between(1, 50), Q.not_null("id"), Q.between("id", 0, 5), Q.in_set("part", [0, 1]), Q.gte("id", 3), Q.gte("missing", 1),
         Q.columns_match(["id", "part"]), Q.of_type("id", "integer")]


def test_quality_counted_while_publishing(spark, tmp_path):
    df, path = numbers(spark, 20), str(tmp_path / "t")
    runs = spark.sparkContext.accumulator(0)

    @F.udf("int")
    def counted(v):
        runs.add(1)
        return v

    once = df.withColumn("part", counted("part"))

    def write(d, metrics):
        got = files.write_table(d, path, ["part"], metrics=metrics)
        return publish.read_table(spark, path, d.schema), got

    got = Q.validate(once, RULES, "numbers", ["id"], write=write)
    assert rows(got) == rows(Q.validate(df, RULES, "numbers", ["id"]))
    assert runs.value == 20  # the rows were made once
    assert publish.read_table(spark, path).count() == 20
    copy = Q.validate(df, RULES, "numbers", ["id"], write=lambda d, m: materialize_counted(Q.rule_columns(d, RULES, ["id"]), m))
    assert rows(copy) == rows(got)


def test_a_rule_that_cannot_run_does_not_stop_the_publish(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, None)], "k int, v string")
    path = str(tmp_path / "t")
    rules = [Q.not_null("k"), Q.gte("k", 2), Q.between("v", 1, 2)]
    want = rows(Q.validate(df, rules, "d", ["k"]))

    def failing(d, metrics):
        if metrics:
            raise PySparkException("no metrics")
        files.write_table(d, path)
        return publish.read_table(spark, path), {"rows": 2}

    assert rows(Q.validate(df, rules, "d", ["k"], write=failing)) == want
