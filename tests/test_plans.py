"""Plan shape at sf0.001: no Python evaluation, no cartesian product,
no window over the ledger, pushed-down scans; registry/oracle coverage."""

import __spark_entry__ as entry
from martforge.plans import catalog

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_wide_plan_is_jvm_only(spark):
    wide = catalog.wide(spark, SF)
    plan = _plan(wide)
    for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in plan, bad
    assert "BroadcastHashJoin" in plan


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns[0] == "Order Date" and df.columns[-1] == "extreme_weather_flag"


def test_every_query_has_an_oracle():
    assert set(catalog.queries()) <= set(entry.oracle_sql()) <= set(entry.queries())


def test_small_queries_run(spark):
    qs = entry.queries()
    for k in ("bi_kpis", "dq_summary", "filter_dedup_holidays", "customer_dim_upsert", "union_weather"):
        assert qs[k](spark, SF).count() >= 1, k


def test_materialized_tables_broadcast_by_bytes(spark):
    from martforge.operators.sizing import materialize
    big = spark.range(0, 1000).withColumnRenamed("id", "k")
    small = materialize(spark.range(0, 5).withColumnRenamed("id", "k"))
    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        for limit, broadcast in (("10m", True), ("16b", False)):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
            joined = big.hint("merge").join(small, "k") if not broadcast else big.join(small, "k")
            assert ("BroadcastHashJoin" in _plan(joined)) == broadcast
            assert joined.count() == 5
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)


def test_short_reads_and_private_folders_are_errors(spark, monkeypatch):
    import pytest
    from martforge import session
    from martforge.operators.sizing import verified
    with pytest.raises(RuntimeError, match="shared"):
        verified(spark.range(0, 4), 5, "somewhere")

    class Conf:
        def get(self, key, default=None):
            return {"spark.master": "spark://host:7077"}.get(key, default)

    class Context:
        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="checkpoint"):
        session.checkpoint_dir(Session())


def test_work_paths_are_cleaned(spark):
    from martforge import session
    monkey = list(session._made)
    session._made.clear()
    path = session.work_path(spark, "gone")
    spark.range(0, 3).write.parquet(path)
    try:
        assert session.clean_work(spark) == 1 and not session._made
    finally:
        session._made.extend(monkey)


def test_holiday_distances_read_the_ledger_once(spark):
    plan = _plan(catalog.queries()["days_until_next_holiday"](spark, SF))
    assert plan.count("lineitem.parquet") == 1


def test_hot_and_null_keys_stay_whole(spark):
    from pyspark.sql import functions as F
    from martforge.operators.dims import customer_dim_build
    from martforge.operators.joins import join_sales_customers
    n = 3000
    sales = spark.range(0, n).select(
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).when(F.col("id") % 3 == 1, F.lit(None))
        .otherwise(F.concat(F.lit("C"), F.col("id").cast("string"))).alias("Customer ID"),
        F.col("id").alias("row"))
    staging = sales.select(F.col("Customer ID").alias("customer_id"),
                           F.concat(F.lit("name-"), (F.col("row") % 7).cast("string")).alias("customer_name"),
                           F.lit("S").alias("segment"), F.lit("X").alias("country"), F.lit("c").alias("city"),
                           F.lit("s").alias("state"), F.lit(1).alias("postal_code"), F.lit("r").alias("region"))
    dim = customer_dim_build(staging)
    assert dim.where("customer_id = 'HOT'").collect()[0].customer_name == "name-0"
    assert dim.where("customer_id IS NULL").count() == 0
    joined = join_sales_customers(sales, dim)
    assert joined.count() == n
    assert joined.where("`Customer ID` IS NULL AND db_customer_name IS NOT NULL").count() == 0
    assert joined.where("`Customer ID` = 'HOT' AND db_customer_name = 'name-0'").count() == n // 3


def test_bucketed_tables_join_without_shuffle(spark):
    from pyspark.sql import functions as F
    from martforge.operators.joins import join_sales_customers
    from martforge.session import work_path
    from martforge.sources.files import write_bucketed
    ledger = spark.range(0, 2000).select(
        F.concat(F.lit("C"), (F.col("id") % 50).cast("string")).alias("Customer ID"), F.col("id").alias("row"))
    dim = spark.range(0, 50).select(
        F.concat(F.lit("C"), F.col("id").cast("string")).alias("customer_id"),
        *[F.lit(x).alias(c) for x, c in [("n", "customer_name"), ("s", "segment"), ("c", "city"),
                                          ("st", "state"), ("r", "region")]])
    write_bucketed(ledger, "t_ledger_b", work_path(spark, "ledger-b"), "Customer ID", 8)
    write_bucketed(dim, "t_dim_b", work_path(spark, "dim-b"), "customer_id", 8)
    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        j = join_sales_customers(spark.table("t_ledger_b"), spark.table("t_dim_b"))
        plan = _plan(j)
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert j.where("db_customer_name = 'n'").count() == 2000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)


def _written_csv(spark, monkeypatch, name):
    """(plan, compression) of each CSV that a query writes."""
    seen, real = [], catalog.files.write_csv

    def write(df, path, *args, **options):
        seen.append((_plan(df), options.get("compression")))
        real(df, path, *args, **options)

    monkeypatch.setattr(catalog.files, "write_csv", write)
    assert catalog.queries()[name](spark, SF).count() > 0
    return seen


def test_ledger_lines_are_exchanged_twice(spark):
    """Customers meet the orders, not the order lines."""
    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        lines = _plan(catalog.raw(spark, SF)).splitlines()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)
    at = next(i for i, x in enumerate(lines) if "SortMergeJoin [o_custkey" in x)
    depth = lines[at].index("SortMergeJoin")
    below = [x for x in lines[at + 1:] if x.lstrip(" :+-*()0123456789")]
    end = next((i for i, x in enumerate(below) if len(x) - len(x.lstrip(" :+-")) <= depth - 4), len(below))
    assert "orders.parquet" in " ".join(below[:end]) and "lineitem.parquet" not in " ".join(below[:end])


def test_csv_roundtrip_writes_compressed_parts(spark, monkeypatch):
    assert [c for _, c in _written_csv(spark, monkeypatch, "csv_roundtrip")] == ["gzip"]


def test_load_published_writes_compressed_parts(spark, monkeypatch):
    assert [c for _, c in _written_csv(spark, monkeypatch, "load_published")] == ["gzip"]


def test_misordered_parts_run_the_ledger_once(spark, monkeypatch):
    seen = _written_csv(spark, monkeypatch, "csv_misordered_parts")
    assert [c for _, c in seen] == ["gzip"] * 3 and not any("Join" in plan for plan, _ in seen)


def test_suites_publish_rows_placed_before_they_are_wide(spark, monkeypatch):
    """The final table is made from one copy of the ledger and exchanged by month before its day-grain joins."""
    seen, real = [], catalog.files.write_table

    def write(df, *args, **options):
        seen.append((_plan(df), options.get("cluster_by")))
        return real(df, *args, **options)

    monkeypatch.setattr(catalog.files, "write_table", write)
    for name in ("dq_suite_final", "dq_results", "dq_summary"):
        assert catalog.queries()[name](spark, SF).count() > 0
    assert len(seen) == 3
    for plan, cluster_by in seen:
        assert cluster_by is None and "lineitem.parquet" not in plan
        at = plan.index("Exchange hashpartitioning(year(Order Date")
        assert "BroadcastHashJoin [Order Date" in plan[:at] and "BroadcastHashJoin [Order Date" not in plan[at:]


def test_placed_rows_are_written_by_few_tasks(spark, tmp_path):
    import os
    from pyspark.sql import functions as F
    rows = spark.range(0, 4000, 1, 8).select("id", (F.col("id") % 3).cast("int").alias("part"))
    placed = catalog.files.clustered(rows, [F.col("part")], ["id"], 2).withColumn("more", F.col("id") + 1)
    catalog.files.write_table(placed, str(tmp_path / "t"), partition_by=["part"], compression="zstd")
    for part in range(3):
        names = [n for n in os.listdir(tmp_path / "t" / f"part={part}") if n.startswith("part-")]
        assert 1 <= len(names) <= 2 and all(".zstd." in n for n in names)
    assert spark.read.parquet(str(tmp_path / "t")).count() == 4000


def test_wide_exchanges_line_columns_last(spark, monkeypatch):
    """What lines of an order share comes first in the rows that the customer join exchanges; the result keeps its order."""
    from martforge.plans import wide
    seen, real = [], wide.join_sales_customers
    monkeypatch.setattr(wide, "join_sales_customers", lambda sales, dim: seen.append(sales.columns) or real(sales, dim))
    df = catalog.wide_from_stored_dimension(spark, SF)
    assert seen[0].index("Region") < seen[0].index("Row ID") < seen[0].index("Ship Date") < seen[0].index("Product Name")
    assert sorted(seen[0]) == sorted(catalog.RAW_LEDGER.fieldNames())
    assert df.columns[:4] == ["Order Date", "Row ID", "Order ID", "Ship Date"]


def test_suites_send_many_customers_to_the_lines(spark, monkeypatch):
    """Customers that are too many for a broadcast go to the place of the order lines, which are exchanged
    once; the published rows are those of the wide table."""
    import glob
    plans, paths, real = [], [], catalog.files.write_table

    def write(df, path, *args, **options):
        plans.append(_plan(df))
        paths.append(path.removeprefix("file:"))
        return real(df, path, *args, **options)

    plain = catalog.queries()["dq_suite_final"](spark, SF).collect()
    monkeypatch.setattr(catalog.files, "write_table", write)
    monkeypatch.setattr(catalog, "broadcasts", lambda df: False)
    assert catalog.queries()["dq_suite_final"](spark, SF).collect() == plain
    assert plans[0].count("Exchange shufflepartitionidpassthrough") == 2 and "lineitem.parquet" not in plans[0]
    assert "Exchange hashpartitioning(year(Order Date" not in plans[0]
    wide = catalog.materialize(catalog.wide(spark, SF))
    published = spark.read.schema(wide.schema).parquet(paths[0]).select(wide.columns)
    assert published.exceptAll(wide).isEmpty() and wide.exceptAll(published).isEmpty()
    months = [len(glob.glob(f"{m}/part-*")) for m in glob.glob(f"{paths[0]}/year=*/month=*")]
    assert months and max(months) <= 16


def test_broadcasts_by_stored_bytes(spark):
    from martforge.operators.sizing import broadcasts, materialize
    table = materialize(spark.range(0, 50))
    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        for limit, small in (("10MB", True), ("100b", False), ("-1", False)):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
            assert broadcasts(table) == small
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)


def test_stored_tables_are_checked_without_another_copy(spark, monkeypatch):
    """The ledger and the weather are stored once for all suites that read them."""
    names, real = [], catalog.materialize_counted

    def counted(df, metrics, name="table", *args):
        names.append(name)
        return real(df, metrics, name, *args)

    def stored(df, name="table"):
        return counted(df, {}, name)[0]

    monkeypatch.setattr(catalog, "materialize_counted", counted)
    monkeypatch.setattr(catalog, "materialize", stored)
    runs, real_weather = [], catalog.weather
    monkeypatch.setattr(catalog, "weather", lambda *at: runs.append(at) or real_weather(*at))
    for key in ("dq_results", "dq_summary"):
        names.clear()
        runs.clear()
        assert catalog.queries()[key](spark, SF).count() > 0
        assert sorted(names) == ["checked-raw_holidays", "customers", "ledger", "weather"] and len(runs) == 1
