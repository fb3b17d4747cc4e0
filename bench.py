"""Benchmark: headline queries on the test tables.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_REPEAT (default 3, median reported).  Results are consumed by the
``noop`` writer (full execution, nothing collected to the driver).

The test tables are files of one row group each, which one task reads whole; so
that the keys measure plans on all cores, the tables are first written to work
folders in one file per core (not timed).

Two groups, like the reference's own flow (build the wide table, publish
it, then validate it and serve dashboards from it):
* end-to-end keys build their plan from the raw tables every run;
* ``wide_publish`` writes the wide table as parquet partitioned by
  year/month; ``*_published`` keys read that published table.
Prints ONE JSON line; ``value`` is the sum over all keys.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from martforge.functions.columns import normalize_columns  # noqa: E402
from martforge.operators import bi  # noqa: E402
from martforge.operators import quality as Q  # noqa: E402
from martforge.plans import catalog  # noqa: E402
from martforge.session import clean_work, local_session, work_path  # noqa: E402
from martforge.sources.files import write_table  # noqa: E402

END_TO_END = ["wide_analytics", "engineer_features", "rolling_sales", "days_until_next_holiday",
              "join_sales_weather", "bi_kpis"]


def timed(action):
    t0 = time.perf_counter()
    action()
    return time.perf_counter() - t0


TABLES = ["lineitem", "orders", "customer", "part", "nation", "region"]


def spread(spark, sf, cpus):
    """The tables of ``sf`` as files that all cores can read at once."""
    root = work_path(spark, "bench-tables")
    for name in TABLES:
        table = spark.read.parquet(f"{sf}/{name}.parquet")
        large = name in ("lineitem", "orders")
        (table.repartition(cpus) if large else table).write.parquet(f"{root}/{name}.parquet")
    return root


def noop(df):
    df.write.format("noop").mode("overwrite").save()


def main():
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    spark = local_session(cores=cpus, shuffle_partitions=max(8, cpus * 2), app="martforge-bench")
    qs = catalog.queries()
    given, sf = sf, spread(spark, sf, cpus)
    noop(qs["wide_analytics"](spark, sf))  # warm-up: JVM, code generation
    times = {}
    for name in END_TO_END:
        times[name] = statistics.median(timed(lambda: noop(qs[name](spark, sf))) for _ in range(repeat))

    paths = []

    def publish():
        path = work_path(spark, "wide-published")
        write_table(catalog.wide(spark, sf), path, partition_by=["year", "month"], cluster_by=["Row ID"])
        paths.append(path)

    times["wide_publish"] = statistics.median(timed(publish) for _ in range(repeat))
    published = paths[-1]

    def table():
        return spark.read.parquet(published)

    published_queries = {
        "dq_suite_final_published": lambda: Q.validate(
            table(), catalog.SUITE_RULES["final_analytics"], "final_analytics",
            sample_order=["Row ID"]),
        "bi_kpis_published": lambda: bi.kpis(normalize_columns(table())),
        "bi_top_customers_published": lambda: bi.top_customers(normalize_columns(table())),
        "bi_sales_by_category_published": lambda: bi.measure_by(
            normalize_columns(table()), "category", "sales"),
    }
    for name, build in published_queries.items():
        times[name] = statistics.median(timed(lambda: noop(build())) for _ in range(repeat))

    times = {k: round(v, 3) for k, v in times.items()}
    sf_name = os.path.basename(given.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total_wall", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf_name, "cpus": cpus,
                      "repeat": repeat, "spark": spark.version}))
    clean_work(spark)
    spark.stop()


if __name__ == "__main__":
    main()
