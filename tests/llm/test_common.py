"""Tables of operators: results outlive other operators and threads, the rest goes."""

import os
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import functions as F

from martforge import session
from martforge.llm import common, jaccard, packing, prefixtrie, shards, substrings

from .helpers import corpus, frame


def folders(spark):
    base = session.checkpoint_dir(spark)
    return {f for f in os.listdir(base) if f.startswith("martforge-")}


def test_results_outlive_other_operators(spark):
    import corpus_pipeline as cp

    from .test_pipeline import tables

    before = folders(spark)
    lazy = substrings.find_repeats(frame(spark, corpus(31)))
    assert len(folders(spark) - before) == 1  # the result
    expected = sorted(map(str, lazy.collect()))
    path, _ = tables(spark)
    cp.run(spark, path).count()
    jaccard.classes(frame(spark, corpus(32))).count()
    assert sorted(map(str, lazy.collect())) == expected


def test_two_threads(spark):
    docs = [frame(spark, corpus(40 + k)) for k in range(4)]
    jobs = [lambda: substrings.find_repeats(docs[0]), lambda: jaccard.classes(docs[1]), lambda: packing.pack(docs[2]).drop("ids"),
            lambda: shards.shuffle_to_shards(docs[3])]
    with ThreadPoolExecutor(4) as pool:
        lazy = [f.result() for f in [pool.submit(j) for j in jobs]]
    for df, rows in zip(lazy, (corpus(40 + k) for k in range(4))):
        assert df.select("doc_id").distinct().count() == len(rows)


def test_a_failing_operator_leaves_no_tables(spark):
    before = folders(spark)
    bad = spark.range(3).select(F.col("id").alias("conv_id"), F.lit(1).alias("turn"), F.lit("u").alias("role"),
                                F.when(F.col("id") == 2, F.raise_error(F.lit("bad")).cast("string")).otherwise("x").alias("text"))
    try:
        prefixtrie.trie(bad)
        raise AssertionError
    except Exception as exc:  # noqa: BLE001
        assert "bad" in str(exc)
    assert folders(spark) - before <= {f for f in folders(spark) if "-turns-" in f}
    assert common._running.get() is None


def test_nested_operators_hand_their_results_over(spark):
    @common.scoped
    def outer(n):
        inner = common.scoped(lambda: spark.range(n))()
        return inner.selectExpr("id + 1 AS id")

    before = folders(spark)
    assert sorted(r.id for r in outer(4).collect()) == [1, 2, 3, 4]
    assert len(folders(spark) - before) == 1
