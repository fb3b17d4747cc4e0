import zlib

import numpy as np

from martforge.llm import shards

from .helpers import corpus, frame


def test_sizes_slots_and_columns(spark):
    rows = corpus(4) + [(5, "same")] * 300
    got = shards.report(frame(spark, rows).repartition(3)).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(i for i, _ in rows)
    counts = np.bincount([r["shard"] for r in got], minlength=8)
    assert counts.max() - counts.min() <= 1 and len(counts) == 8
    for s in range(8):
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(counts[s]))
    texts = dict(rows)
    for r in got:
        body = (texts[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(body) + 1, zlib.crc32(body), "rows", None)


def test_empty_and_few_rows(spark):
    assert shards.report(frame(spark, [])).count() == 0
    got = shards.report(frame(spark, [(1, "a"), (2, None)])).collect()
    assert sorted(r["slot"] for r in got) == [0, 0] and len({r["shard"] for r in got}) == 2


def test_matrix_sums_and_uniformity():
    sizes = np.array([10, 0, 35, 7])
    total = np.zeros((4, 8))
    for seed in range(400):
        m = shards.draw_matrix(sizes, 8, seed)
        assert (m.sum(axis=1) == sizes).all() and np.ptp(m.sum(axis=0)) <= 1
        total += m
    assert np.allclose(total / 400, sizes[:, None] / 8, atol=0.35)


def test_large_populations():
    rng = np.random.default_rng(1)
    draws = [shards._hypergeometric(rng, 3 * 10**9, 9 * 10**9, 4000) for _ in range(300)]
    assert abs(np.mean(draws) - 1000) < 8 and 20 < np.std(draws) < 35
    assert shards._hypergeometric(rng, 2 * 10**9, 0, 5) == 5


def test_repeatable(spark):
    df = frame(spark, corpus(6)).repartition(4).persist()
    a, b = (sorted(map(tuple, shards.report(df).collect()), key=str) for _ in range(2))
    assert a == b


def test_whole_documents_lie_in_their_shards(spark):
    rows = corpus(8) + [(5, "same")] * 40 + [(6, "long " * 50_000), (None, None)]
    sharded = shards.shuffle_to_shards(frame(spark, rows).select("doc_id", "text").repartition(3))
    got = sharded.collect()
    assert sorted(((r["doc_id"], r["text"]) for r in got), key=str) == sorted(rows, key=str)
    assert len({(r["shard"], r["slot"]) for r in got}) == len(rows)
    files = sharded.inputFiles()  # the written result itself, one folder per shard
    assert {f.split("/shard=")[1].split("/")[0] for f in files} == {str(s) for s in range(8)}
    for s in range(8):
        inside = spark.read.schema("text string").parquet(*[f for f in files if f"/shard={s}/" in f])
        assert sorted(map(str, (r["text"] for r in inside.collect()))) == sorted(str(r["text"]) for r in got if r["shard"] == s)
