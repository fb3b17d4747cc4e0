import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from martforge.llm import packing
from martforge.session import work_path

from .helpers import corpus, frame


def check(rows, capacity):
    bins = {}
    for r in rows:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for members in bins.values():
        at = 0
        for offset, length in sorted(members):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


def test_pieces_and_sequences(spark):
    from tokenizers import Tokenizer

    rows = corpus(7) + [(1, "wörd " * 9000), (2, "it's 3.5 x<|endoftext|>y é"), (3, "same text")] + [(4, "same text")] * 3
    got = packing.report(frame(spark, rows)).collect()
    model = Tokenizer.from_file(packing.tokenizer_path())
    want = []
    for i, t in rows:
        ids = np.array([*model.encode(t or "", add_special_tokens=False).ids, 0], dtype="<u4")
        want += [(i, k // 2048, k, len(ids[k:k + 2048]), zlib.crc32(ids[k:k + 2048].tobytes())) for k in range(0, len(ids), 2048)]
    assert sorted(tuple(r)[:5] for r in got) == sorted(want)
    bins = check(got, 2048)
    assert bins <= -(-sum(w[3] for w in want) // 2048) + 1


def test_sequences_hold_the_token_ids(spark):
    from tokenizers import Tokenizer

    rows = corpus(9) + [(1, "wörd " * 9000), (2, None), (3, "same text"), (4, "same text"), (None, "no id")]
    path = work_path(spark, "sequences-test")
    packing.report(frame(spark, rows), path)
    written = spark.read.parquet(path).withColumn("file", F.input_file_name()).collect()
    model = Tokenizer.from_file(packing.tokenizer_path())
    texts, sequences, files = {}, {}, {}
    for r in written:
        ids = np.frombuffer(r["ids"], dtype="<u4")
        assert len(ids) == r["length"]
        texts.setdefault(r["doc_id"], {})[r["start"]] = ids
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], ids))
        files.setdefault(r["sequence_id"], set()).add(r["file"])
    for i, t in rows:
        got = np.concatenate([ids for _, ids in sorted(texts.pop(i).items())])
        assert got.tolist() == [*model.encode(t or "", add_special_tokens=False).ids, 0]
    assert not texts and all(len(f) == 1 for f in files.values())
    for members in sequences.values():  # in order and gapless as they stand in the file
        assert [at for at, _ in members] == np.cumsum([0] + [len(ids) for _, ids in members])[:-1].tolist()
        assert sum(len(ids) for _, ids in members) <= 2048


def test_empty_table(spark):
    assert packing.report(frame(spark, [])).count() == 0


@pytest.mark.parametrize("kind", ["uniform", "thirds", "halves", "small", "one"])
def test_plan_places_everything_once(kind):
    rng = np.random.default_rng(1)
    lengths = {"uniform": rng.integers(1, 101, 3000), "thirds": rng.integers(30, 38, 2000), "halves": rng.integers(49, 53, 999),
               "small": rng.integers(1, 9, 2000), "one": np.array([7])}[kind]
    counts = np.bincount(lengths, minlength=101)
    for cut in (26, 34, 51):
        plan = packing._plan(counts, 100, cut, 12)
        rank = {}
        rows = []
        for length, lo, hi, first, per, offset in sorted(plan.rows):
            assert rank.get(length, 0) == lo
            rank[length] = hi
            rows += [{"sequence_id": first + k // per, "offset": offset + k % per * length, "length": length} for k in range(hi - lo)]
        assert np.array_equal(np.bincount([r["length"] for r in rows], minlength=101), counts)
        assert check(rows, 100) == plan.sequences
        assert plan.sequences <= 1.35 * counts @ np.arange(101) / 100 + 1


def test_configurations_reach_the_bound():
    # 44 and 56 fit together, 34 three times (less than that leaves waste)
    uses = packing.configurations([56, 44, 33], [50, 50, 90], 100)
    assert sum(n for _, n in uses) == 80


def test_groups_have_equal_cardinality():
    counts = np.bincount([90] * 5 + [80] * 5 + [70] * 5 + [60] * 5, minlength=101)
    groups = packing.linear_groups(counts, 50, 3)
    assert [(g[0], g[1]) for g in groups] == [(90, 7), (80, 7), (70, 6)]
