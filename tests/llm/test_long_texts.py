"""Texts longer than a slice, rows without id and repeated rows in operators whose own tests have none."""

import random
import zlib

import pytest

from martforge.llm import decontaminate, langid, quality, shards, toxicity

from .helpers import ALNUM, SPACE, lower, prose

LONG = prose(random.Random(1), 220_000)
ROWS = [(1, LONG), (1, LONG), (None, LONG), (None, None), (2, "short text of a few words"), (2, ""), (None, "short text of a few words")]


def docs(spark):
    assert len(LONG.encode()) > 1 << 20
    rng = random.Random(2)
    more = [(100 + k, prose(rng, 40)) for k in range(80)]
    return spark.createDataFrame([(i, t, "aa" if k % 2 else "bb") for k, (i, t) in enumerate(ROWS + more)],
                                 "doc_id bigint, text string, lang string")


def of(df, *columns):
    return sorted([tuple(r[c] for c in columns) for r in df.collect() if r.doc_id is None or r.doc_id < 100], key=str)


def test_decontamination(spark):
    words = ALNUM.findall(lower(LONG))
    items = spark.createDataFrame([(7, " ".join(words[-300:-280])), (8, None), (None, "of a few words")], "item_id bigint, text string")
    got = of(decontaminate.report(docs(spark), items), "doc_id", "n_words", "n_hit")
    n = len(words)
    assert got == sorted([(1, n, 20), (1, n, 20), (None, n, 20), (None, 0, 0), (2, 6, 4), (2, 0, 0), (None, 6, 4)], key=str)


def test_quality(spark):
    got = of(quality.report(docs(spark)), "doc_id", "n_words", "word_chars")
    words = SPACE.findall(LONG)
    whole = (len(words), sum(map(len, words)))
    short = (6, len("shorttextofafewwords"))
    assert got == sorted([(1, *whole), (1, *whole), (None, *whole), (None, 0, 0), (2, *short), (2, 0, 0), (None, *short)], key=str)


@pytest.mark.parametrize("report", ["langid", "toxicity"])
def test_learned(spark, report):
    table = docs(spark)
    if report == "langid":
        got = langid.report(table).collect()
    else:
        labels = spark.createDataFrame([(100 + k, k % 2) for k in range(80)] + [(1, 0), (None, 1)], "doc_id bigint, toxic int")
        got = toxicity.report(table, labels).collect()
    assert len(got) == len(ROWS) + 80
    score = {}
    for r in got:
        assert 0 <= r.score <= 1
        if r.doc_id is not None:
            assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        score.setdefault(r.doc_id, []).append(round(r.score, 9))
    assert len(set(score[1])) == 1 and set(score[1]) <= set(score[None])  # equal texts, whatever the id


def test_shards(spark):
    got = shards.report(docs(spark)).collect()
    sizes = sorted(r.size for r in got if r.doc_id is None or r.doc_id < 100)
    assert sizes == sorted(len((t or "").encode()) + 1 for _, t in ROWS)
    for shard in {r.shard for r in got}:
        slots = sorted(r.slot for r in got if r.shard == shard)
        assert slots == list(range(len(slots)))
