import random
import zlib

import numpy as np

from martforge.llm import langid

from .helpers import by_id

SYLLABLES = {"aa": "the ing tion re wh an th er ed".split(), "bb": "der sch ung ein ich ö ü ver".split(),
             "cc": "que eau ment é è les ou".split()}


def documents(spark, n=240, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        lang = rng.choice(list(SYLLABLES))
        text = " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 3))) for _ in range(rng.randint(5, 80)))
        rows.append((i, text, lang, "x"))
    rows += [(9001, None, "aa", "x"), (9002, "", "bb", "x"), (9003, "12 34 --", "cc", "x"), (9004, "sch einung", None, "x")]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, lang_pred string"), rows


def test_held_out_accuracy_and_edges(spark):
    docs, rows = documents(spark)
    got = by_id(langid.report(docs))
    assert len(got) == len(rows)
    held = [(i, lang) for i, _, lang, _ in rows[:240] if zlib.crc32(str(i).encode()) % 4 == 2]
    assert all(got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) for i in got)
    assert np.mean([got[i]["lang_pred"] == lang for i, lang in held]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in got.values())
    assert [got[i]["lang_pred"] for i in (9001, 9002, 9003)] == ["und"] * 3 and got[9004]["lang_pred"] == "bb"


def test_nothing_to_learn(spark):
    docs, _ = documents(spark)
    assert langid.report(docs.limit(0)).count() == 0
    only_held = docs.where("crc32(cast(doc_id as string)) % 4 = 2")
    assert {r["lang_pred"] for r in langid.report(only_held).collect()} == {"und"}


def test_penalty_keeps_weights_sparse():
    rng = np.random.default_rng(1)
    rows = [(np.sort(rng.choice(500, 20, replace=False)) + 10, np.full(20, 0.1), 0) for _ in range(100)]
    rows = [(np.append(c, y), np.append(v, 1.0), y) for (c, v, _), y in zip(rows, [0, 1] * 50)]
    weights = langid.fit_ftrl(rows, 2, 600)
    assert weights[0, 0] > 0.5 and weights[1, 1] > 0.5
    assert np.mean(weights[520:600] == 0) == 1 and np.mean(weights[:520] == 0) > 0.03


def test_temperature():
    rng = np.random.default_rng(2)
    logits = rng.normal(size=(3000, 3))
    labels = np.array([rng.choice(3, p=langid._softmax(x)) for x in logits])
    assert abs(langid.temperature(logits * 4, labels) - 4) < 0.6
