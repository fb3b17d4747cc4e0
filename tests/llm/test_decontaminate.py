import hashlib
import random

import pytest

from martforge.llm import decontaminate as dc

from .helpers import ALNUM, by_id, corpus, frame, lower, prose


def brute(rows, items):
    windows = {}
    for item, text in items:
        w = ALNUM.findall(lower(text or ""))
        if w:
            for k in range(max(1, len(w) - 9)):
                windows.setdefault(tuple(w[k:k + 10]), set()).add(str(item))
    sizes = {len(w) for w in windows}
    out = {}
    for i, text in rows:
        w = ALNUM.findall(lower(text or ""))
        hit, ids = set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                if tuple(w[k:k + n]) in windows:
                    hit.update(range(k, k + n))
                    ids |= windows[tuple(w[k:k + n])]
        out[i] = (len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit))
    return out


def data(seed):
    rows = corpus(seed)
    rng = random.Random(seed)
    items = [(k, prose(rng, rng.choice([3, 9, 10, 11, 30]))) for k in range(12)]
    items += [(20, None), (21, " .,; "), (22, items[0][1]), (3, items[4][1]), (100, "Fa So")]
    for k, (_, text) in enumerate(items[:8]):
        words = ALNUM.findall(text)
        rows.append((9000 + k, prose(rng, 20) + " " + "--".join(words).upper().replace("É", "é") + "! " + prose(rng, 5)))
        rows.append((9100 + k, " ".join(words[1:])))
    return rows, items


@pytest.mark.parametrize("block", [dc.BLOCK_BYTES, 200])
def test_matches_brute_force(spark, block):
    rows, items = data(3)
    bench = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id bigint, text string, item int")
    marked = dc.decontaminate(frame(spark, rows).select("doc_id", "text"), bench, block_bytes=block)
    want = brute(rows, items)
    got = by_id(marked)
    assert {i: (r["n_words"], r["n_hit"], len(r["hit_items"]), dc.digest(r["hit_items"]), r["n_hit"] > 0)
            for i, r in got.items()} == want
    assert sum(w[4] for w in want.values()) > 8
    texts = dict(rows)
    for i, r in got.items():  # offsets point into the original text
        spans = r["hit_spans"]
        words = sum(len(ALNUM.findall(lower(texts[i][a:b]))) for a, b in zip(spans[::2], spans[1::2]))
        assert words == r["n_hit"]
    if block == dc.BLOCK_BYTES:
        rep = by_id(dc.report(frame(spark, rows), bench))
        assert {i: (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) for i, r in rep.items()} == want


def test_empty_tables(spark):
    bench = spark.createDataFrame([], "item_id bigint, text string")
    assert dc.report(frame(spark, []), bench).count() == 0
    assert not by_id(dc.report(frame(spark, [(1, "a b")]), bench))[1]["contaminated"]


def test_equal_items_are_dealt_once(spark, monkeypatch):
    rows, items = data(5)
    bench = spark.createDataFrame(items + [items[2]] * 300, "item_id bigint, text string")
    held, build = [], dc._patterns
    monkeypatch.setattr(dc, "_patterns", lambda rows, size: held.append(rows) or build(rows, size))
    got = by_id(dc.report(frame(spark, rows), bench))
    assert sum(map(len, held)) == len(set(items))
    assert {i: (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) for i, r in got.items()} == brute(rows, items)
