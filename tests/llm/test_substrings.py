import hashlib
import random
import tracemalloc

import pyarrow as pa
import pytest

from martforge.llm import substrings, textkit

from .helpers import SPACE, by_id, corpus, frame, prose


def brute(rows):
    words = {i: SPACE.findall(t or "") for i, t in rows}
    seen = {}
    for i, w in words.items():
        for k in range(len(w) - 34):
            seen.setdefault(tuple(w[k:k + 35]), []).append((i, k))
    gone = {i: set() for i in words}
    for places in seen.values():
        if len(places) > 1:
            for i, k in places:
                gone[i].update(range(k, k + 35))
    out = {}
    for i, w in words.items():
        kept = " ".join(x for k, x in enumerate(w) if k not in gone[i])
        out[i] = (len(w), len(gone[i]), hashlib.sha256(kept.encode()).hexdigest())
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_matches_brute_force(spark, seed):
    rows = corpus(seed)
    got = by_id(substrings.find_repeats(frame(spark, rows)))
    want = brute(rows)
    assert {i: (r["n_words"], r["n_removed"], r["kept_sha256"]) for i, r in got.items()} == want
    assert sum(w[1] > 0 for w in want.values()) > 15
    for r in got.values():
        spans = r["spans"]
        assert sum(b - a for a, b in zip(spans[::2], spans[1::2])) == r["n_removed"]


def test_boundaries_of_repeats(spark):
    rng = random.Random(5)
    shared = SPACE.findall(prose(rng, 90))
    rows = []
    for i, length in enumerate([34, 35, 36, 50, 90, 90]):  # below, at and above the window
        rows.append((i, " ".join(SPACE.findall(prose(rng, 20 + i)) + shared[:length] + SPACE.findall(prose(rng, 9)))))
    twice = " ".join(shared[20:70])
    rows.append((90, f"{twice} {prose(rng, 12)} {twice}"))
    got = by_id(substrings.report(frame(spark, rows)))
    assert {i: (r["n_words"], r["n_removed"], r["kept_sha256"]) for i, r in got.items()} == brute(rows)


def test_empty_table(spark):
    assert substrings.report(frame(spark, [])).count() == 0
    assert by_id(substrings.report(frame(spark, [(1, None)])))[1]["n_removed"] == 0


def test_rows_without_own_ids_and_texts_beyond_a_slice(spark):
    rng = random.Random(8)
    shared, other = prose(rng, 60), prose(rng, 50)
    texts = [f"{prose(rng, 30)} {shared}", f"{shared} {prose(rng, 10)}", f"{prose(rng, 5)} {shared} {prose(rng, 9)}", prose(rng, 80), None,
             f"{other} {prose(rng, 12)}", other, other, prose(rng, 200_000) + " " + shared, "x"]
    ids = [1, 1, 2, None, None, None, 7, 7, 8, 1]
    assert len(texts[8].encode()) > 1 << 20
    want = brute(list(enumerate(texts)))
    got = [(r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in substrings.report(frame(spark, list(zip(ids, texts)))).collect()]
    assert sorted(got, key=str) == sorted([(i, *want[k]) for k, i in enumerate(ids)], key=str)
    assert want[0][1] and want[5][1] and want[8][1]


def test_a_worker_holds_little_beside_its_batch(monkeypatch):
    rng = random.Random(9)
    batch = pa.RecordBatch.from_arrays([pa.array([prose(rng, 500) for _ in range(800)])], ["text"])
    assert batch.nbytes > 2 << 20
    monkeypatch.setattr(textkit, "_powers", {})

    class Stop(Exception):
        pass

    def scan(docs, text, fields, func, *limit):
        for part in textkit.slices(batch, text, *limit):
            func(part.column(text))
        raise Stop

    monkeypatch.setattr(substrings, "add_columns", scan)
    monkeypatch.setattr(substrings, "numbered", lambda docs, *names, **columns: docs)
    tracemalloc.start()
    try:
        with pytest.raises(Stop):
            substrings.find_repeats.__wrapped__(None)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 50 << 20
