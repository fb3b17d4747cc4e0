import random

import numpy as np
import pytest

from martforge.llm import jaccard
from martforge.llm.components import components

from .helpers import SPACE, by_id, corpus, frame, lower, prose, word


def sets_of(rows):
    out = {}
    for i, t in rows:
        w = SPACE.findall(lower(t or ""))
        out[i] = {tuple(w[k:k + 4]) for k in range(len(w) - 3)} if len(w) >= 4 else ({tuple(w)} if w else set())
    return out


def brute(rows):
    sets = sets_of(rows)
    ids = sorted(sets)
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in range(len(ids)):
        for b in range(a):
            x, y = sets[ids[a]], sets[ids[b]]
            both = len(x & y)
            if both and 100 * both >= 85 * len(x | y):
                ra, rb = find(ids[a]), find(ids[b])
                root[max(ra, rb)] = min(ra, rb)
    return {i: (len(sets[i]), find(i)) for i in ids}


def near(rng, base, edits):
    words = SPACE.findall(base)
    for _ in range(edits):
        kind, k = rng.choice("rid"), rng.randrange(len(words))
        words[k:k + (kind != "i")] = [] if kind == "d" else [word(rng)]
    return " ".join(words)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_matches_brute_force(spark, seed):
    rng = random.Random(seed)
    rows = corpus(seed)
    line = prose(rng, 25)
    for c in range(4):
        base = prose(rng, rng.choice([30, 80, 200])) + line
        rows += [(20_000 + 1000 * c + rng.randrange(1000), near(rng, base, rng.randint(0, 8))) for _ in range(60)]
    rows = list(dict(rows).items())
    want = brute(rows)
    got = by_id(jaccard.report(frame(spark, rows)))
    assert {i: (r["n_shingles"], r["component_id"]) for i, r in got.items()} == want
    assert len({c for _, c in want.values()}) < len(want) - 50


def test_search_is_exact():
    rng = np.random.default_rng(3)
    for _ in range(200):
        query = np.unique(rng.integers(0, 60, rng.integers(1, 50))).astype(np.uint64)
        sets = [np.unique(np.concatenate([rng.permutation(query)[:rng.integers(0, len(query) + 1)],
                                          rng.integers(0, 90, rng.integers(1, 9)).astype(np.uint64)])) for _ in range(6)]
        keys, owner = np.concatenate(sets), np.repeat(np.arange(6), [len(s) for s in sets])
        for percent in (30, 60, 85, 100):
            got = jaccard.t_occurrence(query, keys, owner, np.array([len(s) for s in sets]), percent)
            want = [100 * len(np.intersect1d(query, s)) >= percent * len(np.union1d(query, s)) for s in sets]
            assert got.tolist() == want


def test_components(spark):
    rng = random.Random(2)
    links = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)] + [(k, k + 1) for k in range(300, 420)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "u bigint, v bigint")).collect()}
    root = list(range(500))
    for _ in range(200):
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    linked = {x for a, b in links if a != b for x in (a, b)}
    assert got == {x: root[x] for x in linked}
    assert components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0


def test_empty_and_short(spark):
    assert jaccard.report(frame(spark, [])).count() == 0
    got = by_id(jaccard.report(frame(spark, [(5, None), (6, ""), (7, "A b"), (8, "a  B"), (9, "a b c")])))
    assert {i: (r["n_shingles"], r["component_id"]) for i, r in got.items()} == {
        5: (0, 5), 6: (0, 6), 7: (1, 7), 8: (1, 7), 9: (1, 9)}


def test_rows_without_own_ids_and_texts_beyond_a_slice(spark):
    rng = random.Random(6)
    base, long = prose(rng, 120), prose(rng, 200_000)
    assert len(long.encode()) > 1 << 20
    texts = [base, near(rng, base, 1), prose(rng, 40), near(rng, base, 2), base, None, long, near(rng, long, 3), "a b", "A B", prose(rng, 30)]
    ids = [9, 9, 9, None, 4, None, None, None, None, 5, None]
    roots = brute(list(enumerate(texts)))
    least = {}
    for k, i in enumerate(ids):
        if i is not None:
            least[roots[k][1]] = min(i, least.get(roots[k][1], i))
    want = [(i, roots[k][0], least.get(roots[k][1]) if roots[k][0] else i) for k, i in enumerate(ids)]
    got = [(r.doc_id, r.n_shingles, r.component_id) for r in jaccard.report(frame(spark, list(zip(ids, texts)))).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
