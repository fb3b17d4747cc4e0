import itertools
import random
import zlib

import numpy as np

from martforge.llm import crf, toxicity

from .helpers import by_id, prose


def brute(score, trans):
    """Marginals and transition counts over all taggings of one sequence."""
    total, marginal, pairs = 0.0, np.zeros(len(score)), np.zeros((2, 2))
    for tags in itertools.product((0, 1), repeat=len(score)):
        path = list(zip((0,) + tags, tags))
        weight = np.exp(sum(trans[a, b] for a, b in path) + np.dot(tags, score))
        total += weight
        marginal += weight * np.array(tags)
        for a, b in path:
            pairs[a, b] += weight
    return marginal / total, pairs / total


def test_forward_backward_matches_enumeration():
    rng = np.random.default_rng(1)
    trans = rng.normal(size=(2, 2))
    lengths = [3, 0, 1, 9, 5]
    score = rng.normal(size=sum(lengths)) * 2
    marginal, pairs = crf.Chains(np.array(lengths)).marginals(score, trans)
    at, want = 0, np.zeros((2, 2))
    for n in lengths:
        m, p = brute(score[at:at + n], trans)
        assert np.allclose(marginal[at:at + n], m)
        want, at = want + p, at + n
    assert np.allclose(pairs, want)


def test_messages_cross_blocks():
    rng = np.random.default_rng(4)
    trans, n = np.array([[0.0, -2.0], [-1.0, 1.5]]), 3 * crf.BLOCK + 7
    score = rng.normal(size=n)
    m = np.exp(trans)
    ahead, behind = np.zeros((n + 1, 2)), np.ones((n + 1, 2))
    ahead[0] = 1, 0
    for t in range(n):
        a = ahead[t] @ m * np.array([1, np.exp(score[t])])
        ahead[t + 1] = a / a.sum()
    for t in range(n - 1, -1, -1):
        b = m @ (np.array([1, np.exp(score[t])]) * behind[t + 1])
        behind[t] = b / b.sum()
    both = ahead[1:] * behind[1:]
    got, _ = crf.Chains(np.array([n])).marginals(score, trans)
    assert np.allclose(got, both[:, 1] / both.sum(axis=1))


def data(spark, n=400):
    rng = random.Random(1)
    bad = "grumbo flarkin zontic".split()
    rows, labels = [], []
    for i in range(n):
        words = prose(rng, rng.randint(10, 90)).split(" ")
        toxic = rng.random() < 0.2
        for _ in range(rng.randint(1, 4) if toxic else 0):
            words.insert(rng.randrange(len(words)), rng.choice(bad) + rng.choice(["", ",", "ta"]))
        rows.append((i, " ".join(words), "c"))
        labels.append((i, 1, int(toxic)))
    rows += [(9001, None, "c"), (9002, "", "c"), (9003, "unlabelled grumbo", "c")]
    labels += [(9001, 1, 0), (5, 1, None), (77_777, 0, 1)]
    return (spark.createDataFrame(rows, "doc_id bigint, text string, toxic string"),
            spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"), rows, dict((i, y) for i, _, y in labels[:n]))


def test_held_out_and_spans(spark):
    docs, labels, rows, truth = data(spark)
    got = by_id(toxicity.report(docs, labels))
    assert len(got) == len(rows)
    held = [i for i in truth if zlib.crc32(str(i).encode()) % 4 == 2]
    assert all(got[i]["held_out"] for i in held)
    assert np.mean([got[i]["predicted"] == truth[i] for i in held]) > 0.97
    assert got[9001]["predicted"] == got[9002]["predicted"] == 0 and got[9003]["predicted"] == 1
    assert all(0 <= r["score"] <= 1 for r in got.values())
    model = toxicity.train(docs, labels)
    texts = {i: t for i, t, _ in rows}
    spans = [texts[r["doc_id"]][a:b] for r in toxicity.tag(docs, model).collect()
             for a, b in zip(r["toxic_spans"][::2], r["toxic_spans"][1::2])]
    assert len(spans) > 100
    assert np.mean([any(w in s.lower() for w in ("grumbo", "flarkin", "zontic")) for s in spans]) > 0.9


def test_nothing_to_learn(spark):
    docs, labels, rows, _ = data(spark)
    assert {r["score"] for r in toxicity.report(docs, labels.limit(0)).collect()} == {0.0}
    assert toxicity.report(docs.limit(0), labels).count() == 0


def test_long_documents_give_the_words_around_their_strongest(spark, monkeypatch):
    import numpy as np

    from martforge.llm import ngrams

    monkeypatch.setattr(toxicity, "FIT_TOKENS", 10)
    texts = [" ".join([f"w{k}" for k in range(30)]), "a b c", " ".join([f"v{k}" for k in range(11)])]
    docs = spark.createDataFrame([(k, t, k % 2) for k, t in enumerate(texts)], "id bigint, text string, toxic int").coalesce(1)
    bins = np.random.default_rng(1).integers(1, 50, 1 << toxicity.BITS).astype(np.int16)
    run = {}
    monkeypatch.setattr(toxicity, "map_arrow", lambda df, f, schema: run.setdefault("f", f) and df)

    class Shared:
        value = [bins, bins]

    toxicity._sampled(docs, Shared)
    got = [b for b in run["f"](docs.toArrow().to_batches())]
    rows = [x for b in got for x in b.column(2).to_pylist()]
    whole = [toxicity._token_bins(ngrams.pa.array([t]), bins)[1].tolist() for t in texts]
    assert rows[1] == whole[1] and [len(r) for r in rows] == [10, 3, 10]
    for k in (0, 2):
        assert max(rows[k]) == max(whole[k])
        assert any(whole[k][i:i + 10] == rows[k] for i in range(len(whole[k])))
