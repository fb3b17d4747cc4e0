import random

import numpy as np
import pyarrow as pa

from martforge.llm import quality
from martforge.llm.textkit import Words

from .helpers import SPACE, by_id, corpus, frame, prose


def brute(text):
    text = text or ""
    w = SPACE.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if SPACE.search(line):
            dup += line in seen
            seen.add(line)

    def covered(size):
        at = {}
        for k in range(len(w) - size + 1):
            at.setdefault(tuple(w[k:k + size]), []).append(k)
        return {j for v in at.values() if len(v) > 1 for k in v for j in range(k, k + size)}

    longest = 0
    while covered(longest + 1):
        longest += 1
    n8 = len(covered(8))
    failed = len(w) < 20 or 100 * n8 > 30 * len(w)
    kept = not failed and len(covered(quality.MIN_REPEAT)) / max(len(w), 1) <= quality.MAX_COVERED and longest <= quality.MAX_LONGEST
    return (len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), dup, n8, failed, kept), longest


def test_matches_brute_force(spark):
    rng = random.Random(9)
    rows = [r for r in corpus(9) if len(r[1] or "") < 4000]
    line = prose(rng, 12).replace("\n", " ")
    rows += [(1, "\n".join([line] * 4 + [prose(rng, 40)])), (2, "a # b\n\na # b\n \n \n$$ %|<>"), (3, prose(rng, 60) * 2),
             (4, prose(rng, 500) + " " + " ".join([line] * 2))]
    got = by_id(quality.judge(frame(spark, rows).drop("n_words")))
    names = "n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept".split()
    for i, t in rows:
        want, longest = brute(t)
        assert tuple(got[i][n] for n in names) == want, i
        assert got[i]["longest_repeat"] == longest
    assert quality.report(frame(spark, rows)).columns[0] == "doc_id"
    assert quality.report(frame(spark, [])).count() == 0


def test_suffix_array_orders_suffixes():
    rng = np.random.default_rng(2)
    texts = [" ".join(rng.choice(list("abc"), rng.integers(0, 60))) for _ in range(12)]
    words = Words(pa.array(texts))
    _, ids = np.unique(words.hashes(), return_inverse=True)
    ends = np.repeat(words.first[1:], words.count)
    order, levels = quality.suffix_array(ids, words.doc, ends)
    suffixes = [(words.doc[p], tuple(ids[p:ends[p]])) for p in order]
    assert suffixes == sorted(suffixes)
    lcp = quality.neighbour_lcp(order, levels, ends)
    for (d, a), (e, b), n in zip(suffixes, suffixes[1:], lcp):
        same = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        assert n == (same if d == e else 0)
