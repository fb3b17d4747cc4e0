import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from martforge.llm import spelling

from .helpers import corpus, frame, lower

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def counted(rows):
    counts = Counter()
    for i, t in rows:
        for run in RUN.findall(t or ""):
            run = lower(run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 7:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= 2}


def is_near(a, b):
    if len(a) < len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(a) == len(b) + 1 and any(a[:i] + a[i + 1:] == b for i in range(len(a)))


def brute(rows):
    counts = counted(rows)
    near = {w: [] for w in counts}
    for a, b in itertools.combinations(counts, 2):
        if abs(len(a) - len(b)) <= 1 and is_near(a, b):
            near[a].append(b)
            near[b].append(a)
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda u: (-counts[u], u), default=None)
        form[w] = best if best is not None and counts[best] >= 10 * counts[w] else None
    out = set()
    for w in counts:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, counts[w], len(near[w]), counts[form[w]] if form[w] else None))
    return out


def crowd(seed, n=400):
    """Many near words over few letters, some a hundred times as frequent."""
    rng = random.Random(seed)
    words = ["".join(rng.choice("aabé") for _ in range(rng.randint(7, 11))) for _ in range(n)]
    for w in words[:n // 2]:
        i = rng.randrange(len(w))
        words.append(rng.choice([w[:i] + w[i + 1:], w[:i] + rng.choice("abcÿ") + w[i + 1:], w[:i] + rng.choice("abc") + w[i:]]))
    texts = [" ".join(rng.choices(words, k=60)) for _ in range(60)]
    texts += [" ".join([w] * rng.choice([20, 30, 300])) for w in words[:20]]
    return [(i, t) for i, t in enumerate(texts)]


def run(spark, rows):
    got = [tuple(r) for r in spelling.variants(frame(spark, rows).repartition(3)).collect()]
    assert len(got) == len(set(got))
    return set(got)


@pytest.mark.parametrize("rows", [crowd(1), corpus(21) * 2 + [(None, "Abcdefgh ABCDEFGH. abcdefgi")] * 2], ids=["crowd", "corpus"])
def test_against_brute_force(spark, rows):
    assert run(spark, rows) == brute(rows)


def test_long_lists_are_split_and_bundles_hold_whole_lists(spark, monkeypatch):
    for name, value in (("LONG", 20), ("LISTS", 50), ("BUNDLE", 300), ("PRUNE", 1 / 20)):
        monkeypatch.setattr(spelling, name, value)
    rows = crowd(2)
    assert run(spark, rows) == brute(rows)


def test_nulls_empty_and_very_long(spark):
    long = "xy" * 120_000
    rows = [(1, None), (2, ""), (3, "short words only"), (4, f"{long} {long}a {long}"), (5, f"{long}a"), (6, "Été×÷ïsé1"), (7, "Été×÷ïsé")]
    assert run(spark, rows) == brute(rows)
    assert run(spark, rows[:3]) == set()
    assert run(spark, []) == set()


def test_roots_follow_several_forms(spark):
    chain = ["abcdefgh", "abcdefgi", "abcdefji", "abcdkfji"]
    rows = [(1, " ".join(w for k, w in enumerate(chain) for _ in range(2 * 15 ** k)))]
    rows = [(i, rows[0][1]) for i in range(1)]
    got = {r[0]: r[2] for r in run(spark, rows) if r[0] in chain}
    assert {r[0]: r[2] for r in brute(rows) if r[0] in chain} == got and len(set(got.values())) < len(got)


@pytest.mark.parametrize("length", range(7, 12))
def test_every_word_keeps_a_gram(length):
    """T is positive whichever grams are frequent: letters a, b, c with all tables of frequent pairs
    that matter, i.e. all patterns of frequent places of a word of distinct letters."""
    word = bytes(range(97, 97 + length))
    for pattern in itertools.product([False, True], repeat=length - 1):
        frequent = np.zeros(1 << 16, dtype=bool)
        for k, often in enumerate(pattern):
            frequent[word[k] << 8 | word[k + 1]] = often
        *_, t = spelling.grams(np.frombuffer(word, dtype=np.uint8), np.array([0, length]), frequent)
        assert t[0] >= 1


def gram_set(word, frequent):
    code = np.frombuffer(word.encode("latin-1"), dtype=np.uint8)
    kept, size, _, t = spelling.grams(code, np.array([0, len(code)]), frequent)
    return [(int(p), word[p:p + s]) for p, s in zip(kept, size)], int(t[0])


@settings(max_examples=300, deadline=None)
@given(st.text("abc", min_size=7, max_size=12), st.integers(0, 12), st.sampled_from(["", "a", "b", "c", "d"]), st.booleans(),
       st.lists(st.booleans(), min_size=16, max_size=16))
def test_bound_of_affected_grams(word, at, letter, insert, often):
    """A near word keeps T grams, those left of the edit at their ranks from the left, the others from the right."""
    at = min(at, len(word) - (not insert))
    other = word[:at] + letter + word[at + (not insert):]
    frequent = np.zeros(1 << 16, dtype=bool)
    for (x, y), flag in zip(itertools.product(b"abcd", repeat=2), often):
        frequent[x << 8 | y] = flag
    mine, t = gram_set(word, frequent)
    theirs, _ = gram_set(other, frequent)
    left = next((k for k, (x, y) in enumerate(zip(mine, theirs)) if x != y), min(len(mine), len(theirs)))
    turned = [[(len(w) - p, g) for p, g in reversed(gs)] for w, gs in ((word, mine), (other, theirs))]
    right = next((k for k, (x, y) in enumerate(zip(*turned)) if x != y), min(len(mine), len(theirs)))
    assert left + right >= t


def test_words_of_a_slice():
    rows = corpus(22)
    texts = pa.array([t for _, t in rows], pa.string())
    batch = spelling._counted(texts, [i for i, _ in rows])
    got = Counter(dict(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())))
    assert {w: n for w, n in got.items() if n >= 2} == counted(rows)
