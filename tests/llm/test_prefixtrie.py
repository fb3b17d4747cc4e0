import hashlib
import random
import zlib

import pytest

from martforge.llm import common, prefixtrie

SCHEMA = "conv_id bigint, turn bigint, role string, text string, a string, n int, d double"


def brute(rows):
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()
            convs.setdefault(c, []).append((turn is not None, turn or 0, digest, role, text))
    turns = {c: [t[3:] for t in sorted(ts)] for c, ts in convs.items()}
    whole = {}
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (abs(c) % 100 if c >= 0 else -(abs(c) % 100))
        whole[c] = turns.get(base, [])[:h] + turns[c][h:]
    nodes = {}
    for c, seq in whole.items():
        for d in range(len(seq) + 1):
            nodes.setdefault(tuple(seq[:d]), []).append(c)
    out = set()
    for path, members in nodes.items():
        below = [p for p in nodes if p[:len(path)] == path]
        kids = {p for p in below if len(p) == len(path) + 1}
        leaves = [p for p in below if not any(len(q) == len(p) + 1 and q[:len(p)] == p for q in below)]
        saved = sum((len(nodes[p]) - 1) * len(p[-1][1]) for p in below if p)
        ends = ",".join(map(str, sorted(c for c in members if len(whole[c]) == len(path))))
        out.add((min(members), len(path), min(nodes[path[:-1]]) if path else None, len(members), len(kids), len(leaves), saved,
                 hashlib.sha256(ends.encode()).hexdigest()))
    return out


def random_rows(seed, convs=60, longest=12):
    rng = random.Random(seed)
    texts = ["", None, "a", "hé", "long text " * 9, "x"]
    rows = []
    for _ in range(convs):
        c = rng.choice([rng.randrange(-250, 450), 100 * rng.randrange(-2, 5)])
        if any(r[0] == c for r in rows):
            continue
        n = rng.choice([1, 2, 3, rng.randrange(1, longest)])
        common_part = rng.randrange(0, n + 1)
        for i in range(n):
            turn = rng.choice([i, i, i, None, 0])
            text = texts[i % 6] if i < common_part else rng.choice(texts)
            rows.append((c, turn, rng.choice(["user", None]) if i >= common_part else "user", text))
    rows += [(None, 1, "user", "nobody's"), *rows[:5]]
    rng.shuffle(rows)
    return rows


def run(spark, rows):
    table = spark.createDataFrame([(*r, "x", 1, 2.0) for r in rows], SCHEMA).repartition(3)
    got = [tuple(r) for r in prefixtrie.trie(table).collect()]
    assert len(got) == len(set(got))
    return set(got)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_brute_force(spark, seed):
    rows = random_rows(seed)
    assert run(spark, rows) == brute(rows)


def test_hot_keys_and_long_conversations(spark, monkeypatch):
    """Keys count as hot early, names are summed in short segments, one conversation holds most rows."""
    monkeypatch.setattr(common, "HOT_ROWS", 3)
    monkeypatch.setattr(common, "HOT_KEYS", 30)
    monkeypatch.setattr(prefixtrie, "SEGMENT", 2)
    rows = random_rows(4, convs=40)
    rows += [(300, i, "user", f"turn {i % 7}") for i in range(60)]
    rows += [(c, i, "user", f"turn {i % 7}") for c in range(301, 312) for i in range(c - 270)]
    rows += [(900 + c, i, "user", "same") for c in range(40) for i in range(5)]
    assert run(spark, rows) == brute(rows)


def test_turnless_empty_and_long_texts(spark):
    rows = [(c, 0, "user", "only one") for c in range(201, 240)]  # no conversation 200: heads vanish
    assert any(d == 0 and sha != prefixtrie.NO_IDS for _, d, *_, sha in run(spark, rows))
    assert run(spark, rows) == brute(rows)
    rows = [(0, 0, "user", "very long " * 300_000), (1, 0, None, None), (7, 0, "user", "very long " * 300_000)]
    assert run(spark, rows) == brute(rows)
    assert run(spark, []) == set()
    assert run(spark, [(None, 0, "user", "x")]) == set()
