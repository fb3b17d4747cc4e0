import random

import corpus_pipeline as cp
from martforge.llm import secrets
from martforge.session import work_path

from .helpers import SPACE, lower, prose
from .test_jaccard import brute as classes_of
from .test_jaccard import near

BAD = "grumbo flarkin zontic".split()
KEY = "token = \"0123456789abcdef0123456789abcdef\""


def tables(spark):
    rng = random.Random(4)
    items = [(k, prose(rng, 30)) for k in range(4)]
    rows, labels = [], []
    for i in range(260):
        text, toxic = prose(rng, rng.randint(20, 90)), rng.random() < 0.25
        if toxic:
            text += " " + " ".join(rng.choices(BAD, k=4))
        rows.append((i, text))
        if i < 230:
            labels.append((i, 1, int(toxic)))
    base = prose(rng, 150)
    rows += [(300 + k, near(rng, base, k % 3)) for k in range(6)] + [(310, base), (311, base)]
    rows += [(400 + k, prose(rng, 20) + items[k][1] + prose(rng, 20)) for k in range(3)]
    rows += [(500 + k, f"{prose(rng, 40)} {KEY} {prose(rng, 10)}") for k in range(3)]
    rows += [(600, None), (601, "")]
    path = work_path(spark, "pipeline-test")
    spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t), 7) for i, t in rows],
                          "doc_id bigint, text string, lang string, source string, n_chars bigint, score int"
                          ).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, dict(rows)


def test_stages_against_brute_force(spark):
    path, texts = tables(spark)
    docs = spark.read.parquet(f"{path}/documents.parquet")
    steps = dict(cp.STAGES)

    def step(name, docs):
        out = work_path(spark, f"stage-{name}")
        steps[name](spark, docs, path).write.parquet(out)
        return spark.read.parquet(out)

    clean = step("toxicity", docs)
    assert clean.columns == docs.columns
    left = {r.doc_id for r in clean.collect()}
    toxic = {i for i, t in texts.items() if t and any(w in t for w in BAD)}
    assert len(toxic & left) <= 2 and len(set(texts) - toxic - left) <= 3

    single = step("near_duplicates", clean)
    want = {i for i, (_, c) in classes_of([(i, texts[i]) for i in left]).items() if c == i}
    assert {r.doc_id for r in single.collect()} == want and single.columns == docs.columns

    own = step("decontamination", single)
    assert {r.doc_id for r in own.collect()} == want - {400, 401, 402} and own.columns == docs.columns

    safe = step("secrets", own)
    assert safe.columns == docs.columns
    got = {r.doc_id: r for r in safe.collect()}
    assert set(got) == want - {400, 401, 402}
    for i, r in got.items():
        assert r.score == 7
        if 500 <= i < 510:
            assert r.text == texts[i].replace(KEY[:-1], "[SECRET]") and r.n_chars == len(r.text)
        else:
            assert r.text == texts[i]
    assert not any(r["spans"] for r in secrets.report(safe).collect())

    packed = step("packing", safe)
    assert {r.doc_id for r in packed.collect()} == set(got)


def test_run_keeps_the_columns_of_the_last_stage(spark):
    path, _ = tables(spark)
    out = cp.run(spark, path)
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert out.count() > 150


def test_empty_documents(spark):
    path, _ = tables(spark)
    docs = spark.read.parquet(f"{path}/documents.parquet").limit(0)
    for name, stage in cp.STAGES:
        out = work_path(spark, f"empty-{name}")
        stage(spark, docs, path).write.parquet(out)
        docs = spark.read.parquet(out)
        assert docs.count() == 0


def linked(a, b, size, percent):
    x, y = ({tuple(w[k:k + size]) for k in range(max(1, len(w) - size + 1))} for w in (SPACE.findall(lower(t)) for t in (a, b)))
    return bool(x and y) and 100 * len(x & y) >= percent * len(x | y)


def test_near_duplicates_at_five_words_and_four_fifths(spark):
    rng = random.Random(9)
    rows = []
    for c in range(3):
        base = [f"w{c}x{k}" for k in range(200)]
        rows.append((100 * c, " ".join(base)))
        for edits in range(1, 8):  # spread replacements; the fourth lies between 4/85 and 5/80
            words = list(base)
            for e in range(edits):
                words[20 + 25 * e] = f"new{c}x{edits}x{e}"
            rows.append((100 * c + edits, " ".join(words)))
    rows += [(900 + k, prose(rng, 60)) for k in range(5)]
    rng.shuffle(rows)
    assert linked(dict(rows)[0], dict(rows)[4], 5, 80) and not linked(dict(rows)[0], dict(rows)[4], 4, 85)
    root = {i: i for i, _ in rows}
    for _ in range(3):
        for i, a in rows:
            for j, b in rows:
                if linked(a, b, 5, 80):
                    root[i] = root[j] = min(root[i], root[j])
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id for r in cp.drop_near_duplicates(spark, docs, "").collect()}
    assert got == {i for i in root if root[i] == i}


def test_near_duplicates_keep_every_text(spark):
    rng = random.Random(12)
    base, lone = prose(rng, 90), prose(rng, 70)
    rows = [(1, base), (1, lone), (1, lone), (2, base + " more"), (None, base), (None, prose(rng, 50)), (None, None), (3, None), (3, ""), (None, "")]
    docs = spark.createDataFrame([(i, t, i, "x") for i, t in rows], "doc_id bigint, text string, _row bigint, n_shingles string")
    out = cp.drop_near_duplicates(spark, docs, "")
    assert out.columns == docs.columns
    got = sorted(((r.doc_id, r.text) for r in out.collect()), key=str)
    assert got == sorted([(1, base), (1, lone), rows[5], (None, None), (3, None), (3, ""), (None, "")], key=str)
