import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from martforge.llm import idfiles
from martforge.session import work_path

from .helpers import corpus, frame


def wanted(rows):
    """(doc_id, start, n_tokens, crc) in the order of the files."""
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(idfiles.tokenizer_path())
    coded = []
    for i, t in rows:
        ids = np.array([*model.encode(t or "", add_special_tokens=False).ids, 1], dtype="<u4")
        coded.append((i, zlib.crc32(ids.tobytes()), ids))
    coded.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    out, start = [], 0
    for i, crc, ids in coded:
        out.append((i, start, len(ids), crc))
        start += len(ids)
    return out, coded


def test_files_hold_all_ids_in_order(spark):
    rows = corpus(11) + [(1, "wörd " * 9000), (2, "it's 3.5 x<|endoftext|>y é"), (3, None), (3, "other text"), (3, "other text"),
                         (None, "no id"), (None, ""), (-4, "negative"), (10 ** 15, "long id"), (5, "very long " * 150_000)]
    got = idfiles.report(frame(spark, rows)).collect()
    want, _ = wanted(rows)
    key = lambda r: (r[1], r[2])
    assert sorted((tuple(r) for r in got), key=key) == sorted(want, key=key)


def test_ids_themselves_and_small_blocks(spark, monkeypatch):
    rows = corpus(12)
    out = work_path(spark, "id-files-test")
    monkeypatch.setattr(idfiles, "BLOCK_IDS", 500)
    idfiles.write_ids(frame(spark, rows).repartition(5), out)
    _, coded = wanted(rows)
    found = idfiles.add_starts(idfiles.read_ids(spark, out), out).orderBy("start").collect()
    assert [r["doc_id"] for r in found] == [c[0] for c in coded]
    for r, (_, _, ids) in zip(found, coded):
        assert np.array_equal(np.frombuffer(r["ids"], dtype="<u4"), ids)
    dictionary = spark.read.parquet(f"{out}/dictionary").orderBy("rank").collect()
    n = np.bincount(np.concatenate([c[2] for c in coded]))
    assert [(r["id"], r["n"]) for r in dictionary] == sorted(((i, k) for i, k in enumerate(n) if k), key=lambda x: (-x[1], x[0]))
    size = spark.read.format("binaryFile").load(f"{out}/ids").agg(F.sum("length")).first()[0]
    assert size < 2.2 * n.sum() + 100 * len(rows)


def test_empty_table(spark):
    assert idfiles.report(frame(spark, [])).count() == 0


def test_damage_is_noticed():
    body = bytearray(idfiles.pack_block(0, 0, np.array([1]), np.array([0]), np.array([2]), b"\x00", b"\x01\x02") + b"\n")
    assert len(list(idfiles.blocks(memoryview(bytes(body))))) == 1
    body[-8] ^= 1
    try:
        list(idfiles.blocks(memoryview(bytes(body))))
    except ValueError:
        return
    raise AssertionError


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.sampled_from([0, 1, 200, 255, 256, 65535, 65536, 1 << 24, (1 << 32) - 1]), max_size=11), max_size=7))
def test_codes_round_trip(docs):
    counts = np.array([len(d) for d in docs], dtype=np.int64)
    flat = np.array([v for d in docs for v in d], dtype=np.uint32)
    control, data, quads, size = idfiles.encode(flat, counts)
    assert len(control) == quads.sum() and len(data) == size.sum()
    assert np.array_equal(idfiles.decode(control, data, counts), flat)
