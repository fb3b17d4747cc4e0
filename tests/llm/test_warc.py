import hashlib

from martforge.llm import warc
from martforge.session import work_path

SCHEMA = "page_id bigint, url string, html string, payload string"


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "clash") for i, u, h in rows], SCHEMA)


def test_round_trip_and_revisits(spark):
    big, other = "é" * 600, "z" * 1000
    rows = [(1, "http://a/1", big), (2, "http://a/2", big), (9, "http://a/9", big), (3, None, None), (4, "u", ""),
            (5, "http://x/a b\r\nEvil: 1", "short"), (6, "u", "short"), (7, "u", other), (8, "u", other[:-1]), (10, "u", other[:-1])]
    path = work_path(spark, "warc-test")
    warc.write_archive(pages(spark, rows), path)
    assert spark.read.parquet(f"{path}/{warc.PAYLOADS}").count() == len({h or "" for _, _, h in rows})
    back = warc.read_archive(spark, path)
    got = {r["page_id"]: r for r in warc.parse(back).collect()}
    for i, _, html in rows:
        body = (html or "").encode()
        assert got[i]["payload_bytes"] == len(body)
        assert got[i]["payload_digest"] == hashlib.sha1(body).hexdigest()
    assert {i: (r["record_type"], r["refers_to"]) for i, r in got.items() if r["record_type"] == "revisit"} == {
        1: ("revisit", 9), 2: ("revisit", 9)}
    assert got[5]["target_uri"] == "http://x/a%20b%0D%0AEvil:%201"
    for r in back.collect():
        head, _, rest = bytes(r["record"]).partition(b"\r\n\r\n")
        length = int([x for x in head.split(b"\r\n") if x.startswith(b"Content-Length: ")][0].split(b": ")[1])
        assert rest[length:] == b"\r\n\r\n"
        assert rest[:length].endswith(b"" if b"revisit\r\n" in head else bytes(r["payload"]))


def test_empty_and_repeated_rows(spark):
    path = work_path(spark, "warc-test")
    warc.write_archive(pages(spark, []), path)
    assert warc.read_archive(spark, path).count() == 0
    path = work_path(spark, "warc-test")
    warc.write_archive(pages(spark, [(1, "u", "q" * 1200)] * 2 + [(None, "u", "q" * 1200)]), path)
    got = sorted((r["page_id"] or 0, r["record_type"], r["refers_to"]) for r in warc.parse(warc.read_archive(spark, path)).collect())
    assert got == [(0, "revisit", 1), (1, "response", None), (1, "response", None)]


def test_records_are_read_whole(spark):
    import pytest
    from pyspark.errors import PySparkException
    from pyspark.sql import functions as F

    long = "long ünd breit " * 90_000
    rows = [(1, "u", long), (2, "u", long), (3, "u", "x\r\n\r\ny"), (4, "u", "")]
    path = work_path(spark, "warc-test")
    warc.write_archive(pages(spark, rows), path)
    records = warc.read_archive(spark, path)
    assert {r.page_id: r.payload_bytes for r in warc.parse(records).collect()} == {i: len(h.encode()) for i, _, h in rows}
    for broken in (F.expr("substring(record, 1, octet_length(record) - 1)"), F.concat("record", F.lit(b"x")),
                   F.expr("cast(replace(cast(record as string), 'Content-Length: ', 'Content-Length: 1') as binary)")):
        with pytest.raises(PySparkException, match="Content-Length"):
            warc.parse(records.withColumn("record", broken)).collect()
    plan = warc.parse(records)._jdf.queryExecution().optimizedPlan().toString()
    assert "concat(header" in plan  # the record is built and read
