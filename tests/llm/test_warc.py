import glob
import hashlib
import os
import random

import pytest

from wardflow.llm import warc
from wardflow.session import shared_dir

SCHEMA = "page_id long, url string, html string, payload string, record_no long, http string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "clash", 9, "x") for r in rows], SCHEMA).repartition(3)


def expected_record(page, url, payload, kind, first, date="2024-01-01T00:00:00Z"):
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (payload if kind == "response" else b"")
    lines = ["WARC/1.1", f"WARC-Type: {kind}"]
    lines += [f"WARC-Record-ID: <urn:page:{page}>"] if page is not None else []
    lines += [f"WARC-Date: {date}"]
    lines += [f"WARC-Target-URI: {url}"] if url is not None else []
    lines += [f"WARC-Payload-Digest: sha256:{hashlib.sha256(payload).hexdigest()}"]
    if kind == "revisit":
        lines += [f"WARC-Profile: {warc.PROFILE}", f"WARC-Refers-To: <urn:page:{first}>"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def test_records_are_rebuilt_byte_for_byte(spark):
    rnd = random.Random(1)
    bodies = ["x" * 99, "x" * 100, "é" * 60, "<p>" + "y" * 500, "", None, "z" * 200_000]
    rows = [(i, rnd.choice(["http://a/ü", None]), rnd.choice(bodies)) for i in range(80)]
    path = warc.write_archive(pages(spark, rows), shared_dir(spark, "test-warc"))
    first, want = {}, []
    for i, url, html in rows:
        payload = (html or "").encode()
        again = len(payload) >= 100 and first.setdefault(payload, i) != i
        want.append((expected_record(i, url, payload, "revisit" if again else "response", first.get(payload)), payload))
    got = sorted((bytes(r["record"]), bytes(r["payload"])) for r in warc.rebuild(spark, path).collect())
    assert got == sorted(want)
    stored = spark.read.parquet(path + "/payloads")
    assert stored.count() == len({(h or "") for _, _, h in rows})  # once each
    for r in warc.read_records(spark, path).collect():
        payload = (rows[r["page_id"]][2] or "").encode()
        again = len(payload) >= 100 and first[payload] != r["page_id"]
        assert (r["payload_bytes"], r["payload_digest"]) == (len(payload), hashlib.sha256(payload).hexdigest())
        assert (r["record_type"], r["refers_to"]) == (("revisit", first[payload]) if again else ("response", None))


def test_edge_rows(spark):
    body = "b" * 150
    rows = [(5, "u", body), (5, "u", body), (None, "u\r\nX-Evil: 1", body), (7, None, None), (None, None, None), (3, "", body)]
    got = sorted(((r["page_id"] or 0, r["record_type"], r["refers_to"]) for r in warc.archive_roundtrip(pages(spark, rows)).collect()),
                 key=str)
    assert got == sorted([(3, "response", None), (5, "revisit", 3), (5, "revisit", 3), (0, "revisit", 3), (7, "response", None),
                          (0, "response", None)], key=str)
    rows = [(5, "u", body), (5, "u", body)]
    assert sorted((r["record_type"], r["refers_to"] or 0) for r in warc.archive_roundtrip(pages(spark, rows)).collect()) == [
        ("response", 0), ("revisit", 5)]
    assert warc.archive_roundtrip(pages(spark, [])).count() == 0


def test_a_payload_that_differs_from_its_digest_stops_the_read(spark):
    path = shared_dir(spark, "test-bad")
    spark.createDataFrame([("00" * 32, b"abc")], warc.PAYLOADS).write.parquet(path + "/payloads")
    with pytest.raises(Exception, match="payload differs from its digest"):
        warc.read_payloads(spark, path).collect()


def test_archive_files_are_packed_well(spark):
    """Letters of a small alphabet without repeats: only a codec that codes single letters makes them smaller."""
    rnd = random.Random(2)
    bodies = ["".join(rnd.choices("abcdefgh", k=4000)) for _ in range(60)]
    path = warc.write_archive(pages(spark, [(i, "http://a/", b) for i, b in enumerate(bodies)]), shared_dir(spark, "test-warc"))
    files = glob.glob(f"{path.removeprefix('file:')}/payloads/*.parquet")
    assert sum(os.path.getsize(f) for f in files) < 0.6 * sum(map(len, bodies))
    stored = {r["payload_digest"]: bytes(r["payload"]) for r in warc.read_payloads(spark, path).collect()}
    assert stored == {hashlib.sha256(b.encode()).hexdigest(): b.encode() for b in bodies}


def test_payloads_are_shuffled_once(spark):
    """Written by digest, they stay where they are when the records are rebuilt; a copy of the files needs no catalog."""
    rows = [(i, "http://a/", f"{i % 7} " * 100) for i in range(40)]
    path = warc.write_archive(pages(spark, rows), shared_dir(spark, "test-warc"))
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        out = warc.rebuild(spark, path)
        assert out._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1  # the headers
        got = sorted((r["record_no"], bytes(r["payload"])) for r in out.collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
    assert sorted(p for _, p in got) == sorted(h.encode() for _, _, h in rows)
    spark.sql(f"DROP TABLE {warc._table(path)}")
    assert sorted((r["record_no"], bytes(r["payload"])) for r in warc.rebuild(spark, path).collect()) == got
