import base64
import gzip
import hashlib
import io
import random
import re

import pytest
from pyspark.sql import functions as F

from tributary.llm import QUERIES, warc
from tributary.session import scratch_path


def digest(html):
    return base64.b32encode(hashlib.sha1(html.encode()).digest()).decode()


def brute(pages):
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every page."""
    groups = {}
    for n, (page_id, _, html) in enumerate(pages):
        groups.setdefault(html or "", []).append((page_id is not None, page_id or 0, n))
    out = []
    for html, members in groups.items():
        best = max(members)
        for known, page_id, n in members:
            first = n == best[2]
            own = page_id if known else None
            refers = None if first or not best[0] else best[1]
            out.append((own, len(html.encode()), digest(html), "response" if first else "revisit", refers))
    return sorted(out, key=str)


COLUMNS = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
KIND = "page_id long, url string, html string, row int, best string, copies int, block string"


def archived(spark, pages, parts=3):
    df = spark.createDataFrame([(*p, 1, "x", 2, "y") for p in pages], KIND).repartition(parts)
    path = scratch_path(spark, "archive")
    warc.write_warc(warc.page_records(df), path)
    return path


def rows(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=str)


LONG = "<p>long</p>" * 300_000
ODD = [
    (1, "http://a/1", "<p>one</p>"), (2, "http://a/2", "<p>one</p>"), (2, "http://a/2", "<p>one</p>"),
    (3, None, None), (4, "http://a/\r\nX: y", ""), (5, " spaced ", "\r\n\r\nWARC/1.1\r\n\r\n"), (None, "u", "<p>one</p>"),
    (None, "u", "only null"), (None, "u", "only null"), (6, "é", "ünïcode   \x00"), (7, "l", LONG), (8, "l", LONG),
    (9, "l", LONG + "x"), (-5, "n", "negative"),
]


def test_odd_rows(spark):
    path = archived(spark, ODD)
    got = warc.read_pages(spark, path)
    assert rows(got) == brute(ODD)
    held = {r.page_id: r.payload for r in got.filter("record_type = 'response'").collect()}
    assert held[5] == b"\r\n\r\nWARC/1.1\r\n\r\n" and held[8] == LONG.encode()
    assert all(r.payload is None for r in got.filter("record_type = 'revisit'").collect())
    empty = archived(spark, [])
    assert warc.read_pages(spark, empty).collect() == []


def test_query_against_brute_force(spark, sf_dir):
    pages = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html").collect()]
    assert rows(QUERIES["op13_warc"](spark, sf_dir)) == brute(pages)


def test_a_payload_of_a_third_of_the_rows(spark, monkeypatch):
    """Frequent payloads take the broadcast way, others the shuffle, with the same outcome."""
    r = random.Random(1)
    pages = [(n, "u", "hot" if n % 3 == 0 else f"text {r.randrange(200)}") for n in range(600)]
    for share in (1000, 50, 1):
        monkeypatch.setattr(warc, "HOT_SHARE", share)
        assert rows(warc.read_pages(spark, archived(spark, pages))) == brute(pages)


def test_revisits_name_the_record_they_stand_for(spark):
    records = warc.read_warc(spark, archived(spark, ODD)).collect()
    ids = {r.record_id: r for r in records}
    assert len(ids) == len(ODD)
    for r in records:
        if r.record_type == "revisit":
            assert ids[r.refers_to].record_type == "response"
            assert ids[r.refers_to].payload_digest == r.payload_digest


def filtered(df):
    return re.search(r"\bFilter \(", df._jdf.queryExecution().executedPlan().toString()) is not None


def test_header_predicates_are_taken_over(spark):
    path = archived(spark, ODD)
    records = warc.read_warc(spark, path, fields=warc.PAGE)
    some = records.filter("record_type = 'revisit'").filter(F.col(warc.PAGE).isin("1", "2"))
    assert not filtered(some)
    assert {r[warc.PAGE] for r in some.collect()} == {"1", "2"}
    start = records.filter(F.col("target_uri").startswith("http://a/"))
    assert not filtered(start) and start.count() == 4
    assert records.filter(F.col("target_uri").isNull()).count() == 1
    other = records.filter("http_length > 100")
    assert filtered(other) and other.count() == 3
    assert records.filter(F.col("record_type") != "response").count() == 6


def test_unwanted_payloads_are_not_inflated(tmp_path):
    pages = [("response", b"x" * 500_000), ("revisit", b""), ("response", b"y" * 300_000)]
    data = b"".join(warc.member([("WARC-Type", kind)], block) for kind, block in pages)
    read = warc.Members(io.BytesIO(data))
    assert [h["warc-type"] for h, _ in read.records(lambda h: True, False)] == ["response", "revisit", "response"]
    assert read.inflated == 0
    read = warc.Members(io.BytesIO(data))
    assert [b for _, b in read.records(lambda h: h["warc-type"] == "revisit", True)] == [b""]
    assert read.inflated < 100
    read = warc.Members(io.BytesIO(data))
    assert [b for _, b in read.records(lambda h: True, True)] == [block for _, block in pages]


def test_members_of_another_writer(monkeypatch):
    """Plain gzip members state no length; names, comments and short reads are no matter."""
    blocks = [b"", b"a" * 10, bytes(random.Random(2).randbytes(300_000)), b"b" * 2_000_000]
    data = b""
    for block in blocks:
        out = io.BytesIO()
        with gzip.GzipFile(filename="name", mode="wb", fileobj=out) as file:
            file.write(b"WARC/1.0\r\nWARC-Type: resource\r\nContent-Length: %d\r\n\r\n" % len(block) + block + b"\r\n\r\n")
        data += out.getvalue()
    for size in (7, 1000, 1 << 20):
        monkeypatch.setattr(warc, "READ_BYTES", size)
        assert [b for _, b in warc.Members(io.BytesIO(data)).records(lambda h: True, True)] == blocks
        assert list(warc.Members(io.BytesIO(data)).records(lambda h: False, True)) == []
    assert gzip.decompress(warc.member([("A", "b")], b"block")) == b"WARC/1.1\r\nA: b\r\nContent-Length: 5\r\n\r\nblock\r\n\r\n"


def test_broken_archives_are_named():
    data = warc.member([("WARC-Type", "response")], b"x" * 1000)
    for bad in (data[:-20], b"junk" + data, data + b"junk junk junk"):
        with pytest.raises(warc.BrokenArchive):
            list(warc.Members(io.BytesIO(bad)).records(lambda h: True, True))


def test_only_committed_files_are_read(spark, tmp_path):
    path = archived(spark, ODD)
    stray = warc.member([("WARC-Type", "response")], b"left by a lost task")
    with open(f"{path}/stray.warc.gz", "wb") as file:
        file.write(stray)
    assert warc.read_warc(spark, path).count() == len(ODD)


def test_a_wrong_digest_fails(spark):
    path = scratch_path(spark, "archive")
    bad = spark.createDataFrame([("response", "sha1:AAAA", bytearray(b"x"))], "record_type string, payload_digest string, block binary")
    warc.write_warc(bad, path)
    with pytest.raises(Exception, match="does not have its digest"):
        warc.read_warc(spark, path).collect()


def test_files_are_rolled_and_dealt(spark, monkeypatch):
    pages = [(n, "u", random.Random(n).randbytes(3000).hex()) for n in range(200)]
    df = spark.createDataFrame([(*p, 1, "x", 2, "y") for p in pages], KIND).coalesce(1)
    path = scratch_path(spark, "archive")
    spark.dataSource.register(warc.Warc)
    warc.page_records(df).coalesce(1).write.format(warc.FORMAT).option("fileBytes", "100000").mode("append").save(path)
    files = warc.committed(path)
    assert len(files) > 5 and max(size for _, size in files) < 110_000
    monkeypatch.setattr(warc, "PARTITION_BYTES", 250_000)
    parts = warc.WarcReader(path, {}, True).partitions()
    assert sorted(n for p in parts for n in p.names) == [n for n, _ in files] and 2 < len(parts) < len(files)
    assert rows(warc.read_pages(spark, path)) == brute(pages)
