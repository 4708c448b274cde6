"""WARC: the round trip, pushdown that skips payloads, revisits, hostile payloads, the edge cases."""

import base64
import gzip
import hashlib
import io

from pyspark.sql import functions as F

from assayspark.llm import warc
from assayspark.session import new_path

HTML = ["<p>é</p>", "", None, "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\nabc\r\n\r\n", "x" * 200_000, "<p>é</p>", "\r\n\r\n", "<p>é</p>"]


def pages(spark):
    rows = [(i, f"http://h{i % 2}.example/\n{i}", h, "clash") for i, h in enumerate(HTML)]
    return spark.createDataFrame(rows + [(None, None, "<p>null</p>", "clash"), (4, "http://again", "y", "clash")], "page_id long, url string, html string, first string")


def sha(h):
    return base64.b32encode(hashlib.sha1((h or "").encode()).digest()).decode()


def test_round_trip(spark):
    path = new_path(spark, "warc-test")
    warc.write(warc.records_of(pages(spark)).repartition(3), path, per_file=2)
    got = warc.read(spark, path).collect()
    assert len(got) == 10
    by_id = {r["record_id"]: r for r in got if r["target_uri"] != "http://again"}
    for i, h in enumerate(HTML):
        r = by_id[f"<urn:page:{i}>"]
        last = max(k for k, x in enumerate(HTML) if (x or "") == (h or ""))
        assert r["payload_digest"] == f"sha1:{sha(h)}" and r["payload_bytes"] == len((h or "").encode())
        assert r["record_type"] == ("response" if last == i else "revisit")
        assert r["refers_to"] == (None if last == i else f"<urn:page:{last}>")
        assert (None if r["payload"] is None else bytes(r["payload"])) == ((h or "").encode() if last == i else None)
        assert r["target_uri"] == f"http://h{i % 2}.example/ {i}"
    assert by_id["<urn:page:>"]["record_type"] == "response"


def test_predicates_are_pushed_and_skip(spark):
    path = new_path(spark, "warc-test")
    warc.write(warc.records_of(pages(spark)), path)
    rows = warc.read(spark, path)
    revisits = rows.where((F.col("record_type") == "revisit") & F.col("target_uri").startswith("http://h0"))
    assert {r["record_id"] for r in revisits.collect()} == {"<urn:page:0>"}
    assert rows.where(F.col("record_id").isin("<urn:page:4>", "<urn:page:6>") & (F.col("payload_bytes") > 0)).count() == 3
    assert rows.where(F.col("refers_to").isNull()).count() == 7


def test_unwanted_blocks_are_never_read():
    class Watched(io.BytesIO):
        taken = 0

        def read(self, n=-1):
            Watched.taken += n
            return super().read(n)

    headers = {"record_type": "response", "record_id": "<urn:page:1>"}
    data = warc.record(headers, b"a" * 1000, 1000) + warc.record(headers | {"record_type": "revisit"}, None, 7)
    reader = warc.WarcReader("/x", "response")
    reader.accept = [("record_type", "in", frozenset(["revisit"]))]
    assert [(r[0], r[7], r[8]) for r in reader.records(Watched(data))] == [("revisit", 7, None)] and Watched.taken == 0
    assert [r[8] for r in warc.WarcReader("/x", "").records(io.BytesIO(data))] == [None, None]
    packed = gzip.GzipFile(fileobj=io.BytesIO(gzip.compress(data[: len(data) // 2]) + gzip.compress(data[len(data) // 2 :])))
    assert [r[8] for r in warc.WarcReader("/x", "response").records(packed)] == [b"a" * 1000, None]


def test_least_and_empty(spark):
    rows = warc.records_of(pages(spark), least=5).collect()
    assert sum(r["record_type"] == "revisit" for r in rows) == 2  # the empty ones are all responses
    path = new_path(spark, "warc-test")
    warc.write(warc.records_of(pages(spark).limit(0)), path)
    assert warc.read(spark, path).collect() == []


def foreign(kind, block, content=None, more=""):
    lines = f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <urn:uuid:{kind}>\r\n{more}"
    lines += f"Content-Type: {content}\r\n" if content else ""
    return f"{lines}Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"


def test_archives_of_other_makers():
    page = b"HTTP/1.1 200 OK\r\nServer: x\r\n\r\n<p>no length</p>"
    data = foreign("warcinfo", b"software: x\r\nformat: WARC\r\n", "application/warc-fields")
    data += foreign("request", b"GET / HTTP/1.1\r\nHost: x\r\n\r\n", "application/http; msgtype=request")
    data += foreign("response", page, "application/http;msgtype=response") + foreign("response", b"plain dns answer", "text/dns")
    data += foreign("metadata", b"") + foreign("revisit", b"HTTP/1.1 304 Not Modified\r\n\r\n", "application/http")
    got = [(r[0], r[7], r[8]) for r in warc.WarcReader("/x", "response,warcinfo").records(io.BytesIO(data))]
    assert got == [
        ("warcinfo", 27, b"software: x\r\nformat: WARC\r\n"), ("request", 0, None), ("response", 16, b"<p>no length</p>"),
        ("response", 16, b"plain dns answer"), ("metadata", 0, None), ("revisit", None, None),
    ]
    whole = [r for r in warc.WarcReader("/x", "response").records(io.BytesIO(data))]
    for cut in range(0, len(data), 7):
        some = [r for r in warc.WarcReader("/x", "response").records(io.BytesIO(data[:cut]))]
        assert [r[:7] for r in some] == [r[:7] for r in whole[: len(some)]] and all(a == b for a, b in zip(some, whole))
