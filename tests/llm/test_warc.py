"""WARC archives against plain readers, and odd archives written by hand."""

from __future__ import annotations

import base64
import gzip
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tidemark.llm import warc
from tidemark.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
DDL = "page_id long, url string, html string"


def digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def plain_records(data: bytes):
    """(headers, block) of an archive, by Content-Length."""
    found = []
    while data:
        head, _, rest = data.partition(b"\r\n\r\n")
        lines = head.decode().split("\r\n")
        assert lines[0] == "WARC/1.1"
        headers = dict(line.split(": ", 1) for line in lines[1:])
        n = int(headers["Content-Length"])
        found.append((headers, rest[:n]))
        assert rest[n : n + 4] == b"\r\n\r\n"
        data = rest[n + 4 :]
    return found


def plain_result(pages):
    largest = {}
    for id_, _, html in pages:
        d = digest((html or "").encode())
        largest[d] = max(largest.get(d, id_), id_)
    result = []
    for id_, _, html in pages:
        data = (html or "").encode()
        first = largest[digest(data)]
        result.append((id_, len(data), digest(data), "response" if first == id_ else "revisit", None if first == id_ else first))
    return sorted(result)


def query_rows(spark, folder):
    found = QUERIES["op13_warc"](spark, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    return sorted(tuple(r) for r in found.collect())


def test_query_equals_plain_digests(spark):
    pages = [tuple(r) for r in spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url", "html").collect()]
    assert query_rows(spark, SF) == plain_result(pages)


HARD = [
    "", "\r\n", "\r\n\r\n", "\r", "\n", "a\r\r\nb\r", "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n",
    "x\r\n\r\nWARC/1.1\r\n", "é" * 1000, "line\n" * 40_000, "\x00\x01",
]


def test_copies_nulls_and_line_ends_round_trip(spark, rows, tmp_path):
    rng = random.Random(9)
    texts = HARD + ["".join(rng.choice("\r\nab") for _ in range(rng.randrange(30))) for _ in range(60)]
    pages = [(i, f"http://h.example/{i}", t) for i, t in enumerate(texts)]
    pages += [(1000 + i, "http://h.example/same", "hot copy") for i in range(300)] + [(2000, None, None), (2001, "bad\r\nurl: x", "y")]
    rows(pages, DDL).write.parquet(f"{tmp_path}/pages.parquet")
    assert query_rows(spark, str(tmp_path)) == plain_result(pages)
    warc.write_archives(warc.plan_captures(spark.read.parquet(f"{tmp_path}/pages.parquet")), f"{tmp_path}/out")
    read = warc.read_archives(spark, f"{tmp_path}/out").collect()
    assert all(r.problem is None for r in read) and len(read) == 3 * len(pages)
    told = {(r.http_head, bytes(r.payload)) for r in read if r.warc_type == "response"}
    assert {p for _, p in told} == {(t or "").encode() for _, _, t in pages}
    plain = [x for f in (tmp_path / "out").glob("*.gz") for x in plain_records(gzip.decompress(f.read_bytes()))]
    assert sorted(h["WARC-Record-ID"] for h, _ in plain) == sorted(r.record_id for r in read)


def test_captures_are_nested_with_request_and_metadata(spark, rows, tmp_path):
    pages = [(1, "https://a.example/x?q=1", "<p>one</p>"), (2, "https://b.example", "<p>two</p>"), (3, "https://c.example/", "<p>one</p>")]
    warc.write_archives(warc.plan_captures(rows(pages, DDL)), f"{tmp_path}/out")
    records = warc.read_archives(spark, f"{tmp_path}/out")
    found = warc.resolve_revisits(warc.assemble(records)).withColumn("key", warc.capture_key("long")).collect()
    by_key = {r.key: r for r in found}
    assert sorted(by_key) == [1, 2, 3] and len(found) == 3
    assert by_key[1].record_type == "revisit" and by_key[1].referred.key == "3"
    assert by_key[1].payload == b"" and by_key[1].referred.payload == b"<p>one</p>"
    assert by_key[2].request.http_head == "GET / HTTP/1.1\r\nHost: b.example"
    assert by_key[1].request.http_head == "GET /x?q=1 HTTP/1.1\r\nHost: a.example"
    assert all(r.n_requests == r.n_metadata == 1 and r.target_uri == f"{pages[r.key - 1][1]}" for r in found)
    assert by_key[2].payload_digest == by_key[2].header_digest == digest(b"<p>two</p>")
    assert warc.unattached(records).count() == 0


def test_small_payloads_are_stored_in_full(rows):
    pages = rows([(1, "u", "same"), (2, "u", "same"), (3, "u", "longer text"), (4, "u", "longer text")], DDL)
    found = warc.plan_captures(pages, least_bytes=5).collect()
    assert {r.key: r.first and r.first.key for r in found} == {1: None, 2: None, 3: 4, 4: None}


def raw(kind, id_, block=b"", *more, length=None):
    head = [f"WARC-Type: {kind}", f"warc-record-id: <{id_}>", *more, f"Content-Length: {len(block) if length is None else length}"]
    return "\r\n".join(["WARC/1.0", *head, "", ""]).encode() + block + b"\r\n\r\n"


def test_odd_archives(spark, tmp_path):
    http = b"HTTP/1.1 200 OK\r\nX: y\r\n\r\nbody"
    media = "Content-Type: application/http;\r\n msgtype=response"
    members = [
        raw("warcinfo", "i", b"software: x\r\n"),
        raw("response", "r1", http, media),
        raw("request", "q1", b"GET / HTTP/1.1\r\n\r\n", "WARC-Concurrent-To: <r1>", "Content-Type: application/http"),
        raw("metadata", "m1", b"a: 1\r\n", "WARC-Concurrent-To: <r1>"),
        raw("metadata", "m0", b"a: 0\r\n", "WARC-Concurrent-To: <r1>"),
        raw("request", "q2", b"GET /2 HTTP/1.1\r\n\r\n", "Content-Type: application/http"),
        raw("response", "r2", http, media, "WARC-Concurrent-To: <q2>"),
        raw("metadata", "stray", b"", "WARC-Concurrent-To: <nowhere>"),
        raw("response", "nolength", b"", length="x"),
        raw("response", "r3", b"12345", length=3),
    ]
    (tmp_path / "a.warc.gz").write_bytes(b"".join(gzip.compress(m) for m in members))
    (tmp_path / "b.warc.gz").write_bytes(gzip.compress(raw("response", "cut", http, media)[:-20]))
    (tmp_path / "c.warc.gz").write_bytes(gzip.compress(b""))
    records = warc.read_archives(spark, str(tmp_path))
    by_id = {r.record_id: r for r in records.collect()}
    assert len(by_id) == len(members) + 1
    assert bytes(by_id["<r1>"].payload) == b"body" and by_id["<r1>"].http_head.endswith("X: y")
    assert {k: r.problem for k, r in by_id.items() if r.problem} == {
        "<nolength>": "no length", "<r3>": "text after the block", "<cut>": "truncated"
    }
    found = {r.record_id: r for r in warc.assemble(records).collect()}
    assert found["<r1>"].metadata.record_id == "<m0>" and found["<r1>"].n_metadata == 2
    assert found["<r2>"].request.record_id == "<q2>" and found["<r3>"].request is None
    assert [r.record_id for r in warc.unattached(records).collect()] == ["<stray>"]


def test_repeated_rows_and_empty_tables(spark, rows, tmp_path):
    pages = [(1, "u", "a"), (1, "u", "a"), (2, "v", "b"), (None, "w", "b"), (None, "w", "c")]
    for n, data in enumerate((pages, [])):
        rows([(*p, "x", 1) for p in data], DDL + ", payload string, first int").write.parquet(f"{tmp_path}/{n}/pages.parquet")
        found = QUERIES["op13_warc"](spark, f"{tmp_path}/{n}").select("page_id", "record_type", "refers_to").collect()
        want = [(1, "response", None), (1, "response", None), (2, "response", None), (None, "revisit", 2), (None, "response", None)] if not n else []
        assert sorted(map(tuple, found), key=str) == sorted(want, key=str)


@pytest.mark.parametrize("data", [b"", b"a", b"abc" * 1000])
def test_base32(rows, data):
    made = rows([(bytearray(data),)], "b binary").select(warc.base32_sha1(F.col("b"))).first()[0]
    assert made == digest(data)
