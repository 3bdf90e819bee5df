import base64
import gzip
import hashlib

import pytest

from holdfast.llm import warc as A
from holdfast.session import scratch_path

SCHEMA = "page_id long, url string, html string, digest string, path string"


def digest(data):
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def converted(spark, rows, **options):
    pages = spark.createDataFrame(rows, SCHEMA).coalesce(3)
    arc, out = scratch_path(spark, "arc"), scratch_path(spark, "warc")
    A.write_arc(pages, arc)
    A.convert(spark, arc, out, **options)
    return out


ROWS = [
    (1, "http://a/x y", "<p>é</p>", "d", "p"),
    (2, None, "<p>é</p>", "d", "p"),
    (3, "", None, None, None),
    (4, "http://b/\n", "", "d", "p"),
    (5, "http://c", "x" * 300_000 + "\r\n\r\nWARC/1.1\r\nhttp://d 0.0.0.0 20260101000000 text/html 3\nabc", "d", "p"),
    (5, "http://c", "other", "d", "p"),
    (5, "http://c", "other", "d", "p"),
    (None, "http://e", "other", "d", "p"),
    (-7, "http://e", "\n\nlines\n", "d", "p"),
]


def test_round_trip_of_pages(spark):
    out = converted(spark, ROWS)
    read = A.read_warc(spark, out).where("record_type != 'warcinfo'").collect()
    assert len(read) == len(ROWS)
    by_type = {t: [r for r in read if r.record_type == t] for t in ("response", "revisit")}
    assert sorted(bytes(r.payload).decode() for r in by_type["response"]) == sorted({h or "" for _, _, h, _, _ in ROWS})
    assert all(bytes(r.payload) == b"" and r.refers_to_id for r in by_type["revisit"])
    assert len({r.record_id for r in read}) == len(ROWS) and {r.date for r in read} == {"2026-01-01T00:00:00Z"}
    assert {r.uri for r in read} == {"http://a/x%20y", "unknown:", "http://b/%0A", "http://c", "http://e"}
    pages = A.resolved(A.read_warc(spark, out, payloads=False)).collect()
    want = []
    for k, (page, _, html, _, _) in enumerate(ROWS):
        data = (html or "").encode()
        same = [(p is not None, p or 0, -j) for j, (p, _, h, _, _) in enumerate(ROWS) if (h or "") == (html or "")]
        first = max(s[:2] for s in same)[1]
        want.append((page, len(data), digest(data), first))
    got = [(r.page_id, r.payload_bytes, r.payload_digest, r.refers_to if r.record_type == "revisit" else r.page_id) for r in pages]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert sum(r.record_type == "response" for r in pages) == len({w[2] for w in want})


def test_small_payloads_may_repeat(spark):
    pages = A.resolved(A.read_warc(spark, converted(spark, ROWS, min_bytes=6), payloads=False)).collect()
    assert {r.page_id for r in pages if r.record_type == "revisit"} == {1}


def test_page_ids_of_64_bits(spark):
    least, most = -(1 << 63), (1 << 63) - 1
    rows = [(i, "http://a", "same", "d", "p") for i in (least, 10**18, most, 5)]
    pages = A.resolved(A.read_warc(spark, converted(spark, rows), payloads=False)).collect()
    assert {r.page_id for r in pages} == {least, 10**18, most, 5}
    assert {(r.page_id, r.record_type, r.refers_to) for r in pages if r.page_id != most} == {(i, "revisit", most) for i in (least, 10**18, 5)}
    for text, page_id in [(str(most), most), (str(most + 1), None), (str(least), least), (str(least - 1), None), ("1" * 20, None)]:
        assert A.http_of(f"HTTP/1.1 200 OK\r\n{A.PAGE_HEADER}: {text}\r\n\r\n".encode()).page_id == page_id


def test_empty(spark):
    out = converted(spark, [])
    assert A.resolved(A.read_warc(spark, out, payloads=False)).count() == 0


@pytest.mark.parametrize("version", [1, 2])
@pytest.mark.parametrize("pack", [lambda parts: b"".join(parts), lambda parts: gzip.compress(b"".join(parts)), lambda parts: b"".join(map(gzip.compress, parts))])
def test_versions_and_compression(version, pack):
    pages = [("http://a/1", 1, b"one\n\nhttp://x 0 0 0 5\n"), ("http://a/2", None, b""), ("dns:a", 3, b"\x00\xff\r\n")]
    parts = [A.arc_head(version, "f.arc") + b"\n"] + [A.arc_record(version, "f.arc", u, i, h) + b"\n" for u, i, h in pages]
    found = list(A.arc_records(pack(parts)))
    assert found[0].fields["URL"] == "filedesc://f.arc" and not any(r.truncated for r in found)
    assert [(r.fields["URL"], A.http_of(r.content).page_id, A.http_of(r.content).payload) for r in found[1:]] == pages
    assert all(len(r.fields) == len(A.ARC_FIELDS[version].split()) for r in found[1:])
    assert [r.offset for r in found] == [sum(map(len, parts[:k])) for k in range(4)]


def test_damaged_archives():
    head = A.arc_head(1, "f.arc") + b"\n"
    one = A.arc_record(1, "f.arc", "http://a", 1, b"abcdef")
    cut = list(A.arc_records(head + one[:-3]))
    assert cut[-1].truncated and cut[-1].content.endswith(b"abc")
    odd = list(A.arc_records(head + b"no record line\nhttp://x 0.0.0.0 2026 text/html many\n" + one + b"\n"))
    assert [r.fields["URL"] for r in odd[1:]] == ["http://a"]
    assert list(A.arc_records(b"")) == [] and len(list(A.arc_records(gzip.compress(head + one)[:-12]))) >= 1
    short = list(A.arc_records(b"http://no-head 1.2.3.4 2026 text/plain 3\nabc\n"))
    assert short[0].content == b"abc" and A.iso_date("2026") == "2026-01-01T00:00:00Z"


def test_other_content_is_a_resource():
    record = A.ArcRecord(5, {"URL": "dns:a", "IP-address": "1.2.3.4", "Archive-date": "20200229010203", "Content-type": "text/dns", "Archive-length": "3"}, b"abc", False)
    found = next(A.warc_records(A.warc_record("f.arc", record, None) + b"\r\n\r\n"))
    assert found.headers["warc-type"] == "resource" and found.block == b"abc"
    assert found.headers["warc-date"] == "2020-02-29T01:02:03Z" and found.headers["warc-ip-address"] == "1.2.3.4"
