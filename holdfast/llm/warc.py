"""Legacy ARC archives converted to WARC.

An ARC file begins with a version block that names the fields of its record
lines; version 1 has five, version 2 ten. Records are found by those fields and
by their declared lengths. Each becomes a WARC record: its identifier is a UUID
made of file name and offset, its date the 14 digits as ISO 8601, its type
``response`` for HTTP content and ``resource`` otherwise, with SHA-1 digests of
block and payload. Of records with equal payloads the one with the largest page
id (then date, file and offset) stays a response; others become ``revisit``
records that refer to it and hold the HTTP header alone.

Archives are read file by file with Spark's binary file source and written
through its text sink (gzip), so they may lie in any store that Spark reaches,
and a lost task leaves no part of a file. A file is read by one task, so files
should be of a usual size (about 100 MB); those written here follow the input's
partitions.

Cases: null payload counts as empty; white space in a URL is percent-encoded and
an absent one is ``unknown:``; a record without a page id (a header line of its
HTTP content) has none in the result and comes last among equals; a record cut
off by the end of its file keeps what is there and is marked truncated; lines
that are no record line are skipped; repeated rows are separate records; an
empty table gives archives without records; other columns are not archived.
"""

from __future__ import annotations

import base64
import hashlib
import io
import re
import uuid
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.llm.store import registry, text_of, written
from holdfast.llm.text import slices
from holdfast.session import scratch_path

# fixed values: field names of the two ARC versions, the revisit profile
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
PAGE_HEADER = "X-Page-Id"
DATE = "20260101000000"
MIN_BYTES = 0
OUT_BYTES = 4 << 20  # of records that are handed on at a time

QUERIES, ORACLE, query = registry()


# --- ARC ---------------------------------------------------------------------------------------


class ArcRecord(NamedTuple):
    offset: int
    fields: dict[str, str]
    content: bytes
    truncated: bool


def _arc_line(version: int, url: str, kind: str, name: str, length: int, date: str, status: str = "200") -> bytes:
    middle = f" {status} - - 0 {name}" if version == 2 else ""
    return f"{url} 0.0.0.0 {date} {kind}{middle} {length}".encode()


def arc_head(version: int, name: str, date: str = DATE) -> bytes:
    """The version block that begins a file, without the line break that ends it."""
    body = f"{version} 0 holdfast\n{ARC_FIELDS[version]}\n".encode()
    return _arc_line(version, f"filedesc://{name}", "text/plain", name, len(body), date) + b"\n" + body


def arc_record(version: int, name: str, url: str | None, page_id, html: bytes, date: str = DATE) -> bytes:
    """A page as an HTTP response in an ARC record, without the line break that ends it."""
    url = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "") or "unknown:"
    page = "" if page_id is None else f"{PAGE_HEADER}: {page_id}\r\n"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n{page}Content-Length: {len(html)}\r\n\r\n".encode()
    return _arc_line(version, url, "text/html", name, len(http) + len(html), date) + b"\n" + http + html


class _Unpacked(io.RawIOBase):
    """The members of gzip data one after the other, as far as they can be unpacked."""

    def __init__(self, content: bytes) -> None:
        self.rest, self.member, self.ready = content, None, b""

    def readable(self) -> bool:
        return True

    def readinto(self, buffer) -> int:
        while not self.ready:
            if self.member is None or self.member.eof:
                self.rest = (self.member.unused_data if self.member else self.rest).lstrip(b"\0")
                if not self.rest:
                    return 0
                self.member = zlib.decompressobj(31)
            try:
                self.ready = self.member.decompress(self.rest, 1 << 16)
            except zlib.error:
                self.rest, self.member = b"", None
                return 0
            self.rest = self.member.unconsumed_tail
            if not self.ready and not self.member.eof and not self.rest:
                return 0
        n = min(len(buffer), len(self.ready))
        buffer[:n], self.ready = self.ready[:n], self.ready[n:]
        return n


def _opened(content: bytes) -> io.BufferedReader:
    raw = _Unpacked(content) if content[:2] == b"\x1f\x8b" else io.BytesIO(content)
    return io.BufferedReader(raw, 1 << 16)


def _read(file: io.BufferedReader, n: int) -> bytes:
    """``n`` bytes, or as many as the file has."""
    parts = []
    while n > 0 and (part := file.read(min(n, 1 << 24))):
        parts.append(part)
        n -= len(part)
    return b"".join(parts)


def arc_records(content: bytes) -> Iterator[ArcRecord]:
    """Records of an ARC file, the version block first; gzip in one or many members is unpacked."""
    file, names, at = _opened(content), ARC_FIELDS[1].split(), 0
    while line := file.readline():
        start, at = at, at + len(line)
        text = line.decode("utf-8", "replace").rstrip("\r\n")
        if not text.strip():
            continue
        head = text.startswith("filedesc:")
        wanted = len(names) if not head else len(text.split(" "))
        parts = text.rsplit(" ", wanted - 1)
        if len(parts) != wanted or not re.fullmatch(r"\d{1,18}", parts[-1]):
            continue
        length = int(parts[-1])
        body = _read(file, length)
        at += len(body)
        if head:
            lines = body.decode("utf-8", "replace").splitlines()
            if len(lines) > 1 and lines[1].endswith("Archive-length"):
                names = lines[1].split(" ")
            elif lines and lines[0][:1] in ("1", "2"):
                names = ARC_FIELDS[int(lines[0][0])].split()
        yield ArcRecord(start, dict(zip(names if not head else ["URL"], parts)), body, len(body) < length)


class Http(NamedTuple):
    head: bytes
    payload: bytes
    page_id: int | None


def http_of(content: bytes) -> Http | None:
    """Header and payload of HTTP content; None if it is something else."""
    if not content.startswith(b"HTTP/"):
        return None
    ends = [m for m in (content.find(b"\r\n\r\n"), content.find(b"\n\n")) if m >= 0]
    if not ends:
        return Http(content, b"", None)
    end = min(ends) + (4 if content.startswith(b"\r\n\r\n", min(ends)) else 2)
    head = content[:end]
    found = re.search(rb"(?im)^" + PAGE_HEADER.encode() + rb":[ \t]*(-?\d{1,19})\s*$", head)
    page_id = int(found[1]) if found else None
    return Http(head, content[end:], page_id if page_id is not None and -(1 << 63) <= page_id < 1 << 63 else None)


def sha1_32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def write_arc(pages: DataFrame, path: str, id: str = "page_id", url: str = "url", html: str = "html", date: str = DATE) -> None:
    """Pages as ARC files below ``path``, versions 1 and 2 by turns of the partitions."""
    rows = pages.select(F.col(id).cast("long").alias("id"), F.col(url).cast("string").alias("url"), text_of(pages, html).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        version, name, begun = 1 + part % 2, f"pages-{part:06d}.arc", False
        for batch in slices(batches, size=OUT_BYTES):
            out = [] if begun else [arc_head(version, name, date)]
            begun = True
            texts = batch.column("text").cast(pa.binary())
            for key, link, page in zip(batch.column("id").to_pylist(), batch.column("url").to_pylist(), texts.to_pylist()):
                out.append(arc_record(version, name, link, key, page, date))
            yield pa.record_batch({"value": pa.array(out, pa.binary())})

    _to_files(rows.mapInArrow(run, "value binary"), path, "\n")


def _to_files(records: DataFrame, path: str, end: str) -> None:
    """Records to gzip files as they are, each followed by ``end``."""
    raw = records.select(F.col("value").cast("string").alias("value"))
    raw.write.option("compression", "gzip").option("lineSep", end).text(path)


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")


# --- conversion --------------------------------------------------------------------------------


def record_id(path: str, offset: int) -> str:
    return f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, path.rsplit('/', 1)[-1] + '#' + str(offset))}"


def iso_date(digits: str) -> str:
    """14 digits as ISO 8601; shorter dates are filled up."""
    d = (digits if digits.isdigit() else "")[:14]
    d += "19700101000000"[len(d) :]
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def _survey(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each HTTP record of ARC files: place, address, date, page id, and digest and size of its payload."""
    for batch in batches:
        for path, content in zip(batch.column("path").to_pylist(), batch.column("content")):
            rows = []
            for r in arc_records(content.as_py()):
                if (http := http_of(r.content)) is not None:
                    rows.append((path, r.offset, r.fields["URL"], iso_date(r.fields["Archive-date"]), http.page_id, sha1_32(http.payload), len(http.payload)))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), _SURVEY_TYPES)], _SURVEY_NAMES)


_SURVEY = "path string, offset long, uri string, date string, page_id long, digest string, bytes long"
_SURVEY_NAMES = [x.split()[0] for x in _SURVEY.split(", ")]
_SURVEY_TYPES = [pa.string() if x.endswith("string") else pa.int64() for x in _SURVEY.split(", ")]


def _warc(kind: str, headers: list[tuple[str, str | None]], block: bytes) -> bytes:
    lines = [f"{k}: {v}" for k, v in [("WARC-Type", kind), *headers, ("WARC-Block-Digest", f"sha1:{sha1_32(block)}"), ("Content-Length", str(len(block)))] if v is not None]
    return ("WARC/1.1\r\n" + "\r\n".join(lines) + "\r\n\r\n").encode() + block


def warc_record(path: str, r: ArcRecord, original: dict | None) -> bytes:
    """The WARC record of an ARC record; ``original``: the record whose payload it repeats."""
    common = [("WARC-Record-ID", f"<{record_id(path, r.offset)}>")]
    if r.fields["URL"].startswith("filedesc:"):
        info = b"software: holdfast\r\nformat: WARC File Format 1.1\r\n"
        return _warc("warcinfo", [*common, ("WARC-Date", iso_date("")), ("Content-Type", "application/warc-fields")], info)
    address = r.fields.get("IP-address")
    common += [
        ("WARC-Date", iso_date(r.fields["Archive-date"])),
        ("WARC-Target-URI", r.fields["URL"]),
        ("WARC-IP-Address", address if address not in ("0.0.0.0", "-") else None),
        ("WARC-Truncated", "length" if r.truncated else None),
    ]
    http = http_of(r.content)
    if http is None:
        return _warc("resource", [*common, ("Content-Type", r.fields["Content-type"])], r.content)
    common += [("Content-Type", "application/http;msgtype=response"), ("WARC-Payload-Digest", f"sha1:{sha1_32(http.payload)}")]
    if original is None:
        return _warc("response", common, r.content)
    return _warc(
        "revisit",
        [
            *common,
            ("WARC-Profile", REVISIT),
            ("WARC-Refers-To", f"<{record_id(original['path'], original['offset'])}>"),
            ("WARC-Refers-To-Target-URI", original["uri"]),
            ("WARC-Refers-To-Date", original["date"]),
        ],
        http.head,
    )


def _convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        repeats = batch.column("repeats").to_pylist()
        for path, content, known in zip(batch.column("path").to_pylist(), batch.column("content"), repeats):
            originals = {x["at"]: x for x in known or ()}
            out, size = [], 0
            for r in arc_records(content.as_py()):
                out.append(warc_record(path, r, originals.get(r.offset)))
                size += len(out[-1])
                if size > OUT_BYTES:
                    yield pa.record_batch({"value": pa.array(out, pa.binary())})
                    out, size = [], 0
            if out:
                yield pa.record_batch({"value": pa.array(out, pa.binary())})


def convert(spark: SparkSession, arc: str, warc: str, min_bytes: int = MIN_BYTES) -> None:
    """WARC files below ``warc`` for the ARC files below ``arc``.

    Payloads of at least ``min_bytes`` are written once. The first pass keeps a line per record; what a
    file's records repeat is then joined to the file, a list no longer than the file's records.
    """
    survey = written(_files(spark, arc).mapInArrow(_survey, _SURVEY), "survey")
    place = F.struct(F.col("page_id").isNotNull().alias("has"), "page_id", "date", "path", "offset", "uri")
    firsts = survey.where(F.col("bytes") >= min_bytes).groupBy("digest", "bytes").agg(F.max(place).alias("first"), F.count("*").alias("n"))
    firsts = written(firsts.where("n > 1").select(F.col("digest").alias("d"), F.col("bytes").alias("b"), "first"), "firsts")
    # both tables are written, so the join can split the records of a common payload
    joined = survey.select("path", "offset", "digest", "bytes").join(firsts, (F.col("digest") == F.col("d")) & (F.col("bytes") == F.col("b")))
    repeats = joined.where((F.col("path") != F.col("first.path")) | (F.col("offset") != F.col("first.offset")))
    original = F.struct(F.col("offset").alias("at"), "first.path", "first.offset", "first.uri", "first.date")
    repeats = repeats.groupBy("path").agg(F.collect_list(original).alias("repeats"))
    files = _files(spark, arc).join(repeats, "path", "left").select("path", "content", "repeats")
    _to_files(files.mapInArrow(_convert, "value binary"), warc, "\r\n\r\n")


# --- reading back ------------------------------------------------------------------------------


class WarcRecord(NamedTuple):
    headers: dict[str, str]
    block: bytes


def warc_records(content: bytes) -> Iterator[WarcRecord]:
    """Records of a WARC file; header names in lower case."""
    file = _opened(content)
    while line := file.readline():
        if not line.startswith(b"WARC/"):
            continue
        headers = {}
        while (line := file.readline().decode("utf-8", "replace").rstrip("\r\n")) != "":
            name, _, value = line.partition(":")
            headers[name.strip().lower()] = value.strip()
        length = headers.get("content-length", "0")
        yield WarcRecord(headers, _read(file, int(length) if length.isdigit() else 0))


def _bare(value: str | None) -> str | None:
    return value.strip("<>") if value else None


def _parsed(payloads: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                rows, size = [], 0
                for r in warc_records(content.as_py()):
                    kind, http = r.headers.get("warc-type"), http_of(r.block)
                    payload = http.payload if http is not None else r.block
                    stated = (r.headers.get("warc-payload-digest") or "").removeprefix("sha1:") or None
                    digest = sha1_32(payload) if kind == "response" else stated
                    rows.append(
                        (
                            kind, _bare(r.headers.get("warc-record-id")), r.headers.get("warc-target-uri"), r.headers.get("warc-date"),
                            _bare(r.headers.get("warc-refers-to")), http.page_id if http is not None else None,
                            digest, len(payload), payload if payloads else None,
                        )
                    )
                    size += len(payload) if payloads else 200
                    if size > OUT_BYTES:
                        yield _batch(rows)
                        rows, size = [], 0
                if rows:
                    yield _batch(rows)

    return run


_PARSED = "record_type string, record_id string, uri string, date string, refers_to_id string, page_id long, payload_digest string, payload_bytes long, payload binary"


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
    fields = [x.split() for x in _PARSED.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(x, kinds[t]) for x, (_, t) in zip(zip(*rows), fields)], [n for n, _ in fields])


def read_warc(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """Records of WARC files, with their payloads if wanted; digests of responses are those of what was read."""
    return _files(spark, path).mapInArrow(_parsed(payloads), _PARSED)


def resolved(records: DataFrame) -> DataFrame:
    """Responses and revisits as pages: a revisit takes size and page of the record it refers to."""
    records = written(records.drop("payload").where("record_type IN ('response', 'revisit')"), "records")
    first = records.where("record_type = 'response'").select(
        F.col("record_id").alias("refers_to_id"), F.col("page_id").alias("refers_to"), F.col("payload_bytes").alias("first_bytes")
    )
    again = records.where("record_type = 'revisit'").drop("payload_bytes").join(first, "refers_to_id")
    pages = records.where("record_type = 'response'").withColumn("refers_to", F.lit(None).cast("long"))
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return pages.select(*columns).unionByName(again.withColumnRenamed("first_bytes", "payload_bytes").select(*columns))


@query(
    """
    WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS bytes, sha1(coalesce(html, '')) AS h FROM pages),
    g AS (SELECT *, max(page_id) OVER (PARTITION BY h, bytes) AS first FROM p)
    SELECT page_id, bytes AS payload_bytes,
           list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
               1 + CAST((CAST('0x' || substr(h, 1 + 10 * CAST(i // 8 AS INT), 10) AS BIGINT) >> CAST(35 - 5 * (i % 8) AS INT)) & 31 AS INT), 1)),
               'string_agg', '') AS payload_digest,
           CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
    FROM g
    """
)
def op1_arc_to_warc(spark, sf_dir):
    arc, warc = scratch_path(spark, "arc"), scratch_path(spark, "warc")
    write_arc(spark.read.parquet(f"{sf_dir}/pages.parquet"), arc)
    convert(spark, arc, warc)
    return resolved(read_warc(spark, warc, payloads=False))
