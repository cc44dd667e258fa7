"""Operator 3, WARC: archives of response and revisit records, and a reader that salvages damaged ones.

Each record is one gzip member, so a reader can start at any member. The salvage reader checks each member (inflate,
CRC, version line, header block, Content-Length, payload digest). When a check fails it looks for the next place where
a gzip member or, in an archive that is not compressed, a version line begins and holds, goes on from there and
logs the bytes between as a gap. Nothing of a later record is lost by damage before it.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from datetime import UTC, datetime

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.llm import common, storage

VERSION = b"WARC/1.1"
MAGIC = b"\x1f\x8b\x08"
LINE = re.compile(rb"WARC/1\.[01]\r\n")
#: Payloads below this size are never worth a revisit record.
LEAST_REVISIT = 100
#: An archive is closed and the next begun when it holds this many compressed bytes.
ARCHIVE_BYTES = 16 << 20
#: Compressed bytes that a reader hands to zlib at once: what lies behind a member's end in them is copied.
READ_BYTES = 16 << 10


@dataclass
class Record:
    kind: str
    headers: dict[str, str]
    block: bytes
    at: int = 0

    @property
    def payload(self) -> bytes:
        """The block without the HTTP header."""
        head, found, body = self.block.partition(b"\r\n\r\n")
        return body if found and head.startswith(b"HTTP/") else self.block


@dataclass
class Salvage:
    """What reading has set aside: [start, end) of bytes and why, in order."""

    gaps: list[tuple[int, int, str]] = field(default_factory=list)

    def log(self, lo: int, hi: int, why: str) -> None:
        if self.gaps and self.gaps[-1][1] == lo:  # the same stretch goes on; its first reason stands
            lo, _, why = self.gaps.pop()
        self.gaps.append((lo, hi, why))


def format_record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = [VERSION, *(f"{k}: {v}".encode() for k, v in headers), b"Content-Length: %d" % len(block)]
    return b"\r\n".join(lines) + b"\r\n\r\n" + block + b"\r\n\r\n"


def compress_member(raw: bytes, level: int = 1) -> bytes:
    z = zlib.compressobj(level, zlib.DEFLATED, 31)
    return z.compress(raw) + z.flush()


def _clean(value: str) -> str:
    """A header value on one line."""
    return re.sub(r"[\r\n]+", " ", value)


def record_id(name: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>"


def page_name(page_id: int | None, digest: str) -> str:
    return f"page:{page_id}:{digest}"


def page_record(
    page_id: int | None, url: str | None, payload: bytes, digest: str, name: str, date: str,
    refers_to: int | None = None, refers_url: str | None = None, refers_known: bool = False,
) -> bytes:
    """A response record, or with refers_to a revisit record that holds no payload. name is unlike that of any other
    record; with refers_known the response is the one named page_name(refers_to, digest)."""
    revisit = refers_to is not None
    headers = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", record_id(name)),
        ("WARC-Date", date),
        ("WARC-Target-URI", _clean(url or "")),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("X-Payload-Length", str(len(payload))),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    if page_id is not None:
        headers.append(("X-Page-ID", str(page_id)))
    if revisit:
        headers += [
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
            *([("WARC-Refers-To", record_id(page_name(refers_to, digest)))] if refers_known else []),
            ("WARC-Refers-To-Target-URI", _clean(refers_url or "")),
            ("WARC-Refers-To-Date", date),
            ("X-Refers-To-Page", str(refers_to)),
        ]
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    return compress_member(format_record(headers, http if revisit else http + payload))


def parse_record(raw: bytes, at: int = 0) -> tuple[Record, int]:
    """The record that begins at raw[at] and where it ends; ValueError says which check failed."""
    if not LINE.match(raw, at):
        raise ValueError("version line")
    end = raw.find(b"\r\n\r\n", at)
    if end < 0:
        raise ValueError("header block")
    headers = {}
    for line in raw[at:end].split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            raise ValueError("header line")
        headers[name.decode("utf-8", "replace").strip().lower()] = value.decode("utf-8", "replace").strip()
    size = headers.get("content-length", "")
    if not size.isdigit():
        raise ValueError("content length")
    block, stop = raw[end + 4 : end + 4 + int(size)], end + 4 + int(size)
    if len(block) < int(size) or raw[stop : stop + 4] != b"\r\n\r\n":
        raise ValueError("record end")
    record = Record(headers.get("warc-type", ""), headers, block, at)
    named = headers.get("warc-payload-digest", "")
    if record.kind == "response" and named.startswith("sha256:"):
        if hashlib.sha256(record.payload).hexdigest() != named[7:]:
            raise ValueError("payload digest")
    return record, stop + 4


def _member(data: bytes, at: int) -> tuple[bytes, int]:
    z, view, raw = zlib.decompressobj(31), memoryview(data), []
    try:
        while not z.eof and at < len(data):
            raw.append(z.decompress(view[at : at + READ_BYTES]))
            at = min(at + READ_BYTES, len(data))
    except zlib.error as e:
        raise ValueError("gzip member") from e
    if not z.eof:
        raise ValueError("gzip end")
    return b"".join(raw), at - len(z.unused_data)


def read_archive(data: bytes, salvage: Salvage | None = None) -> Iterator[Record]:
    """All records that hold, in order; damaged stretches go to salvage.gaps."""
    salvage, at = salvage or Salvage(), 0
    while at < len(data):
        try:
            if data.startswith(MAGIC, at):
                raw, end = _member(data, at)
                record, stop = parse_record(raw)
                if stop != len(raw):
                    raise ValueError("member holds more than a record")
                record.at = at
            else:
                record, end = parse_record(data, at)
            yield record
            at = end
        except ValueError as e:
            found = [data.find(MAGIC, at + 1)] + [m.start() for m in [LINE.search(data, at + 1)] if m]
            to = min((x for x in found if x > at), default=len(data))
            salvage.log(at, to, str(e))
            at = to


MANIFEST = "archive int, uri string, n_records long, n_bytes long"


def plan_records(pages: DataFrame) -> DataFrame:
    """Adds payload_digest, payload_bytes, refers_to and refers_url (null for responses) and alone to pages (page_id, url,
    html): whether one row only has the id and payload of the response among equal payloads.

    Of the rows with equal payloads of at least LEAST_REVISIT bytes the smallest page_id is the response; rows that
    repeat that id are responses too, and payloads whose ids are all null stay responses.
    """
    rows = pages.select(
        F.col("page_id").cast("long"), "url", F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload")
    ).withColumns({"payload_digest": F.sha2("payload", 256), "payload_bytes": F.octet_length("payload").cast("long")})
    counted = rows.filter(F.col("payload_bytes") >= LEAST_REVISIT).groupBy("payload_digest", "page_id")
    counted = counted.agg(F.min(F.struct(F.col("url").isNull(), "url"))["url"].alias("url"), F.count("*").alias("n"))
    first = counted.groupBy("payload_digest").agg(
        F.min(F.when(F.col("page_id").isNotNull(), F.struct("page_id", "url", "n"))).alias("first"), F.sum("n").alias("all")
    )
    first = first.filter("all > 1").select("payload_digest", "first.*")
    first = first.toDF("payload_digest", "first_id", "first_url", "copies")
    joined = rows.join(first, "payload_digest", "left")
    again = F.col("page_id").isNull() | (F.col("page_id") != F.col("first_id"))
    joined = joined.withColumns(
        {
            "refers_to": F.when(again, F.col("first_id")),
            "refers_url": F.when(again, F.col("first_url")),
            "alone": F.coalesce(F.col("copies") == 1, F.lit(False)),
        }
    )
    return joined.drop("first_id", "first_url", "copies")


def write_date() -> str:
    return datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")


def write_archives(planned: DataFrame, folder: str, date: str | None = None) -> DataFrame:
    """One record for each row, of this date (now); the manifest (written to the shared folder) names the archives of
    successful attempts. Each record has an id of its own: that of a page where revisits refer to it, else one by the
    place where it is written."""
    date = date or write_date()
    names = ["archive", "uri", "n_records", "n_bytes"]

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, out, uri, n, size = TaskContext.get().partitionId(), None, "", 0, 0

        def done() -> pa.RecordBatch:
            out.close()
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([uri]), pa.array([n]), pa.array([size])], names=names
            )

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if out is None:
                    uri, n, size = f"{folder}/part-{part:05d}-{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = storage.open_write(uri)
                page_id, url, payload, digest, refers_to, refers_url, alone = row
                name = page_name(page_id, digest) if alone and refers_to is None else f"{uri}#{n}"
                data = page_record(page_id, url, payload, digest, name, date, refers_to, refers_url, alone)
                out.write(data)
                n, size = n + 1, size + len(data)
                if size >= ARCHIVE_BYTES:
                    yield done()
                    out = None
        if out is not None:
            yield done()

    rows = planned.select("page_id", "url", "payload", "payload_digest", "refers_to", "refers_url", "alone")
    return common.materialize(rows.mapInArrow(write, MANIFEST), "archives")


def _number(headers: dict[str, str], name: str) -> int | None:
    found = re.fullmatch(r"-?\d{1,19}", headers.get(name, ""))
    return int(found[0]) if found else None


RECORDS = "uri string, at long, page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary, gap_end long, why string"


def read_archives(manifest: DataFrame, payloads: bool = True, whole: bool = False) -> DataFrame:
    """A row for each record that holds and each gap (record_type 'gap': bytes [at, gap_end) and why) of the archives of a
    manifest; with whole an archive that does not hold all n_records of its row is an error.

    payload_digest and payload_bytes of a response are taken anew from its payload; those of a revisit from its header.
    """
    schema = pa.schema(
        [("uri", pa.string()), ("at", pa.int64()), ("page_id", pa.int64()), ("url", pa.string())]
        + [("record_type", pa.string()), ("refers_to", pa.int64()), ("payload_bytes", pa.int64())]
        + [("payload_digest", pa.string()), ("payload", pa.binary()), ("gap_end", pa.int64()), ("why", pa.string())]
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(rows: list[tuple]) -> pa.RecordBatch:
            cols = [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)]
            return pa.RecordBatch.from_arrays(cols, schema=schema)

        for batch in batches:
            for uri, expected in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rows, size, salvage, held = [], 0, Salvage(), 0
                for r in read_archive(storage.read_bytes(uri), salvage):
                    h, body, held = r.headers, r.payload, held + 1
                    if r.kind == "revisit":
                        digest, n = h.get("warc-payload-digest", "").removeprefix("sha256:"), _number(h, "x-payload-length")
                    else:
                        digest, n = hashlib.sha256(body).hexdigest(), len(body)
                    ids = _number(h, "x-page-id"), _number(h, "x-refers-to-page")
                    rows.append(
                        (uri, r.at, ids[0], h.get("warc-target-uri"), r.kind, ids[1], n)
                        + (digest, body if payloads and r.kind != "revisit" else None, None, None)
                    )
                    size += len(body) if payloads else 200
                    if size >= 4 << 20:
                        yield flush(rows)
                        rows, size = [], 0
                if whole and (held != expected or salvage.gaps):
                    raise ValueError(f"{uri}: {held} of {expected} records, gaps {salvage.gaps}")
                rows += [(uri, lo, None, None, "gap", None, None, None, None, hi, w) for lo, hi, w in salvage.gaps]
                if rows:
                    yield flush(rows)

    spark = manifest.sparkSession
    return manifest.select("uri", "n_records").repartition(common.parts(spark)).mapInArrow(read, RECORDS)


def salvage_archives(manifest: DataFrame, name: str = "salvage") -> tuple[DataFrame, DataFrame]:
    """The records that hold and the quarantined gaps (uri, at, gap_end, why) of archives that may be damaged, both written
    to the shared folder. n_records of the manifest may be null, as for archives of other writers."""
    read = common.materialize(read_archives(manifest), name)
    return read.filter("record_type <> 'gap'").drop("gap_end", "why"), read.filter("record_type = 'gap'").select("uri", "at", "gap_end", "why")


def archive_pages(pages: DataFrame) -> DataFrame:
    """Write a record for each row of pages and read the archives back; a record lost on the way is an error."""
    manifest = write_archives(plan_records(pages), common.scratch_path(pages.sparkSession, "warc"))
    return read_archives(manifest, payloads=False, whole=True)
