import hashlib
import random
from collections import Counter

import pytest

from kindred.llm import common, queries, storage, warc

DATE = "2026-01-02T03:04:05Z"
PAGES = "page_id long, url string, html string"


def archive(payloads):
    return [warc.page_record(i, f"http://x/{i}", p, hashlib.sha256(p).hexdigest(), f"n{i}", DATE) for i, p in enumerate(payloads)]


def test_round_trip_of_records():
    payloads = [b"", b"\r\n\r\nWARC/1.1\r\n", b"a" * 5000, "é漢".encode(), b"\x1f\x8b\x08 not a member"]
    salvage = warc.Salvage()
    read = list(warc.read_archive(b"".join(archive(payloads)), salvage))
    assert [r.payload for r in read] == payloads and salvage.gaps == []


def test_reading_is_linear_in_the_archive(monkeypatch):
    """zlib keeps a copy of what it is given beyond a member's end: it must not be given the rest of the archive."""
    fed = 0

    class Counting:
        def __init__(self, wbits):
            self.z = real(wbits)

        def decompress(self, part):
            nonlocal fed
            fed += len(part)
            return self.z.decompress(part)

        def __getattr__(self, name):
            return getattr(self.z, name)

    real = warc.zlib.decompressobj
    rng = random.Random(2)
    payloads = [rng.randbytes(n) for n in (100, 70_000, *[2000] * 400, 50_000)]
    data = b"".join(archive(payloads))
    monkeypatch.setattr(warc.zlib, "decompressobj", Counting)
    salvage = warc.Salvage()
    assert [r.payload for r in warc.read_archive(data, salvage)] == payloads and salvage.gaps == []
    assert fed <= len(data) + len(payloads) * (16 << 10)


def test_damage_loses_only_what_it_hits():
    rng = random.Random(1)
    payloads = [rng.randbytes(300) for _ in range(8)]
    members = archive(payloads)
    starts = [sum(map(len, members[:i])) for i in range(9)]
    data = bytearray(b"".join(members))
    for i in (2, 3, 6):
        data[starts[i] + len(members[i]) // 2] ^= 0xFF
    salvage = warc.Salvage()
    read = list(warc.read_archive(bytes(data), salvage))
    assert [r.headers["x-page-id"] for r in read] == [str(i) for i in (0, 1, 4, 5, 7)]
    assert [(lo, hi) for lo, hi, _ in salvage.gaps] == [(starts[2], starts[4]), (starts[6], starts[7])]
    read = list(warc.read_archive(b"junk before " + bytes(data[: starts[5] - 3]), salvage := warc.Salvage()))
    assert len(read) == 2 and salvage.gaps[0][:2] == (0, 12) and salvage.gaps[-1][1] == 12 + starts[5] - 3


def test_archives_that_are_not_compressed():
    raw = [warc.format_record([("WARC-Type", "resource")], b"body %d" % i) for i in range(3)]
    salvage = warc.Salvage()
    read = list(warc.read_archive(raw[0] + b"????" + raw[1][:-6] + raw[2], salvage))
    assert [r.block for r in read] == [b"body 0", b"body 2"] and len(salvage.gaps) == 1
    assert list(warc.read_archive(b"")) == []


def test_header_values_stay_on_one_line():
    (record,) = warc.read_archive(warc.page_record(None, "http://x/\r\nEvil: 1", b"p", hashlib.sha256(b"p").hexdigest(), "n", DATE))
    assert "evil" not in record.headers and "x-page-id" not in record.headers
    assert record.headers["warc-date"] == DATE


def test_pages_with_copies_nulls_and_ties(spark):
    big = "x" * 200
    rows = [(5, "u", big), (3, None, big), (3, "v", big), (9, "w", big), (None, "n", big), (1, "s", "small"), (2, "s", "small"), (4, None, None)]
    df = spark.createDataFrame(rows, PAGES)
    out = warc.archive_pages(df).collect()
    found = Counter((r["page_id"], r["record_type"], r["refers_to"], r["payload_bytes"], r["payload_digest"]) for r in out)
    h = lambda t: hashlib.sha256(t.encode()).hexdigest()
    expected = {
        (5, "revisit", 3, 200, h(big)): 1,
        (3, "response", None, 200, h(big)): 2,
        (9, "revisit", 3, 200, h(big)): 1,
        (None, "revisit", 3, 200, h(big)): 1,
        (1, "response", None, 5, h("small")): 1,
        (2, "response", None, 5, h("small")): 1,
        (4, "response", None, 0, h("")): 1,
    }
    assert found == expected
    assert warc.archive_pages(spark.createDataFrame([], PAGES)).count() == 0


def test_records_have_ids_of_their_own_and_revisits_name_theirs(spark):
    big = "y" * 300
    rows = [(1, "a", big), (2, "b", big), (2, "b", big), (3, "c", "z" * 150), (3, "c", "z" * 150), (4, None, "z" * 150)]
    rows += [(7, "l", "long " * 400_000), (7, "l", "x"), (None, None, None)]
    folder = common.scratch_path(spark, "warc")
    manifest = warc.write_archives(warc.plan_records(spark.createDataFrame(rows, PAGES)), folder, DATE)
    read = [r for m in manifest.collect() for r in warc.read_archive(storage.read_bytes(m["uri"]))]
    ids = [r.headers["warc-record-id"] for r in read]
    assert len(set(ids)) == len(rows) and all(r.headers["warc-date"] == DATE for r in read)
    by_page = {r.headers.get("x-page-id"): r for r in read}
    revisits = [r for r in read if r.kind == "revisit"]
    assert sorted(r.headers["x-page-id"] for r in revisits) == ["2", "2", "4"]
    for r in revisits:
        named = r.headers.get("warc-refers-to")
        assert named == (by_page["1"].headers["warc-record-id"] if r.headers["x-page-id"] == "2" else None)
        assert r.headers["warc-refers-to-target-uri"] == ("a" if r.headers["x-page-id"] == "2" else "c")


def test_damaged_archives_on_disk(spark):
    rows = [(i, f"u{i}", f"{i} " * 200) for i in range(40)]
    planned = warc.plan_records(spark.createDataFrame(rows, PAGES).coalesce(1))
    manifest = warc.write_archives(planned.coalesce(1), common.scratch_path(spark, "warc"))
    (m,) = manifest.collect()
    data = bytearray(storage.read_bytes(m["uri"]))
    at = [r.at for r in warc.read_archive(bytes(data))]
    for i in (3, 20):
        data[at[i] + 40] ^= 0xFF
    storage.write_bytes(m["uri"], bytes(data[: at[39] + 30]))
    records, gaps = warc.salvage_archives(manifest)
    assert records.count() == 37
    found = sorted((g["at"], g["gap_end"]) for g in gaps.collect())
    assert found == [(at[3], at[4]), (at[20], at[21]), (at[39], at[39] + 30)]
    with pytest.raises(Exception, match="37 of 40 records"):
        warc.read_archives(manifest, whole=True).collect()


def test_query_covers_every_page(spark):
    sf = "/root/testdata/sf0.001"
    pages = {r["page_id"]: (r["html"] or "").encode() for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    for r in queries.op3_warc(spark, sf).collect():
        assert r["payload_digest"] == hashlib.sha256(pages.pop(r["page_id"])).hexdigest()
    assert not pages
