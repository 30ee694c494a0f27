import hashlib
import io
import zipfile

import pytest

from quarry.llm import warc
from quarry.llm.blocks import scratch

BIG = "<p>é</p>" * 40


def pages(spark):
    rows = [(1, "http://a/", "x"), (2, "http://b/", "x"), (9, None, BIG), (5, "u\r\nInjected: 1", BIG), (7, "http://c/", BIG), (5, "again", BIG), (None, "n", BIG), (None, "n", "alone" * 30),
            (11, "e", None), (12, "e", ""), (13, "z", "\r\n\r\nWARC/1.1\r\n" * 20)]
    return spark.createDataFrame([(*r, "p", "d") for r in rows], "page_id long, url string, html string, payload string, digest string"), rows


def expected(rows):
    first = {}
    for i, _, h in rows:
        if i is not None and len((h or "").encode()) >= 100:
            first[h] = min(first.get(h, i), i)
    out = []
    for i, _, h in rows:
        raw = (h or "").encode()
        refers = first.get(h) if first.get(h) != i else None
        out.append((i, len(raw), hashlib.sha256(raw).hexdigest(), "response" if refers is None else "revisit", refers))
    return sorted(out, key=str)


def test_round_trip_of_odd_rows(spark):
    df, rows = pages(spark)
    got = warc.round_trip(df)
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got.collect()), key=str) == expected(rows)
    assert {r.payload is None for r in got.where("record_type = 'revisit'").collect()} == {True}
    assert {bytes(r.payload) for r in got.where("page_id = 13").collect()} == {("\r\n\r\nWARC/1.1\r\n" * 20).encode()}
    assert {r.url for r in got.where("page_id = 5").collect()} == {"u%0D%0AInjected: 1", "again"}
    assert warc.round_trip(df.limit(0)).count() == 0


def test_an_index_filter_reads_only_those_records(spark, monkeypatch):
    df, _ = pages(spark)
    folder = scratch(spark, "warc-test")
    index = warc.index_of(warc.write_packages(warc.decided(df), folder).checkpoint())
    got = warc.fetch(index.where("url = 'http://c/'"), df.schema["page_id"].dataType).collect()
    assert [(r.page_id, r.record_type, r.refers_to) for r in got] == [(7, "revisit", 5)]


@pytest.mark.parametrize("limit", [zipfile.ZIP64_LIMIT, 100])
def test_directories_with_and_without_zip64_fields(monkeypatch, limit):
    monkeypatch.setattr(zipfile, "ZIP64_LIMIT", limit)  # small: sizes and offsets stand in ZIP64 extra fields
    raw = io.BytesIO()
    with zipfile.ZipFile(raw, "w", zipfile.ZIP_STORED) as z:
        z.writestr("first", b"a" * 300)
        z.writestr("é/second", b"b" * 500)
        z.comment = b"comment PK"
    found = warc.directory(raw, len(raw.getvalue()))
    for name, byte, size in (("first", b"a", 300), ("é/second", b"b", 500)):
        method, local, stored, full = found[name]
        at = warc.member_at(raw, local)
        assert (method, stored, full) == (0, size, size) and raw.getvalue()[at:at + size] == byte * size


def test_more_members_than_16_bits_count():
    raw = io.BytesIO()
    with zipfile.ZipFile(raw, "w", zipfile.ZIP_STORED) as z:
        for i in range(66000):
            z.writestr(f"m{i}", b"")
    assert len(warc.directory(raw, len(raw.getvalue()))) == 66000


def test_what_is_no_package():
    with pytest.raises(ValueError, match="end of central directory"):
        warc.directory(io.BytesIO(b"x" * 100), 100)
