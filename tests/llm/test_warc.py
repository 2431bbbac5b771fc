import hashlib
import struct

import pytest
import zstandard

from wrenchlake.llm import warc


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "x", 5) for i, u, h in rows], "page_id long, url string, html string, payload string, record_type int")


BIG, SMALL = "<p>é</p>" * 300, "<p>s</p>"
ROWS = [(1, "http://a/1", BIG), (2, "http://a/2", BIG), (9, None, BIG), (3, "http://a/3", SMALL), (4, "http://a\r\n/4", SMALL), (5, "u", None), (6, "u", ""),
        (7, "u", "x" * 999), (8, "u", "x" * 999), (None, "u", BIG), (10, "u", "y" * 1000), (10, "u", "y" * 1000), (11, "u", "\r\n\r\n" * 400)]


def expected(rows):
    first = {}
    for i, _, html in rows:
        if i is not None:
            first[html or ""] = max(first.get(html or "", i), i)
    out = []
    for i, _, html in rows:
        data = (html or "").encode()
        revisit = len(data) >= 1000 and first.get(html or "") != i
        out.append((repr(i), len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", first[html or ""] if revisit else None))
    return sorted(out, key=repr)


def got(df):
    return sorted(((repr(r["page_id"]), r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in df.collect()), key=repr)


def test_round_trip(spark, tmp_path):
    folder, archives, records = warc.archive_pages(pages(spark, ROWS * 1).repartition(3), f"file://{tmp_path}/w")
    assert records == len(ROWS) and archives >= 1
    read = warc.read_archives(spark, folder)
    assert got(read) == expected(ROWS)
    payloads = {r["page_id"]: bytes(r["payload"]) for r in read.filter("record_type = 'response'").collect()}
    assert payloads[9] == BIG.encode() and payloads[5] == b"" and payloads[11] == b"\r\n\r\n" * 400


def test_many_archives_and_a_trained_dictionary(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "SAMPLE_BYTES", 40_000)
    rows = [(i, f"http://h/{i}", f"<html><p>page {i} of words and words {i * i}</p></html>" * 20) for i in range(300)]
    made = warc.with_record_types(pages(spark, rows).repartition(2))
    (tmp_path / "w").mkdir()
    files = warc.write_archives(made, f"file://{tmp_path}/w", archive_bytes=4000).collect()
    assert len(files) > 2 and sum(f["records"] for f in files) == 300
    assert got(warc.read_archives(spark, f"file://{tmp_path}/w")) == expected(rows)
    raw = next((tmp_path / "w").glob("*.zst")).read_bytes()
    assert struct.unpack_from("<I", raw)[0] == warc.DICTIONARY_MAGIC


def test_no_pages(spark):
    folder, _, records = warc.archive_pages(pages(spark, []))
    assert records == 0


def one_archive(record=None, **row):
    row = {"page_id": 1, "url": "u", "payload": b"abc", "payload_digest": hashlib.sha1(b"abc").hexdigest(), "payload_bytes": 3,
           "record_type": "response", "refers_to": None} | row
    record = record(warc.record_bytes(row)) if record else warc.record_bytes(row)
    return zstandard.ZstdCompressor().compress(record)


def test_archive_without_or_with_a_compressed_dictionary():
    assert next(warc.archive_records("a", one_archive()))["payload"] == b"abc"
    samples = [b"sample record number %d of some length" % k for k in range(50)]
    dictionary = warc._dictionary(samples)
    packed = zstandard.ZstdCompressor().compress(dictionary)
    kind = zstandard.ZstdCompressionDict(dictionary)
    row = {"page_id": None, "url": None, "payload": b"", "payload_digest": hashlib.sha1(b"").hexdigest(), "payload_bytes": 0, "record_type": "response", "refers_to": None}
    frame = zstandard.ZstdCompressor(dict_data=kind).compress(warc.record_bytes(row))
    content = struct.pack("<II", warc.DICTIONARY_MAGIC, len(packed)) + packed + frame * 2
    assert [r["page_id"] for r in warc.archive_records("a", content)] == [None, None]


@pytest.mark.parametrize(
    "content",
    [
        one_archive(payload_digest="0" * 40),
        one_archive(payload_bytes=4),
        one_archive(record_type="other"),
        one_archive(lambda r: r.replace(b"WARC/1.1", b"WARC/9.9")),
        one_archive(lambda r: r.replace(b"WARC-Date", b"X-Date")),
        one_archive(lambda r: r.replace(b"WARC-Date: ", b"WARC-Date ")),
        one_archive(lambda r: r[:-1]),
        one_archive(lambda r: r + b"x"),
        one_archive()[:-3],
        one_archive() + b"rest of something",
        struct.pack("<II", warc.DICTIONARY_MAGIC, 99) + b"short",
    ],
)
def test_faults_are_found(content):
    with pytest.raises(ValueError):
        list(warc.archive_records("a", content))
