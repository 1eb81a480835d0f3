import hashlib
import io
import struct

import pytest
import zstandard

from flowsift.llm import warc
from flowsift.llm.warc import ArchiveWriter, WarcError, archive_round_trip, frames, parse, read_archives, record, write_archives
from flowsift.session import scratch_dir

PAGES = "page_id bigint, url string, html string, record_type string, path string"


def pages(spark):
    big, other = "é" * 600, "x" * 1000
    rows = [(1, "http://a/%7e?q=ä b\r\nc", big), (2, None, big), (9, "u", big), (3, "u", "small"), (4, "u", "small"), (5, "u", other), (6, "", None), (7, "u", ""), (8, "u", "y" * 2_000_000), (None, "u", other), (9, "u", big)]
    return rows, spark.createDataFrame([(*r, "clash", "clash") for r in rows], PAGES).repartition(3)


@pytest.mark.parametrize("size", [1, 1 << 20])
def test_round_trip(spark, monkeypatch, size):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", size)
    rows, frame = pages(spark)
    got = archive_round_trip(frame, payloads=True).collect()
    assert len(got) == len(rows)
    kept = {}
    for i, _, html in rows:
        if i is not None:
            kept[html or ""] = max(kept.get(html or "", i), i)
    want = []
    for i, url, html in rows:
        payload = (html or "").encode()
        again = len(payload) >= 1000 and kept[html] != i
        want.append((i, url, len(payload), hashlib.sha1(payload).hexdigest(), "revisit" if again else "response", kept[html] if again else None, None if again else payload))
    assert sorted(map(repr, want)) == sorted(repr((r.page_id, r.url, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, r.payload and bytes(r.payload) if r.payload is not None else None)) for r in got)


def test_no_pages(spark):
    empty = pages(spark)[1].limit(0)
    assert write_archives(empty, scratch_dir(spark, "warc-test")).count() == 0
    assert archive_round_trip(empty).count() == 0


def archive(count, size=2000):
    out = io.BytesIO()
    out.close = lambda: None
    writer = ArchiveWriter(out)
    for i in range(count):
        payload = (f"<html><body>page {i} " + "common words " * (size // 13)).encode()
        writer.write(record(i, "u", payload, hashlib.sha1(payload).hexdigest(), None, False, "1970-01-01T00:00:00Z"))
    writer.close()
    return out.getvalue()


def test_dictionary_leads_and_every_record_is_a_frame():
    data = archive(400)
    magic, size = struct.unpack("<II", data[:8])
    assert magic == warc.DICTIONARY_FRAME and 0 < size <= warc.DICTIONARY_BYTES
    for read in (1, 7, 1 << 20) if len(data) < 1 << 17 else (997, 1 << 20):
        assert [parse(f)["page_id"] for f in frames(io.BytesIO(data), read)] == list(range(400))
    with pytest.raises(zstandard.ZstdError):
        list(frames(io.BytesIO(data[8 + size :])))


def test_compressed_dictionary_is_read():
    data = archive(400)
    size = struct.unpack("<II", data[:8])[1]
    packed = zstandard.ZstdCompressor().compress(data[8 : 8 + size])
    again = struct.pack("<II", warc.DICTIONARY_FRAME, len(packed)) + packed + data[8 + size :]
    assert len(list(frames(io.BytesIO(again)))) == 400


def test_damage_is_found():
    data = archive(3)
    with pytest.raises(WarcError):
        list(frames(io.BytesIO(data[:-5])))
    good = record(1, "u", b"payload", hashlib.sha1(b"payload").hexdigest(), None, False, "d")
    for bad in (good.replace(b"payload", b"Payload"), good[:-1], good + b"x", good.replace(b"WARC/1.1", b"WARC/9.9"), good.replace(b"Content-Length: 7", b"Content-Length: 8"), good.replace(b"response\r\nWARC-R", b"unknown\r\nWARC-R")):
        with pytest.raises(WarcError):
            parse(bad)


def test_unreadable_archive_fails_the_job(spark):
    _, frame = pages(spark)
    manifest = write_archives(frame, scratch_dir(spark, "warc-test"))
    path = manifest.head().path
    system, inner = warc._filesystem(path)
    with system.open_input_stream(inner) as stream:
        data = stream.read()
    with system.open_output_stream(inner) as out:
        out.write(data[: len(data) // 2])
    with pytest.raises(Exception, match="cut short|Zstd|zstd"):
        read_archives(manifest).count()
