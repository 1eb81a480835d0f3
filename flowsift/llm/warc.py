"""WARC archives in Zstandard: one frame per record, the dictionary in a leading skippable frame."""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator
from typing import BinaryIO
from urllib.parse import quote, unquote

import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowsift.session import scratch_dir, stage

# Fixed values of the formats.
DICTIONARY_FRAME = 0x184D2A5D
ZSTD_FRAME = 0xFD2FB528
VERSION = b"WARC/1.1"
END = b"\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

#: Uncompressed bytes after which a task opens another archive, and those its dictionary learns from.
ARCHIVE_BYTES = 128 << 20
SAMPLE_BYTES = 512 << 10
DICTIONARY_BYTES = 8 << 10
#: Payloads below this size are never replaced by revisits.
REVISIT_BYTES = 1000

_SAFE = "".join(chr(c) for c in range(0x21, 0x7F) if chr(c) != "%")


class WarcError(ValueError):
    """An archive does not hold what its headers say."""


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool, date: str) -> bytes:
    """One record: an HTTP response, or a revisit that has its headers alone."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d" % len(payload) + END
    block = http if revisit else http + payload
    name = "" if page_id is None else str(page_id)
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", f"<urn:page:{name}>"),
        ("WARC-Date", date),
        ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
    ]
    if url is not None:
        fields.append(("WARC-Target-URI", quote(url, safe=_SAFE)))
    if revisit:
        fields += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", f"<urn:page:{refers_to}>")]
    fields.append(("Content-Length", str(len(block))))
    head = b"".join(f"{k}: {v}\r\n".encode() for k, v in fields)
    return VERSION + b"\r\n" + head + b"\r\n" + block + END


def _fields(lines: list[bytes]) -> dict[str, str]:
    out = {}
    for line in lines:
        name, colon, value = line.partition(b":")
        if not colon:
            raise WarcError(f"header line without a colon: {line[:80]!r}")
        out[name.decode().lower()] = value.strip().decode()
    return out


def _number(uri: str) -> int | None:
    if not uri.startswith("<urn:page:") or not uri.endswith(">"):
        raise WarcError(f"unknown record id: {uri}")
    return int(uri[10:-1]) if uri[10:-1] else None


def parse(raw: bytes) -> dict:
    """Checks a record's version, lengths and digest and returns its parts."""
    head, blank, rest = raw.partition(END)
    lines = head.split(b"\r\n")
    if not blank or lines[0] != VERSION:
        raise WarcError("no WARC header")
    fields = _fields(lines[1:])
    size = int(fields["content-length"])
    if len(rest) != size + len(END) or rest[size:] != END:
        raise WarcError(f"content of {len(rest) - len(END)} bytes, header says {size}")
    http, blank, payload = rest[:size].partition(END)
    if not blank or not http.startswith(b"HTTP/"):
        raise WarcError("no HTTP header")
    length = int(_fields(http.split(b"\r\n")[1:])["content-length"])
    kind = fields["warc-type"]
    if kind not in ("response", "revisit"):
        raise WarcError(f"unknown record type: {kind}")
    algorithm, _, digest = fields["warc-payload-digest"].partition(":")
    if algorithm != "sha1":
        raise WarcError(f"unknown digest: {algorithm}")
    if kind == "response" and (len(payload) != length or hashlib.sha1(payload).hexdigest() != digest):
        raise WarcError("payload differs from its length or digest")
    if kind == "revisit" and payload:
        raise WarcError("revisit with a payload")
    return {
        "page_id": _number(fields["warc-record-id"]),
        "url": unquote(fields["warc-target-uri"]) if "warc-target-uri" in fields else None,
        "payload_bytes": length,
        "payload_digest": digest,
        "record_type": kind,
        "refers_to": _number(fields["warc-refers-to"]) if kind == "revisit" else None,
        "payload": payload if kind == "response" else None,
    }


def _dictionary(samples: list[bytes]) -> zstandard.ZstdCompressionDict | None:
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, k=64, d=8)
    except zstandard.ZstdError:  # too few or too uniform records
        return None


class ArchiveWriter:
    """Streams records into one archive. The first ones are held back to train its dictionary."""

    def __init__(self, out: BinaryIO) -> None:
        self.out, self.samples, self.sampled = out, [], 0
        self.compressor: zstandard.ZstdCompressor | None = None
        self.records = self.bytes = 0

    def write(self, raw: bytes) -> None:
        self.records += 1
        self.bytes += len(raw)
        if self.compressor:
            self.out.write(self.compressor.compress(raw))
            return
        self.samples.append(raw)
        self.sampled += len(raw)
        if self.sampled >= SAMPLE_BYTES:
            self._begin()

    def _begin(self) -> None:
        trained = _dictionary(self.samples)
        if trained:
            data = trained.as_bytes()
            self.out.write(struct.pack("<II", DICTIONARY_FRAME, len(data)) + data)
        self.compressor = zstandard.ZstdCompressor(level=3, dict_data=trained)
        for raw in self.samples:
            self.out.write(self.compressor.compress(raw))
        self.samples.clear()

    def close(self) -> None:
        if not self.compressor:
            self._begin()
        self.out.close()


def frames(stream: BinaryIO, read: int = 1 << 20) -> Iterator[bytes]:
    """Decoded frames of an archive, one record each, holding one at a time."""
    data = stream.read(8)
    if len(data) < 8:
        if data:
            raise WarcError("archive cut short")
        return
    magic, size = struct.unpack("<II", data)
    dictionary = None
    if magic == DICTIONARY_FRAME:
        content = stream.read(size)
        if len(content) != size:
            raise WarcError("dictionary cut short")
        if struct.unpack_from("<I", content)[0] == ZSTD_FRAME:
            content = zstandard.ZstdDecompressor().decompressobj().decompress(content)
        dictionary = zstandard.ZstdCompressionDict(content)
        data = b""
    decoder = zstandard.ZstdDecompressor(dict_data=dictionary)
    while True:
        data = data or stream.read(read)
        if not data:
            return
        frame, parts = decoder.decompressobj(), []
        while True:
            parts.append(frame.decompress(data))
            if frame.eof:
                data = frame.unused_data
                break
            data = stream.read(read)
            if not data:
                raise WarcError("frame cut short")
        yield b"".join(parts)


def _filesystem(uri: str) -> tuple[pa.fs.FileSystem, str]:
    return pa.fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))


_MANIFEST = "path string, records bigint, bytes bigint"


def write_archives(pages: DataFrame, folder: str, date: str = "1970-01-01T00:00:00Z", page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Writes every page as a record into archives below ``folder``; returns their ``path, records, bytes``.

    Of pages with equal payloads of at least ``REVISIT_BYTES`` bytes, the one with the largest id is a
    response and the others revisit it; rows that repeat that id are all responses, as are equal
    payloads whose ids are all NULL. Smaller payloads are responses. A NULL text is an empty payload,
    a NULL url leaves out the header. An empty table makes no archive. Other columns are not read.

    Only digests and ids are shuffled to find equal payloads, a page is moved once. Each attempt of a
    task writes files of its own; those of the attempts that succeeded are in the result.
    """
    slim = pages.select(
        F.col(page_id).cast("bigint").alias("page_id"), F.col(url).cast("string").alias("url"), F.coalesce(F.col(html), F.lit("")).cast("binary").alias("payload")
    )
    slim = slim.withColumns({"digest": F.sha1("payload"), "size": F.length("payload")})
    equal = slim.where(F.col("size") >= REVISIT_BYTES).groupBy("digest", "size").agg(F.max("page_id").alias("kept"), F.count("*").alias("n"))
    joined = slim.join(equal.where("n > 1").drop("n"), ["digest", "size"], "left")
    revisit = F.coalesce(~F.col("page_id").eqNullSafe(F.col("kept")) & F.col("kept").isNotNull(), F.lit(False))
    rows = joined.select("page_id", "url", "payload", "digest", F.when(revisit, F.col("kept")).alias("refers_to"), revisit.alias("revisit"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, path, done = None, "", []
        for batch in batches:
            for i in range(batch.num_rows):
                if writer is None:
                    path = f"{folder}/{uuid.uuid4().hex}.warc.zst"
                    system, inner = _filesystem(path)
                    system.create_dir(inner.rpartition("/")[0], recursive=True)
                    writer = ArchiveWriter(system.open_output_stream(inner))
                page, address, payload, digest, kept, again = (c[i].as_py() for c in batch.columns)
                writer.write(record(page, address, payload, digest, kept, again, date))
                if writer.bytes >= ARCHIVE_BYTES:
                    writer.close()
                    done.append((path, writer.records, writer.bytes))
                    writer = None
        if writer is not None:
            writer.close()
            done.append((path, writer.records, writer.bytes))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done) if done else ((), (), ()), (pa.string(), pa.int64(), pa.int64()))], ["path", "records", "bytes"])

    return stage(rows.mapInArrow(run, _MANIFEST), "warc-manifest")


_RECORDS = pa.schema(
    [
        ("page_id", pa.int64()),
        ("url", pa.string()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("record_type", pa.string()),
        ("refers_to", pa.int64()),
        ("payload", pa.binary()),
    ]
)


def read_archives(archives: DataFrame, payloads: bool = True) -> DataFrame:
    """The validated records of the archives named in ``path``.

    ``payloads=False`` checks payloads but does not return them. A record whose headers, lengths or
    digest do not fit fails the job with its archive and number. Without archives there are no rows.
    """
    kinds = {pa.int64(): "bigint", pa.string(): "string", pa.binary(): "binary"}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                system, inner = _filesystem(path)
                rows, size, number = [], 0, 0
                with system.open_input_stream(inner) as stream:
                    for raw in frames(stream):
                        try:
                            row = parse(raw)
                        except (KeyError, ValueError) as e:
                            raise WarcError(f"{path}, record {number}: {e}") from e
                        number += 1
                        if not payloads:
                            row["payload"] = None
                        size += len(row["payload"] or b"")
                        rows.append(row)
                        if len(rows) >= 2048 or size >= 8 << 20:
                            yield pa.RecordBatch.from_pylist(rows, _RECORDS)
                            rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, _RECORDS)

    parallel = archives.select("path").repartition(max(1, archives.count()))
    return parallel.mapInArrow(run, ", ".join(f"{f.name} {kinds[f.type]}" for f in _RECORDS))


def archive_round_trip(pages: DataFrame, payloads: bool = False) -> DataFrame:
    """Writes the pages to the shared folder and reads the records back."""
    return read_archives(write_archives(pages, scratch_dir(pages.sparkSession, "warc")), payloads)
