"""WARC archives whose records are compressed one by one with a dictionary of the archive.

Each archive begins with a skippable frame that holds a Zstandard dictionary built from records
of that archive; every record is a frame of its own, so it can be read without the others.
Equal payloads are stored once: the other records are revisits of the one with the smallest key.

Tasks write under names of their own and report them; only archives in the written report count,
so a task that runs twice leaves an unused file and nothing else.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import written

ARCHIVE_BYTES = 16 << 20
SAMPLE_BYTES = 1 << 20
DICTIONARY_BYTES = 32 << 10
LEAST_PAYLOAD = 100
LEVEL = 3
DATE = "2024-01-01T00:00:00Z"
#: The frame that holds a dictionary, and the profile of a revisit by payload digest.
DICTIONARY_MAGIC = 0x184D2A5D
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
READ_BYTES = 1 << 20
BATCH_BYTES = 2 << 20


def record(kind: str, headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = ["WARC/1.1", f"WARC-Type: {kind}", *(f"{k}: {v}" for k, v in headers), f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def page_record(key: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """A response with its payload, or a revisit that only names the response."""
    headers = [("WARC-Record-ID", f"<urn:page:{key}>"), ("WARC-Date", DATE)]
    if url:
        headers.append(("WARC-Target-URI", quote(url, safe=":/?#[]@!$&'()*+,;=%-._~")))
    headers += [("WARC-Payload-Digest", f"sha256:{digest}"), ("X-Payload-Length", str(len(payload))),
                ("Content-Type", "application/http;msgtype=response")]
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    if refers_to is None:
        return record("response", headers, head + payload)
    headers += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<urn:page:{refers_to}>")]
    return record("revisit", headers, head)


def dictionary_of(records: list[bytes]) -> zstandard.ZstdCompressionDict | None:
    """A dictionary of records spread over the archive; None where there are too few."""
    total = sum(map(len, records))
    samples = records[::max(1, -(-total // SAMPLE_BYTES))]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples)
    except zstandard.ZstdError:
        return None


def _write_archive(folder: str, records: list[bytes]) -> tuple[str, int]:
    system, place = fs.FileSystem.from_uri(folder)
    system.create_dir(place, recursive=True)
    name = f"{uuid.uuid4().hex}.warc.zst"
    info = record("warcinfo", [("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Date", DATE),
                               ("Content-Type", "application/warc-fields")], b"format: WARC/1.1\r\n")
    dictionary = dictionary_of(records)
    size = 0
    with system.open_output_stream(f"{place}/{name}", compression=None) as out:
        if dictionary:
            frame = zstandard.ZstdCompressor(level=19).compress(dictionary.as_bytes())
            size += out.write(DICTIONARY_MAGIC.to_bytes(4, "little") + len(frame).to_bytes(4, "little") + frame)
        packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=dictionary, write_checksum=True)
        for one in (info, *records):
            size += out.write(packer.compress(one))
    return f"{folder.rstrip('/')}/{name}", size


def _writer(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def close() -> pa.RecordBatch:
            path, size = _write_archive(folder, records)
            return pa.RecordBatch.from_pylist([{"path": path, "n_records": len(records), "n_bytes": size}])

        records: list[bytes] = []
        total = 0
        for batch in batches:
            for key, url, html, digest, first in zip(*(batch.column(c) for c in ("id", "url", "html", "digest", "first"))):
                payload = (html.as_py() or "").encode()
                one = page_record(key.as_py(), url.as_py(), payload, digest.as_py(), first.as_py())
                if records and total + len(one) > ARCHIVE_BYTES:
                    yield close()
                    records, total = [], 0
                records.append(one)
                total += len(one)
        if records:
            yield close()

    return run


def write_archives(pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", payload: str = "html",
                   least: int = LEAST_PAYLOAD) -> DataFrame:
    """Write a record per row below ``folder`` and return the report: ``path``, ``n_records``, ``n_bytes``.

    Of equal payloads of at least ``least`` bytes the one with the smallest key is a response,
    the others are revisits that name it. NULL payloads are empty, NULL URLs left out. Rows with
    a NULL key are always responses. Rows that repeat both key and payload are alike: all
    responses or all revisits. Other columns are not stored; an empty table writes no archive.
    ``folder`` is a URI of a file system that all executors reach.
    """
    rows = pages.select(F.col(f"`{key}`").cast("bigint").alias("id"), F.col(f"`{url}`").alias("url"),
                        F.col(f"`{payload}`").alias("html"),
                        F.sha2(F.coalesce(F.col(f"`{payload}`"), F.lit("")), 256).alias("digest"))
    large = rows.where(F.octet_length("html") >= least).where("id IS NOT NULL").select("id", "digest")
    classes = large.groupBy("digest").agg(F.min("id").alias("first"), F.max("id").alias("last"))
    revisits = (large.join(classes.where("first < last"), "digest").where("id > first")
                .select("id", "digest", "first").distinct())
    report = rows.join(revisits, ["id", "digest"], "left").mapInArrow(
        _writer(f"{folder}/archives"), "path string, n_records bigint, n_bytes bigint")
    return written(report, f"{folder}/report")


def frames(stream) -> Iterator[bytes]:
    """The records of an open archive, one decompressed frame after the other."""
    def more(data: bytes, n: int) -> bytes:
        while len(data) < n and (chunk := stream.read(READ_BYTES)):
            data += chunk
        return data

    data = more(b"", 8)
    reader = zstandard.ZstdDecompressor()
    if data[:4] == DICTIONARY_MAGIC.to_bytes(4, "little"):
        end = 8 + int.from_bytes(data[4:8], "little")
        data = more(data, end)
        held, data = data[8:end], data[end:]
        if held[:4] == b"\x28\xb5\x2f\xfd":
            held = zstandard.ZstdDecompressor().decompress(held)
        reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(held))
    while data := data or stream.read(READ_BYTES):
        frame, parts = reader.decompressobj(), []
        while True:
            parts.append(frame.decompress(data))
            if frame.eof:
                data = frame.unused_data
                break
            data = stream.read(READ_BYTES)
            if not data:
                raise ValueError("the archive ends within a record")
        yield b"".join(parts)


def parsed(data: bytes) -> dict:
    """Kind, keys, payload and payload headers of a record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    named = {k.lower(): v for k, _, v in (line.partition(": ") for line in lines[1:])}
    block = rest[:int(named["content-length"])]

    def number(name: str) -> int | None:
        value = named.get(name, "").removeprefix("<urn:page:").removesuffix(">")
        return int(value) if value.lstrip("-").isdigit() else None

    kind = named["warc-type"]
    return {"id": number("warc-record-id"), "record_type": kind, "url": named.get("warc-target-uri"),
            "refers_to": number("warc-refers-to"),
            "payload_digest": named.get("warc-payload-digest", "").removeprefix("sha256:") or None,
            "payload_bytes": number("x-payload-length"),
            "payload": block.partition(b"\r\n\r\n")[2] if kind == "response" else None}


_READ = pa.schema([("id", pa.int64()), ("record_type", pa.string()), ("url", pa.string()), ("refers_to", pa.int64()),
                   ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("payload", pa.binary())])


def _reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path in batch.column("path").to_pylist():
            system, place = fs.FileSystem.from_uri(path)
            rows, size = [], 0
            with system.open_input_stream(place, compression=None) as stream:
                for data in frames(stream):
                    row = parsed(data)
                    if row["record_type"] == "warcinfo":
                        continue
                    rows.append(row)
                    size += len(data)
                    if size > BATCH_BYTES:
                        yield pa.RecordBatch.from_pylist(rows, _READ)
                        rows, size = [], 0
            yield pa.RecordBatch.from_pylist(rows, _READ)


def read_archives(report: DataFrame) -> DataFrame:
    """The records of the archives a report names: ``id``, ``record_type``, ``url``, ``refers_to``,
    ``payload_digest``, ``payload_bytes`` and, for responses, ``payload``. One task reads an archive as a stream.
    """
    return report.select("path").repartition("path").mapInArrow(
        _reader, "id bigint, record_type string, url string, refers_to bigint, payload_digest string, "
                 "payload_bytes bigint, payload binary")
