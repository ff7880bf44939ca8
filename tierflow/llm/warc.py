"""WARC archives as a table of chunks.

Each page becomes a record; pages whose payload (the html in UTF-8) an earlier one has become revisits of
it. A record is stored as rows ``(archive, record, chunk, data, digest)``: chunk 0 holds the WARC and HTTP
headers, the next ones the payload in pieces of bounded size, the last the record's end. ``digest`` is the
SHA-1 of the payload up to and with the row, so a reader checks every piece as it comes and never holds a
record. The ``data`` of an archive, in order, is a valid WARC/1.1 file.

Null html is an empty payload. A page without an id is a response of its own. Rows that repeat a page_id
and payload are records of their own of the same type. An empty table gives an empty archive.
"""

from __future__ import annotations

import base64
import hashlib
import urllib.parse
import uuid

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, stage, text_bytes

CHUNK_BYTES = 1 << 18
END = b"\r\n\r\n"
ARCHIVE = "archive int, record long, chunk int, data binary, digest binary"
RECORD = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long"
NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # fixed: the URL namespace of RFC 4122


def record_id(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, f'page:{page_id}')}>"


def header(page_id, url, size: int, digest: str, refers_to, date: str) -> bytes:
    """WARC and HTTP headers of a record. ``refers_to`` is the page of the response, or None for a response.
    Characters that would break a header line are percent-encoded in the address."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {record_id(page_id)}",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {urllib.parse.quote(url or '', safe=':/?#[]@!$&()*+,;=%~-._')}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(http) + (size if refers_to is None else 0)}",
    ]
    if page_id is not None:
        lines.append(f"X-Page-ID: {page_id}")
    if refers_to is not None:
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        lines.append(f"WARC-Refers-To: {record_id(refers_to)}")
        lines.append(f"X-Refers-To-Page-ID: {refers_to}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + http


def fields(head: bytes) -> dict[str, str]:
    """Header fields by lower-case name, the WARC ones and those of the HTTP block as ``http:name``."""
    warc, _, http = head.partition(b"\r\n\r\n")
    out = {}
    for prefix, block in (("", warc), ("http:", http)):
        for line in block.split(b"\r\n")[1:]:
            name, colon, value = line.partition(b":")
            if colon:
                out[prefix + name.decode().strip().lower()] = value.decode().strip()
    return out


def mark_revisits(pages: DataFrame, least: int = 0) -> DataFrame:
    """``page_id, url, payload, digest, refers_to``: of equal payloads of at least ``least`` bytes all but the
    one with the smallest page_id refer to that one."""
    payload = text_bytes("html")
    keyed = stage(
        pages.filter(F.col("page_id").isNotNull()).select("page_id", F.sha1(payload).alias("digest"), F.octet_length(payload).alias("bytes")),
        "warc-digests",
    )
    large = keyed.filter(F.col("bytes") >= least)
    # staged, so that both sides of the join are plain exchanges and a hot payload can be split
    firsts = stage(
        large.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).filter("n > 1").select("digest", "first"),
        "warc-firsts",
    )
    refers = large.join(firsts, "digest").filter("page_id <> first").select("page_id", "digest", F.col("first").alias("refers_to")).distinct()
    return (
        pages.select("page_id", "url", payload.alias("payload"), F.sha1(payload).alias("digest"))
        .join(refers, ["page_id", "digest"], "left")
        .select("page_id", "url", "payload", "digest", "refers_to")
    )


def write_chunks(marked: DataFrame, chunk_bytes: int = CHUNK_BYTES, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """The chunk table of marked pages, not yet written. One archive per task."""

    def make():
        archive, at = TaskContext.get().partitionId(), 0

        def step(batch):
            nonlocal at
            rows = zip(*(batch.column(i) for i in range(5)), strict=True)
            out, held = [], 0
            for page, url, body, digest, refers in rows:
                data = memoryview(body.as_buffer()) if body.is_valid else memoryview(b"")
                b32 = base64.b32encode(bytes.fromhex(digest.as_py())).decode()
                running = hashlib.sha1()
                out.append((archive, at, 0, header(page.as_py(), url.as_py(), len(data), b32, refers.as_py(), date), running.digest()))
                chunk = 1
                if not refers.is_valid:
                    for start in range(0, len(data), chunk_bytes):
                        piece = data[start : start + chunk_bytes]
                        running.update(piece)
                        out.append((archive, at, chunk, bytes(piece), running.digest()))
                        chunk, held = chunk + 1, held + len(piece)
                        if held >= 16 * chunk_bytes:
                            yield _batch(out)
                            out, held = [], 0
                out.append((archive, at, chunk, END, running.digest()))
                at += 1
            yield _batch(out)

        return step

    return map_batches(marked, make, ARCHIVE)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[]] * 5
    types = (pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary())
    return pa.record_batch([pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], names=["archive", "record", "chunk", "data", "digest"])


def read_records(archive: DataFrame) -> DataFrame:
    """One row per record of a chunk table, each piece checked against its running digest and the whole
    payload against the header. Holds one chunk at a time. A broken record raises ``ValueError``."""

    def make():
        head, key, running, size, expected = None, None, None, 0, 0

        def step(batch):
            nonlocal head, key, running, size, expected
            done = []
            for archive_no, record, chunk, data, digest in zip(*(batch.column(i) for i in range(5)), strict=True):
                here, number = (archive_no.as_py(), record.as_py()), chunk.as_py()
                if number == 0:
                    if head is not None:
                        raise ValueError(f"record {key} has no end")
                    head, key, running, size, expected = fields(data.as_py()), here, hashlib.sha1(), 0, 0
                elif here != key or number != expected + 1:
                    raise ValueError(f"record {here}: chunk {number} is out of place")
                expected = number
                piece = memoryview(data.as_buffer())
                end = number > 0 and len(piece) == len(END) and bytes(piece) == END and digest.as_py() == running.digest()
                if number and not end:
                    running.update(piece)
                    size += len(piece)
                if running.digest() != digest.as_py():
                    raise ValueError(f"record {here}: chunk {number} does not match its digest")
                if end:
                    done.append(_record(key, head, size, running))
                    head = key = None
            columns = zip(*done, strict=True) if done else [[]] * 6
            types = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64())
            names = [c.split()[0] for c in RECORD.split(", ")]
            yield pa.record_batch([pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], names=names)

        return step

    ordered = archive.repartition("archive", "record").sortWithinPartitions("archive", "record", "chunk")
    return map_batches(ordered, make, RECORD)


def _record(key, head: dict[str, str], size: int, running) -> tuple:
    declared, kind = int(head["http:content-length"]), head["warc-type"]
    digest = head["warc-payload-digest"].removeprefix("sha1:")
    if kind == "response" and (size != declared or base64.b32encode(running.digest()).decode() != digest):
        raise ValueError(f"record {key}: payload does not match its header")
    number = lambda name: int(head[name]) if name in head else None
    url = urllib.parse.unquote(head["warc-target-uri"])
    return number("x-page-id"), url, kind, declared, digest, number("x-refers-to-page-id")


def round_trip(pages: DataFrame, least: int = 0) -> DataFrame:
    """Write the pages as an archive below the shared scratch folder and read its records back."""
    return read_records(stage(write_chunks(mark_revisits(pages, least)), "warc"))
