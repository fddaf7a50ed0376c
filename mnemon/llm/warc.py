"""WARC records in seekable Zstandard bundles.

A bundle is a chain of independent Zstandard frames of whole WARC records and
a skippable frame at its end, the seek table: for each frame its compressed
and plain size, then the count of frames, a flag byte and a magic number.  Any
frame opens alone, and a record is found by (bundle, frame, offset in the
frame's plain bytes, length).

Bundles are rows of a Parquet table with the places of their records, so any
store that Spark can reach holds them; ``export_bundles`` turns them into files.
Records are WARC/1.1: a bundle starts with a warcinfo record, a response has the
HTTP header its payload would come with, and a revisit only that header.
"""

from __future__ import annotations

import hashlib
import os
import struct
import uuid
from collections.abc import Iterator
from datetime import datetime, timezone
from urllib.parse import quote, unquote

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mnemon.llm.shared import scratch

# fixed values: the seekable format's skippable-frame magic and footer magic
SKIPPABLE, FOOTER = 0x184D2A5E, 0x8F92EAB1

BUNDLE_SCHEMA = "bundle string, content binary, records array<struct<page_id: bigint, frame: int, offset: bigint, length: bigint>>"
RECORD_SCHEMA = "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, payload binary"


#: A url that WARC-Target-URI can't hold as it is (none, or with control characters) is quoted, and this field says so.
QUOTED = "X-Quoted-URI"


def record_id(page_id: int | None, url: str | None, digest: str) -> str:
    """A record's URN; only rows alike in all three share one."""
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.sha1(repr((page_id, url, digest)).encode()).digest()[:16], version=5)}>"


def _target(url: str | None, page_id: int | None) -> list[str]:
    if url is None:
        return [f"WARC-Target-URI: urn:x-page:{'' if page_id is None else page_id}", f"{QUOTED}: none"]
    if url and url.isprintable() and " " not in url:
        return [f"WARC-Target-URI: {url}"]
    return [f"WARC-Target-URI: {quote(url) or 'urn:x-empty:'}", f"{QUOTED}: yes"]


def _url(fields: dict[str, str]) -> str | None:
    how, uri = fields.get(QUOTED), fields["WARC-Target-URI"]
    return None if how == "none" else uri if how is None else "" if uri == "urn:x-empty:" else unquote(uri)


def _record(head: list[str], block: bytes) -> bytes:
    return "\r\n".join(["WARC/1.1", *head, f"Content-Length: {len(block)}"]).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def info_bytes(date: str) -> bytes:
    """The warcinfo record of a bundle."""
    block = b"software: mnemon\r\nformat: WARC File Format 1.1\r\n"
    return _record(["WARC-Type: warcinfo", f"WARC-Record-ID: <urn:uuid:{uuid.uuid4()}>", f"WARC-Date: {date}", "Content-Type: application/warc-fields"], block)


def record_bytes(page_id: int | None, url: str | None, payload: bytes, digest: str, size: int, date: str, response: tuple[int, str | None] | None) -> bytes:
    """One response, or a revisit of ``response`` (page id and url), whose block is the HTTP header alone."""
    head = [
        "WARC-Type: " + ("response" if response is None else "revisit"),
        f"WARC-Record-ID: {record_id(page_id, url, digest)}",
        f"WARC-Date: {date}",
        *_target(url, page_id),
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http;msgtype=response",
    ]
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    if response is not None:
        head += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: {record_id(*response, digest)}",
            f"WARC-Refers-To-Date: {date}",
            f"X-Refers-To-Page-ID: {response[0]}",
        ]
        if response[1] is not None and response[1].isprintable() and response[1] and " " not in response[1]:
            head.append(f"WARC-Refers-To-Target-URI: {response[1]}")
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    return _record(head, http + (payload if response is None else b""))


def parse_http(block: bytes) -> tuple[int, bytes]:
    """(payload size by the header, what follows the header)."""
    stop = block.index(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in block[:stop].decode().split("\r\n")[1:])
    return int(fields["Content-Length"]), block[stop + 4 :]


def parse_record(data: memoryview | bytes, at: int = 0) -> tuple[dict, bytes, int]:
    """The header fields, the body and the end of the record at ``at``."""
    data = bytes(data) if not isinstance(data, bytes) else data
    stop = data.index(b"\r\n\r\n", at)
    lines = data[at:stop].decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("no WARC record here")
    fields = dict(x.split(": ", 1) for x in lines[1:])
    start = stop + 4
    end = start + int(fields["Content-Length"])
    if data[end : end + 4] != b"\r\n\r\n":
        raise ValueError("a record's length is wrong")
    return fields, data[start:end], end + 4


class BundleWriter:
    def __init__(self, frame_bytes: int, level: int, date: str):
        self.pack = zstandard.ZstdCompressor(level=level, write_checksum=True)
        self.frame_bytes, self.date = frame_bytes, date
        self.clear()

    def clear(self) -> None:
        self.frames: list[bytes] = []
        self.plain: list[int] = []
        self.open: list[bytes] = []
        self.filled = 0
        self.index: list[dict] = []
        self.size = 0

    def add(self, page_id: int | None, record: bytes) -> None:
        if not self.index:
            info = info_bytes(self.date)
            self.open, self.filled = [info], len(info)
        self.index.append({"page_id": page_id, "frame": len(self.frames), "offset": self.filled, "length": len(record)})
        self.open.append(record)
        self.filled += len(record)
        if self.filled >= self.frame_bytes:
            self.flush()

    def flush(self) -> None:
        if self.open:
            self.frames.append(self.pack.compress(b"".join(self.open)))
            self.plain.append(self.filled)
            self.size += len(self.frames[-1])
            self.open, self.filled = [], 0

    def close(self) -> dict | None:
        self.flush()
        if not self.frames:
            return None
        table = b"".join(struct.pack("<II", len(f), p) for f, p in zip(self.frames, self.plain))
        table += struct.pack("<IBI", len(self.frames), 0, FOOTER)
        content = b"".join(self.frames) + struct.pack("<II", SKIPPABLE, len(table)) + table
        row = {"bundle": hashlib.sha1(content).hexdigest(), "content": content, "records": self.index}
        self.clear()
        return row


def seek_table(content: bytes) -> list[tuple[int, int, int]]:
    """(start, compressed size, plain size) of each frame, from the footer."""
    n, flags, magic = struct.unpack("<IBI", content[-9:])
    if magic != FOOTER or flags:
        raise ValueError("no seek table of this kind at the end")
    top = len(content) - 9 - 8 * n
    if struct.unpack("<II", content[top - 8 : top]) != (SKIPPABLE, 8 * n + 9):
        raise ValueError("the seek table's frame is damaged")
    out, at = [], 0
    for i in range(n):
        packed, plain = struct.unpack_from("<II", content, top + 8 * i)
        out.append((at, packed, plain))
        at += packed
    if at != top - 8:
        raise ValueError("the seek table doesn't fit the frames")
    return out


def read_frame(content: bytes, entry: tuple[int, int, int]) -> bytes:
    start, packed, plain = entry
    data = zstandard.ZstdDecompressor().decompress(content[start : start + packed], max_output_size=plain)
    if len(data) != plain:
        raise ValueError("a frame's size is wrong")
    return data


def read_at(content: bytes, frame: int, offset: int, length: int) -> tuple[dict, bytes]:
    """One record by its place: opens its frame and no other."""
    data = read_frame(content, seek_table(content)[frame])
    fields, body, end = parse_record(data[offset : offset + length])
    if end != length:
        raise ValueError("the index doesn't fit the record")
    return fields, body


def write_bundles(pages: DataFrame, path: str, min_bytes: int = 1000, frame_bytes: int = 1 << 18, bundle_bytes: int = 1 << 20, level: int = 3, date: str | None = None) -> None:
    """Write one record per row of ``pages`` (page_id, url, html) to bundles at ``path``.

    Of rows with equal payloads of ``min_bytes`` or more, that with the largest
    page_id is a response and the others revisit it.  A null html is an empty
    payload.  Rows that repeat the largest page_id are responses all; a row
    with a null page_id is always a response, as nothing could name it, and
    never the one that others revisit.  An empty table gives no bundles.
    ``date`` is every record's WARC-Date, by default now.  A payload of any
    length goes into one frame, of its own if it is longer than ``frame_bytes``.

    One join on the payload's digest, with a side that has one row per payload
    that occurs twice or more; Spark may split a digest that many pages have.
    """
    date = date or datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    seen = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url"),
        F.coalesce(F.col("html"), F.lit("")).alias("html"),
    ).withColumns({"digest": F.sha1(F.encode("html", "UTF-8")), "size": F.octet_length("html").cast("long")})
    first = (
        seen.where((F.col("size") >= min_bytes) & F.col("page_id").isNotNull())
        .groupBy("digest")
        .agg(F.max(F.struct("page_id", "url")).alias("response"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select("digest", "response")
    )
    joined = seen.join(first, "digest", "left").select(
        "page_id", "url", "html", "digest", "size",
        F.when(F.col("response.page_id") != F.col("page_id"), F.col("response.page_id")).alias("refers_to"), F.col("response.url").alias("refers_url"),
    )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.schema([
            ("bundle", pa.string()), ("content", pa.binary()),
            ("records", pa.list_(pa.struct([("page_id", pa.int64()), ("frame", pa.int32()), ("offset", pa.int64()), ("length", pa.int64())]))),
        ])
        writer = BundleWriter(frame_bytes, level, date)
        for batch in batches:
            ids, urls, htmls, digests, sizes, refers, refers_urls = (batch.column(i) for i in range(7))
            for i in range(batch.num_rows):
                page_id, refers_to = ids[i].as_py(), refers[i].as_py()
                payload = b"" if refers_to is not None else htmls[i].as_py().encode()
                response = None if refers_to is None else (refers_to, refers_urls[i].as_py())
                writer.add(page_id, record_bytes(page_id, urls[i].as_py(), payload, digests[i].as_py(), sizes[i].as_py(), date, response))
                if writer.size >= bundle_bytes:
                    yield pa.RecordBatch.from_pylist([writer.close()], schema=kind)
        if row := writer.close():
            yield pa.RecordBatch.from_pylist([row], schema=kind)

    joined.mapInArrow(pack, BUNDLE_SCHEMA).write.parquet(path)


def _row(fields: dict[str, str], block: bytes, payloads: bool) -> dict:
    size, body = parse_http(block)
    digest, response = fields["WARC-Payload-Digest"].removeprefix("sha1:"), fields["WARC-Type"] == "response"
    if response and (len(body) != size or hashlib.sha1(body).hexdigest() != digest):
        raise ValueError(f"the payload of {fields['WARC-Record-ID']} is damaged")
    page = lambda name: int(fields[name]) if name in fields else None
    return {
        "page_id": page("X-Page-ID"), "url": _url(fields), "payload_bytes": size, "payload_digest": digest, "record_type": fields["WARC-Type"],
        "refers_to": page("X-Refers-To-Page-ID"), "payload": body if payloads and response else None,
    }


def _at_places(bundles: DataFrame, payloads: bool) -> DataFrame:
    """The records that ``records`` of (content, records) tells the places of; each frame is opened once."""

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.schema([
            ("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
            ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary()),
        ])
        for batch in batches:
            for cell, places in zip(batch.column(0), batch.column(1)):
                content = cell.as_py()
                frames = seek_table(content)
                by_frame: dict[int, list[dict]] = {}
                for place in places.as_py():
                    by_frame.setdefault(place["frame"], []).append(place)
                for n, found in sorted(by_frame.items()):
                    data, rows = read_frame(content, frames[n]), []
                    for place in found:
                        fields, block, end = parse_record(data, place["offset"])
                        row = _row(fields, block, payloads)
                        if end != place["offset"] + place["length"] or row["page_id"] != place["page_id"]:
                            raise ValueError("the index doesn't fit the record")
                        rows.append(row)
                    yield pa.RecordBatch.from_pylist(rows, schema=kind)

    return bundles.select("content", "records").mapInArrow(unpack, RECORD_SCHEMA)


def read_bundles(bundles: DataFrame, payloads: bool = True) -> DataFrame:
    """Every record of every bundle, by the map of records, with its digest checked.

    A response whose payload doesn't have the digest or size that its header
    tells fails the read.  ``payloads=False`` leaves the payloads out.
    """
    return _at_places(bundles, payloads)


def read_pages(bundles: DataFrame, page_ids: DataFrame) -> DataFrame:
    """The records of the ids in ``page_ids`` (one column): opens their frames and no others."""
    asked = page_ids.toDF("page_id").distinct()
    mine = record_index(bundles).join(asked, "page_id")
    # a bundle's records are bounded by its size
    places = mine.groupBy("bundle").agg(F.collect_list(F.struct("page_id", "frame", "offset", "length")).alias("records"))
    return _at_places(bundles.select("bundle", "content").join(places, "bundle"), True)


def record_index(bundles: DataFrame) -> DataFrame:
    """(page_id, bundle, frame, offset, length): where each record lies."""
    return bundles.select("bundle", F.explode("records").alias("at")).select("at.page_id", "bundle", "at.frame", "at.offset", "at.length")


def export_bundles(bundles: DataFrame, folder: str) -> int:
    """Write the bundles as ``<bundle>.warc.zst`` files below ``folder``; their number.

    ``folder`` must be one path on driver and executors alike.  A file is
    renamed into place, so a task that runs twice leaves one whole file.
    """

    def save(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.makedirs(folder, exist_ok=True)
        for batch in batches:
            for name, content in zip(batch.column(0), batch.column(1)):
                to = os.path.join(folder, f"{name.as_py()}.warc.zst")
                part = f"{to}.{os.getpid()}.part"
                with open(part, "wb") as f:
                    f.write(content.as_py())
                os.replace(part, to)
            yield pa.RecordBatch.from_pydict({"n": pa.array([batch.num_rows], pa.int64())})

    return bundles.select("bundle", "content").mapInArrow(save, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def archive(pages: DataFrame, path: str | None = None, **options) -> DataFrame:
    """Write ``pages`` to bundles (at ``path``, else in the shared folder) and read every record back."""
    spark = pages.sparkSession
    path = path or scratch(spark, "warc")
    write_bundles(pages, path, **options)
    return read_bundles(spark.read.schema(BUNDLE_SCHEMA).parquet(path), payloads=False)
