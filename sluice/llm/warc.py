"""WARC derivatives: from response records to linked metadata and plain-text conversion records.

A record is (headers, block): its named headers in order, and its bytes. ``derive`` makes two records of every response,
both of which refer to the response by its identifier and keep its target, date and payload digest. The metadata
record holds the response's own headers, the HTTP headers, digests, title and links as JSON; the conversion record holds
the page's plain text. Identifiers are name-based, so a repeated run makes the same records.

``write`` makes compressed WARC files through Spark's text writer, which ends every record with the blank lines of the
format and is atomic on any store; ``read`` takes files of bounded size, as ``write`` makes them (``RECORDS_PER_FILE``), one per task.

Defined cases: a null URL gives no target header; null or empty pages have an empty payload and conversion text; records
of other types are passed over by ``derive``; repeated rows give repeated records; line breaks and control characters in
header values are percent-encoded; damaged or cut off records are read as records of type ``unreadable`` with a reason and
their bytes, and the records after them as usual.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import html
import io
import json
import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sluice.llm.frames import list_array

RECORD = "headers array<struct<name: string, value: string>>, block binary"
RECORDS_PER_FILE = 4000
_END = b"\r\n\r\n"
UNREADABLE = "unreadable"  # type of what is no record
_NAMES = uuid.uuid5(uuid.NAMESPACE_URL, "warc-record")

Headers = list[tuple[str, str]]


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(*parts: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMES, json.dumps(parts))}>"


def value_of(headers: Headers, name: str) -> str | None:
    return next((v for n, v in headers if n.lower() == name.lower()), None)


def header(name: str, headers: str = "headers") -> Column:
    """Value of a record's header, or null."""
    return F.get(F.filter(headers, lambda h: F.lower(h["name"]) == name.lower()), F.lit(0))["value"]


def _plain(value: str) -> str:
    return re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", value)


def _head(kind: str, identifier: str, target: str | None, date: str | None, content_type: str, block: bytes, more: Headers) -> Headers:
    headers = [("WARC-Type", kind), ("WARC-Record-ID", identifier)]
    headers += [(n, _plain(v)) for n, v in (("WARC-Target-URI", target), ("WARC-Date", date)) if v is not None]
    headers += [(n, v) for n, v in more if v is not None]
    return [*headers, ("WARC-Block-Digest", digest(block)), ("Content-Type", content_type), ("Content-Length", str(len(block)))]


def response(key: str, target: str | None, payload: bytes, date: str) -> tuple[Headers, bytes]:
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload) + payload
    identifier = record_id("response", key, target or "", digest(block))
    payload_digest = [("WARC-Payload-Digest", digest(payload))]
    return _head("response", identifier, target, date, "application/http; msgtype=response", block, payload_digest), block


# --- pages ---

_SKIPPED = re.compile(r"<!--.*?-->|<(script|style|template|noscript)\b[^>]*>.*?</\1\s*>|<head\b[^>]*>.*?</head\s*>", re.S | re.I)
_BREAKS = re.compile(r"</?(?:p|div|br|li|ul|ol|h[1-6]|tr|table|article|section|nav|footer|header|title|blockquote|pre)\b[^>]*>", re.I)
_TAG = re.compile(r"<[a-zA-Z/!][^>]*>")
_TITLE = re.compile(r"<title[^>]*>(.*?)</title", re.S | re.I)
_LINK = re.compile(r"""<a\b[^>]*?\bhref\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)


def plain_text(page: str) -> str:
    """The page's text, a line for each block of it."""
    page = _TAG.sub("", _BREAKS.sub("\n", _SKIPPED.sub(" ", page)))
    lines = (" ".join(line.split()) for line in html.unescape(page).split("\n"))
    return "\n".join(line for line in lines if line)


def links(page: str) -> list[str]:
    return [html.unescape(m[1] or m[2] or m[3] or "") for m in _LINK.finditer(page)]


def derivatives(headers: Headers, block: bytes) -> Iterator[tuple[Headers, bytes]]:
    """The metadata and the conversion record of a response."""
    head, _, payload = block.partition(_END)
    status, *lines = head.decode("utf-8", "replace").split("\r\n")
    page = payload.decode("utf-8", "replace")
    title = _TITLE.search(page)
    http = {n.strip(): v.strip() for n, _, v in (line.partition(":") for line in lines)}
    source, target, date = (value_of(headers, n) for n in ("WARC-Record-ID", "WARC-Target-URI", "WARC-Date"))
    kept = [("WARC-Refers-To", source), ("WARC-Payload-Digest", value_of(headers, "WARC-Payload-Digest"))]
    kept += [("WARC-Refers-To-Target-URI", target), ("WARC-Refers-To-Date", date)]
    about = {
        "Envelope": {
            "WARC-Header-Metadata": dict(headers),
            "Block-Digest": digest(block),
            "Actual-Content-Length": len(block),
            "Payload-Metadata": {
                "HTTP-Response-Metadata": {
                    "Response-Message": status,
                    "Headers": http,
                    "Entity-Length": len(payload),
                    "Entity-Digest": digest(payload),
                    "HTML-Metadata": {"Title": html.unescape(title[1]).strip() if title else None, "Links": links(page)},
                }
            },
        }
    }
    for kind, content_type, body in (
        ("metadata", "application/json", json.dumps(about, ensure_ascii=False).encode()),
        ("conversion", "text/plain; charset=utf-8", plain_text(page).encode()),
    ):
        yield _head(kind, record_id(kind, source or "", digest(body)), target, date, content_type, body, kept), body


# --- frames ---


def _batch(records: list[tuple[Headers, bytes]]) -> pa.RecordBatch:
    names, values = [[pair[side] for h, _ in records for pair in h] for side in (0, 1)]
    pairs = pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(values, pa.string())], ["name", "value"])
    headers = list_array(pairs, np.array([len(h) for h, _ in records], np.int64))
    return pa.RecordBatch.from_arrays([headers, pa.array([b for _, b in records], pa.binary())], ["headers", "block"])


def responses(pages: DataFrame, key: str, url: str, page: str, date: str) -> DataFrame:
    """Response records of pages, all fetched at ``date``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                rows = zip(*(c.slice(at, 500).to_pylist() for c in batch.columns))
                yield _batch([response(k or "", u, (p or "").encode(), date) for k, u, p in rows])

    return pages.select(F.col(key).cast("string"), url, page).mapInArrow(run, RECORD)


def derive(records: DataFrame) -> DataFrame:
    """Metadata and conversion records of all response records."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                rows = zip(*(c.slice(at, 500).to_pylist() for c in batch.columns))
                yield _batch([d for h, b in rows for d in derivatives([(x["name"], x["value"]) for x in h], b)])

    return records.filter(header("WARC-Type") == "response").select("headers", "block").mapInArrow(run, RECORD)


def write(records: DataFrame, path: str) -> None:
    """WARC files of the records, in a folder."""
    lines = F.concat_ws("\r\n", F.transform("headers", lambda h: F.concat_ws(": ", h["name"], h["value"])))
    head = F.concat(F.lit("WARC/1.0\r\n"), lines, F.lit("\r\n\r\n"))
    whole = F.concat(F.encode(head, "UTF-8"), F.coalesce("block", F.lit(b""))).cast("string")
    options = {"lineSep": _END.decode(), "maxRecordsPerFile": str(RECORDS_PER_FILE), "compression": "gzip", "zlib.compress.level": "BEST_SPEED"}
    records.select(whole.alias("value")).write.options(**options).text(path)


def parse(raw: bytes) -> Iterator[tuple[Headers, bytes]]:
    """Records of a file, one at a time, whether it is compressed or not.

    Blank lines between records are skipped. What is no record, or is cut off, comes as a record of type ``unreadable``
    with a reason and the bytes, up to the next line that begins a record; no byte but blank lines is passed over.
    """
    stream = gzip.open(io.BytesIO(raw)) if raw.startswith(b"\x1f\x8b") else io.BytesIO(raw)
    try:
        yield from _records(stream)
    except (EOFError, OSError, zlib.error) as error:  # the compressed stream itself is cut off or damaged
        yield _unreadable(f"compressed data end early: {type(error).__name__}", b"")


def _unreadable(reason: str, found: bytes) -> tuple[Headers, bytes]:
    return [("WARC-Type", UNREADABLE), ("Reason", reason), ("Content-Length", str(len(found)))], found


def _records(stream: io.BufferedIOBase) -> Iterator[tuple[Headers, bytes]]:
    line = stream.readline()
    while line:
        if not line.strip(b"\r\n"):
            line = stream.readline()
            continue
        if not line.startswith(b"WARC/"):
            found = []
            while line and not line.startswith(b"WARC/"):
                found.append(line)
                line = stream.readline()
            yield _unreadable("no record begins here", b"".join(found))
            continue
        seen, headers = [line], []
        while (line := stream.readline()) and line.strip(b"\r\n"):
            seen.append(line)
            name, _, value = line.rstrip(b"\r\n").decode("utf-8", "replace").partition(":")
            headers.append((name, value.strip()))
        length = value_of(headers, "Content-Length") or "0"
        if not line or not length.isdecimal():
            yield _unreadable("the header is cut off" if not line else "no length", b"".join(seen))
            line = stream.readline()
            continue
        block = stream.read(int(length))
        if len(block) < int(length):
            yield _unreadable("the block is cut off", b"".join([*seen, line, block]))
            return
        yield headers, block
        line = stream.readline()


def read(spark: SparkSession, path: str) -> DataFrame:
    """Records of all WARC files in a folder."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file in batch.column(0):
                held: list = []
                size = 0
                for record in parse(file.as_py()):
                    held.append(record)
                    size += len(record[1])
                    if size > 4 << 20:
                        yield _batch(held)
                        held, size = [], 0
                if held:
                    yield _batch(held)

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, RECORD)
