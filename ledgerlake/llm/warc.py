"""Operator 10: derivative web-archive records.

``responses`` writes each page as a WARC/1.1 response record.  ``derive`` reads response records and
builds two records from each: a metadata record (JSON with the source's record and HTTP headers, title, links and
digests) and a plain-text conversion record.  Both name their source in WARC-Refers-To, carry its target and date, and
have digests of their own blocks; ids derive from contents, so a repeated task writes the same records.
``read_records`` reads a file of records back, gzip members or plain, and checks lengths and digests; ``files`` bundles
records into such files.

Scale: records are made row by row inside the scan's tasks, with no shuffle; a file bundles the records of one
partition up to a size, so nothing grows with the input.

Defined results: null html is an empty page and still gives three records; a null url is the empty target; repeated rows give
repeated records with equal ids; an empty table gives no rows; extra columns are ignored.  A record that
is no response, or whose digest disagrees, raises.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import html as entities
import json
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DATE = "2024-01-01T00:00:00Z"
VERSION = b"WARC/1.1\r\n"
BREAKS = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style)\b.*?(?:</\1\s*>|\Z)|</?(?:p|div|br|li|ul|ol|h[1-6]|tr|table|article|section|header|footer|nav|title|body|head|html)\b[^>]*>", re.S | re.I)
TAG = re.compile(r"<[a-zA-Z/!?][^>]*>")
GAP = re.compile(r"[^\S\n]+")
LINES = re.compile(r"\s*\n\s*")
TITLE = re.compile(r"<title\b[^>]*>(.*?)</title", re.S | re.I)
LINK = re.compile(r"<a\b[^>]*?\bhref\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)


def sha1(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(*parts: bytes) -> str:
    """A name-based id (version 5 layout) of the parts."""
    raw = bytearray(hashlib.sha1(b"\x00".join(parts)).digest()[:16])
    raw[6], raw[8] = raw[6] & 0x0F | 0x50, raw[8] & 0x3F | 0x80
    return f"<urn:uuid:{uuid.UUID(bytes=bytes(raw))}>"


def record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = "".join(f"{k}: {v}\r\n" for k, v in [*headers, ("Content-Length", str(len(block)))])
    return VERSION + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


def header_value(text: str) -> str:
    """One line: control characters are percent-encoded."""
    return re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", text)


def response(url: str | None, page: str | None) -> bytes:
    """A response record of one page."""
    payload = (page or "").encode()
    target = header_value(url or "")
    block = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n").encode() + payload
    return record([("WARC-Type", "response"), ("WARC-Record-ID", record_id(b"response", target.encode(), payload)), ("WARC-Date", DATE),
                   ("WARC-Target-URI", target), ("WARC-Payload-Digest", sha1(payload)), ("WARC-Block-Digest", sha1(block)),
                   ("Content-Type", "application/http; msgtype=response")], block)


def read_record(data: bytes, at: int = 0) -> tuple[dict[str, str], bytes, int]:
    """Headers and block of the record at a place, and the place after it."""
    if not data.startswith(b"WARC/", at):
        raise ValueError("no record starts here")
    end = data.index(b"\r\n\r\n", at)
    lines = data[at:end].decode().split("\r\n")[1:]
    headers = {name.strip(): value.strip() for name, _, value in (line.partition(":") for line in lines)}
    start = end + 4
    stop = start + int(headers["Content-Length"])
    block = data[start:stop]
    if data[stop:stop + 4] != b"\r\n\r\n":
        raise ValueError("a record's length disagrees with its block")
    if "WARC-Block-Digest" in headers and headers["WARC-Block-Digest"] != sha1(block):
        raise ValueError("a record's digest disagrees with its block")
    return headers, block, stop + 4


def read_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """The records of a file, gzip members or plain."""
    data, at = gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data, 0
    while at < len(data):
        headers, block, at = read_record(data, at)
        yield headers, block


def http_parts(block: bytes) -> tuple[str, dict, bytes]:
    """Status line, headers (a list where a name repeats) and payload."""
    head, _, payload = block.partition(b"\r\n\r\n")
    lines = head.decode("latin-1").split("\r\n")
    headers: dict[str, str | list[str]] = {}
    for name, colon, value in (line.partition(":") for line in lines[1:]):
        if colon:
            old, name, value = headers.get(name.strip()), name.strip(), value.strip()
            headers[name] = value if old is None else [*(old if isinstance(old, list) else [old]), value]
    return lines[0], headers, payload


def plain_text(page: str) -> str:
    text = TAG.sub("", BREAKS.sub("\n", page))
    return LINES.sub("\n", GAP.sub(" ", entities.unescape(text))).strip()


def derivatives(source: bytes) -> list[tuple[str, str, str, str, bytes, str, str]]:
    """For a response record: ``kind, id, refers_to, target, record, block digest, payload digest of the source``."""
    headers, block, _ = read_record(source)
    if headers.get("WARC-Type") != "response":
        raise ValueError("not a response record")
    status, http, payload = http_parts(block)
    payload_digest = headers.get("WARC-Payload-Digest", sha1(payload))  # the field is optional
    if payload_digest != sha1(payload):
        raise ValueError("a payload's digest disagrees")
    page = payload.decode("utf-8", "replace")
    title = TITLE.search(page)
    facts = {"source": headers, "status": status, "http": http, "title": " ".join(entities.unescape(title[1]).split()) if title else None,
             "links": [entities.unescape("".join(m)) for m in LINK.findall(page)], "payload_digest": payload_digest,
             "payload_length": len(payload)}
    out = []
    for kind, media, data in (("metadata", "application/json", json.dumps(facts, ensure_ascii=False, sort_keys=True).encode()),
                              ("conversion", "text/plain; charset=utf-8", plain_text(page).encode())):
        own, digest = record_id(kind.encode(), headers["WARC-Record-ID"].encode(), data), sha1(data)
        out.append((kind, own, headers["WARC-Record-ID"], headers["WARC-Target-URI"], record([
            ("WARC-Type", kind), ("WARC-Record-ID", own), ("WARC-Date", headers["WARC-Date"]), ("WARC-Target-URI", headers["WARC-Target-URI"]),
            ("WARC-Refers-To", headers["WARC-Record-ID"]), ("WARC-Block-Digest", digest), ("Content-Type", media)], data),
            digest, payload_digest))
    return out


def responses(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id, record`` with a response record for every page."""
    rows = pages.select(F.col(f"`{id_col}`").cast("long").alias("page_id"), F.col(f"`{url_col}`").alias("url"), F.col(f"`{html_col}`").alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = [response(u, h) for u, h in zip(b.column(1).to_pylist(), b.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(made, pa.binary())], names=["page_id", "record"])

    return rows.mapInArrow(run, "page_id long, record binary")


def derive(records: DataFrame) -> DataFrame:
    """The linked records of every response in ``records`` (page_id, record); one row of kind ``damaged`` with the
    ``reason`` for a record that is null, cut, changed or no response."""
    names = ["page_id", "kind", "record_id", "refers_to", "target_uri", "record", "block_digest", "source_payload_digest", "reason"]

    def derived(source: bytes | None) -> list[tuple]:
        try:
            if source is None:
                raise ValueError("no record")
            return [(*d, None) for d in derivatives(source)]
        except (ValueError, KeyError) as error:
            return [("damaged", *[None] * 6, f"{type(error).__name__}: {error}")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(page, *d) for page, source in zip(b.column(0).to_pylist(), b.column(1).to_pylist()) for d in derived(source)]
            if rows:
                kinds = [pa.int64(), *[pa.string()] * 4, pa.binary(), *[pa.string()] * 3]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    return records.select("page_id", "record").mapInArrow(
        run, "page_id long, kind string, record_id string, refers_to string, target_uri string, record binary, block_digest string, source_payload_digest string, reason string")


def files(records: DataFrame, prefix: str = "part", most_bytes: int = 64 << 20) -> DataFrame:
    """``name, content``: files of gzip members, one member a record, of up to ``most_bytes`` each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        held, size, number = [], 0, 0
        names = ["name", "content"]

        def bundle() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([f"{prefix}-{TaskContext.get().partitionId():05d}-{number:05d}.warc.gz"]),
                                               pa.array([b"".join(held)], pa.binary())], names=names)

        for b in batches:
            for r in b.column(0).to_pylist():
                member = gzip.compress(r, 6, mtime=0)
                if held and size + len(member) > most_bytes:
                    yield bundle()
                    held, size, number = [], 0, number + 1
                held.append(member)
                size += len(member)
        if held:
            yield bundle()

    return records.select("record").mapInArrow(run, "name string, content binary")


def digest(derived: DataFrame) -> DataFrame:
    """The records' identities, links, digests and sizes."""
    return derived.select("page_id", "kind", "record_id", "refers_to", "target_uri", "block_digest", "source_payload_digest",
                          F.octet_length("record").cast("long").alias("n_bytes"))
