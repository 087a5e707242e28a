"""Metadata and plain-text records derived from web archive responses.

Each response gives a ``metadata`` record (JSON: the source's own headers, the HTTP
message, title, metas and links) and, where its payload is text, a ``conversion`` record
of plain text. Both name the response they come from (WARC-Refers-To, its address and
its date), repeat the source's payload digest and carry a digest of their own block.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import uuid
import zlib
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.warc import header, record_bytes
from .html_extract import _ATTRIBUTE, page_lines

SCHEMA = (
    "source_id string, record_id string, warc_type string, refers_to string, refers_to_uri string, refers_to_date string, "
    "content_type string, source_payload_digest string, block_digest string, content_length long, source_headers string, block string"
)
_TAG = re.compile(r"<(a|link|img|script|iframe|form|meta|title)\b((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>", re.I)
_LINK = {"a": "href", "link": "href", "img": "src", "script": "src", "iframe": "src", "form": "action"}


def sha1_digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(*parts: str) -> str:
    """The same for the same parts, so a task that runs again gives the same records."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, chr(0).join(parts))}>"


def responses_of_pages(pages: DataFrame, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """page_id, record_id, target_uri, warc_date, headers, block: response records of crawled pages."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for k, url, page in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                payload = (page.as_py() or "").encode("utf-8", "surrogatepass")
                block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode() + payload
                name = record_id("response", str(k), url or "")
                heads = {
                    "WARC-Type": "response", "WARC-Record-ID": name, "WARC-Date": date, "WARC-Target-URI": url or "",
                    "Content-Type": "application/http; msgtype=response", "WARC-Payload-Digest": sha1_digest(payload), "WARC-Block-Digest": sha1_digest(block), "Content-Length": str(len(block)),
                }
                rows.append((k, name, url, date, json.dumps(heads), block))
            if rows:
                kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], ["page_id", "record_id", "target_uri", "warc_date", "headers", "block"])

    return pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string")).mapInArrow(
        run, "page_id long, record_id string, target_uri string, warc_date string, headers string, block binary"
    )


def parse_http(block: bytes) -> tuple[dict, list[list[str]], bytes]:
    """(status line, headers, decoded payload) of an HTTP response."""
    head, sep, payload = block.partition(b"\r\n\r\n")
    if not sep:
        head, sep, payload = block.partition(b"\n\n")
    lines = head.decode("latin-1").splitlines() or [""]
    version, _, rest = lines[0].partition(" ")
    status, _, reason = rest.partition(" ")
    if not version.startswith("HTTP/"):
        return {}, [], b""
    headers = [[k.strip(), v.strip()] for k, s, v in (x.partition(":") for x in lines[1:]) if s]
    low = {k.lower(): v.lower() for k, v in headers}
    if "chunked" in low.get("transfer-encoding", ""):
        payload = _dechunked(payload)
    for coding in reversed([x.strip() for x in low.get("content-encoding", "").split(",")]):
        if coding in ("gzip", "x-gzip", "deflate"):
            payload = _inflated(payload)
    return {"Version": version, "Status": status, "Reason": reason}, headers, payload


def _inflated(data: bytes) -> bytes:
    """Gzip members, zlib or raw deflate data, told by their first bytes; what a torn stream gave before its
    end; data that is none of them as it is."""
    for bits in (47, -15):  # gzip or zlib by its header, then raw
        out, rest = [], data
        while rest:
            stream = zlib.decompressobj(bits)
            try:
                for at in range(0, len(rest), 1 << 16):  # in parts, so that what precedes an error is kept
                    out.append(stream.decompress(rest[at : at + (1 << 16)]))
                    if stream.eof:
                        break
                else:
                    return b"".join(out)
            except zlib.error:
                if b"".join(out):
                    return b"".join(out)
                break
            rest = stream.unused_data + rest[at + (1 << 16) :]
            if rest[:2] != b"\x1f\x8b":  # padding
                return b"".join(out)
    return data


_HEX = re.compile(rb"[0-9A-Fa-f]{1,16}")


def _dechunked(data: bytes) -> bytes:
    """The chunks' data; what isn't chunked as it is, and a torn body up to where it breaks off."""
    out, at = [], 0
    while (end := data.find(b"\r\n", at)) >= 0:
        size = data[at:end].split(b";")[0].strip()
        if not _HEX.fullmatch(size):
            return b"".join(out) if out else data
        n = int(size, 16)
        if not n:
            return b"".join(out)
        out.append(data[end + 2 : end + 2 + n])
        at = end + 4 + n
    return b"".join(out) if out else data


def _decoded(payload: bytes, content_type: str) -> str:
    m = re.search(r"charset\s*=\s*[\"']?([\w.:-]+)", content_type, re.I) or re.search(rb"<meta[^>]+charset\s*=\s*[\"']?([\w.:-]+)", payload[:2048], re.I)
    name = (m[1].decode("ascii", "replace") if isinstance(m[1], bytes) else m[1]) if m else "utf-8"
    try:
        return payload.decode(name, "replace")
    except (LookupError, UnicodeError, ValueError):  # unknown names, and codecs that aren't for text
        return payload.decode("utf-8", "replace")


def _headers(raw: str | None) -> dict[str, str]:
    """A record's headers from JSON; none where that is no object."""
    try:
        found = json.loads(raw) if raw else {}
    except (ValueError, RecursionError):
        return {}
    return {k: v if isinstance(v, str) else json.dumps(v) for k, v in found.items()} if isinstance(found, dict) else {}


def html_metadata(html: str) -> dict:
    links, metas, title = [], [], None
    for m in _TAG.finditer(html):
        name = m[1].lower()
        if name == "title":
            if title is None:
                end = html.find("<", m.end())
                title = " ".join(unescape(html[m.end() : end if end >= 0 else len(html)]).split())
            continue
        found = {(a[1] or a[5]).lower(): unescape(a[2] or a[3] or a[4] or "") for a in _ATTRIBUTE.finditer(m[2])}
        if name == "meta":
            metas.append(found)
        elif found.get(_LINK[name]):
            links.append({"path": f"{name.upper()}@/{_LINK[name]}", "url": found[_LINK[name]]})
    return {"Head": {"Title": title, "Metas": metas}, "Links": links}


def derive_one(heads: dict[str, str], uri: str | None, date: str | None, block: bytes) -> list[tuple]:
    """The records derived from one response, as rows of SCHEMA."""
    source = header(heads, "WARC-Record-ID") or record_id("response", uri or "", sha1_digest(block))
    status, http, payload = parse_http(block)
    content_type = next((v for k, v in http if k.lower() == "content-type"), "")
    kind = content_type.split(";")[0].strip().lower()
    digest = header(heads, "WARC-Payload-Digest") or sha1_digest(payload)
    markup = kind in ("text/html", "application/xhtml+xml", "") and bool(status)
    text = _decoded(payload, content_type) if markup or kind.startswith("text/") else None
    message: dict = {"Response-Message": status, "Headers": http, "Payload-Length": len(payload), "Payload-Digest": digest}
    if markup and text is not None:
        message["HTML-Metadata"] = html_metadata(text)
    if not status:
        message["Error"] = "no HTTP response"
    envelope = {"Envelope": {"Format": "WARC", "WARC-Header-Metadata": heads, "Actual-Content-Length": len(block), "Block-Digest": sha1_digest(block), "Payload-Metadata": {"HTTP-Response-Metadata": message}}}
    out = [("metadata", "application/json", json.dumps(envelope, ensure_ascii=False, sort_keys=True))]
    if text is not None:
        out.append(("conversion", "text/plain", page_lines(text) if markup else text))
    rows = []
    for warc_type, mime, body in out:
        data = body.encode("utf-8", "replace")
        rows.append((source, record_id(warc_type, source), warc_type, source, uri, date, mime, digest, sha1_digest(data), len(data), json.dumps(heads), body))
    return rows


def derive(responses: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """One or two rows per response: SCHEMA, after the columns of ``keep`` (long).

    ``responses``: target_uri, warc_date, headers (JSON), block. A block that is no HTTP
    response, a null one included, gives a metadata record that says so and no conversion;
    a payload that is no text gives metadata alone; empty text gives an empty conversion.
    Null headers, and such as are no JSON object, count as none, and the source then gets an identifier
    from address and digest. Chunked, gzip, zlib and raw deflate payloads are decoded, torn ones as far as they go;
    unknown character sets are read as UTF-8. Repeated rows give repeated records of the same identifiers; an empty table
    gives no rows; other columns aren't read. Long payloads are converted whole.
    """
    keep = keep or []
    names = keep + [c.split()[0] for c in SCHEMA.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64()] * len(keep) + [pa.int64() if c.endswith("long") else pa.string() for c in SCHEMA.split(", ")]
        for b in batches:
            *kept, uris, dates, heads, blocks = (b.column(i) for i in range(b.num_columns))
            rows, size = [], 0
            for i in range(b.num_rows):
                raw = heads[i].as_py()
                new = derive_one(_headers(raw), uris[i].as_py(), dates[i].as_py(), blocks[i].as_py() or b"")
                rows += [(*(k[i].as_py() for k in kept), *r) for r in new]
                size += sum(len(r[-1]) for r in new)
                if size > 16_000_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)
                    rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)

    columns = [F.col(k).cast("long") for k in keep] + [F.col(c).cast("string") for c in ("target_uri", "warc_date", "headers")] + [F.col("block").cast("binary")]
    return responses.select(*columns).mapInArrow(run, ", ".join([f"{k} long" for k in keep] + [SCHEMA]))


def archive_bytes(derived: DataFrame) -> DataFrame:
    """record_id, record: each derived record as a gzip member; concatenated they are a WARC file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for r in b.to_pylist():
                heads = {
                    "WARC-Type": r["warc_type"], "WARC-Record-ID": r["record_id"], "WARC-Date": r["refers_to_date"] or "", "WARC-Target-URI": r["refers_to_uri"] or "",
                    "WARC-Refers-To": r["refers_to"], "WARC-Refers-To-Target-URI": r["refers_to_uri"] or "", "WARC-Refers-To-Date": r["refers_to_date"] or "",
                    "WARC-Source-Payload-Digest": r["source_payload_digest"], "WARC-Block-Digest": r["block_digest"], "Content-Type": r["content_type"],
                }
                out.append(record_bytes(heads, r["block"].encode("utf-8", "replace")))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.binary())], ["record_id", "record"])

    columns = ["record_id", "warc_type", "refers_to", "refers_to_uri", "refers_to_date", "source_payload_digest", "block_digest", "content_type", "block"]
    return derived.select(*columns).mapInArrow(run, "record_id string, record binary")
