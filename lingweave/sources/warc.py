"""Web archive records as rows, and rows as web archives."""

from __future__ import annotations

import gzip
import io
import json
import lzma
import zlib
from collections.abc import Iterator
from typing import BinaryIO
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "path string, record_no long, record_id string, warc_type string, target_uri string, warc_date string, headers string, block binary"


def parse_records(data: bytes | BinaryIO, most_bytes: int | None = None) -> Iterator[tuple[dict[str, str], bytes | None]]:
    """(headers, block) of each record. Reads plain files, one gzip stream and one gzip member a record, as a
    stream: no more than one block is held. Blocks over ``most_bytes`` are skipped and None. Stops at the first
    byte that is no record, and where a torn archive breaks off."""
    stream = plain_stream(io.BytesIO(data) if isinstance(data, (bytes, bytearray)) else data)
    while True:
        try:
            line = stream.readline()
            while line in (b"\r\n", b"\n"):
                line = stream.readline()
            if not line.startswith(b"WARC/"):
                return
            headers: dict[str, str] = {}
            name = ""
            while (line := stream.readline()) not in (b"\r\n", b"\n", b""):
                if line[:1] in b" \t" and name:
                    headers[name] += " " + line.strip().decode("utf-8", "replace")
                    continue
                name, _, value = line.decode("utf-8", "replace").partition(":")
                name = name.strip()
                headers[name] = value.strip()
            low = {k.lower(): v for k, v in headers.items()}
            length = low.get("content-length", "0")
            size = int(length) if length.isascii() and length.isdigit() else 0
            if most_bytes is not None and size > most_bytes:
                while size > 0 and (part := stream.read(min(size, 1 << 20))):
                    size -= len(part)
                yield headers, None
                continue
            block = stream.read(size)
        except (EOFError, OSError, zlib.error):  # a torn member ends the file
            return
        yield headers, block


def plain_stream(stream: BinaryIO) -> BinaryIO:
    """A stream of what a file holds, decompressed (gzip or xz) by its first bytes."""
    buffered = io.BufferedReader(stream) if not isinstance(stream, io.BufferedReader) else stream
    head = buffered.peek(6)[:6]
    if head[:2] == b"\x1f\x8b":
        return gzip.open(buffered)
    if head == b"\xfd7zXZ\x00":
        return lzma.open(buffered)
    return buffered


def open_stream(path: str) -> BinaryIO:
    """A file of any scheme that Arrow knows, opened for reading in turn."""
    if path.startswith("file:"):
        return open("/" + unquote(path[5:]).lstrip("/"), "rb")
    fs, inner = pa.fs.FileSystem.from_uri(path)
    return fs.open_input_stream(inner, compression=None)


def paths_under(spark: SparkSession, path: str) -> DataFrame:
    """path of every file; none is read. Splits hold as many as their sizes allow."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path")


def header(headers: dict[str, str], name: str) -> str | None:
    return next((v for k, v in headers.items() if k.lower() == name.lower()), None)


def read_warc(spark: SparkSession, path: str, most_bytes: int | None = None) -> DataFrame:
    """Every record of the archives under ``path``; one task streams a file's records in turn. Blocks over
    ``most_bytes`` are skipped before they are held, and null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for source in b.column(0).to_pylist():
                rows, size = [], 0
                with open_stream(source) as stream:
                    for n, (h, block) in enumerate(parse_records(stream, most_bytes)):
                        uri = header(h, "WARC-Target-URI")
                        uri = uri and uri.strip("<>").replace("\t", " ")
                        rows.append((source, n, header(h, "WARC-Record-ID"), header(h, "WARC-Type"), uri, header(h, "WARC-Date"), json.dumps(h), block))
                        size += len(block or b"")
                        if len(rows) >= 200 or size > 16_000_000:
                            yield _batch(rows)
                            rows, size = [], 0
                if rows:
                    yield _batch(rows)

    return paths_under(spark, path).mapInArrow(run, SCHEMA)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.string(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], [c.split()[0] for c in SCHEMA.split(", ")])


def record_bytes(headers: dict[str, str], block: bytes) -> bytes:
    """One record as its own gzip member, without a time stamp so that it is reproducible."""
    head = "WARC/1.0\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers.items() if k.lower() != "content-length")
    return gzip.compress(f"{head}Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n", mtime=0)


def pages_of(records: DataFrame) -> DataFrame:
    """Response and resource records with a known address."""
    return records.filter(F.col("warc_type").isin("response", "resource") & F.col("target_uri").isNotNull() & (F.col("target_uri") != "unknown"))
