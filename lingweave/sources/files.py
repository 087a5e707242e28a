"""Other sources: directories, office containers, preverticals, legacy tables, text in any compression."""

from __future__ import annotations

import gzip
import io
import lzma
import re
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from .warc import open_stream, paths_under, plain_stream

_PAYLOADS = (
    (re.compile(r"^content\.xml$"), "odf"),
    (re.compile(r"^word/document\.xml$"), "docx"),
    (re.compile(r"^ppt/slides/slide[^/]*$"), "pptx"),
    (re.compile(r"^xl/sharedStrings\.xml$"), "xlsx"),
    (re.compile(r".*ml$"), "epub"),
)


def payloads(name: str, data: bytes) -> list[bytes]:
    """The text-bearing parts of an ODF, OOXML or EPUB file, in order of name; of any other file the
    file itself; of a broken container none."""
    kind = name.lower().rsplit(".", 1)[-1]
    wanted = {"odt": "odf", "ods": "odf", "odp": "odf", "docx": "docx", "pptx": "pptx", "xlsx": "xlsx", "epub": "epub"}.get(kind)
    if not wanted:
        return [data]
    pattern = next(p for p, k in _PAYLOADS if k == wanted)
    try:
        with zipfile.ZipFile(io.BytesIO(data)) as z:
            return [z.read(n) for n in sorted(z.namelist()) if pattern.match(n)]
    except (zipfile.BadZipFile, KeyError, NotImplementedError, RuntimeError):
        return []


def read_directory(spark: SparkSession, path: str, pdf=None) -> DataFrame:
    """url (the last two parts of the path, ``.converted`` for containers), part, content. ``pdf``
    turns a PDF's bytes into bytes of markup; without it PDFs are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            urls, parts, contents = [], [], []
            for p, data in zip(b.column(0).to_pylist(), b.column(1)):
                url, data = "/".join(p.split("/")[-2:]), data.as_py()
                if url.lower().endswith(".pdf"):
                    found = [pdf(data)] if pdf else []
                else:
                    found = payloads(url, data)
                converted = found and found[0] is not data
                for k, x in enumerate(found):
                    urls.append(url + ".converted" * bool(converted))
                    parts.append(k)
                    contents.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(urls, pa.string()), pa.array(parts, pa.int32()), pa.array(contents, pa.binary())], ["url", "part", "content"])

    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "content")
    return files.mapInArrow(run, "url string, part int, content binary")


_DOC = re.compile(r"<doc\b([^>]*)>(.*?)</doc>", re.S)
_PAR = re.compile(r"<p\b([^>]*)>(.*?)</p>", re.S)
_ATT = re.compile(r'(\w+)="([^"]*)"')


def parse_prevertical(text: str, boilerplate: bool = True) -> Iterator[tuple]:
    """(url, title, crawl_date, lang name, mime, text) of each document; without ``boilerplate`` only
    paragraphs of class good or near-good."""
    for m in _DOC.finditer(text):
        a = dict(_ATT.findall(m[1]))
        lines = []
        for p in _PAR.finditer(m[2]):
            kind = dict(_ATT.findall(p[1])).get("class", "good")
            if boilerplate or kind in ("good", "neargood"):
                lines.append(" ".join(p[2].split()))
        yield a.get("url"), a.get("title"), a.get("crawl_date"), a.get("lang") or a.get("lang_diff"), a.get("file_type"), "\n".join(lines)


def read_prevertical(spark: SparkSession, path: str, boilerplate: bool = True) -> DataFrame:
    """url, title, crawl_date, lang (ISO code), mime, text."""
    schema = "url string, title string, crawl_date string, lang_name string, mime string, text string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for p, data in zip(b.column(0).to_pylist(), b.column(1)):
                rows = list(parse_prevertical(plain(p, data.as_py()).decode("utf-8", "replace"), boilerplate))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*rows)], [c.split()[0] for c in schema.split(", ")])

    files = spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, schema)
    return files.withColumn("lang", T.language_code(F.col("lang_name"))).drop("lang_name")


def plain(name: str, data: bytes) -> bytes:
    """Decompressed by its magic bytes, whatever its name."""
    if data[:2] == b"\x1f\x8b":
        return gzip.decompress(data)
    if data[:6] == b"\xfd7zXZ\x00":
        return lzma.decompress(data)
    return data


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """path, line_no (from 0), line of plain, gzip and xz text, streamed: a task holds 10 000 lines of a file. Numbers are by file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for p in b.column(0).to_pylist():
                part, at = [], 0
                with open_stream(p) as stream:
                    for line in plain_stream(stream):
                        part.append(line.removesuffix(b"\n").decode("utf-8", "replace"))
                        if len(part) >= 10_000:
                            yield _lines(p, at, part)
                            part, at = [], at + len(part)
                if part:
                    yield _lines(p, at, part)

    return paths_under(spark, path).mapInArrow(run, "path string, line_no long, line string")


def _lines(path: str, at: int, part: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([path] * len(part)), pa.array(range(at, at + len(part)), pa.int64()), pa.array(part, pa.string())], ["path", "line_no", "line"])


def read_lett(spark: SparkSession, path: str) -> DataFrame:
    """lang, mime, encoding, url, html, text, domain of the six-column legacy table."""
    names = ["lang", "mime", "encoding", "url", "html64", "text64"]
    raw = spark.read.csv(path, sep="\t", quote="", schema=", ".join(f"{c} string" for c in names))
    return raw.select("lang", "mime", "encoding", "url", T.decode64(F.col("html64")).alias("html"), T.decode64(F.col("text64")).alias("text"), T.registered_domain(F.col("url")).alias("domain"))


def read_tsv(spark: SparkSession, path: str) -> DataFrame:
    """A table with a header; every column text, empty cells the empty string."""
    return spark.read.csv(path, sep="\t", header=True, quote="", escape="", emptyValue="").na.fill("")


def read_parallel(spark: SparkSession, prefixes: list[str], lang1: str, lang2: str) -> DataFrame:
    """src_text, trg_text of line-aligned ``prefix.lang.gz`` files, joined on file and line number."""
    sides = []
    for lang in (lang1, lang2):
        parts = [read_lines(spark, f"{p}.{lang}.gz").select(F.lit(i).alias("prefix"), "line_no", "line") for i, p in enumerate(prefixes)]
        out = parts[0]
        for x in parts[1:]:
            out = out.unionByName(x)
        sides.append(out)
    a, b = sides
    return a.withColumnRenamed("line", "src_text").join(b.withColumnRenamed("line", "trg_text"), ["prefix", "line_no"])


def numbered_sources(inline: list[str], listed: list[str], offset: int = 0) -> list[tuple[int, str]]:
    """The union of both lists in order of name, numbered from ``offset`` + 1. Hosts must look like hosts."""
    out = sorted({*inline, *listed} - {""})
    for x in out:
        if "/" not in x and not re.fullmatch(r"[A-Za-z0-9]([A-Za-z0-9.-]*[A-Za-z0-9])?", x):
            raise ValueError(f"no host: {x}")
    return list(enumerate(out, offset + 1))


def split_every(records: DataFrame, n: int, order: str) -> DataFrame:
    """records with ``chunk``: the number of the file each goes to, ``n`` records a file, within its source file."""
    return records.withColumn("chunk", F.expr(f"{order} div {int(n)}"))
