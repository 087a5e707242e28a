"""Corpora as files: tables, translation memories, encoded documents, hashes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T


def write_tsv(df: DataFrame, path: str, most_rows: int = 0) -> None:
    """Gzip tables with headers; nulls are empty cells; tabs and line breaks in cells are spaces."""
    cells = [F.coalesce(F.regexp_replace(F.col(c).cast("string"), "[\t\n\r]", " "), F.lit("")).alias(c) for c in df.columns]
    writer = df.select(*cells).write.option("sep", "\t").option("header", True).option("quote", "").option("emptyValue", "").option("compression", "gzip")
    (writer.option("maxRecordsPerFile", most_rows) if most_rows else writer).csv(path)


def raw_corpus(parts: list[DataFrame]) -> DataFrame:
    """All parts under one header; columns that a part lacks are null."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def by_size(df: DataFrame, columns: list[str], megabytes: int) -> DataFrame:
    """Even chunks of about the size, by the columns' characters: a repartition, with the number of chunks
    from the sum."""
    total = df.agg(F.sum(sum((F.length(c) for c in columns), F.lit(0)))).first()[0] or 0
    return df.repartition(max(1, -(-total // (megabytes * 1_000_000))))


def documents_corpus(pairs: DataFrame) -> DataFrame:
    return pairs.select("src_url", "trg_url", "src_doc", "trg_doc").distinct()


def write_encoded(docs: DataFrame, path: str, columns: list[str]) -> None:
    """A document a line, a base64 cell a column."""
    ordered = docs.select(*[T.encode64(F.col(c)).alias(c) for c in columns])
    ordered.write.option("sep", "\t").option("quote", "").option("compression", "gzip").csv(path)


def _property(name: str, value: Column) -> Column:
    return F.when(value.isNotNull() & (value.cast("string") != ""), F.concat(F.lit(f'   <prop type="{name}">'), T.escape_xml(value.cast("string")), F.lit("</prop>\n"))).otherwise(F.lit(""))


def tmx_units(df: DataFrame, lang1: str, lang2: str, properties: list[str] | None = None) -> DataFrame:
    """tu: a translation unit's XML, with every address of its duplicates in sorted order.
    ``df``: src_text, trg_text, src_urls, trg_urls (arrays) and the properties' columns."""

    def side(lang: str, urls: str, text: str) -> Column:
        places = F.array_join(F.transform(urls, lambda u: F.concat(F.lit('    <prop type="source-document">'), T.escape_xml(u), F.lit("</prop>\n"))), "")
        return F.concat(F.lit(f'   <tuv xml:lang="{lang}">\n'), places, F.lit("    <seg>"), T.escape_xml(T.strip_invalid_xml(F.col(text))), F.lit("</seg>\n   </tuv>\n"))

    props = [_property(p, F.col(p)) for p in properties or []]
    return df.select("*", F.concat(F.lit("  <tu>\n"), *props, side(lang1, "src_urls", "src_text"), side(lang2, "trg_urls", "trg_text"), F.lit("  </tu>")).alias("tu"))


def write_tmx(units: DataFrame, path: str, lang1: str) -> None:
    """One memory a file: header and footer go round each partition's units."""
    head = f'<?xml version="1.0" encoding="UTF-8"?>\n<tmx version="1.4">\n <header adminlang="{lang1}" srclang="{lang1}" o-tmf="TSV" creationtool="lingweave" creationtoolversion="1" datatype="PlainText" segtype="sentence"/>\n <body>'

    def run(batches):
        import pyarrow as pa

        yield pa.RecordBatch.from_arrays([pa.array([head])], ["value"])
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0)], ["value"])
        yield pa.RecordBatch.from_arrays([pa.array([" </body>\n</tmx>"])], ["value"])

    units.select("tu").mapInArrow(run, "value string").write.option("compression", "gzip").text(path)


def write_hashes(texts: DataFrame, path: str) -> None:
    """Text hashes for the next crawl."""
    texts.select("text_hash").distinct().write.mode("append").parquet(path)
