"""Removal of repeated runs of lines by winnowing (DataFrame operations only).

Of every ``min_run`` successive line hashes the least is a fingerprint, so any run of
that many lines that occurs twice has a fingerprint in common (Schleimer, Wilkerson and
Aiken, "Winnowing", SIGMOD 2003). Fingerprints met once drop out. The positions of the others
are joined by the windows of ``min_run`` lines around them (128-bit keys), each with the
window's first position in the order (doc_id, line), and the match goes on to the left and to the right as
long as windows are met. (Joining all positions of a fingerprint with each other would square those of a
frequent line; joining them with its first position alone would miss runs that begin to be
equal at the second.) A single line of ``long_line`` words or more is a run of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import spool, text_key

BLANK = " \t\r"
#: Removed lines (12 bytes each) that are broadcast to the texts; beyond that both sides are shuffled.
BROADCAST_LINES = 2_000_000


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text.cast("string"), F.lit("")), "\n")


def _blank(line: Column) -> Column:
    return F.btrim(line, F.lit(BLANK)) == ""


def _keys(text: Column) -> Column:
    """16-byte keys of the lines that aren't blank."""
    return F.transform(F.filter(_lines(text), lambda x: ~_blank(x)), lambda x: F.unhex(F.md5(F.btrim(x, F.lit(BLANK)))))


def fingerprints(docs: DataFrame, min_run: int) -> DataFrame:
    """Selected lines: h, doc_id, text_key, at (number among the lines that aren't blank), and ``around``,
    the 16-byte keys of the up to ``min_run`` - 1 lines before it, itself and as many after it."""
    keys = docs.select("doc_id", text_key(), _keys(F.col("text")).alias("k"))
    # the first half of a key orders the lines of a window; ties fall to the last line
    order = F.transform("k", lambda x, i: F.struct(F.substring(x, 1, 8).alias("h"), (-i).alias("i")))
    windows = F.when(F.size("k") >= min_run, F.sequence(F.lit(1), F.size("k") - (min_run - 1)))
    rows = keys.withColumn("o", order).select(
        "doc_id", "text_key", "k", F.explode(F.array_distinct(F.transform(windows, lambda i: F.array_min(F.slice(F.col("o"), i, min_run))))).alias("f")
    )
    at = -F.col("f.i")
    first = F.greatest(at - (min_run - 1), F.lit(0))
    return rows.select("doc_id", "text_key", F.col("f.h").alias("h"), at.alias("at"), first.alias("first"), F.slice("k", first + 1, at + min_run - first).alias("around"))


def _long_lines(docs: DataFrame, long_line: int) -> DataFrame:
    """doc_id, text_key, start, lines (1), w of every line of ``long_line`` words or more."""
    trimmed = F.transform(F.filter(_lines(F.col("text")), lambda x: ~_blank(x)), lambda x: F.btrim(x, F.lit(BLANK)))
    rows = docs.select("doc_id", text_key(), F.posexplode(trimmed).alias("start", "line")).filter(F.size(F.split("line", f"[{BLANK}]+")) >= long_line)
    return rows.select("doc_id", "text_key", "start", F.lit(1).alias("lines"), F.unhex(F.md5("line")).alias("w"))


def repeated_lines(docs: DataFrame, min_run: int = 2, long_line: int = 10) -> DataFrame:
    """doc_id, text_key, line (number among the lines that aren't blank): lines of windows that occurred before."""
    found = fingerprints(docs.select("doc_id", "text"), min_run)
    repeated = found.groupBy("h").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("h")
    hits = found.join(repeated, "h")
    starts = F.sequence(F.lit(0), F.size("around") - min_run)
    windows = hits.select("doc_id", "text_key", "first", "around", F.explode(starts).alias("s")).select(
        "doc_id",
        "text_key",
        (F.col("first") + F.col("s")).alias("start"),
        F.lit(min_run).alias("lines"),
        F.unhex(F.md5(F.array_join(F.transform(F.slice("around", F.col("s") + 1, min_run), F.hex), ""))).alias("w"),
    )
    windows = windows.distinct()
    if min_run > 1:
        windows = windows.unionByName(_long_lines(docs, long_line))
    windows = spool(windows, "line-windows")
    firsts = windows.groupBy("w").agg(F.min(F.struct("doc_id", "text_key", "start")).alias("at"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("w", "at")
    later = windows.join(firsts, "w").filter(F.struct("doc_id", "text_key", "start") != F.col("at"))
    return later.select("doc_id", "text_key", F.explode(F.sequence(F.col("start"), F.col("start") + F.col("lines") - 1)).alias("line")).distinct()


def line_dedup(docs: DataFrame, min_run: int = 2, long_line: int = 10) -> DataFrame:
    """One row per document: doc_id, n_lines, n_removed, text.

    Runs of at least ``min_run`` lines, and lines of at least ``long_line`` words, that occurred before,
    in an earlier document or further up, are deleted; their first occurrence stays. Lines are compared without
    the blanks at their ends; blank lines are stepped over, never counted and always
    kept. A null text becomes the empty one. Documents are in the order of doc_id, null first, then of a hash of
    the text, so rows that repeat an id with other texts are documents of their own; those that repeat
    both count as one document and lose the same lines. An empty table gives no
    rows; other columns aren't read.
    """
    gone = spool(repeated_lines(docs, min_run, long_line).groupBy("doc_id", "text_key").agg(F.collect_set("line").alias("gone")), "repeated-lines")
    few = (gone.agg(F.sum(F.size("gone") + 4)).first()[0] or 0) <= BROADCAST_LINES
    gone = gone.select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key"), "gone")
    texts = docs.select("doc_id", text_key(), _lines(F.col("text")).alias("l"))
    both = texts.join(F.broadcast(gone) if few else gone, texts["doc_id"].eqNullSafe(gone["__id"]) & (texts["text_key"] == gone["__key"]), "left")
    n_lines = F.size(F.filter("l", lambda x: ~_blank(x)))
    text = F.when(F.col("gone").isNull(), F.array_join("l", "\n")).otherwise(F.array_join(_without_lines(F.col("l"), F.col("gone")), "\n"))
    return both.select("doc_id", n_lines.cast("long").alias("n_lines"), F.when(F.col("gone").isNull(), 0).otherwise(F.size("gone")).cast("long").alias("n_removed"), text.alias("text"))


def _without_lines(lines: Column, gone: Column) -> Column:
    """The lines but those whose number among the lines that aren't blank is in ``gone``."""
    start = F.struct(F.lit(0).alias("n"), F.array().cast("array<string>").alias("kept"))

    def step(a: Column, x: Column) -> Column:
        blank = _blank(x)
        return F.struct(
            (a["n"] + F.when(blank, 0).otherwise(1)).alias("n"),
            F.when(~blank & F.array_contains(gone, a["n"]), a["kept"]).otherwise(F.array_append(a["kept"], x)).alias("kept"),
        )

    return F.aggregate(lines, start, step, lambda a: a["kept"])
