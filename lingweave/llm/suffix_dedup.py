"""Repeated passages by sparse suffix arrays.

Only suffixes that start at minimisers are retained: positions that the text itself
selects, the least hash of a window of successive word groups, so that two
copies of a passage retain the same ones. A suffix's key is a hash of its first words;
keys met once drop out before anything else is carried. The other suffixes are sorted by
key and following words; neighbours are compared for the length of their common prefix;
and within the runs that share enough words to the right, what precedes is compared word by
word to the left. Every window of ``words`` words that occurs twice is found, and
overlapping windows make up a passage's whole extent.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import BROADCAST_IDS, partitions, spool, text_key

_B = 0x9E3779B97F4A7C15 | 1
_B_INVERSE = pow(_B, -1, 2**64)
#: Suffixes of one key from which on its windows are grouped one by one, in many tasks.
HOT_KEY = 100_000


@dataclass(frozen=True)
class Shape:
    """Any passage of ``words`` words has, in its first ``window`` word groups of ``group``
    words, a minimiser, after which at least ``prefix`` of its words follow."""

    words: int = 50
    group: int = 8

    @property
    def window(self) -> int:
        return max(1, min(32, self.words - self.group + 1, self.words * 2 // 3))

    @property
    def prefix(self) -> int:
        return self.words - self.window + 1

    @property
    def context(self) -> int:
        """Words kept to the left of a suffix, and to the right of its prefix."""
        return self.window - 1


def _powers(n: int, base: int, kept: dict) -> np.ndarray:
    if len(kept.get(base, ())) < n:
        out = np.full(max(n, 4096), base, np.uint64)
        out[0] = 1
        kept[base] = np.multiply.accumulate(out)
    return kept[base][:n]


def word_hashes(text: str | None) -> np.ndarray:
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def _window_hashes(h: np.ndarray, size: int, kept: dict) -> np.ndarray:
    """A hash of each run of ``size`` values, all runs at once, by a polynomial mod 2**64."""
    total = np.zeros(len(h) + 1, np.uint64)
    np.cumsum(h * _powers(len(h), _B, kept), out=total[1:])
    return _mix((total[size:] - total[:-size]) * _powers(len(h) - size + 1, _B_INVERSE, kept))


def suffixes(h: np.ndarray, shape: Shape, kept: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(positions, keys, lo, hi) of a text's retained suffixes; none in texts shorter than a
    passage. A passage's minimiser is one alone, by its own words; the passages of which a
    suffix is the minimiser begin from ``hi`` to ``lo`` words before it."""
    starts = len(h) - shape.words + 1
    if starts < 1:
        return (np.empty(0, np.int64),) * 4
    groups = _window_hashes(h, shape.group, kept)
    least = np.lib.stride_tricks.sliding_window_view(groups, shape.window)[:starts].argmin(axis=1)
    chosen = np.arange(starts) + least  # never decreases
    begin = np.flatnonzero(np.concatenate(([True], chosen[1:] != chosen[:-1])))
    end = np.concatenate((begin[1:], [starts])) - 1
    at = chosen[begin]
    return at, _window_hashes(h, shape.prefix, kept)[at], at - end, at - begin


def repeated_passages(docs: DataFrame, words: int = 50, group: int = 8, hot_key: int = HOT_KEY) -> DataFrame:
    """doc_id, first, start_word, n_words: maximal unions of repeated windows of ``words`` words.

    A window's earliest place in the order (doc_id, position) has ``first`` true, its
    others false. Words are runs without ASCII white space, A-Z lower-cased. Documents
    without such a window have no row. Null and short texts have none. A null doc_id is
    ordered first; rows that repeat a doc_id with another text are documents of their own, in the order of a
    hash of it, and listed under one id; rows that repeat both count as one
    document; empty tables give no rows; other columns aren't read. Texts
    are read whole, and repeats within a text count.
    """
    return spans_by_row(docs, words, group, hot_key).select("doc_id", "first", "start_word", "n_words")


def spans_by_row(docs: DataFrame, words: int = 50, group: int = 8, hot_key: int = HOT_KEY) -> DataFrame:
    """:func:`repeated_passages` with text_key, which tells rows of one doc_id apart."""
    shape = Shape(words, group)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key(), F.col("text").cast("string").alias("text"))

    def select(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict = {}
        for b in batches:
            found, rows = [], []
            for i, t in enumerate(b.column(2)):
                at, key, lo, hi = suffixes(word_hashes(t.as_py()), shape, kept)
                if len(at):
                    rows.append(np.full(len(at), i))
                    found.append((at.astype(np.int32), key.view(np.int64), lo.astype(np.int16), hi.astype(np.int16)))
            if found:
                who = pa.array(np.concatenate(rows))
                yield pa.RecordBatch.from_arrays([b.column(0).take(who), b.column(1).take(who), *(pa.array(np.concatenate(c)) for c in zip(*found))], ["doc_id", "text_key", "at", "key", "lo", "hi"])

    found = spool(texts.mapInArrow(select, "doc_id long, text_key long, at int, key long, lo short, hi short"), "suffixes")
    repeated = found.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    survivors = found.join(repeated, "key").groupBy("doc_id", "text_key").agg(F.collect_set(F.struct("at", "key", "lo", "hi", (F.col("n") > hot_key).alias("hot"))).alias("s"))
    survivors = survivors.select(F.col("doc_id").alias("id"), F.col("text_key").alias("tk"), "s")
    # texts without a surviving suffix go no further
    rows = texts.join(survivors, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("text_key") == F.col("tk"))).select("doc_id", "text_key", "text", "s.at", "s.key", "s.lo", "s.hi", "s.hot")
    context = rows.mapInArrow(_contexts(shape), "doc_id long, text_key long, at int, key long, lo short, hi short, hot boolean, left binary, right binary")
    context = spool(context, "suffix-contexts")
    order = context.filter("not hot").drop("hot").repartition(partitions(docs.sparkSession), "key").sortWithinPartitions("key", "right")
    spans = order.mapInArrow(_compared(shape), SPANS).unionByName(_hot_spans(context.filter("hot"), shape))
    # unions of overlapping or touching spans
    w = Window.partitionBy("doc_id", "text_key", "first").orderBy("start", "stop")
    reach = F.max("stop").over(w.rowsBetween(Window.unboundedPreceding, -1))
    island = F.sum(F.when(F.col("start") <= F.col("reach"), 0).otherwise(1)).over(w)
    merged = spans.distinct().withColumn("reach", reach).withColumn("island", island)
    merged = merged.groupBy("doc_id", "text_key", "first", "island").agg(F.min("start").alias("a"), F.max("stop").alias("z"))
    return merged.select("doc_id", "text_key", "first", F.col("a").cast("long").alias("start_word"), (F.col("z") - F.col("a")).cast("long").alias("n_words"))


SPANS = "doc_id long, text_key long, first boolean, start int, stop int"


def _contexts(shape: Shape):
    c, prefix = shape.context, shape.prefix
    names = ["doc_id", "text_key", "at", "key", "lo", "hi", "hot", "left", "right"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[list] = [[] for _ in names]
            for i in range(b.num_rows):
                h = (word_hashes(b.column(2)[i].as_py()) >> np.uint64(32)).astype(">u4")
                data, back = h.tobytes(), h[::-1].tobytes()
                for at, key, lo, hi, hot in zip(*(b.column(j)[i].as_py() for j in range(3, 8))):
                    r = at + prefix
                    row = (b.column(0)[i].as_py(), b.column(1)[i].as_py(), at, key, lo, hi, hot, back[4 * (len(h) - at) :][: 4 * c], data[4 * r : 4 * (r + c)])
                    for column, value in zip(out, row):
                        column.append(value)
                if len(out[0]) >= 20_000:
                    yield _rows(out)
                    out = [[] for _ in names]
            if out[0]:
                yield _rows(out)

    def _rows(out: list[list]) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int16(), pa.int16(), pa.bool_(), pa.binary(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names)

    return run


def _matrix(column: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """(values, lengths) of packed 32-bit words, padded with zeros."""
    size = np.fromiter((len(x) // 4 for x in column), np.int64, len(column))
    data = b"".join(x.ljust(4 * width, b"\0") for x in column)
    return np.frombuffer(data, ">u4").reshape(len(column), width), size


def compare(doc: np.ndarray, tk: np.ndarray, at: np.ndarray, key: np.ndarray, lo: np.ndarray, hi: np.ndarray, left: list[bytes], right: list[bytes], shape: Shape) -> np.ndarray:
    """(row, first, start, stop) of the repeated windows around suffixes sorted by (key, right)."""
    n, c = len(doc), shape.context
    empty = np.empty((0, 4), np.int64)
    if n < 2:
        return empty
    after, after_n = _matrix(right, c)
    before, _ = _matrix(left, c)
    # words that neighbours have in common from the suffix on; keys stand for the prefix
    common = np.where((after[1:] != after[:-1]).any(axis=1), (after[1:] != after[:-1]).argmax(axis=1), c) if c else np.zeros(n - 1, np.int64)
    common = np.minimum(common, np.minimum(after_n[1:], after_n[:-1])) + shape.prefix
    common = np.concatenate(([-1], np.where(key[1:] == key[:-1], common, -1)))
    place = np.lexsort((at, tk, doc))  # by (doc_id, text_key, position): the first of equals is the earliest
    left_hash = np.zeros(n, np.uint64)
    seen, first = np.zeros((n, c + 1), bool), np.zeros((n, c + 1), bool)
    for a in range(c + 1):
        if a:
            left_hash = _mix(left_hash * np.uint64(_B) + before[:, a - 1].astype(np.uint64) + np.uint64(1))
        need = shape.words - a
        run = np.cumsum(common < need).astype(np.uint64)
        fits = (lo <= a) & (a <= hi)
        rows = place[fits[place]]
        if len(rows) < 2:
            continue
        value = _mix(run * np.uint64(_B_INVERSE) + left_hash)[rows]
        _, index, inverse, count = np.unique(value, return_index=True, return_inverse=True, return_counts=True)
        twice = count[inverse] > 1
        seen[rows[twice], a] = True
        first[rows[index[count > 1]], a] = True
    out = []
    for flag, mask in ((1, first), (0, seen & ~first)):
        edge = np.diff(np.pad(mask, ((0, 0), (1, 1))).astype(np.int8), axis=1)
        who, a0 = np.nonzero(edge == 1)
        _, a1 = np.nonzero(edge == -1)
        out.append(np.stack([who, np.full(len(who), flag), at[who] - a1 + 1, at[who] - a0 + shape.words], axis=1))
    return np.concatenate(out) if out else empty


def _compared(shape: Shape, most: int = 50_000):
    """Over suffixes sorted by (key, right), all of a key in one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pending: list[pa.RecordBatch] = []
        size = 0
        for b in batches:
            pending.append(b)
            size += b.num_rows
            if size >= most:
                table = pa.Table.from_batches(pending).combine_chunks()
                keys = table["key"].to_numpy()
                cut = int(np.searchsorted(keys, keys[-1]))  # the last key may go on
                if cut:
                    yield from emit(table.slice(0, cut))
                    table = table.slice(cut)
                pending, size = table.to_batches(), table.num_rows if not cut else 0
        if pending:
            yield from emit(pa.Table.from_batches(pending))

    def emit(t: pa.Table) -> Iterator[pa.RecordBatch]:
        tk, at, key, lo, hi = (t[c].to_numpy().astype(np.int64) for c in ("text_key", "at", "key", "lo", "hi"))
        doc = t["doc_id"].fill_null(np.iinfo(np.int64).min).to_numpy()  # null comes first, as in SQL
        spans = compare(doc, tk, at, key, lo, hi, t["left"].to_pylist(), t["right"].to_pylist(), shape)
        if len(spans):
            who = pa.array(spans[:, 0])
            ids, keys = (t[c].combine_chunks().take(who) for c in ("doc_id", "text_key"))
            yield pa.RecordBatch.from_arrays([ids, keys, pa.array(spans[:, 1] == 1), pa.array(spans[:, 2].astype(np.int32)), pa.array(spans[:, 3].astype(np.int32))], ["doc_id", "text_key", "first", "start", "stop"])

    return run


def _hot_spans(context: DataFrame, shape: Shape) -> DataFrame:
    """The same for keys of very many suffixes: a row a window, pre-aggregated before each shuffle."""

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for d, tk, at, key, lo, hi, left, right in zip(*(b.column(i).to_pylist() for i in range(8))):
                for a in range(lo, hi + 1):
                    r = 4 * (shape.words - a - shape.prefix)
                    out.append((d, tk, at - a, xxhash.xxh3_128_digest(key.to_bytes(8, "little", signed=True) + left[: 4 * a] + b"|" + right[:r])))
            if out:
                d, k, s, w = zip(*out)
                yield pa.RecordBatch.from_arrays([pa.array(d, pa.int64()), pa.array(k, pa.int64()), pa.array(s, pa.int32()), pa.array(w, pa.binary())], ["doc_id", "text_key", "start", "w"])

    windows = context.select("doc_id", "text_key", "at", "key", "lo", "hi", "left", "right").mapInArrow(explode, "doc_id long, text_key long, start int, w binary")
    at = F.struct("doc_id", "text_key", "start")
    firsts = windows.groupBy("w").agg(F.count(F.lit(1)).alias("n"), F.min(at).alias("f")).filter("n > 1")
    return windows.join(firsts, "w").select("doc_id", "text_key", (at == F.col("f")).alias("first"), "start", (F.col("start") + shape.words).alias("stop"))


_WORD = re.compile(rb"[^\x20\x09-\x0d]+")


def cut_words(text: str, spans: list[tuple[int, int]]) -> str:
    """``text`` without the words of the (start, length) spans and the white space after each span."""
    data = text.encode("utf-8", "surrogatepass")
    words = [m.start() for m in _WORD.finditer(data)] + [len(data)]
    out, at = [], 0
    for start, n in sorted(spans):
        out.append(data[at : max(at, words[start])])
        at = max(at, words[min(start + n, len(words) - 1)])
    return b"".join([*out, data[at:]]).decode("utf-8", "surrogatepass")


def drop_repeats(docs: DataFrame, words: int = 50, **options) -> DataFrame:
    """``docs`` with every passage but its first occurrence cut out of ``text``; other columns stay."""
    later = spans_by_row(docs, words, **options).filter("not first").groupBy("doc_id", "text_key").agg(F.collect_list(F.struct("start_word", "n_words")).alias("__spans"))
    later = spool(later.select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key"), "__spans"), "repeats")
    few = later.count() * 8 <= BROADCAST_IDS
    same = docs["doc_id"].eqNullSafe(later["__id"]) & (F.xxhash64(F.coalesce(docs["text"].cast("string"), F.lit(""))) == later["__key"])
    both = docs.join(F.broadcast(later) if few else later, same, "left")

    @F.pandas_udf("string")
    def cut(text, spans):
        return text.combine(spans, lambda t, s: t if s is None or t is None else cut_words(t, [(x["start_word"], x["n_words"]) for x in s]))

    return both.withColumn("text", F.when(F.col("__spans").isNull(), F.col("text")).otherwise(cut("text", "__spans"))).drop("__spans", "__id", "__key")
