"""SimHash near-duplicate detection with multi-index hashing.

Fingerprints are cut into segments, each with a table of its values. Small Hamming balls of
segment values are enumerated (a wider ball is met from both sides), table matches are
fetched, and the whole fingerprints' distance is verified.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import once_each, spool, text_key, without
from .components import connected_components

BITS = 64
#: Fingerprints in one bucket of a segment table from which on the bucket is split by a further segment.
HOT_BUCKET = 2000


def fingerprint(text: str | None, n: int = 3, seed: int = 42) -> int:
    """64-bit SimHash of the word n-grams, repeats included, as an unsigned integer."""
    return int(_fingerprints([text], n, seed)[0])


def _fingerprints(texts: list, n: int, seed: int) -> np.ndarray:
    out = np.zeros(len(texts), np.uint64)
    hashes, owners, sizes = [], [], []
    digest, pending = xxhash.xxh64_intdigest, 0
    for k, text in enumerate(texts):
        words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
        if not words:
            continue
        if len(words) <= n:
            own = [digest(b" ".join(words), seed)]
        else:
            data = b" ".join(words)
            ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
            starts = np.concatenate(([0], ends[:-n])).tolist()
            own = [digest(data[a:b], seed) for a, b in zip(starts, (ends[n - 1 :] - 1).tolist())]
        hashes.append(np.array(own, np.uint64))
        owners.append(k)
        sizes.append(len(own))
        pending += len(own)
        if pending > 200_000:
            out[owners] = _majority(hashes, sizes)
            hashes, owners, sizes, pending = [], [], [], 0
    if owners:
        out[owners] = _majority(hashes, sizes)
    return out


def _majority(hashes: list[np.ndarray], sizes: list[int]) -> np.ndarray:
    """Bit by bit, 1 where over half the hashes of a text have it."""
    flat, size = np.concatenate(hashes), np.array(sizes)
    at = np.concatenate(([0], np.cumsum(size)[:-1]))
    bits = np.unpackbits(flat.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    counts = np.empty((len(size), BITS), np.int64)
    for k, (a, m) in enumerate(zip(at.tolist(), sizes)):
        counts[k] = bits[a : a + m].sum(axis=0, dtype=np.int64) if m > 1 else bits[a]
    on = np.packbits(2 * counts > size[:, None], axis=1, bitorder="little")
    return np.ascontiguousarray(on).view("<u8").ravel()


def word_fingerprint(text: str | None, seed: int) -> int:
    """64-bit SimHash of the distinct words, each weighing the logarithm of its count plus one: far
    less is changed by an edited word than with n-grams, and one frequent word can't decide alone."""
    counts = Counter(text.encode("utf-8", "surrogatepass").lower().split()) if text else None
    if not counts:
        return 0
    hashes = np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in counts), np.uint64, len(counts))
    weight = np.log1p(np.fromiter(counts.values(), np.float64, len(counts)))
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return int(np.packbits(2 * (weight @ bits) > weight.sum(), bitorder="little").view("<u8")[0])


def paired_fingerprints(docs: DataFrame, n: int = 3, seed: int = 42) -> DataFrame:
    """doc_id, text_key, fp (of words), v (of n-grams), both signed; texts without words get zero twice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(2).to_pylist()
            fp = np.array([word_fingerprint(t, seed) for t in texts], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fp), pa.array(_fingerprints(texts, n, seed).view(np.int64))], ["doc_id", "text_key", "fp", "v"])

    return docs.select(F.col("doc_id").cast("long"), text_key(), F.col("text").cast("string")).mapInArrow(run, "doc_id long, text_key long, fp long, v long")


def fingerprints(docs: DataFrame, n: int = 3, seed: int = 42) -> DataFrame:
    """doc_id, fp (the 64 bits as a signed long). Text crosses to Python in Arrow
    batches and is never shuffled. Null, empty and blank texts get zero."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = _fingerprints(b.column(1).to_pylist(), n, seed).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp)], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, fp long")


def _segment(fp: Column, low: int, width: int) -> Column:
    return F.shiftrightunsigned(fp, low).bitwiseAND(F.lit((1 << width) - 1).cast("long"))


def _ball(width: int, radius: int) -> list[int]:
    """All masks of at most ``radius`` bits."""
    return [sum(1 << i for i in c) for r in range(radius + 1) for c in combinations(range(width), r)]


def _plan(low: int, width: int, distance: int, parts: int = 2) -> list[tuple[int, int, int]]:
    """(low bit, width, radius) of each segment: with distance = parts * r + a the first
    a + 1 segments are searched at radius r and the rest at r - 1, which misses nothing."""
    r, a = divmod(distance, parts)
    step = width // parts
    plan = [(low + i * step, step if i < parts - 1 else width - step * (parts - 1), r if i <= a else r - 1) for i in range(parts)]
    return [x for x in plan if x[2] >= 0]


def near_links(classes: DataFrame, distance: int = 2, hot_bucket: int = HOT_BUCKET, parts: int = 2, columns: tuple[str, ...] = ("fp", "n", "id"), also: Callable[[Column, Column], Column] | None = None) -> DataFrame:
    """Pairs of distinct fingerprints that differ in at most ``distance`` bits, once each: the
    ``columns`` (fp first) of one and, with a 2 behind their names, of the other, the lesser one first.
    ``classes``: one row per fingerprint, or per fingerprint and the column after it. ``also`` is a
    further condition on both rows.

    Every segment of the fingerprint has a table of its values; the probing side enumerates
    the Hamming ball of the segment's radius. A radius over 1 is shared with the table, whose
    rows then come once for each value of the smaller ball. A pair counts only in the first
    segment whose radius it meets, and there at one value, so none comes twice. Buckets that hold more
    than ``hot_bucket`` fingerprints are keyed further by segments of the remaining
    bits, again with balls, so that they are compared in parts; only fingerprints that are near
    in those too meet.

    The joins are by sorting whatever the tables' sizes: Spark takes exploded rows for as few as the
    classes (66 times fewer at three segments), and would broadcast the whole table through the driver.
    """
    plan = _plan(0, BITS, distance, parts)
    rows = lambda name: classes.select(F.struct(*columns).alias(name))
    table, probes = _keyed(rows("t"), "t", plan, False), _keyed(rows("p"), "p", plan, True)
    hot = spool(table.groupBy("seg", "val").count().filter(F.col("count") > hot_bucket).select("seg", "val"), "simhash-hot")
    p, t = F.col("p.fp"), F.col("t.fp")
    near = (F.col("p") < F.col("t")) & (F.bit_count(p.bitwiseXOR(t)) <= distance) & _meets_first(plan, p, t, F.col("seg")) & _meets_once(plan, p, t, F.col("seg"), F.col("val"))
    near = near & also(F.col("p"), F.col("t")) if also else near
    names = [F.col(f"p.{c}").alias(c) for c in columns] + [F.col(f"t.{c}").alias(f"{c}2") for c in columns]
    if hot.isEmpty():
        return probes.join(table.hint("merge"), ["seg", "val"]).filter(near).select(*names)
    found = probes.join(hot, ["seg", "val"], "left_anti").join(table.hint("merge"), ["seg", "val"]).filter(near).select(*names)
    for i, (lo, w, _) in enumerate(plan):
        other = _rest(lo, w, distance, parts)
        keys = hot.filter(F.col("seg") == i)
        inner = _keyed(table.join(keys, ["seg", "val"], "left_semi"), "t", other, False, "sub", "subval")
        outer = _keyed(probes.join(keys, ["seg", "val"], "left_semi"), "p", other, True, "sub", "subval")
        once = _meets_first(other, p, t, F.col("sub")) & _meets_once(other, p, t, F.col("sub"), F.col("subval"))
        found = found.unionByName(outer.join(inner.hint("merge"), ["seg", "val", "sub", "subval"]).filter(near & once).select(*names))
    return found


def _rest(low: int, width: int, distance: int, parts: int) -> list[tuple[int, int, int]]:
    """A plan over the bits beside a segment: its widest neighbour side first, so segments are runs of bits."""
    sides = [(0, low), (low + width, BITS - low - width)]
    at, size = max(sides, key=lambda x: x[1])
    return _plan(at, size, distance, parts)


def _keyed(rows: DataFrame, name: str, plan: list, probing: bool, seg: str = "seg", val: str = "val") -> DataFrame:
    """``rows`` once for each value of their part of each segment's ball."""

    def keys(i: int, lo: int, w: int, r: int) -> Column:
        masks = F.array(*[F.lit(m).cast("long") for m in _ball(w, _shared(r, probing))])
        return F.transform(masks, lambda m: F.struct(F.lit(i).alias(seg), _segment(F.col(f"{name}.fp"), lo, w).bitwiseXOR(m).alias(val)))

    return rows.withColumn("__k", F.explode(F.concat(*[keys(i, *x) for i, x in enumerate(plan)]))).select(*rows.columns, f"__k.{seg}", f"__k.{val}")


#: Classes in a group of :func:`near_id_pairs`, before their neighbours' are added.
GROUP = 32_768


def near_id_pairs(classes: DataFrame, distance: int, verify: int, hot_bucket: int = HOT_BUCKET, parts: int = 3) -> DataFrame:
    """id, id2 of the pairs of ``classes`` (fp, v, id) whose fp differ in at most ``distance`` bits and v in
    at most ``verify``, once each: the pairs of :func:`near_links` with balls of radius one at most on either side.

    A class goes to the groups of its segments' first bits and of those that differ in one of them (24 copies at
    four million classes, where exploded balls are 67 a side). A group enumerates the balls' values itself, sorts them
    and compares a bucket's rows as vectors, each two once. Buckets of over ``hot_bucket`` are keyed by further segments.
    """
    plan = _plan(0, BITS, distance, parts)
    n = classes.count()
    bits = [min(w, max(0, (max(n, 1) - 1) // GROUP).bit_length()) for _, w, _ in plan]

    def places(i: int, lo: int, w: int, r: int) -> Column:
        first = _segment(F.col("fp"), lo + w - bits[i], bits[i])
        masks = F.array(*[F.lit(m).cast("long") for m in _ball(bits[i], _half(r))])
        return F.transform(masks, lambda m: F.struct(F.lit(i).alias("seg"), first.bitwiseXOR(m).alias("pre")))

    rows = classes.select("fp", "v", "id", F.explode(F.concat(*[places(i, *x) for i, x in enumerate(plan)])).alias("k")).select("k.seg", "k.pre", "fp", "v", "id")

    def run(t: pa.Table) -> pa.Table:
        fp, v, ids = (t[c].to_numpy() for c in ("fp", "v", "id"))
        seg, pre = t["seg"][0].as_py(), t["pre"][0].as_py()
        a, b = _pairs_of_group(fp.view(np.uint64), v.view(np.uint64), plan, seg, pre, bits[seg], distance, verify, hot_bucket, parts)
        return pa.table({"id": ids[a], "id2": ids[b]})

    return rows.groupBy("seg", "pre").applyInArrow(run, "id long, id2 long")


def _half(radius: int) -> int:
    return (radius + 1) // 2


def _values(fp: np.ndarray, lo: int, w: int) -> np.ndarray:
    return (fp >> np.uint64(lo)).astype(np.int64) & ((1 << w) - 1)


def _sorted_buckets(value: np.ndarray, who: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Both by value, and the end of each one's bucket."""
    order = np.argsort(value, kind="stable")
    value, who = value[order], who[order]
    last = np.flatnonzero(np.append(value[1:] != value[:-1], True)) if len(value) else np.zeros(0, np.int64)
    return value, who, np.repeat(last + 1, np.diff(last, prepend=-1))


def _meetings(fp: np.ndarray, v: np.ndarray, who: np.ndarray, end: np.ndarray, active: np.ndarray, distance: int, verify: int) -> tuple[np.ndarray, np.ndarray]:
    """Places (first, second) of the ``active`` ones' alike rows further on in the same bucket."""
    f, out = fp[who], [np.zeros((2, 0), np.int64)]
    lag = 1
    while len(active := active[active + lag < end[active]]):
        hit = active[np.bitwise_count(f[active] ^ f[active + lag]) <= distance]
        hit = hit[np.bitwise_count(v[who[hit]] ^ v[who[hit + lag]]) <= verify]
        out.append(np.stack((hit, hit + lag)))
        lag += 1
    first, second = np.concatenate(out, axis=1)
    return first, second


def _canonical(fp: np.ndarray, a: np.ndarray, b: np.ndarray, value: np.ndarray, plan: list, seg: int) -> np.ndarray:
    """True where no segment before ``seg`` makes the pair meet, and ``value`` is the one, of those at which it meets, that counts."""
    ok = np.ones(len(a), bool)
    for lo, w, r in plan[:seg]:
        ok &= np.bitwise_count(_values(fp[a], lo, w) ^ _values(fp[b], lo, w)) > 2 * _half(r)
    lo, w, _ = plan[seg]
    x, y = _values(fp[a], lo, w), _values(fp[b], lo, w)
    d = x ^ y
    low = d & -d
    # one bit apart: the lesser value; two: the lesser of both between them
    return ok & (value == np.where(d == 0, x, np.where(d == low, np.minimum(x, y), np.minimum(x ^ low, y ^ low))))


def _pairs_of_group(fp: np.ndarray, v: np.ndarray, plan: list, seg: int, pre: int, bits: int, distance: int, verify: int, hot_bucket: int, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs, by row numbers, that meet in the group ``pre`` of the first ``bits`` of segment ``seg`` and count there."""
    lo, w, r = plan[seg]
    val = _values(fp, lo, w)
    off = (val >> (w - bits)) ^ pre
    own, near = np.flatnonzero(off == 0), np.flatnonzero(off)
    flips = [0, *(1 << i for i in range(w - bits))] if _half(r) else [0]
    value, who, end = _sorted_buckets(np.concatenate([val[near] ^ (off[near] << (w - bits)), *[val[own] ^ m for m in flips]]), np.concatenate([near, *[own] * len(flips)]))
    size = end - np.searchsorted(value, value)
    hot = size > hot_bucket
    first, second = _meetings(fp, v, who, end, np.flatnonzero(~hot), distance, verify)
    keep = _canonical(fp, who[first], who[second], value[first], plan, seg)
    found = [(who[first[keep]], who[second[keep]])]
    other = _rest(lo, w, distance, parts)
    for stop in np.unique(end[hot]):
        members = who[stop - size[stop - 1] : stop]
        for i, (lo2, w2, r2) in enumerate(other):
            inner = _values(fp[members], lo2, w2)
            masks = _ball(w2, _half(r2))
            value2, who2, end2 = _sorted_buckets(np.concatenate([inner ^ m for m in masks]), np.concatenate([members] * len(masks)))
            x, y = _meetings(fp, v, who2, end2, np.arange(len(who2)), distance, verify)
            a, b = who2[x], who2[y]
            keep = _canonical(fp, a, b, value2[x], other, i) & _canonical(fp, a, b, np.full(len(a), value[stop - 1]), plan, seg)
            found.append((a[keep], b[keep]))
    return tuple(np.concatenate(x) for x in zip(*found))


def _shared(radius: int, probing: bool) -> int:
    return (radius + 1) // 2 if probing else radius // 2


def _meets_once(plan: list, a: Column, b: Column, seg: Column, val: Column) -> Column:
    """Of the values at which two balls meet, the one where the probing side flips the lowest bits."""
    ok = F.lit(True)
    for i, (lo, w, r) in enumerate(plan):
        if _shared(r, False):
            x, y = val.bitwiseXOR(_segment(a, lo, w)), val.bitwiseXOR(_segment(b, lo, w))
            ok = ok & ((seg != i) | (y == 0) | ((F.bit_count(x) == _shared(r, True)) & (x < y.bitwiseAND(-y))))
    return ok


def _meets_first(plan: list, a: Column, b: Column, seg: Column) -> Column:
    """True where no segment before ``seg`` meets its radius."""
    ok, before = F.lit(True), F.lit(True)
    for i, (lo, w, r) in enumerate(plan):
        ok = ok & ((seg != i) | before)
        before = before & (F.bit_count(_segment(a, lo, w).bitwiseXOR(_segment(b, lo, w))) > r)
    return ok


def _classes(fps: DataFrame, keys: list[str], least: Column) -> DataFrame:
    """One row per fingerprint: ``keys``, n, the ``least`` row of its documents, and a number of its own, id."""
    return spool(fps.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.min(least).alias("least")).withColumn("id", F.monotonically_increasing_id()), "simhash-classes")


def _least_reachable(classes: DataFrame, links: DataFrame) -> DataFrame:
    """id, least: for every class that has links, the least row of its component."""
    roots = connected_components(links.select(F.col("id").alias("u"), F.col("id2").alias("v")))
    linked = classes.select("id", "least").join(roots, F.col("id") == F.col("node")).select("id", "root", "least")
    return linked.select("id", "root").join(linked.groupBy("root").agg(F.min("least").alias("reachable")), "root").select(F.col("id").alias("node"), "reachable")


def simhash_near_dups(docs: DataFrame, n: int = 3, distance: int = 2, seed: int = 42, hot_bucket: int = HOT_BUCKET) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), n_near (other documents
    within ``distance`` bits), component_id (smallest doc_id reachable over such links).

    Documents of one fingerprint form one class before anything is compared, so a
    group of copies of any size is one row in the search. Null, empty and blank
    texts have fingerprint zero and link like any other; an empty table gives no rows;
    rows that repeat a doc_id count each; a null one counts as a document but names no component
    unless all of it are null; other columns are not read.
    """
    fps = spool(fingerprints(docs, n, seed), "simhash-fps")
    classes = _classes(fps, ["fp"], F.col("doc_id"))
    links = spool(near_links(classes, distance, hot_bucket), "simhash-links")
    degree = (
        links.select("id", F.col("n2").alias("m")).unionByName(links.select(F.col("id2").alias("id"), F.col("n").alias("m"))).groupBy("id").agg(F.sum("m").alias("m"))
    )
    marked = (
        classes.join(degree, "id", "left")
        .join(_least_reachable(classes, links), F.col("id") == F.col("node"), "left")
        .select("fp", (F.col("n") - 1 + F.coalesce("m", F.lit(0))).alias("n_near"), F.coalesce("reachable", "least").alias("component_id"))
    )
    return fps.join(marked, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "n_near", "component_id")


def near_copies(docs: DataFrame, distance: int = 8, verify: int = 16, n: int = 3, seed: int = 42, hot_bucket: int = HOT_BUCKET) -> DataFrame:
    """One row per document: doc_id, text_key, component_id, component_key: the last two tell the row
    with the smallest doc_id (of repeated ones the smallest key, null last) reachable over links.

    For removing near copies a wider net than :func:`simhash_near_dups`: documents link whose
    word fingerprints differ in at most ``distance`` bits and whose n-gram fingerprints, which
    travel along, in at most ``verify``. Texts without words link to each other; an empty table gives
    no rows; other columns aren't read.
    """
    fps = spool(paired_fingerprints(docs, n, seed), "simhash-pairs")
    classes = _classes(fps, ["fp", "v"], F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key"))
    if distance <= 8:  # balls of radius one at most
        links = spool(near_id_pairs(classes, distance, verify, hot_bucket), "simhash-links")
    else:
        links = near_links(classes, distance, hot_bucket, 3, ("fp", "v", "id"), lambda p, t: F.bit_count(p["v"].bitwiseXOR(t["v"])) <= verify)
    reachable = _least_reachable(classes, links)
    marked = classes.join(reachable, F.col("id") == F.col("node"), "left").select("fp", "v", F.coalesce("reachable", "least").alias("r"))
    return fps.join(marked, ["fp", "v"]).select("doc_id", "text_key", F.col("r.doc_id").alias("component_id"), F.col("r.text_key").alias("component_key"))


def keep_one_of_each(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with one row, that of the smallest doc_id, of each component of near copies; all columns stay."""
    found = spool(near_copies(docs, **options), "near-copies")
    stays = F.col("doc_id").eqNullSafe(F.col("component_id")) & (F.col("text_key") == F.col("component_key"))
    repeated = found.filter(stays).groupBy("doc_id", "text_key").count().filter("count > 1")
    return once_each(without(docs, found.filter(~stays)), repeated)
