"""Language-model scoring from a log-frequency Bloom filter (Talbot and Osborne,
"Randomised language modelling for statistical machine translation", ACL 2007).

Training counts words and bigrams over all training documents. Counts travel as packed
arrays that are merged before the shuffle, and land in shards by the top bits of a
64-bit hash, so a frequent word is one entry and shards are even. Word counts stay
exact. A bigram's count is quantised on a logarithmic scale, and the bigram enters its
shard's Bloom filter once for each level up to its own; at scoring time the filter is
probed level after level until one is missing. A level stands for the mean count of its bigrams, so
quantising keeps the total, and the probabilities after a word sum to one on average over the
words (not for each). The weight of the word model is the one of a few under which all training documents, each
token left out of its own counts, are likeliest; one pass scores under every weight, and the best one's
scores are kept. The filter and the word counts are
broadcast while their size, known by then, stays within a bound. Beyond it the probes go
to the shards instead, by a shuffle, with the same results.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import partitions, spool

WORDS, BIGRAMS = 0, 1
_END, _START = b"\x00end", b"\x00start"
#: Tokens (with one end a text) that are held at a time.
BLOCK = 1 << 18
#: Distinct keys of a task that are merged before they are handed on (12 bytes each).
COMBINE = 250_000
#: Bytes of training text a shard, which bounds what one task merges.
SHARD_BYTES = 32 << 20
#: Bytes of model that are broadcast; a worker keeps one copy, the driver two for a while.
BROADCAST_BYTES = 256 << 20
#: Requests of a shard that are answered at a time.
TOGETHER = 64
#: Training documents on which the weight is chosen: all.
TUNING_DOCS = float("inf")
WEIGHTS = (1.0, 3.0, 10.0, 30.0, 100.0, 300.0, 1000.0, 3000.0)
PART_SCHEMA = "kind int, shard int, entries long, total long, keys binary, counts binary"


@dataclass
class Options:
    probes: int = 7  # bits a level sets
    bits: float = 10.1  # filter bits an entry and level: false positives of 0.8 %
    base: float = 2.0  # of the count scale
    weight: float = 0.0  # of the word model in the smoothed bigram model; 0: chosen, see WEIGHTS
    shards: int = 0  # a power of two; 0: from the bytes of training text


def _mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def bigram_keys(h: np.ndarray, previous: np.ndarray) -> np.ndarray:
    return _mix(previous * np.uint64(0x9E3779B97F4A7C15) + _mix(h))


def held_out(doc_id: int | None, modulus: int = 7, remainder: int = 2) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % modulus == remainder


def hashed(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(word hashes of all texts, each closed by the end token; number of tokens of each)."""
    words: list[bytes] = []
    sizes = np.empty(len(texts), np.int64)
    for k, t in enumerate(texts):
        before = len(words)
        if t:
            words += t.encode("utf-8", "surrogatepass").lower().split()
        words.append(_END)
        sizes[k] = len(words) - before
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)), sizes


def _with_previous(h: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    previous = np.empty_like(h)
    previous[1:] = h[:-1]
    previous[np.cumsum(sizes) - sizes] = xxhash.xxh3_64_intdigest(_START)
    return previous


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list]]:
    """(ids, texts) of about BLOCK tokens or a single longer text."""
    ids, texts, size = [], [], 0
    for b in batches:
        for k, t in zip(b.column(0).to_pylist(), b.column(1)):
            t = t.as_py()
            ids.append(k)
            texts.append(t)
            size += len(t) if t else 1
            if size > 6 * BLOCK:
                yield ids, texts
                ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


def _by_shard(keys: np.ndarray, shards: int) -> list[slice]:
    """The slice of each shard in sorted keys."""
    if shards == 1:
        return [slice(0, len(keys))]
    edges = np.arange(1, shards, dtype=np.uint64) << np.uint64(64 - (shards - 1).bit_length())
    at = [0, *np.searchsorted(keys, edges).tolist(), len(keys)]
    return [slice(a, b) for a, b in zip(at, at[1:])]


def _packed(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], [c.split()[0] for c in PART_SCHEMA.split(", ")])


def _merged(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and the sums of their counts."""
    if len(keys) == 1:
        return keys[0], counts[0]
    k, n = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(k, kind="stable")
    k = k[order]
    first = np.flatnonzero(np.concatenate(([True], k[1:] != k[:-1])))
    return k[first], np.add.reduceat(n[order].astype(np.int64), first)


def train(docs: DataFrame, options: Options | None = None) -> tuple[DataFrame, Options]:
    """Model parts, one row a kind and shard: for words sorted hashes and their counts, for
    bigrams a filter and for each level its bigrams and the sum of their counts. Null and empty texts
    count as one end token each."""
    o = options or Options()
    size = 0 if o.shards else docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    shards = o.shards or 1 << max(4, (max(1, size // SHARD_BYTES) - 1).bit_length())
    o = Options(o.probes, o.bits, o.base, o.weight, shards)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[list, list]] = {WORDS: ([], []), BIGRAMS: ([], [])}

        def handed_on(kind: int) -> pa.RecordBatch:
            unique, n = _merged(*held[kind])
            held[kind] = ([], [])
            rows = [(kind, i, s.stop - s.start, int(n[s].sum()), unique[s].tobytes(), n[s].astype("<u4").tobytes()) for i, s in enumerate(_by_shard(unique, shards)) if s.stop > s.start]
            return _packed(rows)

        for _, texts in _blocks(batches):
            h, sizes = hashed(texts)
            for kind, keys in ((WORDS, h), (BIGRAMS, bigram_keys(h, _with_previous(h, sizes)))):
                for part, x in zip(held[kind], np.unique(keys, return_counts=True)):
                    part.append(x)
                if sum(map(len, held[kind][0])) > COMBINE:
                    k, n = _merged(*held[kind])
                    held[kind] = ([k], [n])
                    if len(k) > COMBINE // 2:
                        yield handed_on(kind)
        for kind in held:
            if held[kind][0]:
                yield handed_on(kind)

    def merge(group: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        kind, shard = group
        keys, counts = _merged([np.frombuffer(k, "<u8") for k in rows["keys"]], [np.frombuffer(c, "<u4").astype(np.int64) for c in rows["counts"]])
        if kind == WORDS:
            payload = keys.tobytes(), counts.astype("<u8").tobytes()
        else:
            levels = levels_of(counts, o.base)
            sums = np.stack([np.bincount(levels), np.bincount(levels, counts).astype(np.int64)])
            payload = bloom(keys, counts, o).tobytes(), sums.astype("<i8").tobytes()
        return pd.DataFrame({"kind": [kind], "shard": [shard], "entries": [len(keys)], "total": [int(counts.sum())], "keys": [payload[0]], "counts": [payload[1]]})

    parts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(count, PART_SCHEMA)
    # as many tasks as shards, whatever the session's setting
    parts = parts.repartition(max(partitions(docs.sparkSession), shards), "kind", "shard")
    return spool(parts.groupBy("kind", "shard").applyInPandas(merge, PART_SCHEMA), "lm-parts"), o


def level_means(parts: DataFrame) -> np.ndarray:
    """The mean count of each level's bigrams, from 0 (none) on. One short row a shard comes to the driver."""
    total = np.zeros((2, 64))
    for r in parts.filter(F.col("kind") == BIGRAMS).select("counts").toLocalIterator():
        sums = np.frombuffer(r["counts"], "<i8").reshape(2, -1)
        total[:, : sums.shape[1]] += sums
    top = int(np.flatnonzero(total[0])[-1]) if total[0].any() else 0
    means = np.divide(total[1], total[0], out=np.zeros(64), where=total[0] > 0)
    return means[: top + 1]


def levels_of(counts: np.ndarray, base: float) -> np.ndarray:
    return 1 + np.floor(np.log(counts) / np.log(base) + 1e-9).astype(np.int64)


def _hashes(keys: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    """Where the probes of a level begin, and their steps."""
    x = _mix(keys + np.uint64((level * 0xD1342543DE82EF95 + 1) % 2**64))
    return x & np.uint64(0xFFFFFFFF), (x >> np.uint64(32)) | np.uint64(1)


def _bit(x: np.ndarray, bits: int | np.ndarray) -> np.ndarray:
    """The low 32 bits of ``x`` brought into the range of ``bits``."""
    return ((x & np.uint64(0xFFFFFFFF)) * np.asarray(bits, np.uint64)) >> np.uint64(32)


def bloom(keys: np.ndarray, counts: np.ndarray, o: Options) -> np.ndarray:
    """The filter of one shard as bytes."""
    levels = levels_of(counts, o.base)
    size = max(64, int(o.bits * levels.sum())) // 8 + 1
    on = np.zeros(size * 8, bool)
    for level in range(1, int(levels.max(initial=0)) + 1):
        keys, levels = keys[levels >= level], levels[levels >= level]
        x, step = _hashes(keys, level)
        for _ in range(o.probes):
            on[_bit(x, size * 8)] = True
            x += step
    return np.packbits(on, bitorder="little")


def bloom_levels(keys: np.ndarray, data: np.ndarray, o: Options, starts: np.ndarray | None = None) -> np.ndarray:
    """The level of each key: how many levels in a row the filter holds. ``starts``: where the filter
    of each shard begins in ``data``, and the end; all shards are probed at once. Without it
    ``data`` is one filter."""
    out = np.zeros(len(keys), np.int64)
    starts = np.array([0, len(data)]) if starts is None else starts
    wide = (len(starts) - 2).bit_length()
    shard = (keys >> np.uint64(64 - wide)).astype(np.int64) if wide else np.zeros(len(keys), np.int64)
    bits, base = (8 * np.diff(starts)).astype(np.uint64)[shard], starts.astype(np.uint64)[shard]
    left, level = np.arange(len(keys)), 1
    hit = bits > 0  # a shard may have no filter
    while len(left):
        left, keys, bits, base = (v[hit] for v in (left, keys, bits, base))
        x, step = _hashes(keys, level)
        for _ in range(o.probes):
            at = _bit(x, bits)
            hit = (data[base + (at >> np.uint64(3))] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
            if not hit.all():
                left, keys, bits, base, x, step = (v[hit] for v in (left, keys, bits, base, x, step))
            x += step
        out[left] = level
        hit = slice(None)
        level += 1
    return out


def level_value(levels: np.ndarray, means: np.ndarray) -> np.ndarray:
    """What the levels stand for; false positives beyond the highest level count as that."""
    return means[np.minimum(levels, len(means) - 1)]


def word_counts(keys: np.ndarray, known: np.ndarray, counts: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.zeros(len(keys), np.int64)
    at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
    return np.where(known[at] == keys, counts[at], 0).astype(np.int64)


def _scores(ids: list, sizes: np.ndarray, c: np.ndarray, level: np.ndarray, place: np.ndarray, m: dict, weights: tuple[float, ...]) -> pa.RecordBatch:
    """Rows of a block from its tokens' word counts, its distinct bigrams' levels and each token's place
    among those. ``left_out``, in the block's first row, is the log10 probability of its training texts under
    each of ``weights``, every token left out of the counts that it made itself."""
    first = np.cumsum(sizes) - sizes
    before = np.empty_like(c)
    before[1:] = c[:-1]
    before[first] = m["docs"]
    word = (c + 1) / (m["tokens"] + 1 * (m["types"] + 1))
    out = [held_out(k) for k in ids]
    # what depends on the bigram alone is worked out once for each
    some = np.empty(len(level), np.int64)
    some[place] = np.arange(len(place))
    after, prior, of_word = c[some], before[some], word[some]
    pair = np.minimum(level_value(level, m["means"]), np.minimum(after, prior))
    learned = np.bincount(place[np.repeat(~np.array(out, bool), sizes)], minlength=len(level))
    own_word = np.maximum(after, 1) / (m["tokens"] + m["types"] or 1)
    own_pair, own_prior = np.maximum(pair - 1, 0), np.maximum(prior - 1, 0)
    scores, left_out = np.empty((len(ids), len(weights))), []
    for i, w in enumerate(weights):
        scores[:, i] = np.add.reduceat(np.log10((pair + w * of_word) / (prior + w))[place], first)
        left_out.append(float(learned @ np.log10((own_pair + w * own_word) / (own_prior + w))))
    lists = pa.list_(pa.float64())
    columns = [
        pa.array(ids, pa.int64()),
        pa.array(out),
        pa.array(sizes),
        pa.array(np.add.reduceat((c > 0).astype(np.int64), first)),
        pa.array(np.full(len(ids), m["tokens"], np.int64)),
        pa.array(np.add.reduceat(np.log10(word), first)),
        pa.ListArray.from_arrays(pa.array(np.arange(len(ids) + 1) * len(weights), pa.int32()), pa.array(scores.ravel())),
        pa.array([left_out] + [None] * (len(ids) - 1), lists),
    ]
    return pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in SCHEMA.split(", ")])


SCHEMA = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, scores array<double>, left_out array<double>"


@dataclass
class Model:
    """What scoring needs: the parts, their totals, and the broadcast where they fit one."""

    parts: DataFrame
    totals: dict
    broadcast: object | None


def prepare(parts: DataFrame, o: Options, train_docs: int, broadcast_bytes: int = BROADCAST_BYTES) -> Model:
    totals = {r["kind"]: r for r in parts.groupBy("kind").agg(F.sum("entries").alias("e"), F.sum("total").alias("t"), F.sum(F.octet_length("keys") + F.octet_length("counts")).alias("b")).collect()}
    words = totals.get(WORDS)
    m = {"tokens": words["t"] if words else 0, "types": words["e"] if words else 0, "docs": train_docs, "means": level_means(parts)}
    small = sum(r["b"] for r in totals.values()) <= broadcast_bytes
    return Model(parts, m, parts.sparkSession.sparkContext.broadcast(_collected(parts, o)) if small else None)


def choose_weight(rows: DataFrame) -> int:
    """Which of WEIGHTS makes all training documents likeliest, from the rows of :func:`score`."""
    best = rows.agg(*[F.sum(F.get("left_out", F.lit(i))).alias(str(i)) for i in range(len(WEIGHTS))]).first()
    return max((x if x is not None else 0.0, i) for i, x in enumerate(best))[1]


def score(docs: DataFrame, prepared: Model, o: Options, weights: tuple[float, ...]) -> DataFrame:
    """Score every document with the model under each of ``weights``."""
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    m, model = prepared.totals, prepared.broadcast
    if model is None:
        return _routed(texts, prepared.parts, o, m, weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, counts, filters, starts = model.value
        known, counts, filters = np.frombuffer(known, "<u8"), np.frombuffer(counts, "<u8"), np.frombuffer(filters, np.uint8)
        for ids, block in _blocks(batches):
            h, sizes = hashed(block)
            unique, place = np.unique(h, return_inverse=True)
            c = word_counts(unique, known, counts)[place]
            unique, place = np.unique(bigram_keys(h, _with_previous(h, sizes)), return_inverse=True)
            yield _scores(ids, sizes, c, bloom_levels(unique, filters, o, starts), place, m, weights)

    return texts.mapInArrow(run, SCHEMA)


def _collected(parts: DataFrame, o: Options) -> tuple[bytes, bytes, bytes, np.ndarray]:
    """The model of checked size at the driver: all word hashes in order, their counts, the filters
    one behind another, and where each begins."""
    keys, counts, filters = {}, {}, {}
    for r in parts.toLocalIterator():
        if r["kind"] == WORDS:
            keys[r["shard"]] = bytes(r["keys"])
            counts[r["shard"]] = bytes(r["counts"])
        else:
            filters[r["shard"]] = bytes(r["keys"])
    starts = np.cumsum([0, *(len(filters.get(i, b"")) for i in range(o.shards))])
    return b"".join(keys[i] for i in sorted(keys)), b"".join(counts[i] for i in sorted(keys)), b"".join(filters[i] for i in sorted(filters)), starts


ROUTE = "kind int, shard int, request long, at binary, keys binary, counts binary"


def _routed(texts: DataFrame, parts: DataFrame, o: Options, m: dict, weights: tuple[float, ...]) -> DataFrame:
    """The same scores for a model of any size: each block's distinct keys travel to their
    shards, and the answers back to the block. No task holds more than one shard and one block."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        for ids, block in _blocks(batches):
            h, sizes = hashed(block)
            rows = [(-1, -1, number, np.array([-1 if k is None else k for k in ids], "<i8").tobytes(), sizes.astype("<i8").tobytes(), np.array([k is None for k in ids], "u1").tobytes())]
            for kind, keys in ((WORDS, h), (BIGRAMS, bigram_keys(h, _with_previous(h, sizes)))):
                keys, place = np.unique(keys, return_inverse=True)
                rows.append((-1, kind, number, b"", place.astype("<i4").tobytes(), b""))
                rows += [(kind, i, number, np.array([s.start], "<i8").tobytes(), keys[s].tobytes(), b"") for i, s in enumerate(_by_shard(keys, o.shards)) if s.stop > s.start]
            number += 1
            yield _routes(rows)

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, part = None, None
        for b in batches:
            for (kind, shard), same in groupby(b.to_pylist(), lambda r: (r["kind"], r["shard"])):
                asked = list(same)
                if asked[0]["request"] is None:
                    here, part = (kind, shard), asked.pop(0)
                while asked:
                    some, asked = asked[:TOGETHER], asked[TOGETHER:]
                    keys = np.frombuffer(b"".join(r["keys"] for r in some), "<u8")
                    if here != (kind, shard):
                        found = np.zeros(len(keys), np.int64)
                    elif kind == WORDS:
                        found = word_counts(keys, np.frombuffer(part["keys"], "<u8"), np.frombuffer(part["counts"], "<u8"))
                    else:
                        found = bloom_levels(keys, np.frombuffer(part["keys"], np.uint8), o)
                    ends = np.cumsum([len(r["keys"]) // 8 for r in some])[:-1]
                    yield _routes([(kind, shard, r["request"], r["at"], x.astype("<i8").tobytes(), b"") for r, x in zip(some, np.split(found, ends))])

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, places, values = None, {}, {}

        def done() -> pa.RecordBatch:
            ids, none = np.frombuffer(head["at"], "<i8").tolist(), np.frombuffer(head["counts"], "u1").tolist()
            c = values[WORDS][places[WORDS]]
            return _scores([None if x else k for k, x in zip(ids, none)], np.frombuffer(head["keys"], "<i8"), c, values[BIGRAMS], places[BIGRAMS], m, weights)

        for b in batches:
            for r in b.to_pylist():
                if r["kind"] == -1 and r["shard"] == -1:
                    if head:
                        yield done()
                    head = r
                elif r["kind"] == -1:
                    places[r["shard"]] = np.frombuffer(r["keys"], "<i4")
                    values[r["shard"]] = np.zeros(int(places[r["shard"]].max()) + 1, np.int64)
                else:
                    at, found = int(np.frombuffer(r["at"], "<i8")[0]), np.frombuffer(r["keys"], "<i8")
                    values[r["kind"]][at : at + len(found)] = found
        if head:
            yield done()

    asked = spool(texts.mapInArrow(ask, ROUTE), "lm-requests")
    n = partitions(texts.sparkSession)
    model = parts.select("kind", "shard", F.lit(None).cast("long").alias("request"), F.lit(None).cast("binary").alias("at"), "keys", "counts")
    met = model.unionByName(asked.filter("kind >= 0")).repartition(n, "kind", "shard").sortWithinPartitions("kind", "shard", F.col("request").asc_nulls_first())
    answers = met.mapInArrow(answer, ROUTE)
    back = answers.unionByName(asked.filter("kind < 0")).repartition(n, "request").sortWithinPartitions("request", "kind", "shard")
    return back.mapInArrow(finish, SCHEMA)


def _routes(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], [c.split()[0] for c in ROUTE.split(", ")])


def lm_scores(docs: DataFrame, options: Options | None = None, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Words are runs without ASCII white space, A-Z lower-cased, then one end token. The
    model learns from the documents that aren't held out; ``score`` is the log10
    probability of the text under the bigram model smoothed with the word model as
    prior. Null and empty texts are one end token. With nothing to learn from, all
    probabilities are uniform. Repeated rows are each learned from and scored; an empty
    table gives no rows; other columns aren't read; texts are read whole.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # as in held_out(), and null ids alike
    out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 7 == 2
    learned = texts.filter(~out)
    parts, o = train(learned, options)
    model = prepare(parts, o, learned.select("doc_id").count(), broadcast_bytes)
    rows = score(texts, model, o, (o.weight,) if o.weight else WEIGHTS)
    rows, at = (rows, 0) if o.weight else (scored := spool(rows, "lm-scores"), choose_weight(scored))
    return rows.select(*rows.columns[:-2], F.get("scores", F.lit(at)).alias("score"))
