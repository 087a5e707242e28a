"""Packing documents into sequences by the sum-of-squares rule.

Each piece goes into the open bin after which the sum over all residual gaps of the
squared number of open bins with that gap is smallest (Csirik et al., "On the
sum-of-squares algorithm for bin packing", 2006), a new bin among them.
"""

from __future__ import annotations

import gc
import os
import re
import zlib
from collections.abc import Iterator
from unicodedata import is_normalized

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import spool

CAPACITY = 2048
#: Separators that Python splits on but the tokenizer's white space doesn't hold.
_ODD_SPACES = ("\x1c", "\x1d", "\x1e", "\x1f")


_LAST_MARK = re.compile(r"[.,;:!?](?<=[^\W_].)(?=\s|\Z)")


def _runs(text: str) -> list[str]:
    """White-space-free runs whose encodings, in order, are the text's."""
    if is_normalized("NFC", text) and "\u03a3" not in text:  # a capital sigma lower-cases by its place
        low = text.lower()
        if is_normalized("NFC", low):
            return _LAST_MARK.sub(r" \g<0>", low).split()
    return text.split()


class WordIds:
    """A tokenizer's ids of whole texts as little-endian 32-bit bytes.

    For tokenizers that normalise to NFC, lower-case letter by letter, end each word with
    its own mark and never cross white space: runs without white space are encoded apart
    and remembered. Where lower-casing first can't matter, texts are lower-cased and a last
    punctuation mark becomes a run of its own, so there are fewer runs; runs of letters
    are encoded many at a time and told apart by the end marks. Added tokens that stand in a
    text get their own ids, as the tokenizer gives them, and part it; ``special_as_text`` takes
    them for ordinary text. ``most`` bounds what is remembered (twice that, of about 0.2 KB).
    """

    def __init__(self, path: str, most: int = 250_000, end_mark: str = "</w>", special_as_text: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer, self.most, self.runs, self.older = Tokenizer.from_file(path), most, {}, {}
        self.tokenizer.encode_special_tokens = True  # for runs, from which those in a text are taken out first
        added = {} if special_as_text else self.tokenizer.get_added_tokens_decoder()
        if any(t.normalized or t.lstrip or t.rstrip or t.single_word for t in added.values()):
            raise ValueError("added tokens that depend on what stands beside them")
        self.added = {t.content: np.array([k], "<u4").tobytes() for k, t in added.items()}
        longest_first = sorted(self.added, key=len, reverse=True)
        self.parting = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if self.added else None
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[k for token, k in vocabulary.items() if token.endswith(end_mark)]] = True

    def encode(self, texts: list[str | None]) -> list[bytes]:
        parted = {k: self.parting.split(t) for k, t in enumerate(texts) if t and any(a in t for a in self.added)}
        if not parted:
            return self._plain(texts)
        out = self._plain([None if k in parted else t for k, t in enumerate(texts)])
        for k, parts in parted.items():
            pieces = self._plain(parts[::2])
            pieces[1:] = [x for a, b in zip(map(self.added.get, parts[1::2]), pieces[1:]) for x in (a, b)]
            out[k] = b"".join(pieces)
        return out

    def _plain(self, texts: list[str | None]) -> list[bytes]:
        if len(self.runs) > self.most:  # runs that aren't met again go with the older half
            self.older, self.runs = self.runs, {}
        out: list = [None] * len(texts)
        found, unknown, get = [], set(), self.runs.get
        for k, t in enumerate(texts):
            if not t:
                out[k] = b""
            elif any(c in t for c in _ODD_SPACES):
                out[k] = self._apart([t])[0]
            else:
                runs = _runs(t)
                ids = list(map(get, runs))
                if None in ids:
                    gaps = [i for i, x in enumerate(ids) if x is None]
                    names = [runs[i] for i in gaps]
                    unknown.update(names)
                    found.append((k, ids, gaps, names))
                else:
                    out[k] = b"".join(ids)
        self._learn(unknown)
        for k, ids, gaps, names in found:
            for i, r in zip(gaps, names):
                ids[i] = get(r)
            out[k] = b"".join(ids)
        return out

    def _learn(self, unknown: set[str]) -> None:
        runs, older = self.runs, self.older
        if older:
            again = [r for r in unknown if r in older]
            runs.update((r, older[r]) for r in again)
            unknown.difference_update(again)
        words = [r for r in unknown if r.isalpha() and "\u03a3" not in r and "\u0130" not in r]
        for i in range(0, len(words), 200):
            part = words[i : i + 200]
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, "<u4")
            at = np.flatnonzero(self.ends[ids]) + 1
            if len(at) == len(part):
                data, at = ids.tobytes(), (4 * at).tolist()
                runs.update(zip(part, [data[a:b] for a, b in zip([0, *at], at)]))
            else:
                runs.update(zip(part, self._apart(part)))
        unknown.difference_update(words)
        odd = list(unknown)
        runs.update(zip(odd, self._apart(odd)))

    def _apart(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


#: One per Python worker and tokenizer, kept between its tasks.
_WORKER_IDS: dict[str, WordIds] = {}


def _worker_ids(path: str) -> WordIds:
    if path not in _WORKER_IDS:
        _WORKER_IDS[path] = WordIds(path)
    return _WORKER_IDS[path]


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = 0) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32: every document's ids and ``end_id``, cut at ``capacity``."""
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _worker_ids(tokenizer_path)
        gc.disable()  # millions of small byte strings, no cycles
        try:
            for b in batches:
                ids, piece, start, length, crc = [], [], [], [], []
                for k, data in zip(b.column(0).to_pylist(), _encoded(b.column(1), words)):
                    data += end
                    for i, at in enumerate(range(0, len(data), 4 * capacity)):
                        part = data[at : at + 4 * capacity]
                        ids.append(k)
                        piece.append(i)
                        start.append(at // 4)
                        length.append(len(part) // 4)
                        crc.append(zlib.crc32(part))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, crc))], ["doc_id", "piece", "start", "length", "ids_crc32"]
                )
        finally:
            gc.enable()

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def _encoded(column: pa.Array, words: WordIds, rows: int = 256) -> Iterator[bytes]:
    for at in range(0, len(column), rows):
        yield from words.encode(column.slice(at, rows).to_pylist())


def sum_of_squares(sizes: np.ndarray, capacity: int, finish: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each item, placed in the given order. A new bin competes with the open
    ones; of equal sums the smallest gap wins, and an open bin before a new one. With ``finish``
    a new bin no longer competes (only where none has room is one opened) once the open bins have
    as much room as all the items left need, since each bin opened then is a sequence more than needed."""
    n = np.zeros(capacity + 1, np.int64)  # open bins by residual gap
    holding: list[list[int]] = [[] for _ in range(capacity + 1)]
    where, offset, bins = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64), 0
    far, room, left = np.iinfo(np.int64).max, 0, int(sizes.sum())
    for k, s in enumerate(sizes.tolist()):
        if s >= capacity:
            where[k], offset[k], bins, left = bins, 0, bins + 1, left - s
            continue
        gaps = n[s:capacity]
        # moving a bin from gap g to g - s adds 2 (n[g-s] - n[g]) + 2; a filled bin leaves the count
        change = 2 * (n[: capacity - s] - gaps) + 2
        change[0] = 1 - 2 * gaps[0]
        change[gaps == 0] = far
        best = int(change.argmin())
        if change[best] < far and (change[best] <= 2 * n[capacity - s] + 1 or (finish and room >= left)):
            gap = best + s
            b = holding[gap].pop()
            n[gap] -= 1
            room -= s
        else:
            gap, b, bins, room = capacity, bins, bins + 1, room + capacity - s
        where[k], offset[k], left = b, capacity - gap, left - s
        if gap > s:
            n[gap - s] += 1
            holding[gap - s].append(b)
    return where, offset


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = 0, group_rows: int = 1 << 16, finish: bool = True) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Only documents longer than ``capacity`` are cut; full pieces are sequences of their
    own. The others are dealt by a hash of their row's number into groups of about ``group_rows`` and
    each group is packed on its own, largest first, so a task's memory is bounded, whatever
    repeats, and what a group leaves open is a small share of it. ``finish`` is that of
    :func:`sum_of_squares`. Null and empty texts are the end id alone; rows
    that repeat a doc_id, null ones too, are packed each; an empty table gives no rows; other columns
    aren't read.
    """
    numbered = spool(pieces(docs, tokenizer_path, capacity, end_id).withColumn("__row", F.monotonically_increasing_id()), "pieces")
    cut = numbered.drop("__row")
    groups = max(1, round(cut.filter(F.col("length") < capacity).count() / group_rows))
    fields = cut.columns
    full = numbered.filter(F.col("length") >= capacity).select(*fields, (-F.col("__row") - 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "doc_id", "piece"], ascending=[False, True, True], kind="stable", na_position="last")
        where, offset = sum_of_squares(rows["length"].to_numpy(), capacity, finish)
        return rows[fields].assign(sequence_id=where + (int(key[0]) << 32), offset=offset)

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    part = numbered.filter(F.col("length") < capacity).select(*fields, F.expr(f"pmod(xxhash64(__row), {groups})").alias("__group"))
    return part.groupBy("__group").applyInPandas(run, schema).unionByName(full)
