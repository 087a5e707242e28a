"""Sentence splitting, tokenising and sentence alignment."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from .cleaning import is_noise, within

ABBREVIATIONS = {
    "en": "Mr Mrs Ms Dr Prof St vs etc Inc Ltd No Jr Sr Fig".split(),
    "fr": "M Mme Mlle Dr Pr etc art p".split(),
    "de": "Dr Prof Nr z.B bzw usw ca Str".split(),
    "es": "Sr Sra Dr Dra etc pág núm".split(),
}


def split_line(line: Column, lang: str = "en", breaks: list[str] | None = None) -> Column:
    """Native splitter: after . ! ? and before white space with an upper-case letter, not after
    an abbreviation. ``breaks`` replaces the language's (else English) non-breaking words."""
    stop = breaks if breaks is not None else ABBREVIATIONS.get(lang, ABBREVIATIONS["en"])
    guard = "".join(rf"(?<!\b{w.replace('.', '[.]')}[.])" for w in stop)
    return F.split(line, rf"(?<=[.!?]){guard}\s+(?=\p{{Lu}})")


def sentences(
    docs: DataFrame, splitter: Callable[[Column], Column] | None = split_line, prune: int = 0, prune_by: str = "words", drop_noise: bool = True, keys: list[str] | None = None, metadata: list[str] | None = None
) -> DataFrame:
    """keys..., sent_idx, text, paragraph_id and ``metadata``: columns of texts with a line for each line of
    ``text``, of which every sentence gets its paragraph's (null where there are fewer). Each line is a paragraph; sentences are pruned, filtered,
    stripped and emptied in that order. A document without any keeps one row with a null sentence."""
    keys = keys or ["doc_idx"]
    ok = lambda s: within(s, prune, prune_by) & (~is_noise(s) if drop_noise else F.lit(True)) & (F.btrim(s) != "")
    kept = lambda line: F.transform(F.filter(splitter(line) if splitter else F.array(line), ok), lambda s: F.btrim(s))
    metadata = metadata or []
    more = [F.split(m, "\n").alias(f"__{m}") for m in metadata]
    try:  # numbered within the row, so that nothing is shuffled
        by_line = docs.select(*keys, *more, F.transform(F.split("text", "\n"), kept).alias("l"))
    except AnalysisException:  # a splitter in Python takes a column, not a lambda's variable
        lines = docs.select(*keys, *more, F.posexplode_outer(F.split("text", "\n")).alias("p", "line"))
        first = [F.first(f"__{m}").alias(f"__{m}") for m in metadata]
        grouped = lines.select(*keys, *[f"__{m}" for m in metadata], "p", kept(F.col("line")).alias("s")).groupBy(*keys).agg(*first, F.array_sort(F.collect_list(F.struct("p", "s"))).alias("l"))
        by_line = grouped.select(*keys, *[f"__{m}" for m in metadata], F.transform("l", lambda x: x["s"]).alias("l"))
    tag = lambda p, n_p, k, n_s: F.concat(F.lit("p"), (p + 1).cast("string"), F.lit(":"), n_p.cast("string"), F.lit("s"), (k + 1).cast("string"), F.lit("/"), n_s.cast("string"))
    numbered = F.transform("l", lambda s, p: F.transform(s, lambda x, k: F.struct(x.alias("text"), tag(p, F.size("l"), k, F.size(s)).alias("paragraph_id"), *[F.get(f"__{m}", p).alias(m) for m in metadata])))
    rows = by_line.select(*keys, F.posexplode_outer(F.flatten(numbered)).alias("sent_idx", "s"))
    return rows.select(*keys, F.coalesce("sent_idx", F.lit(0)).alias("sent_idx"), "s.text", "s.paragraph_id", *[f"s.{m}" for m in metadata])


def pipe(docs: DataFrame, command: list[str], column: str = "text", line_by_line: bool = True) -> DataFrame:
    """``docs`` with ``column`` passed through a command's standard input and output, a process an Arrow batch.
    With ``line_by_line`` the lines of all documents of a batch go through it and must come back as many;
    else a process gets each document whole. Null texts stay null; a command that fails is an error."""

    def once(data: str) -> str:
        import subprocess

        return subprocess.run(command, input=data.encode("utf-8", "replace"), stdout=subprocess.PIPE, check=True).stdout.decode("utf-8", "replace")

    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        if not line_by_line:
            return texts.map(lambda t: None if t is None else once(t))
        parts = [None if t is None else t.split("\n") for t in texts]
        lines = [x for p in parts if p is not None for x in p]
        back = once("".join(x + "\n" for x in lines)).split("\n")[:-1] if lines else []
        if len(back) != len(lines):
            raise ValueError(f"{command[0]} made {len(back)} lines of {len(lines)}")
        it = iter(back)
        return pd.Series([None if p is None else "\n".join(next(it) for _ in p) for p in parts], dtype=object)

    return docs.withColumn(column, run(column))


def tokenise(lines: DataFrame, column: str = "text") -> DataFrame:
    return lines.withColumn("tokens", T.word_tokens(F.col(column)))


# --- aligners: per document pair, dynamic programming in Arrow groups ---------------------


def modified_bleu(a: list[str], b: list[str], order: int = 2) -> float:
    """Smoothed precision of n-grams up to ``order``, with the brevity penalty, both ways."""

    def one(x: list[str], y: list[str]) -> float:
        total = 0.0
        for n in range(1, order + 1):
            gx, gy = Counter(zip(*[x[i:] for i in range(n)])), Counter(zip(*[y[i:] for i in range(n)]))
            hit = sum((gx & gy).values())
            if n == 1 and not hit:
                return 0.0
            total += math.log((hit + (n > 1)) / (max(1, sum(gx.values())) + (n > 1)))
        return math.exp(total / order) * min(1.0, math.exp(1 - len(y) / len(x)) if x else 0.0)

    if not a or not b:
        return 0.0
    x, y = one(a, b), one(b, a)
    return 0.0 if x + y == 0 else 2 * x * y / (x + y)


def monotone(score: np.ndarray) -> list[tuple[int, int]]:
    """Cells of the best monotone path (1-1 links and gaps) through a score matrix."""
    n, m = score.shape
    best = np.zeros((n + 1, m + 1))
    for i in range(1, n + 1):
        row = np.maximum(best[i - 1, 1:], best[i - 1, :-1] + score[i - 1])
        best[i, 1:] = np.maximum.accumulate(row)
    out, i, j = [], n, m
    while i and j:
        if best[i, j] == best[i - 1, j]:
            i -= 1
        elif best[i, j] == best[i, j - 1]:
            j -= 1
        else:
            i, j = i - 1, j - 1
            out.append((i, j))
    return out[::-1]


def bleu_rungs(translated: list[str], target: list[str], threshold: float = 0.0) -> list[tuple[int, int, float]]:
    a, b = [x.lower().split() for x in translated], [x.lower().split() for x in target]
    score = np.array([[modified_bleu(x, y) for y in b] for x in a]).reshape(len(a), len(b))
    return [(i, j, float(score[i, j])) for i, j in monotone(np.where(score > threshold, score, 0.0)) if score[i, j] > threshold]


_BEADS = {(1, 1): 0.0, (1, 0): 4.6, (0, 1): 4.6, (2, 1): 2.4, (1, 2): 2.4}


def length_rungs(src: list[str], trg: list[str], lexicon: dict[str, set[str]] | None = None, weight: float = 3.0) -> list[tuple[int, int, int, int, float]]:
    """(i, j, di, dj, score) of the beads of a length-and-lexicon alignment (Gale and Church 1993;
    Varga et al. 2005): cost by characters, lowered by shared and dictionary words."""
    n, m = len(src), len(trg)
    sw, tw = [set(T_words(x)) for x in src], [set(T_words(x)) for x in trg]
    sl, tl = [len(x) for x in src], [len(x) for x in trg]
    best, back = {(0, 0): 0.0}, {}

    def cost(i: int, j: int, di: int, dj: int) -> tuple[float, float]:
        a, b = sum(sl[i : i + di]), sum(tl[j : j + dj])
        if not di or not dj:
            return _BEADS[di, dj], -0.3
        delta = abs(b - a) / math.sqrt(6.8 * max(1.0, (a + b) / 2))
        left, right = set().union(*sw[i : i + di]), set().union(*tw[j : j + dj])
        known = {y for x in left for y in (lexicon or {}).get(x, ())} | left
        overlap = len(known & right) / max(1, min(len(left), len(right)))
        return _BEADS[di, dj] + delta - weight * overlap, overlap + 1 / (1 + delta)

    for i in range(n + 1):
        for j in range(m + 1):
            if (i, j) not in best:
                continue
            for di, dj in _BEADS:
                if i + di <= n and j + dj <= m:
                    c, s = cost(i, j, di, dj)
                    c += best[i, j]
                    if c < best.get((i + di, j + dj), math.inf):
                        best[i + di, j + dj], back[i + di, j + dj] = c, (i, j, di, dj, s)
    out, at = [], (n, m)
    while at != (0, 0):
        out.append(back[at])
        at = back[at][:2]
    return out[::-1]


def T_words(text: str) -> list[str]:
    return text.lower().split()


def vector_rungs(src: np.ndarray, trg: np.ndarray, gap: float = 0.3) -> list[tuple[int, int, int, int, float]]:
    """Beads of an alignment by cosine of sentence vectors; two sentences count as their mean."""
    n, m = len(src), len(trg)
    unit = lambda v: v / max(float(np.linalg.norm(v)), 1e-9)
    best, back = {(0, 0): 0.0}, {}
    for i in range(n + 1):
        for j in range(m + 1):
            if (i, j) not in best:
                continue
            for di, dj in _BEADS:
                if i + di <= n and j + dj <= m:
                    s = float(unit(src[i : i + di].mean(axis=0)) @ unit(trg[j : j + dj].mean(axis=0))) if di and dj else 0.0
                    c = best[i, j] + (1 - s if di and dj else gap) * (di + dj) / 2
                    if c < best.get((i + di, j + dj), math.inf):
                        best[i + di, j + dj], back[i + di, j + dj] = c, (i, j, di, dj, s)
    out, at = [], (n, m)
    while at != (0, 0):
        out.append(back[at])
        at = back[at][:2]
    return out[::-1]


SEGMENTS = "src_text string, trg_text string, aligner_score double, src_sentences array<int>, trg_sentences array<int>"


def align(pairs: DataFrame, method: str = "length", threshold: float = 0.0, lexicon: dict[str, set[str]] | None = None, keys: list[str] | None = None, metadata: list[str] | None = None) -> DataFrame:
    """keys..., SEGMENTS and src_x, trg_x for each x of ``metadata``, arrays src_x, trg_x of ``pairs`` with a value a sentence,
    joined with ``+`` where sentences merge: sentence pairs of document pairs. ``pairs``: keys..., src_sents,
    trg_sents (arrays), for 'bleu' translated_sents, for 'vector' src_vecs, trg_vecs. Pairs are independent rows in Arrow
    batches, so a task's memory is one batch."""
    keys = keys or ["src_url", "trg_url"]
    names = [f"{side}_{m}" for m in metadata or [] for side in ("src", "trg")]

    def more(r: dict, i: int, di: int, j: int, dj: int) -> list[str]:
        at = lambda n: slice(i, i + di) if n.startswith("src_") else slice(j, j + dj)
        return ["+".join("" if x is None else str(x) for x in list(r[n])[at(n)]) for n in names]

    def run(it):
        for pdf in it:
            rows = []
            for r in pdf.to_dict("records"):
                s, t = list(r["src_sents"]), list(r["trg_sents"])
                if method == "bleu":
                    beads = [(i, j, 1, 1, x) for i, j, x in bleu_rungs(list(r["translated_sents"]), t, threshold)]
                elif method == "vector":
                    beads = vector_rungs(np.array([*r["src_vecs"]], float), np.array([*r["trg_vecs"]], float))
                else:
                    beads = length_rungs(s, t, lexicon)
                for i, j, di, dj, x in beads:
                    if di and dj and x >= threshold:
                        rows.append((*(r[k] for k in keys), " ".join(s[i : i + di]), " ".join(t[j : j + dj]), x, list(range(i, i + di)), list(range(j, j + dj)), *more(r, i, di, j, dj)))
            yield pd.DataFrame(rows, columns=[*keys, "src_text", "trg_text", "aligner_score", "src_sentences", "trg_sentences", *names])

    kinds = dict(pairs.dtypes)
    return pairs.mapInPandas(run, ", ".join([f"{k} {kinds[k]}" for k in keys] + [SEGMENTS] + [f"{n} string" for n in names]))


def decode_rungs(rungs: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Segments between successive rungs (keys..., rung_no, src_pos, trg_pos, score of the step
    to the next rung) over src_sents, trg_sents: joined text of each side, empty where a side stands still."""
    keys = keys or ["src_url", "trg_url"]
    w = Window.partitionBy(*keys).orderBy("rung_no")
    nxt = rungs.withColumn("src_next", F.lead("src_pos").over(w)).withColumn("trg_next", F.lead("trg_pos").over(w)).filter("src_next is not null")
    piece = lambda side: F.array_join(F.slice(f"{side}_sents", F.col(f"{side}_pos") + 1, F.col(f"{side}_next") - F.col(f"{side}_pos")), " ")
    return nxt.select(*keys, "rung_no", piece("src").alias("src_text"), piece("trg").alias("trg_text"), F.col("score").alias("aligner_score"))


def deferred_hash(sentences_: Column) -> Column:
    """Hash of each sentence, joined with ``+`` where several merge."""
    return F.array_join(F.transform(sentences_, lambda s: F.lower(F.hex(F.xxhash64(s)))), "+")


def aligner_dictionary(dictionary: DataFrame, reverse: bool = False) -> DataFrame:
    a, b = ("src_word", "trg_word") if reverse else ("trg_word", "src_word")
    return dictionary.select(F.concat(a, F.lit(" @ "), b).alias("line"))
