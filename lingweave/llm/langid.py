"""Language identification by a bidirectional gated recurrent network over bytes.

The network is written and trained in numpy, by backpropagation through time. It
gives every byte position a distribution over the languages and, beside them, what is no
language it knows (trained on made-up windows); a document's is the mean over its positions. Whole texts are read, as windows of bytes that run through
the network side by side, so memory depends on the window count of one block only.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_key, without

UNDETERMINED = "und"
#: Bytes of letters; those beyond ASCII count as such.
_LETTERS = np.array([chr(k).isalpha() or k >= 128 for k in range(256)])
_WORDLIKE = re.compile(r"[^\W\d_]")


def has_letter(text: str) -> bool:
    """Letters alone: number forms such as halves and Roman numeral signs are none."""
    return any(m[0].isalpha() for m in _WORDLIKE.finditer(text))


@dataclass
class Gru:
    """Parameters by direction (0 forward, 1 backward): e (3H, 256) input, u (3H, H)
    recurrent, w (C, H) output; b (C, 1). Gate order: reset, update, candidate."""

    langs: list[str]
    e: list[np.ndarray]
    u: list[np.ndarray]
    w: list[np.ndarray]
    b: np.ndarray
    window: int = 128

    @property
    def known(self) -> list[int]:
        """Places of the languages, without ``und``."""
        return [k for k, x in enumerate(self.langs) if x != UNDETERMINED] or list(range(len(self.langs)))

    def position_probabilities(self, x: np.ndarray) -> np.ndarray:
        """(positions, languages, windows) for byte windows (positions, windows)."""
        steps, n = x.shape
        hidden = self.u[0].shape[1]
        out = np.empty((steps, len(self.langs), n), np.float32)
        out[:] = self.b
        g, m, part = np.empty((3 * hidden, n), np.float32), np.empty((3 * hidden, n), np.float32), np.empty(out.shape[1:], np.float32)
        r, z, c, gates = m[:hidden], m[hidden : 2 * hidden], m[2 * hidden :], m[: 2 * hidden]
        half = np.ones((3 * hidden, 1), np.float32)
        half[: 2 * hidden] = 0.5  # the logistic function as a scaled tanh
        for d in (0, 1):
            table = np.ascontiguousarray(self.e[d] * half)
            u = np.ascontiguousarray(self.u[d] * 0.5)
            h = np.zeros((hidden, n), np.float32)
            for t in range(steps) if d == 0 else range(steps - 1, -1, -1):
                np.take(table, x[t], axis=1, out=g, mode="clip")
                np.dot(u, h, out=m)
                gates += g[: 2 * hidden]
                np.tanh(gates, out=gates)
                r += 1
                c *= r
                c += g[2 * hidden :]
                np.tanh(c, out=c)
                z *= 0.5
                z += 0.5
                h -= c
                h *= z
                h += c
                np.dot(self.w[d], h, out=part)
                out[t] += part
        np.exp(out, out=out)  # the weights are small: no overflow
        out /= out.sum(axis=1, keepdims=True)
        return out

    def document_probabilities(self, texts: list[bytes], block: int = 1024) -> np.ndarray:
        """(texts, languages): the mean over all positions of each text."""
        return self.pooled(texts, block)[0]

    def pooled(self, texts: list[bytes], block: int = 1024) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(texts, languages) means over all positions, the mean share of languages other than ``und``
        over the positions of letters, and the number of these (bytes; 0 if ``und`` wasn't trained). A text's last window reaches back over the one before, but each
        position counts once."""
        size = self.window
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        padded = [t if len(t) >= size else t + bytes(size - len(t)) for t in texts]
        room = np.maximum(lengths, size)
        base = np.concatenate(([0], np.cumsum(room)[:-1])).astype(np.int64)
        buffer = np.frombuffer(b"".join(padded), np.uint8)
        count = -(-room // size)
        owner = np.repeat(np.arange(len(texts)), count)
        k = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
        wanted = k * size
        start = np.minimum(wanted, room[owner] - size)
        skip, end = wanted - start, np.minimum(lengths[owner] - start, size)
        pooled, known, letters = np.zeros((len(texts), len(self.langs))), np.zeros(len(texts)), np.zeros(len(texts))
        none = self.langs.index(UNDETERMINED) if UNDETERMINED in self.langs else None
        at = np.arange(size)[:, None]
        for i in range(0, len(owner), block):
            s = slice(i, i + block)
            x = buffer[base[owner[s]] + start[s] + at]
            p = self.position_probabilities(x)
            if skip[s].any() or (end[s] < size).any():
                p *= ((at >= skip[s]) & (at < end[s]))[:, None, :]
            np.add.at(pooled, owner[s], p.sum(axis=0).T)
            if none is not None:
                letter = _LETTERS[x] & (at >= skip[s]) & (at < end[s])
                np.add.at(letters, owner[s], letter.sum(axis=0))
                np.add.at(known, owner[s], letter.sum(axis=0) - np.einsum("tn,tn->n", p[:, none], letter.astype(np.float32)))
        return pooled / np.maximum(lengths, 1)[:, None], known / np.maximum(letters, 1) if none is not None else np.ones(len(texts)), letters

    def labels(self, text: str) -> list[str]:
        """The language of every byte position of the lower-cased text."""
        data, size = np.frombuffer(text.lower().encode("utf-8", "surrogatepass"), np.uint8), self.window
        if not len(data):
            return []
        x = np.zeros((size, -(-len(data) // size)), np.uint8)
        x.T.flat[: len(data)] = data
        best = self.position_probabilities(x).argmax(axis=1)
        return [self.langs[k] for k in best.T.ravel()[: len(data)]]


def train(samples: list[tuple[str, str]], hidden: int = 8, window: int = 128, steps: int = 260, batch: int = 256, span: int = 64, rate: float = 0.03, seed: int = 7, reject: bool = True) -> Gru:
    """Fit to (text, language) pairs. Each step draws ``batch`` windows of ``span`` bytes,
    languages in equal shares, a sixth of them cut short and padded as short texts are. With
    ``reject`` the windows of one more class, ``und``, are made up: see :func:`_no_language`."""
    rng = np.random.default_rng(seed)
    langs = sorted({y for _, y in samples})
    text = {y: np.frombuffer(b"\n".join(x.lower().encode("utf-8", "surrogatepass") for x, z in samples if z == y) + bytes(span), np.uint8) for y in langs}
    known = list(langs)
    langs += [UNDETERMINED] * reject
    f32 = lambda *shape, by=0.3: (rng.standard_normal(shape) * by).astype(np.float32)
    n_langs = len(langs)
    p = {"b": np.zeros((n_langs, 1), np.float32)}
    for d in (0, 1):
        p |= {f"e{d}": f32(3 * hidden, 256), f"u{d}": f32(3 * hidden, hidden), f"w{d}": f32(n_langs, hidden)}
    first, second = {k: np.zeros_like(v) for k, v in p.items()}, {k: np.zeros_like(v) for k, v in p.items()}
    for step in range(1, steps + 1):
        y = rng.integers(0, n_langs, batch)
        x = np.empty((span, batch), np.uint8)
        mask = np.ones((span, batch), np.float32)
        for k in range(batch):
            t = text[langs[y[k]] if y[k] < len(known) else known[rng.integers(0, len(known))]]
            a = rng.integers(0, max(1, len(t) - span))
            x[:, k] = t[a : a + span] if y[k] < len(known) else _no_language(t[a : a + span], rng)
            if k % 6 == 0:
                cut = rng.integers(4, span)
                x[cut:, k], mask[cut:, k] = 0, 0
        grad = _gradients(p, x, y, mask, hidden)
        lr = rate * min(1, step / 20) * (0.05 ** (step / steps))
        norm = np.sqrt(sum(float((g * g).sum()) for g in grad.values()))
        for k, g in grad.items():
            g = g * min(1, 1 / max(norm, 1e-9))
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.99 * second[k] + 0.01 * g * g
            p[k] -= (lr * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return Gru(langs, [p["e0"], p["e1"]], [p["u0"], p["u1"]], [p["w0"], p["w1"]], p["b"], window)


def _no_language(window: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Bytes as long as ``window`` in no known language: its letters in random order, random letters
    and digits, or words in the bytes of some other script."""
    n, kind = len(window), rng.integers(0, 3)
    if kind == 0:
        return rng.permutation(window)
    if kind == 1:
        signs = np.frombuffer(b"abcdefghijklmnopqrstuvwxyz0123456789+/=-_", np.uint8)
        out = rng.choice(signs, n)
        out[rng.random(n) < rng.choice([0.0, 0.15])] = 32
        return out
    lead = rng.integers(0xC4, 0xF0)
    width = 2 if lead < 0xE0 else 3
    out = rng.integers(0x80, 0xC0, n + width)
    out[::width] = lead + rng.integers(0, 2, len(out[::width]))
    gaps = rng.random(len(out[::width])) < 0.12
    out[::width][gaps] = 32
    at = rng.integers(0, width)
    return out[at : at + n].astype(np.uint8)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def _gradients(p: dict, x: np.ndarray, y: np.ndarray, mask: np.ndarray, hidden: int) -> dict:
    """Of the mean cross-entropy over all positions, backwards through time."""
    steps, n = x.shape
    order = {0: range(steps), 1: range(steps - 1, -1, -1)}
    kept: dict[int, list] = {0: [None] * steps, 1: [None] * steps}
    logits = np.zeros((steps, len(p["b"]), n), np.float32) + p["b"]
    for d in (0, 1):
        h, e, u = np.zeros((hidden, n), np.float32), p[f"e{d}"], p[f"u{d}"]
        for t in order[d]:
            g, a = e[:, x[t]], u @ h
            rz = _sigmoid(g[: 2 * hidden] + a[: 2 * hidden])
            r, z = rz[:hidden], rz[hidden:]
            c = np.tanh(g[2 * hidden :] + r * a[2 * hidden :])
            kept[d][t] = (h, r, z, c, a[2 * hidden :])
            h = c + z * (h - c)
            kept[d][t] += (h,)
            logits[t] += p[f"w{d}"] @ h
    prob = np.exp(logits - logits.max(axis=1, keepdims=True))
    prob /= prob.sum(axis=1, keepdims=True)
    prob[:, y, np.arange(n)] -= 1
    prob *= mask[:, None, :] / mask.sum()
    grad = {"b": prob.sum(axis=(0, 2))[:, None]}
    flat = x.ravel()
    for d in (0, 1):
        u, w = p[f"u{d}"], p[f"w{d}"]
        du, dw, dh = np.zeros_like(u), np.zeros_like(w), np.zeros((hidden, n), np.float32)
        inputs = np.empty((steps, 3 * hidden, n), np.float32)
        for t in reversed(order[d]):
            before, r, z, c, ac, h = kept[d][t]
            dw += prob[t] @ h.T
            dh += w.T @ prob[t]
            dc = dh * (1 - z) * (1 - c * c)
            da = np.concatenate((dc * ac * r * (1 - r), dh * (before - c) * z * (1 - z), dc * r))
            inputs[t, : 2 * hidden], inputs[t, 2 * hidden :] = da[: 2 * hidden], dc
            du += da @ before.T
            dh = dh * z + u.T @ da
        rows = inputs.transpose(1, 0, 2).reshape(3 * hidden, -1)
        grad |= {f"u{d}": du, f"w{d}": dw, f"e{d}": np.stack([np.bincount(flat, weights=v, minlength=256) for v in rows])}
    return grad


def labelled_sample(docs: DataFrame, per_language: int, modulus: int = 1 << 20, most_chars: int = 1 << 15) -> list[tuple[str, str]]:
    """About ``per_language`` documents of each language, picked by a hash of doc_id (of the text
    where that is null), in a fixed order; of longer ones a run of ``most_chars`` characters from a place that a
    hash picks. One pass counts the languages, another fetches the picked rows."""
    known = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & (F.col("lang") != UNDETERMINED)).select(F.col("doc_id"), F.col("lang"), "text")
    draw = F.xxhash64(F.coalesce(F.col("doc_id"), F.xxhash64("text")), F.lit(8))
    counts = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}
    cut = F.create_map(*[F.lit(v) for k, n in counts.items() for v in (k, max(1, min(modulus, modulus * per_language // n)))]) if counts else None
    if cut is None:
        return []
    picked = known.filter(F.pmod(draw, F.lit(modulus)) < cut[F.col("lang")])
    start = F.pmod(F.xxhash64("text"), F.greatest(F.length("text") - most_chars, F.lit(0)) + 1).cast("int") + 1
    picked = picked.select("doc_id", "lang", F.substring("text", start, F.lit(most_chars)).alias("text"))
    return [(r["text"], r["lang"]) for r in sorted(picked.collect(), key=lambda r: (r["lang"], str(r["doc_id"]), r["text"]))]


def fit(docs: DataFrame, per_language: int = 250, **options) -> Gru:
    """Train on a sample of labelled documents: ``per_language`` bounds their number, 32 768 characters each."""
    samples = labelled_sample(docs, per_language)
    return train(samples, **options) if samples else Gru([UNDETERMINED], [np.zeros((3, 256), np.float32)] * 2, [np.zeros((3, 1), np.float32)] * 2, [np.zeros((1, 1), np.float32)] * 2, np.zeros((1, 1), np.float32))


def predict(docs: DataFrame, model: Gru) -> DataFrame:
    """One row per document: doc_id, text_key, lang_pred, score, known, letters.

    Only ``text`` decides. ``lang_pred`` is the likeliest language and ``score`` its share among the
    languages; ``known`` is the share of all languages against ``und`` where the text has
    letters, of which it has ``letters`` bytes. Null texts and those without a
    letter get ``und``, score 0 and known 0; of tied languages the first by name wins; repeated rows are each scored; an empty
    table gives no rows; other columns aren't read. Long texts are cut into windows, not shortened.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(2).to_pylist()
            lang: list[str] = [UNDETERMINED] * len(texts)
            score, known, letters, places = np.zeros(len(texts)), np.zeros(len(texts)), np.zeros(len(texts)), np.array(model.known)
            some = [k for k, t in enumerate(texts) if t and has_letter(t)]
            for part in _parts(some, texts):
                p, known[part], letters[part] = model.pooled([texts[k].lower().encode("utf-8", "surrogatepass") for k in part])
                p = p[:, places]
                best, share = p.argmax(axis=1), np.clip(p.sum(axis=1), 1e-9, 1)
                for k, j in zip(part, best.tolist()):
                    lang[k] = model.langs[places[j]]
                score[part] = np.clip(p[np.arange(len(part)), best] / share, 0, 1)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(lang, pa.string()), pa.array(score), pa.array(known), pa.array(letters.astype(np.int64))], ["doc_id", "text_key", "lang_pred", "score", "known", "letters"])

    return docs.select(F.col("doc_id").cast("long"), text_key(), F.col("text").cast("string")).mapInArrow(run, "doc_id long, text_key long, lang_pred string, score double, known double, letters long")


def _parts(rows: list[int], texts: list, most: int = 4_000_000) -> Iterator[list[int]]:
    part, size = [], 0
    for k in rows:
        part.append(k)
        size += len(texts[k])
        if size > most:
            yield part
            part, size = [], 0
    if part:
        yield part


def held_out(docs: DataFrame, folds: int = 5) -> DataFrame:
    """``docs`` with held_out: true where crc32 of doc_id as text leaves remainder 0."""
    return docs.withColumn("held_out", F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % folds == 0)


def identify(docs: DataFrame, per_language: int = 250, **options) -> DataFrame:
    """doc_id, held_out, lang_pred, score, known, letters, text_key: fit on the documents that aren't held out, predict all."""
    marked = held_out(docs.select("doc_id", "text", "lang"))
    model = fit(marked.filter("not held_out"), per_language, **options)
    return held_out(predict(docs, model)).select("doc_id", "held_out", "lang_pred", "score", "known", "letters", "text_key")


#: Least share of known languages, of texts long enough to tell: at sf0.1 all have over 0.25, while foreign
#: scripts and random letters have under 0.13.
FLOOR, ENOUGH_LETTERS = 0.15, 160


def keep_identified(docs: DataFrame, floor: float = FLOOR, enough: int = ENOUGH_LETTERS, wanted: list[str] | None = None, **options) -> DataFrame:
    """``docs`` without those in no language that the network learned: no letter, or ``enough`` bytes of letters
    (fewer don't tell) and a share of known languages under ``floor``; with ``wanted`` also without those in other languages. All columns stay."""
    other = ~F.col("lang_pred").isin(wanted) if wanted else F.lit(False)
    return without(docs, identify(docs, **options).filter((F.col("lang_pred") == UNDETERMINED) | ((F.col("known") < floor) & (F.col("letters") >= enough)) | other))
