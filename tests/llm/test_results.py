"""Each operator against a brute-force version, an exact round trip or held-out accuracy."""

import collections
import html as markup
import math
import os
import random
import re
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from lingweave.llm import components, decontaminate, html_extract, langid, lm_score, packing, simhash, suffix_dedup, warc_derivatives
from lingweave.llm.queries import tokenizer_path
from lingweave.sources import warc

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").cache()


@pytest.fixture(scope="module")
def texts(docs):
    return {r["doc_id"]: r["text"] for r in docs.collect()}


def simple_fingerprint(text):
    w = re.findall(r"[^\x20\x09-\x0d]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) > 3 else [" ".join(w)] if w else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("hot", [2000, 1])
def test_simhash(docs, texts, hot):
    fp = {k: simple_fingerprint(t) for k, t in texts.items()}
    near = {a: [b for b in fp if b != a and (fp[a] ^ fp[b]).bit_count() <= 2] for a in fp}

    def reach(a):
        seen, todo = {a}, [a]
        while todo:
            new = [y for y in near[todo.pop()] if y not in seen]
            seen.update(new)
            todo += new
        return min(seen)

    got = {r["doc_id"]: (r["fingerprint"], r["n_near"], r["component_id"]) for r in simhash.simhash_near_dups(docs, hot_bucket=hot).collect()}
    assert got == {a: (f"{fp[a]:016x}", len(near[a]), reach(a)) for a in fp}


def test_multi_index_hashing_misses_nothing(spark):
    rng = random.Random(2)
    base = [rng.getrandbits(64) for _ in range(12)]
    fps = sorted({b ^ sum(1 << k for k in rng.sample(range(64), rng.randint(0, 7))) for b in base for _ in range(25)})
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    classes = spark.createDataFrame([(f, 1, i) for i, f in enumerate(signed)], "fp long, n long, id long")
    for distance, parts in ((0, 2), (1, 2), (2, 2), (3, 2), (5, 2), (8, 3)):
        want = {tuple(sorted((i, j))) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= distance}
        for hot in (2000, 2) if distance < 5 else (2000, 30):
            rows = [tuple(sorted((r["id"], r["id2"]))) for r in simhash.near_links(classes, distance, hot, parts).collect()]
            assert len(rows) == len(set(rows)) and set(rows) == want


def weighed_fingerprint(text):
    counts = collections.Counter((text or "").lower().encode().split())
    hashes = {w: (xxhash.xxh64_intdigest(w, 42), math.log1p(n)) for w, n in counts.items()}
    return sum(1 << b for b in range(64) if 2 * sum(x for h, x in hashes.values() if h >> b & 1) > sum(x for _, x in hashes.values()))


def near_components(texts):
    """Least id of each text's component by brute force."""
    prints = {k: (weighed_fingerprint(t), simple_fingerprint(t)) for k, t in texts.items()}
    group = {k: k for k in prints}

    def root(x):
        while group[x] != x:
            x = group[x]
        return x

    for a in prints:
        for b in prints:
            if a < b and (prints[a][0] ^ prints[b][0]).bit_count() <= 8 and (prints[a][1] ^ prints[b][1]).bit_count() <= 16:
                x, y = sorted((root(a), root(b)))
                group[y] = x
    return {k: root(k) for k in prints}


@pytest.mark.parametrize("hot", [2000, 1])
@pytest.mark.parametrize(("distance", "parts"), [(2, 2), (8, 3)])
def test_fingerprints_are_not_broadcast(spark, distance, parts, hot):
    """Each row of the search stands for many, which Spark's estimate of its size leaves out."""
    classes = simhash._classes(spark.range(50).select(F.expr("id div 2").alias("fp"), F.col("id").alias("doc_id")), ["fp"], F.col("doc_id"))
    plan = simhash.near_links(classes, distance, hot, parts)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and not re.search(r"(Broadcast\w+|ShuffledHash)Join.* Inner", plan)


@pytest.mark.parametrize("group", [32_768, 20])
@pytest.mark.parametrize("hot", [2000, 4])
@pytest.mark.parametrize("distance", [8, 7, 4, 1])
def test_near_pairs_in_groups_miss_nothing(spark, monkeypatch, group, hot, distance):
    monkeypatch.setattr(simhash, "GROUP", group)
    rng = random.Random(4)
    base = [(rng.getrandbits(64), rng.getrandbits(64)) for _ in range(12)]
    flip = lambda x, most: x ^ sum(1 << k for k in rng.sample(range(64), rng.randint(0, most)))
    prints = sorted({(flip(a, 7), flip(b, 12)) for a, b in base for _ in range(25)} | {(a, flip(b, 5)) for a, b in base[:2] for _ in range(9)})
    signed = [tuple(x - (1 << 64) if x >> 63 else x for x in p) for p in prints]
    classes = spark.createDataFrame([(a, b, i) for i, (a, b) in enumerate(signed)], "fp long, v long, id long")
    apart = lambda i, j, k: (prints[i][k] ^ prints[j][k]).bit_count()
    want = {(j, i) for i in range(len(prints)) for j in range(i) if apart(i, j, 0) <= distance and apart(i, j, 1) <= 16}
    rows = [tuple(sorted((r["id"], r["id2"]))) for r in simhash.near_id_pairs(classes, distance, 16, hot).collect()]
    assert len(rows) == len(set(rows)) and set(rows) == want and want


def test_near_copies_are_not_joined_as_exploded_rows(docs, monkeypatch):
    monkeypatch.setattr(simhash, "near_links", None)
    simhash.near_copies(docs)


def test_near_copies(docs, texts):
    got = {r["doc_id"]: r["component_id"] for r in simhash.near_copies(docs).collect()}
    assert got == near_components(texts)


def test_recall_of_near_copies(spark):
    """Of pairs that share 60 % of their 3-word shingles, nine in ten are in one component."""
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    sets = {r["doc_id"]: {" ".join(x) for x in zip(*[w[i:] for i in range(3)])} for r in d.collect() if len(w := r["text"].lower().split()) > 20}
    where = collections.defaultdict(set)
    for k, s in sets.items():
        for x in s:
            where[x].add(k)
    met = {(a, b) for x in where.values() if len(x) < 50 for a in x for b in x if a < b}
    near = [(a, b) for a, b in met if len(sets[a] & sets[b]) >= 0.6 * len(sets[a] | sets[b])]
    far = [(a, b) for a, b in met if len(sets[a] & sets[b]) < 0.3 * len(sets[a] | sets[b])]
    got = {r["doc_id"]: r["component_id"] for r in simhash.near_copies(d).collect()}
    assert len(near) > 50 and np.mean([got[a] == got[b] for a, b in near]) > 0.9
    assert np.mean([got[a] == got[b] for a, b in far]) < 0.01


def test_components(spark):
    rng = random.Random(4)
    edges = [(rng.randint(0, 60), rng.randint(0, 60)) for _ in range(45)] + [(100 + i, 101 + i) for i in range(30)]
    parent = {x: x for e in edges for x in e}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    got = {r["node"]: r["root"] for r in components.connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {x: root(x) for a, b in edges if a != b for x in (a, b)}


def repeats(texts, words):
    places = collections.defaultdict(list)
    for k in sorted(texts):
        w = (texts[k] or "").encode().lower().split()
        for i in range(len(w) - words + 1):
            places[tuple(w[i : i + words])].append((k, i))
    starts = collections.defaultdict(set)
    for p in places.values():
        for n, (k, i) in enumerate(p):
            if len(p) > 1:
                starts[k, n == 0].add(i)
    out = set()
    for (k, first), s in starts.items():
        covered = sorted({x for i in s for x in range(i, i + words)})
        a = covered[0]
        # touching spans are one
        for x, y in zip(covered, covered[1:] + [None]):
            if y != x + 1:
                out.add((k, first, a, x - a + 1))
                a = y
    return out


@pytest.mark.parametrize(("words", "hot"), [(50, 10**5), (50, 1), (10, 10**5), (10, 1)])
def test_repeated_passages(docs, texts, words, hot):
    got = {(r["doc_id"], r["first"], r["start_word"], r["n_words"]) for r in suffix_dedup.repeated_passages(docs, words, hot_key=hot).collect()}
    assert got == repeats(texts, words)


def test_cut_words():
    assert suffix_dedup.cut_words("a b  c d", [(1, 2)]) == "a d"
    assert suffix_dedup.cut_words("a b c", [(0, 3)]) == ""
    assert suffix_dedup.cut_words("é b c", [(2, 1)]) == "é b "


def test_decontamination(spark, docs):
    tests = spark.read.parquet(f"{SF}/benchmark.parquet").cache()
    items = {r["item_id"]: re.findall(r"[^\W_]+", r["text"].lower()) for r in tests.collect()}
    rng = random.Random(6)
    rows, planted = [], set()
    for n, (k, w) in enumerate(items.items()):
        v = list(w)
        for i in range(rng.randint(2, 6), len(v), 7):  # every seventh word differs
            v[i] = "zzz"
        rows.append((n, "before " * 5 + " ".join(v).upper() + ". after"))
        planted.add((n, k))
        rows.append((1000 + n, " ".join(rng.sample(w, len(w)))))  # its words in another order
        rows.append((2000 + n, " ".join(w[:7])))
    made = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.overlaps(made, tests).collect()}
    assert got == planted
    real = {(r["doc_id"], r["item_id"], r["matched"]) for r in decontaminate.overlaps(docs, tests).collect()}
    flat = {r["doc_id"]: " ".join(re.findall(r"[^\W_]+", r["text"].lower())) for r in docs.collect()}
    whole = {(d, k, len(w)) for d, t in flat.items() for k, w in items.items() if f" {' '.join(w)} " in f" {t} "}
    assert whole and whole <= real


@pytest.mark.parametrize("bound", [1 << 28, 0])
def test_lm_scores(docs, texts, bound):
    end = object()
    words = {k: [*(t or "").encode().lower().split(), end] for k, t in texts.items()}
    out = {k: zlib.crc32(str(k).encode()) % 7 == 2 for k in words}
    uni = collections.Counter(x for k, w in words.items() if not out[k] for x in w)
    bi = collections.Counter(p for k, w in words.items() if not out[k] for p in zip([None, *w], w))
    n, v, starts = sum(uni.values()), len(uni), sum(not x for x in out.values())
    by_level = collections.defaultdict(list)
    for x in bi.values():
        by_level[x.bit_length()].append(x)
    means = {k: sum(x) / len(x) for k, x in by_level.items()}
    value = lambda x, top: min(means[x.bit_length()], top) if x else 0.0

    def likelihood(k, weight, own):
        """With ``own`` every token is left out of the counts that it made."""
        total = 0.0
        for a, b in zip([None, *words[k]], words[k]):
            before = starts if a is None else uni[a]
            pair, word = value(bi[a, b], min(uni[b], before)), uni[b] / (n + v) if own else (uni[b] + 1) / (n + v + 1)
            total += math.log10((max(pair - own, 0) + weight * word) / (before - own + weight))
        return total

    learned = [k for k in words if not out[k]]
    weight = max(lm_score.WEIGHTS, key=lambda x: sum(likelihood(k, x, 1) for k in learned))
    assert lm_score.TUNING_DOCS > len(learned)  # all of them are read here
    score = lambda k: likelihood(k, weight, 0)

    off = 0
    for r in lm_score.lm_scores(docs, broadcast_bytes=bound).collect():
        w = words[r["doc_id"]]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (out[r["doc_id"]], len(w), sum(x in uni for x in w), n)
        assert r["base_score"] == pytest.approx(sum(math.log10((uni[x] + 1) / (n + v + 1)) for x in w), abs=1e-6)
        off += abs(r["score"] - score(r["doc_id"])) / len(w)  # the filter's false positives alone
        assert r["score"] > r["base_score"] or len(w) < 20 or r["held_out"]
    assert off / len(words) < 0.01


def test_weight_is_chosen_on_all_documents(spark, monkeypatch):
    """The fifth that a sample of ten would be has words that stand once; the rest repeat one sentence."""
    monkeypatch.setattr(lm_score, "TUNING_DOCS", 10)
    repeated, single = [f"a b c d e f g h{' ' * i}" for i in range(200)], [" ".join(f"w{i}x{k}" for k in range(9)) for i in range(200)]
    drawn = {r[0] for r in spark.createDataFrame([(t,) for t in repeated + single], "text string").filter("pmod(xxhash64(text, 9), 5) = 0").collect()}
    texts = [t for t in repeated if t not in drawn][:44] + [t for t in single if t in drawn][:11]
    ids = [i for i in range(200) if not lm_score.held_out(i)]
    d = spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string")
    words = [[*t.split(), "."] for t in texts]
    uni, bi = collections.Counter(x for w in words for x in w), collections.Counter(p for w in words for p in zip([None, *w], w))
    left_out = lambda a, b, x: (bi[a, b] - 1 + x * uni[b] / (sum(uni.values()) + len(uni))) / ((uni[a] if a else len(texts)) - 1 + x)
    weight = max(lm_score.WEIGHTS, key=lambda x: sum(n * math.log10(left_out(a, b, x)) for (a, b), n in bi.items()))
    scores = lambda o: {r["doc_id"]: round(r["score"], 6) for r in lm_score.lm_scores(d, o).collect()}
    assert len(texts) == 55 and scores(None) == scores(lm_score.Options(weight=weight))


def test_bloom_levels_are_never_under_the_count():
    rng = np.random.default_rng(1)
    keys, counts = rng.integers(0, 2**63, 5000).astype(np.uint64), rng.integers(1, 500, 5000)
    o = lm_score.Options()
    data = lm_score.bloom(keys, counts, o)
    assert (lm_score.bloom_levels(keys, data, o) >= lm_score.levels_of(counts, o.base)).all()
    assert (lm_score.bloom_levels(rng.integers(0, 2**63, 20000).astype(np.uint64), data, o) > 0).mean() < 0.015


@pytest.mark.parametrize("shards", [1, 16, 256])
def test_bloom_filters_are_probed_at_once(monkeypatch, shards):
    """The same levels as shard by shard, in a number of steps that doesn't grow with the shards."""
    rng = np.random.default_rng(2)
    keys, counts, o = np.unique(rng.integers(0, 2**64, 4000, np.uint64)), rng.integers(1, 100, 4000), lm_score.Options(shards=shards)
    slices = lm_score._by_shard(keys, shards)
    filters = [lm_score.bloom(keys[s], counts[s], o) if i % 5 != 3 else np.zeros(0, np.uint8) for i, s in enumerate(slices)]
    asked = np.unique(np.concatenate([keys, rng.integers(0, 2**64, 1000, np.uint64)]))
    alone = [lm_score.bloom_levels(asked[s], f, o) if len(f) else np.zeros(s.stop - s.start) for s, f in zip(lm_score._by_shard(asked, shards), filters)]
    steps, bit = [], lm_score._bit
    monkeypatch.setattr(lm_score, "_bit", lambda *a: steps.append(1) or bit(*a))
    got = lm_score.bloom_levels(asked, np.concatenate(filters), o, np.cumsum([0, *map(len, filters)]))
    assert (got == np.concatenate(alone)).all() and len(steps) < 12 * o.probes


def test_gradients_are_right():
    rng = np.random.default_rng(0)
    p = {"b": rng.standard_normal((3, 1))}
    for d in (0, 1):
        p |= {f"e{d}": rng.standard_normal((6, 256)) * 0.3, f"u{d}": rng.standard_normal((6, 2)) * 0.3, f"w{d}": rng.standard_normal((3, 2))}
    x, y, mask = rng.integers(0, 4, (5, 4)).astype(np.uint8), rng.integers(0, 3, 4), np.ones((5, 4), np.float32)

    def loss(q):
        m = langid.Gru(list("abc"), [q["e0"].astype(np.float32), q["e1"].astype(np.float32)], [q["u0"].astype(np.float32), q["u1"].astype(np.float32)], [q["w0"].astype(np.float32), q["w1"].astype(np.float32)], q["b"].astype(np.float32), 5)
        pr = m.position_probabilities(x)
        return -np.log(pr[:, y, np.arange(4)]).mean()

    grad = langid._gradients({k: v.astype(np.float32) for k, v in p.items()}, x, y, mask, 2)
    for k in p:
        i = tuple(rng.integers(0, s) for s in p[k].shape)
        if k[0] == "e":
            i = (i[0], int(x[0, 0]))
        up, down = {**p, k: p[k].copy()}, {**p, k: p[k].copy()}
        up[k][i] += 1e-2
        down[k][i] -= 1e-2
        assert grad[k][i] == pytest.approx((loss(up) - loss(down)) / 2e-2, abs=3e-3)


def test_language_accuracy(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = d.select("doc_id", "lang").join(langid.identify(d), "doc_id").collect()
    held = [r for r in got if r["held_out"]]
    assert len(got) == 1000 and {r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got} == {True}
    assert np.mean([r["lang"] == r["lang_pred"] for r in held]) > 0.97 and all(0 <= r["score"] <= 1 for r in got)


def test_every_position_has_a_label():
    samples = [("the cat and the dog with this " * 20, "en"), ("der hund und die katze mit dem " * 20, "de")]
    m = langid.train(samples, steps=60, window=32, span=32)
    text = "the dog and the cat " * 5 + "der hund und die katze " * 5
    labels = m.labels(text)
    assert len(labels) == len(text.encode()) and labels[20] == "en" and labels[-20] == "de"
    whole = m.document_probabilities([b"the dog", b"x" * 1000])
    assert np.allclose(whole.sum(axis=1), 1, atol=1e-5)


def test_main_text(spark):
    for r in spark.read.parquet(f"{SF}/pages.parquet").collect():
        inner = r["html"].partition("<article>")[2].partition("</article>")[0]
        want = " ".join(markup.unescape(re.sub(r"</?(?:p|h1|br)>", " ", re.sub(r"</?b>", "", inner))).split())
        assert html_extract.main_text(r["html"]) == want
    page = """<body><div class="top-menu"><a href=a>Home</a><a href=b>News</a></div><div id=cookie-notice>We use cookies, dear reader, all of them.</div>
      <div class=post><h1>On &eacute;clairs</h1><p>They are <i>lon</i>g and filled with cream, as everyone knows who has had one.</p><p>Short.</p><blockquote>Said a cook with many years of practice.</blockquote></div>
      <div class="sidebar">Popular posts and other things that are long enough to be dense text</div><section id="comments"><p>Lovely text, thank you very much for it all!</p></section><form>Your name</form></body>"""
    assert html_extract.main_text(page) == "On éclairs They are long and filled with cream, as everyone knows who has had one. Short. Said a cook with many years of practice."


PROSE = "Nobody in the old harbour town could say when the last of the tall ships had left, though many claimed to have seen it go. "


@pytest.mark.parametrize(
    ("page", "want"),
    [
        (f'<body><article class="notice"><p>{PROSE}</p><p>{PROSE}</p></article><div>foot</div></body>', f"{PROSE}{PROSE}"),
        (f'<main><h1 class="header">A title</h1><p>{PROSE}</p><p>{PROSE}</p><div class="discussion"><p>{PROSE}</p><p>{PROSE}</p></div></main>', f"A title {PROSE * 4}"),
        (f"<article><p>{PROSE}</p><p>Tick the <label>box of oak</label> and read on.</p></article>", f"{PROSE}Tick the box of oak and read on."),
        (f'<form id="aspnet"><div><p>{PROSE}</p><p>{PROSE}</p></div></form>', PROSE * 2),
        (f'<div id="sidebar-left-page"><div><p>{PROSE}</p><p>{PROSE}</p></div></div><div class="footer">All rights</div>', PROSE * 2),
        (f'<div><p>{PROSE}</p><p>{PROSE}</p><section id="comments"><p>{PROSE}</p></section><div class="related"><a href=x>More of it</a></div></div>', PROSE * 2),
        ("just words, no markup", "just words, no markup"),
    ],
)
def test_main_text_of_odd_pages(page, want):
    assert html_extract.main_text(page) == want.strip()


def test_density_decides(spark, monkeypatch):
    """Without article elements and names the densities find the same text; without densities nothing does."""
    pages = [r["html"] for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()]
    bare = [p.replace("<article>", "<div>").replace("</article>", "</div>").replace(' class="ad"', "") for p in pages]
    found = [html_extract.main_text(p) for p in bare]
    assert np.mean([x == html_extract.main_text(p) for x, p in zip(found, pages)]) > 0.95
    monkeypatch.setattr(html_extract, "log", lambda x: 0.0)
    assert np.mean([x != html_extract.main_text(p) for x, p in zip(found, bare)]) > 0.95


def test_densities_by_brute_force():
    from xml.etree import ElementTree

    rng = random.Random(3)

    def tree(depth):
        tag = rng.choice(["div", "section", "a", "i", "b"])
        inner = "".join(rng.choice([tree(depth - 1), "word " * rng.randint(0, 9)]) for _ in range(rng.randint(0, 4))) if depth else "text " * rng.randint(0, 5)
        return f"<{tag}>{inner}</{tag}>"

    for _ in range(60):
        page = "<body>" + "".join(tree(3) for _ in range(3)) + "</body>"
        root = ElementTree.fromstring(page)

        def count(e, linked=False):
            """characters, tags, characters and tags of links, under ``e``"""
            linked = linked or e.tag == "a"
            c = t = lc = lt = 0
            for piece in [e.text, *[x.tail for x in e]]:
                size = len((piece or "").strip())
                c, lc = c + size, lc + size * linked
            for x in e:
                more = count(x, linked)
                c, t, lc, lt = c + more[0], t + more[1] + 1, lc + more[2], lt + more[3] + (x.tag == "a")
            return c, t, lc, lt

        whole = count(root)
        want = []
        for e in root.iter():
            linked = any(e in a.iter() for a in root.iter("a"))
            c, t, lc, lt = count(e, linked)
            base = max(math.log(math.log(c / max(c - lc, 1) * lc + whole[2] / max(whole[0], 1) * c + math.e)), 0.1)
            want.append(c / max(t, 1) * max(math.log(c / max(lc, 1) * max(t, 1) / max(lt, 1)), 0) / base if c else 0)
        got, chars, _ = html_extract.densities(html_extract.parse(page))
        assert chars[1:] == [count(e)[0] for e in root.iter()]
        assert got[1:] == pytest.approx(want)


def test_warc_round_trip(spark, tmp_path):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    made = warc_derivatives.derive(warc_derivatives.responses_of_pages(pages), ["page_id"])
    data = b"".join(bytes(r["record"]) for r in warc_derivatives.archive_bytes(made).collect())
    (tmp_path / "x.warc.gz").write_bytes(data)
    back = {r["record_id"]: r for r in warc.read_warc(spark, str(tmp_path)).collect()}
    rows = made.collect()
    assert len(back) == len(rows) == 2 * pages.count()
    for r in rows:
        b = back[r["record_id"]]
        assert bytes(b["block"]).decode() == r["block"] and r["refers_to"] in b["headers"] and r["source_payload_digest"] in b["headers"]
        assert warc_derivatives.sha1_digest(bytes(b["block"])) == r["block_digest"] and len(bytes(b["block"])) == r["content_length"]


def test_packing(docs, texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer_path())
    ids = {k: t.encode(x or "", add_special_tokens=False).ids + [0] for k, x in texts.items()}
    rows = packing.pack(docs, tokenizer_path(), group_rows=64).collect()
    by_doc, by_sequence = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        part = ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert zlib.crc32(np.array(part, "<u4").tobytes()) == r["ids_crc32"] and r["start"] == 2048 * r["piece"]
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    assert all(sum(r["length"] for r in by_doc[k]) == len(v) and len(by_doc[k]) == -(-len(v) // 2048) for k, v in ids.items())
    for s in by_sequence.values():
        at = 0
        for r in sorted(s, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 2048
    one = len({r["sequence_id"] for r in packing.pack(docs, tokenizer_path()).collect()})
    assert one <= 1.02 * sum(map(len, ids.values())) / 2048 + 1


@pytest.mark.parametrize("finish", [False, True])
def test_sum_of_squares_is_least(finish):
    rng = np.random.default_rng(3)
    sizes = rng.integers(1, 30, 300)
    where, offset = packing.sum_of_squares(sizes, 32, finish)
    open_bins = {}
    finished = 0
    for k, (s, b, o) in enumerate(zip(sizes.tolist(), where.tolist(), offset.tolist())):
        def after(x, s=s):
            gaps = collections.Counter(32 - f for y, f in open_bins.items() if y != x and f < 32)
            left = 32 - open_bins.get(x, 0) - s
            gaps[left] += left > 0
            return sum(v * v for v in gaps.values())

        fits = [x for x, f in open_bins.items() if f + s <= 32]
        done = finish and fits and sum(32 - f for f in open_bins.values()) >= sizes[k:].sum()
        finished += bool(done)
        assert after(b) == min(map(after, fits if done else [*fits, "new"])) and o == open_bins.get(b, 0)
        open_bins[b] = open_bins.get(b, 0) + s
    assert max(open_bins.values()) <= 32 and bool(finished) == finish


def test_ids_equal_the_tokenizer():
    from tokenizers import Tokenizer

    words, fresh = packing.WordIds(tokenizer_path(), most=50), Tokenizer.from_file(tokenizer_path())
    rng = random.Random(1)
    letters = [*"aBJj'sé.,!İΣß \t\n \x1c|<>1２日本é̇ﬁ̌_²K;", "<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>"]
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 30))) for _ in range(1500)]
    for i in range(0, len(texts), 7):
        for x, data in zip(texts[i : i + 7], words.encode(texts[i : i + 7])):
            assert np.frombuffer(data, "<u4").tolist() == fresh.encode(x, add_special_tokens=False).ids
    assert any("<|endoftext|>" in x and 49407 in np.frombuffer(words.encode([x])[0], "<u4") for x in texts)
    plain = packing.WordIds(tokenizer_path(), special_as_text=True)
    assert 49407 not in np.frombuffer(plain.encode(["a <|endoftext|> b"])[0], "<u4")


def test_pipeline(spark, docs, texts):
    """Stage by stage against plain loops over what the stage before kept."""
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r["doc_id"]: r["text"] for r in kept.collect()}
        kept = stage(spark, kept, SF).cache()
        assert kept.columns == docs.columns
        after = {r["doc_id"] for r in kept.collect()}
        if name == "language ID":
            assert after == {k for k, t in before.items() if t and langid.has_letter(t)}  # nothing foreign among them
        elif name == "exact dedup":
            assert after == {max(k for k, u in before.items() if u.lower() == t.lower()) for t in before.values()}
        elif name.startswith("SimHash"):
            assert after == set(near_components(before).values())
        else:
            items = [" ".join(re.findall(r"[^\W_]+", r["text"].lower())) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
            flat = {k: " ".join(re.findall(r"[^\W_]+", t.lower())) for k, t in before.items()}
            assert before.keys() - after == {k for k, t in flat.items() if any(f" {i} " in f" {t} " for i in items)}
    assert {r["doc_id"] for r in corpus_pipeline.run(spark, SF).select("doc_id").collect()} == after
    assert os.path.basename(corpus_pipeline.__file__) == "corpus_pipeline.py"
