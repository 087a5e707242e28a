"""The stated rule of decontamination over whole placements, against a plain loop."""

import itertools
import random

from lingweave.llm import decontaminate


def brute(doc, item, least=12, share=0.8):
    """Most equal tokens of a segment that meets the rule, over all diagonals; 0 without one."""
    most, least = 0, min(least, len(item))
    for shift in range(-len(item) + 1, len(doc)):
        e = [doc[i + shift] == w for i, w in enumerate(item) if 0 <= i + shift < len(doc)]
        for a, b in itertools.combinations(range(len(e) + 1), 2):
            if b - a >= least and 10 * sum(e[a:b]) >= round(10 * share) * (b - a):
                most = max(most, sum(e[a:b]))
    return most


def test_substitutions_at_any_places(spark):
    """Every placement of 2 and 3 substitutions in 15 tokens, 3 in 16, 2 in 12, and a sample of 4 in 20."""
    items, docs = [], []
    rng = random.Random(3)
    for n, k in ((12, 2), (15, 2), (15, 3), (16, 3), (20, 4)):
        item = [f"i{n}k{k}w{j}" for j in range(n)]
        items.append((len(items), " ".join(item)))
        places = list(itertools.combinations(range(n), k))
        for p in rng.sample(places, min(len(places), 600)):
            docs.append((len(docs), len(items) - 1, " ".join(["before"] * 3 + ["zzz" if j in p else w for j, w in enumerate(item)] + ["after"] * 3)))
    made = spark.createDataFrame(docs, "doc_id long, want long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.overlaps(made, spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert got == {(d, i) for d, i, _ in docs}


def test_verbatim_run_before_looser_text(spark):
    item = [f"w{j}" for j in range(59)]
    text = item[:12] + ["zzz" if j % 7 in (1, 4) else w for j, w in enumerate(item[12:])]  # 5 of 7 equal
    d = spark.createDataFrame([(1, " ".join(text))], "doc_id long, text string")
    (r,) = decontaminate.overlaps(d, spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")).collect()
    assert (r["matched"], r["item_start"], r["doc_start"]) == (brute(text, item), 0, 0) and r["matched"] >= 12


def test_equals_brute_force(spark):
    rng = random.Random(8)
    items = {i: [f"v{rng.randint(0, 400)}" for _ in range(rng.randint(12, 40))] for i in range(12)}
    docs = {}
    for n in range(150):
        item = rng.choice(list(items.values()))
        part = item[rng.randint(0, len(item) // 2) :][: rng.randint(8, 40)]
        docs[n] = [f"x{rng.randint(0, 400)}" for _ in range(rng.randint(0, 5))] + [w if rng.random() > 0.2 else "zzz" for w in part] + [f"x{rng.randint(0, 400)}" for _ in range(rng.randint(0, 5))]
    made = spark.createDataFrame([(k, " ".join(t)) for k, t in docs.items()], "doc_id long, text string")
    tests = spark.createDataFrame([(k, " ".join(t)) for k, t in items.items()], "item_id long, text string")
    rows = decontaminate.overlaps(made, tests).collect()
    want = {(d, i): m for d, t in docs.items() for i, w in items.items() if (m := brute(t, w))}
    assert {(r["doc_id"], r["item_id"]): r["matched"] for r in rows} == want
    for r in rows:
        a, b = docs[r["doc_id"]][r["doc_start"] :], items[r["item_id"]][r["item_start"] :]
        assert sum(x == y for x, y in list(zip(a, b))[: r["aligned"]]) == r["matched"] and r["aligned"] >= 12


def test_short_items(spark):
    """Items of 6 to 11 tokens with every allowed substitution; 4 and 5 unchanged; 3 match nothing."""
    items, docs, want = [], [], set()
    for n in range(3, 12):
        item = [f"i{n}w{j}" for j in range(n)]
        items.append((n, " ".join(item)))
        for k in range(3):
            for p in itertools.combinations(range(n), k):
                d = len(docs)
                docs.append((d, " ".join(["before"] + ["zzz" if j in p else w for j, w in enumerate(item)] + ["after"])))
                if n >= 4 and 5 * (n - k) >= 4 * n and (n > 5 or not k):
                    want.add((d, n))
    got = decontaminate.overlaps(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {(r["doc_id"], r["item_id"]) for r in got.collect()} == want


def test_repeated_ids(spark, monkeypatch):
    """A contaminated row isn't hidden by another row of its id, in either order and on both paths."""
    item = [f"w{j}" for j in range(40)]
    whole, part, other = " ".join(item), " ".join(item[:9]), "nothing of the kind"
    tests = spark.createDataFrame([(1, whole), (1, "another item of the same name that has its twelve words and more")], "item_id long, text string")
    for bound in (decontaminate.BROADCAST_BYTES, 0):
        monkeypatch.setattr(decontaminate, "BROADCAST_BYTES", bound)
        for rows in ([(7, whole), (7, part), (7, other), (None, whole), (None, other)], [(None, other), (None, whole), (7, other), (7, part), (7, whole)]):
            d = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
            assert {(r["doc_id"], r["item_id"], r["matched"]) for r in decontaminate.overlaps(d, tests).collect()} == {(7, 1, 40), (None, 1, 40)}
            assert sorted(map(repr, ((r["doc_id"], r["text"]) for r in decontaminate.drop_contaminated(d, tests).collect()))) == sorted(map(repr, [(7, part), (7, other), (None, other)]))
