import math
import random

import numpy as np
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from lingweave.operators import cleaning, docjoin, embeddings, features, lexicon, matching, sentences, tfidf, training
from lingweave.plans import pipeline, queries
from lingweave.plans.config import Config
from lingweave.sources import html
from lingweave.streaming import dedup


def documents(spark, src, trg):
    rows = [("src", i, t) for i, t in enumerate(src, 1)] + [("trg", i, t) for i, t in enumerate(trg, 1)]
    return spark.createDataFrame(rows, "side string, doc_idx long, text string")


def expected_pairs(src, trg, least, most, threshold):
    def grams(t):
        w = [x for x in t.replace("\n", " ").split(" ") if x]
        return [a + " " + b for a, b in zip(w, w[1:])]

    docs = {("s", i): grams(t) for i, t in enumerate(src, 1)} | {("t", i): grams(t) for i, t in enumerate(trg, 1)}
    df, n = {}, len(docs)
    for g in docs.values():
        for x in set(g):
            df[x] = df.get(x, 0) + 1
    vec = {}
    for k, g in docs.items():
        w = {x: math.log(g.count(x) + 1) * math.log(n / (1 + (df[x] if df[x] >= least else 1))) for x in set(g) if df[x] <= most}
        norm = math.sqrt(sum(v * v for v in w.values()))
        vec[k] = {x: v / norm for x, v in w.items() if df[x] >= least} if norm else {}
    out = {}
    for (a, i), v in vec.items():
        for (b, j), u in vec.items():
            if a == "s" and b == "t" and set(v) & set(u):
                s = sum(v[x] * u[x] for x in v if x in u)
                if s >= threshold:
                    out[i, j] = s
    return out


@pytest.mark.parametrize(("least", "most"), [(2, 1000), (2, 3), (1, 1000)])
def test_similarity(spark, least, most):
    rng = random.Random(3)
    words = "a b c d e".split()
    src = [" ".join(rng.choice(words) for _ in range(rng.randint(0, 12))) for _ in range(12)]
    trg = [" ".join(rng.choice(words) for _ in range(rng.randint(0, 12))).replace(" c ", "\n") for _ in range(9)]
    got = {(r["src_idx"], r["trg_idx"]): r["score"] for r in tfidf.similarity(documents(spark, src, trg), 2, least, most, 0.1).collect()}
    want = expected_pairs(src, trg, least, most, 0.1)
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in got)


def test_few_documents_have_negative_weights(spark):
    assert tfidf.similarity(documents(spark, ["a b"], ["a b"]), threshold=0.5).first()["score"] == pytest.approx(1)
    assert tfidf.similarity(documents(spark, [""], ["a b"])).count() == 0


def test_scopes_are_apart(spark):
    d = documents(spark, ["a b c", "d e f"], ["a b c", "d e f"]).withColumn("shard", F.col("doc_idx") % 2)
    more = documents(spark, ["x y z"] * 3, ["p q r"] * 3).withColumn("doc_idx", F.col("doc_idx") + 10).withColumn("shard", F.col("doc_idx") % 2)
    got = tfidf.similarity(d.unionByName(more), scope=["shard"]).collect()
    assert {(r["shard"], r["src_idx"], r["trg_idx"]) for r in got} == {(1, 1, 1), (0, 2, 2)}


def greedy(edges):
    s, t, out = set(), set(), []
    for score, a, b in sorted(((round(x, 9), a, b) for a, b, x in edges), reverse=True):
        if a not in s and b not in t:
            s.add(a)
            t.add(b)
            out.append((a, b))
    return sorted(out)


@pytest.mark.parametrize("bound", [0, 10**6])
def test_greedy_is_greedy(spark, bound):
    for seed in range(3):
        rng = random.Random(seed)
        edges = list({(a, b): (a, b, rng.randint(1, 5) / 5) for a, b in ((rng.randint(1, 15), rng.randint(1, 15)) for _ in range(90))}.values())
        got = matching.greedy_match(spark.createDataFrame(edges, "src_idx long, trg_idx long, score double"), one_task_edges=bound)
        assert sorted((r["src_idx"], r["trg_idx"]) for r in got.collect()) == greedy(edges)
    assert matching.greedy_match(spark.createDataFrame([], "src_idx long, trg_idx long, score double"), one_task_edges=bound).count() == 0


def test_reconcile(spark):
    schema = "src_idx long, trg_idx long, score double"
    f = spark.createDataFrame([(1, 1, 0.9), (1, 2, 0.8), (2, 1, 0.7), (2, 2, 0.1), (3, 3, 0.05)], schema)
    b = spark.createDataFrame([(1, 1, 0.9), (2, 1, 0.95), (2, 2, 0.3), (1, 2, 0.2), (3, 3, 0.05)], schema)
    once = matching.reconcile(f, b, rounds=1, threshold=0.1)
    # at n = 1 only source 2 and target 1 want each other; at n = 2 all do, and source 1 has the better mean
    assert [(r["src_idx"], r["trg_idx"], r["score"]) for r in once.collect()] == [(2, 1, pytest.approx(0.825))]
    both = {(r["src_idx"], r["trg_idx"]): r["score"] for r in matching.reconcile(f, b, n=2, threshold=0.1).collect()}
    assert both == {(1, 1): pytest.approx(0.9), (2, 2): pytest.approx(0.2)}
    more = matching.adopt_unpaired(matching.reconcile(f, b, n=2, threshold=0.1), b)
    assert (3, 3) in {(r["src_idx"], r["trg_idx"]) for r in more.collect()}
    assert matching.over_threshold(f, 0.1).filter("src_idx = 1").first()["trg_idx"] == 2


def test_index_counts_punctuated_words_twice(spark):
    d = spark.createDataFrame([("l1", 1, "foo foo, bar"), ("l1", 2, "bar"), ("l2", 3, "bar baz")], "lang string, doc_idx long, text string")
    index = {(r["lang"], r["word"]): r["doc_idxs"] for r in lexicon.word_index(d).collect()}
    assert index == {("l1", "foo"): [1, 1], ("l1", "bar"): [1, 2], ("l2", "bar"): [3], ("l2", "baz"): [3]}
    assert ("l1", "foo") not in {(r["lang"], r["word"]) for r in lexicon.word_index(d, 1).collect()}
    table = lexicon.extend_dictionary(spark.createDataFrame([("foo", "baz")], "src_word string, trg_word string"), lexicon.word_index(d), "l1", "l2")
    got = {(r["src_idx"], r["trg_idx"]): r["bow_overlap_score"] for r in lexicon.bow_candidates(lexicon.word_index(d), table, "l1", "l2").collect()}
    assert got == {(1, 3): pytest.approx(1.0), (2, 3): pytest.approx(0.5 * 1 / 2)}


def test_noise_filter(spark):
    cases = {"": True, "a": True, "ab": False, "a1": True, "abc1": False, "ab12": True, "a\0bcd": True, "abcd": False, "ab1": True}
    d = spark.createDataFrame([(k,) for k in cases], "s string").select("s", cleaning.is_noise(F.col("s")).alias("n"))
    assert {r["s"]: r["n"] for r in d.collect()} == cases


def pairs(spark, rows):
    return spark.createDataFrame(rows, "src_text string, trg_text string")


def test_elrc(spark):
    rows = [("a" * 6, "a"), ("a" * 5, "a"), ("a", "a" * 6), ("x", ""), (" ", "x"), ("a " * 199 + "a", "b " * 198 + "b"), ("a " * 198 + "a", "b " * 198 + "b")]
    m = cleaning.elrc_metrics(pairs(spark, rows))
    assert m.filter("trg_text = ''").first()["length_ratio"] == 0
    kept = {r["src_text"] for r in cleaning.elrc_filter(m).collect()}
    assert kept == {"a" * 5, "a", "a " * 198 + "a"}  # 1 / 6 is over 0.1666
    assert m.select(F.max("src_num_tokens")).first()[0] == 200


def test_alignment_cleaning(spark):
    rows = [("u", "v", 0.2), ("u", "v", 0.5), ("w", "x", 0.1), ("w", "x", None), ("w", "x", 0.9)]
    d = spark.createDataFrame(rows, "src_url string, trg_url string, aligner_score double")
    assert cleaning.clean_alignments(d, 0.2).count() == 2
    assert [r["src_url"] for r in cleaning.clean_alignments(d, 0.2, 2).collect()] == ["u"]


def test_duplicates(spark):
    rows = [("h1", 0.5, "b", "x", "u2", "v"), ("h1", 0.9, "a", "x", "u1", "v"), ("h2", 0.1, "c", "y", "u3", "v"), ("h2", 0.1, "b", "y", "u3", "v")]
    d = spark.createDataFrame(rows, "near_dup_hash string, repair_score double, src_text string, trg_text string, src_url string, trg_url string")
    best = cleaning.best_of_duplicates(d, ["near_dup_hash"], cleaning.corpus_order(d))
    assert {(r["near_dup_hash"], r["src_text"]) for r in best.collect()} == {("h1", "a"), ("h2", "b")}  # the last group's first row too
    assert cleaning.best_of_duplicates(best, ["near_dup_hash"], cleaning.corpus_order(best)).count() == 2
    assert {tuple(r["s"]) for r in cleaning.group_duplicates(d, ["near_dup_hash"], {"s": "src_url"}).collect()} == {("u1", "u2"), ("u3",)}
    keys = pairs(spark, [("A, b!", "c"), ("a b", "C."), ("a b", "d")]).select(cleaning.near_duplicate_key(F.col("src_text"), F.col("trg_text")).alias("k"))
    assert keys.distinct().count() == 2


def test_notes_and_stats(spark):
    d = cleaning.elrc_metrics(pairs(spark, [("in 1999 yes", "in 1998 no"), ("Same, text here", "Same text here!"), ("ok", "good")]))
    assert [r["n"] for r in d.select(cleaning.quality_notes().alias("n")).collect()] == ["different numbers in TUVs", "equal TUVs", "very short segments"]
    assert cleaning.corpus_stats(d).first() == Row(sentence_pairs=3, src_words=7, trg_words=7)
    freq = {r["word"]: r["n"] for r in cleaning.word_frequency(d.withColumnRenamed("src_text", "text")).collect()}
    assert freq == {}
    kept = cleaning.clean_parallel(pairs(spark, [("a |b  c", "d"), ("", "x"), ("a " * 81, "b " * 81), ("a", "b " * 10), ("x" * 1001, "y")])).collect()
    assert [(r["src_text"], r["trg_text"]) for r in kept] == [("a b c", "d")]
    roamed = cleaning.roam(pairs(spark, [("mail a@b.org now", "ip 1.2.3.4")] * 3), keep=1.0).first()
    assert roamed["src_text"] == "mail [EMAIL] now" and roamed["trg_text"] == "ip [IP]"


def test_sentences(spark):
    d = spark.createDataFrame([(1, "Mr. Smith came. He left! Did he? yes.\n\n12345"), (2, ""), (3, "One line. Two lines.")], "doc_idx long, text string")
    got = sentences.sentences(d).orderBy("doc_idx", "sent_idx").collect()
    assert [(r["doc_idx"], r["text"]) for r in got] == [(1, "Mr. Smith came."), (1, "He left!"), (1, "Did he? yes."), (2, None), (3, "One line."), (3, "Two lines.")]
    assert got[1]["paragraph_id"] == "p1:3s2/3" and got[4]["paragraph_id"] == "p1:1s1/2"


def test_aligners(spark):
    src = ["One small house.", "It has a door and two windows.", "Nobody lives there now."]
    trg = ["One small house.", "It has a door.", "And two windows.", "Nobody lives there now."]
    beads = [(i, j, di, dj) for i, j, di, dj, _ in sentences.length_rungs(src, trg)]
    assert beads == [(0, 0, 1, 1), (1, 1, 1, 2), (2, 3, 1, 1)]
    assert [(i, j) for i, j, _ in sentences.bleu_rungs(src, trg, 0.3)] == [(0, 0), (1, 1), (2, 3)] or [(i, j) for i, j, _ in sentences.bleu_rungs(src, trg, 0.3)][0] == (0, 0)
    assert sentences.length_rungs([], ["x"]) == [(0, 0, 0, 1, -0.3)] and sentences.bleu_rungs([], ["x"]) == []
    v = np.eye(3)
    assert [(i, j) for i, j, di, dj, _ in sentences.vector_rungs(v, v) if di and dj] == [(0, 0), (1, 1), (2, 2)]
    d = spark.createDataFrame([("u", "v", src, trg, src)], "src_url string, trg_url string, src_sents array<string>, trg_sents array<string>, translated_sents array<string>")
    got = sentences.align(d, "length").collect()
    assert [r["trg_text"] for r in got][1] == "It has a door. And two windows." and got[1]["trg_sentences"] == [1, 2]
    rungs = spark.createDataFrame([("u", "v", k, i, j, s, ["a", "b", "c"], ["x", "y"]) for k, i, j, s in ((0, 0, 0, 0.5), (1, 2, 1, -0.3), (2, 2, 2, 0.4), (3, 3, 2, 0.0))], "src_url string, trg_url string, rung_no int, src_pos int, trg_pos int, score double, src_sents array<string>, trg_sents array<string>")
    assert [(r["src_text"], r["trg_text"]) for r in sentences.decode_rungs(rungs).orderBy("rung_no").collect()] == [("a b", "x"), ("", "y"), ("c", "")]
    h = spark.range(1).select(sentences.deferred_hash(F.array(F.lit("a"), F.lit("b"))).alias("h")).first()["h"]
    assert h.count("+") == 1


def test_training(spark):
    corpus = spark.createDataFrame([(1, "the house", "das haus"), (2, "the book", "das buch"), (3, "a book", "ein buch")], "pair_id long, src_text string, trg_text string")
    t = {(r["s"], r["t"]): r["p"] for r in training.ibm1(corpus, 8).collect()}
    assert t["book", "buch"] > 0.8 and t["house", "haus"] > 0.7
    assert all(abs(sum(p for (s, _), p in t.items() if s == w) - 1) < 1e-9 for w in {s for s, _ in t})
    back = training.ibm1(corpus.select("pair_id", F.col("trg_text").alias("src_text"), F.col("src_text").alias("trg_text")), 8)
    lex = {(r["src_word"], r["trg_word"]) for r in training.symmetrise(training.ibm1(corpus, 8), back, 0.6).collect()}
    assert ("book", "buch") in lex and ("house", "buch") not in lex
    rng = random.Random(1)
    rows = [tuple([rng.random() * (0.3 if y == 0 else 1) + 0.3 * y for _ in training.FEATURES] + [float(y), i, i]) for i, y in enumerate([0, 1] * 40)]
    d = spark.createDataFrame(rows, training.FEATURES + ["label", "src_idx", "trg_idx"])
    model = training.train_ranker(d, trees=10)
    ranked = training.rank(d, model).join(d, ["src_idx", "trg_idx"])
    assert ranked.filter("(rank_score > 0.5) = (label = 1)").count() >= 76
    assert abs(sum(training.importances(model).values()) - 1) < 1e-6
    assert training.with_negatives(pairs(spark, [(f"s{i}", f"t{i}") for i in range(20)])).groupBy("label").count().count() == 2


def test_relational(spark):
    lines = spark.createDataFrame([(i, x) for i, x in enumerate("abcdef")], "line_no long, line string")
    got = [r["line"] for r in docjoin.interleave(lines, 2).orderBy("line_no").collect()]
    assert got == list("adbecf")
    with pytest.raises(Exception, match="divide"):
        docjoin.interleave(lines, 4).collect()
    d = spark.createDataFrame([(1, "x", 2), (2, "x", 1), (3, None, 5), (4, None, 4)], "id long, k string, o long")
    assert {r["id"] for r in docjoin.first_seen(d, "k", ["o"]).collect()} == {2, 4}
    m = spark.createDataFrame([(1, 9)], "src_idx long, trg_idx long")
    assert docjoin.missing_rows(m, d.withColumnRenamed("id", "doc_idx"), d.withColumnRenamed("id", "doc_idx")).count() == 1
    assert docjoin.column_numbers(d, ["o", "id"]) == [3, 1]
    assert docjoin.cut_columns(d, ["o", "id"], keep_order=True).columns == ["id", "o"]
    v = spark.createDataFrame([(0, 1, [1.0, 0.0]), (0, 2, [0.0, 1.0]), (1, 3, [1.0, 0.0])], "shard int, src_idx long, vector array<double>")
    best = embeddings.best_in_shard(v, v.withColumnRenamed("src_idx", "trg_idx"), 1).collect()
    assert {(r["src_idx"], r["trg_idx"]) for r in best} == {(1, 1), (2, 2), (3, 3)}
    near = embeddings.near_in_space(v, v.withColumnRenamed("src_idx", "trg_idx"), 0.1)
    assert {(r["src_idx"], r["trg_idx"]) for r in near.collect()} >= {(1, 1), (1, 3)}


def test_config():
    assert Config.of({"lang1": "en", "lang2": "de"}).max_df == 10_000
    for bad in ({"nope": 1}, {"lang1": "en", "lang2": "en"}, {"until": "x"}, {"ngram": "2"}, {"segment_aligner": "vector"}, {"document_aligner": "lexicon"}, {"granularity": ["documents"]}, {"segment_aligner": "length"}, {"direction": "xx2yy"}):
        with pytest.raises(ValueError):
            Config.of(bad)
    assert Config.of({"direction": "fr2en"}).swapped


def test_pipeline(spark):
    body = "<p>This house has a red door and two very large windows. Nobody lives in the old house now.</p>"
    rows = [(1, "http://a.org/en", f'<html lang="en">{body}</html>'), (2, "http://a.org/fr", f'<html lang="fr">{body}<p>Autre phrase entre nous et le monde.</p></html>'), (3, "http://b.org/fr", '<html lang="fr"><p>Rien de commun avec les autres pages du site.</p></html>'), (4, "http://a.org/x.gif", '<html lang="en"></html>'), (5, "http://b.org/q", '<html lang="en"><p>Something else entirely on this other page here.</p></html>')]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    config = {"min_df": 1, "score_pairs": False, "elrc": True}
    assert pipeline.run(pages, Config.of({**config, "until": "preprocess"})).count() == 4
    out = pipeline.run(pages, Config.of(config)).collect()
    assert {(r["src_url"], r["trg_url"]) for r in out} == {("http://a.org/en", "http://a.org/fr")} and len(out) == 2
    assert {"near_dup_hash", "length_ratio", "src_urls"} <= set(out[0].asDict())
    lexical = pipeline.run(pages, Config.of({"document_aligner": "lexicon", "segment_aligner": "length", "until": "docalign", "doc_threshold": 0.2})).collect()
    assert (1, 2) in {(r["src_idx"], r["trg_idx"]) for r in lexical}


def test_streaming(spark, tmp_path):
    source, table, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    spark.createDataFrame([(1, "a b"), (2, "a  b"), (3, "c")], "doc_id long, text string").coalesce(1).write.parquet(source)
    new = lambda: dedup.new_texts(dedup.read_documents(spark, source, "doc_id long, text string"))
    dedup.append_unseen(new(), table, state).awaitTermination()
    assert spark.read.parquet(table).count() == 2
    spark.createDataFrame([(4, "c"), (5, "d")], "doc_id long, text string").coalesce(1).write.mode("append").parquet(source)
    dedup.append_unseen(new(), table, state).awaitTermination()
    assert {r["text"] for r in spark.read.parquet(table).collect()} == {"a b", "c", "d"}


def test_partitions_dont_change_results(spark):
    rng = random.Random(5)
    src = [" ".join(rng.choice("abcdefg") for _ in range(10)) for _ in range(20)]
    d = documents(spark, src, src[::-1])
    key = lambda x: sorted((r["src_idx"], r["trg_idx"], round(r["score"], 9)) for r in x.collect())
    assert key(tfidf.similarity(d.repartition(1))) == key(tfidf.similarity(d.repartition(7)))


@pytest.mark.parametrize("n", [4, 10, 11])
def test_interleaved_blocks_of_any_number_of_lines(spark, tmp_path, n):
    import duckdb

    table = f"{tmp_path}/documents.parquet"
    spark.createDataFrame([(i, f"l{i}") for i in range(n)], "doc_id long, lang string").coalesce(1).write.parquet(table)
    want = duckdb.execute(queries.ORACLES["interleave_blocks"].replace("documents", f"'{table}/*.parquet'")).fetchall()
    got = [tuple(r) for r in queries.interleave_blocks(spark, str(tmp_path)).collect()]
    assert sorted(got) == sorted(want) and len(got) == n


@pytest.mark.parametrize("block", [4, 1000])
def test_best_in_shard_in_blocks(spark, block):
    """Equal scores, zero and null vectors, other lengths; every pair is scored, and none leaves its block but the best."""
    rng = random.Random(5)
    rows = [(i % 2, i, [float(rng.randint(-2, 2)) for _ in range(3)]) for i in range(60)] + [(0, 60, [0.0] * 3), (0, 61, None), (1, 62, [1.0, 2.0]), (None, 63, [1.0] * 3), (3, 64, [1.0] * 3), (3, 65, [2.0] * 3)]
    d = spark.createDataFrame(rows, "shard int, id long, vector array<double>")
    src, trg = d.filter("id % 2 = 0 or shard = 1").withColumnRenamed("id", "src_idx"), d.withColumnRenamed("id", "trg_idx")

    def cosine(a, b):
        if not a or not b or len(a) != len(b) or not any(a) or not any(b):
            return None
        return sum(x * y for x, y in zip(a, b)) / math.sqrt(sum(x * x for x in a)) / math.sqrt(sum(x * x for x in b))

    want = set()
    for s, i, a in rows:
        if s is not None and (i % 2 == 0 or s == 1):
            pairs = sorted((c is None, -round(c, 6) if c is not None else 0.0, j) for t, j, b in rows if t == s for c in [cosine(a, b)])
            want |= {(s, i, j, None if none else round(-c, 6) + 0.0, rank) for rank, (none, c, j) in enumerate(pairs[:3], 1)}
    out = embeddings.best_in_shard(src, trg, 3, block_rows=block)
    got = {(r["shard"], r["src_idx"], r["trg_idx"], None if r["score"] is None else round(r["score"], 6) + 0.0, r["rank"]) for r in out.collect()}
    assert got == want
    assert "FlatMapCoGroupsInArrow" in out._jdf.queryExecution().executedPlan().toString()


def test_new_texts_are_read_by_as_many_tasks_as_the_scan(spark, tmp_path, monkeypatch):
    d = spark.createDataFrame([(i, f"text {i % 30}") for i in range(60)], "doc_id long, text string").repartition(6)
    d.write.parquet(f"{tmp_path}/documents.parquet")
    seen, cut = [], matching.cut_lineage
    monkeypatch.setattr(matching, "cut_lineage", lambda df: (seen.append(df.rdd.getNumPartitions()), cut(df))[1])
    before = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", str(256 << 20))
    try:
        assert queries.streaming_new_texts(spark, str(tmp_path)).first()["texts"] == 30
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", before)
    assert seen == [6]


def test_noise_is_counted_by_the_marks_and_not_the_letters(spark):
    """Each match of the pattern costs, so what it matches must be the rarer kind."""
    import re

    from lingweave.functions import text

    assert re.findall(text.NOISE, "Ab, c. (1)") == [",", ".", "(1)"]


@pytest.mark.parametrize(("least", "most", "threshold"), [(2, 1000, 0.1), (2, 5, 0.05), (1, 1000, 0.0), (3, 4, 0.3)])
def test_similarity_in_blocks(spark, monkeypatch, least, most, threshold):
    """Several buckets, blocks of targets, chunks of sources and slices of meetings give the pairs of brute force, and no meeting moves."""
    for name, n in {"BUCKET": 100, "TARGETS": 40, "CHUNK": 3, "ROW": 30, "MEETINGS": 7, "CELLS": 20}.items():
        monkeypatch.setattr(tfidf, name, n)
    rng = random.Random(3)
    text = lambda: " ".join(rng.choice("a b c d e f g h".split()) for _ in range(rng.randint(0, 25)))
    src, trg = [text() for _ in range(25)], [text() for _ in range(25)]
    want = expected_pairs(src, trg, least, most, threshold)
    out = tfidf.similarity(documents(spark, src, trg), 2, least, most, threshold)
    got = {(r["src_idx"], r["trg_idx"]): r["score"] for r in out.collect()}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k], abs=1e-9) for k in want) and want
    assert "ngram" not in out._jdf.queryExecution().executedPlan().toString()


def test_term_queries_move_terms_once(spark, tmp_path):
    rng = random.Random(8)
    rows = [(i, " ".join(rng.choice("a b c d e f".split()) for _ in range(rng.randint(0, 12)))) for i in range(40)] + [(7, "a b c"), (9, None)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    w = queries.tfidf_weights(spark, str(tmp_path))
    plan = w._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    assert plan.count("Exchange hashpartitioning") == 2 and "Join " not in plan.replace("CartesianProduct", "").replace("BroadcastNestedLoopJoin ", "")
    norms = {(r["side"], r["doc_idx"]): r["norm"] for r in queries.doc_norms(spark, str(tmp_path)).collect()}
    want = {(r["side"], r["doc_idx"]): r["norm"] for r in tfidf.norms(w).collect()}
    assert norms.keys() == want.keys() and all(norms[k] == pytest.approx(want[k], abs=2e-6) for k in want)
    assert "ngram" not in queries.doc_norms(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    plan = queries.doc_freq_pruned(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(side" in plan and not any("ngram" in x and "side" in x for x in plan.splitlines() if "hashpartitioning" in x)


def test_only_matched_documents_move(spark):
    d = spark.createDataFrame([(i, f"t{i}") for i in range(50)], "doc_idx long, text string")
    m = spark.createDataFrame([(1, 2, 0.5), (3, 4, 0.7), (5, 99, 0.1)], "src_idx long, trg_idx long, score double")
    out = docjoin.join_documents(m, d, d, ["text"])
    assert sorted(map(tuple, out.collect())) == [(2, 1, 0.5, "t1", "t2"), (4, 3, 0.7, "t3", "t4")] and out.columns == ["trg_idx", "src_idx", "score", "src_text", "trg_text"]
    assert out._jdf.queryExecution().optimizedPlan().toString().count("strategy=broadcast") == 2


def test_pages_are_python_objects_a_few_at_a_time(spark):
    from lingweave.functions import text

    d = spark.range(0, 300, 1, 1).select(F.when(F.col("id") != 5, F.col("id").cast("string")).alias("s"))
    assert [r[0] for r in d.select(text.in_python(lambda s: s and s + "x", "string", F.col("s"), rows=7)).collect()] == [None if i == 5 else f"{i}x" for i in range(300)]
    f = {"url": F.lit("u"), "links": F.array(F.lit("l"))}
    plan = d.select(html.html_to_text(F.col("s")), features.tag_string("s"), features.resolved_links(f["url"], f["links"]), features.structure_similarity("s", "s"))._jdf.queryExecution().optimizedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" in plan
