"""Registered queries and the whole run read all that they should."""

import collections

import pytest

from pyspark.sql import functions as F

from lingweave.operators import sentences, training
from lingweave.plans import pipeline, queries
from lingweave.plans.config import Config
from lingweave.sources import html, warc


def em(pairs, rounds):
    """IBM model 1 by plain loops, from the start value 1."""
    counts = [(collections.Counter(a.split()), collections.Counter(b.split())) for a, b in pairs]
    p = {(s, t): 1.0 for a, b in counts for s in a for t in b}
    for _ in range(rounds):
        c = collections.Counter()
        for a, b in counts:
            for t, m in b.items():
                z = sum(p[s, t] * n for s, n in a.items())
                for s, n in a.items():
                    c[s, t] += p[s, t] * n * m / z
        total = collections.Counter()
        for (s, _), v in c.items():
            total[s] += v
        p = {(s, t): v / total[s] for (s, t), v in c.items()}
    return p


def test_ibm1_lexicon_trains_on_segments_of_80_words_in_5_rounds(spark, tmp_path):
    words = lambda x, n: " ".join(f"{x}{i}" for i in range(n))
    turns = [(1, 0, words("a", 60)), (1, 1, words("b", 80)), (2, 0, words("a", 5)), (2, 1, words("b", 4)), (3, 0, words("c", 81)), (3, 1, words("d", 3))]
    spark.createDataFrame(turns, "conv_id long, turn long, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    got = {(r["s"], r["t"]): r["p"] for r in queries.ibm1_lexicon(spark, str(tmp_path)).collect()}
    want = em([(turns[0][2], turns[1][2]), (turns[2][2], turns[3][2])], 5)
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k], rel=1e-6) for k in want)


def test_lexicon_alignment_ranks_by_page_features(spark, monkeypatch):
    """The pages' links, images and tags reach the ranking of the whole run."""
    seen = []
    rank = training.rank
    monkeypatch.setattr(training, "rank", lambda candidates, **options: (seen.append(candidates), rank(candidates, **options))[1])
    body = '<img src="a.png"><a href="http://a.org/en">x</a><a href="/q">Cathedral</a><p>House with two windows, number 77.</p>'
    rows = [(1, "http://a.org/en", f'<html lang="en">{body}</html>'), (2, "http://a.org/fr", f'<html lang="fr">{body}<p>Autre phrase.</p></html>')]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    config = Config.of({"document_aligner": "lexicon", "segment_aligner": "length", "until": "docalign"})
    pipeline.run(pages, config).collect()
    for candidates in seen:
        (r,) = candidates.collect()
        assert r["images_overlap_score"] == r["urls_overlap_score"] == 1 and 0 < r["structure_distance"] < 1
    assert sorted(c.collect()[0]["src_doc_linked_by_trg_doc"] for c in seen) == [0, 1]


def test_queries_without_sql_read_all_languages(spark, tmp_path):
    text = lambda n: "\n".join(f"mot{n}x{i} suite{n}x{i} fin{n}x{i}" for i in range(4))
    rows = [(2, text(1), "fr"), (3, text(1), "fr"), (4, text(2), "de"), (5, text(2), "de"), (6, text(3), "en"), (7, text(3), "en")]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").write.parquet(str(tmp_path / "documents.parquet"))
    for name in ("mutual_converge", "length_align"):
        got = queries.QUERIES[name](spark, str(tmp_path)).select("src_idx", "trg_idx").distinct().collect()
        assert {tuple(r) for r in got} == {(2, 3), (4, 5), (6, 7)}


def test_metadata_goes_along(spark):
    d = spark.createDataFrame([(1, "One here. Two there.\nThree of them.", "m1\nm2")], "doc_idx long, text string, style string")
    got = [(r["text"], r["style"], r["paragraph_id"]) for r in sentences.sentences(d, metadata=["style"]).collect()]
    assert got == [("One here.", "m1", "p1:2s1/2"), ("Two there.", "m1", "p1:2s2/2"), ("Three of them.", "m2", "p2:2s1/1")]
    pairs = spark.createDataFrame([("a", "b", ["x y", "same words"], ["x y same words"], ["1", None], ["9"])], "src_url string, trg_url string, src_sents array<string>, trg_sents array<string>, src_style array<string>, trg_style array<string>")
    rows = sentences.align(pairs, "length", metadata=["style"]).collect()
    assert [(r["src_style"], r["trg_style"]) for r in rows] == [("1+", "9")]


def test_splitter_in_python(spark):
    @F.pandas_udf("array<string>")
    def halves(lines):
        return lines.map(lambda x: x.split("|"))

    d = spark.createDataFrame([(1, "one more|two more\nthree more", "m1\nm2"), (2, "", "")], "doc_idx long, text string, style string")
    got = {(r["doc_idx"], r["sent_idx"], r["text"], r["style"], r["paragraph_id"]) for r in sentences.sentences(d, lambda c: halves(c), metadata=["style"]).collect()}
    assert got == {(1, 0, "one more", "m1", "p1:2s1/2"), (1, 1, "two more", "m1", "p1:2s2/2"), (1, 2, "three more", "m2", "p2:2s1/1"), (2, 0, None, None, None)}


def test_command_over_documents(spark):
    d = spark.createDataFrame([(1, "b a\nc"), (2, None), (3, "")], "doc_idx long, text string")
    assert [r["text"] for r in sentences.pipe(d, ["tr", "a-z", "A-Z"]).orderBy("doc_idx").collect()] == ["B A\nC", None, ""]
    assert [r["text"] for r in sentences.pipe(d, ["wc", "-w"], line_by_line=False).orderBy("doc_idx").collect()] == ["3\n", None, "0\n"]
    with pytest.raises(Exception, match="lines of"):
        sentences.pipe(d, ["head", "-n", "1"]).collect()


def test_languages_are_guessed(spark):
    texts = {"en": "this is the end of it", "fr": "il est dans le jardin avec une amie", "de": "der Hund ist nicht im Haus", "es": "los perros no se van del parque", None: "xyzzy 12"}
    d = spark.createDataFrame([(k, t) for k, t in texts.items()], "lang string, text string")
    assert all(r["lang"] == r["found"] for r in d.select("lang", html.guess_language(F.col("text")).alias("found")).collect())


def test_vectors_run(spark):
    body = "".join(f"<p>The number {i} of the story is told here at some length.</p>" for i in range(4))
    pages = spark.createDataFrame([(1, "http://a.example.com/en", f'<html lang="en">{body}</html>'), (2, "http://a.example.com/fr", f'<html lang="fr">{body}x</html>'), (3, "http://a.example.com/x", '<html lang="fr"><p>Zzz zzz zzz zzz.</p></html>')], "page_id long, url string, html string")
    letters = lambda s: F.transform(F.sequence(F.lit(97), F.lit(122)), lambda k: F.length(F.regexp_replace(F.lower(s), F.concat(F.lit("[^"), F.char(k), F.lit("]")), "")).cast("double"))
    run = lambda until: pipeline.run(pages, Config.of({"document_aligner": "vectors", "segment_aligner": "vector", "until": until}), encoder=lambda c: F.transform(c, letters))
    assert [(r["src_idx"], r["trg_idx"]) for r in run("docalign").collect()] == [(1, 2)]
    assert sorted(i for r in run("segalign").collect() for i in r["src_sentences"]) == [0, 1, 2, 3]


def test_large_blocks_are_skipped(spark, tmp_path):
    big = warc.record_bytes({"WARC-Type": "response", "WARC-Record-ID": "<big>"}, b"x" * 100_000) + warc.record_bytes({"WARC-Type": "response", "WARC-Record-ID": "<small>"}, b"y" * 10)
    (tmp_path / "a b.warc.gz").write_bytes(big + big[: len(big) // 2])
    rows = warc.read_warc(spark, str(tmp_path), 1000).collect()
    assert [(r["record_id"], r["block"] and bytes(r["block"])) for r in rows][:2] == [("<big>", None), ("<small>", b"y" * 10)]


def test_encodings_that_are_none(spark):
    d = spark.createDataFrame([(bytearray("é".encode("latin-1")), n) for n in ("undefined", "idna", "hex", "nothing", "latin-1", "u\0")], "b binary, n string")
    assert {r[0] for r in d.select(html.decode_bytes(F.col("b"), F.col("n"))).collect()} == {"é"}
