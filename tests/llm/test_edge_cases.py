"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing columns."""

import os
import random

import pytest
from pyspark.sql import functions as F

from lingweave.llm import decontaminate, exact_dedup, html_extract, langid, line_dedup, lm_score, packing, simhash, suffix_dedup, warc_derivatives
from lingweave.llm.queries import tokenizer_path

DOCS = "doc_id long, text string, lang string, source string, n_chars long, digest string, t string, h long, fp long, __gone long, n int, key long, kept string"
LONG = "alpha beta gamma delta " * 20_000
PASSAGE = " ".join(f"w{i}" for i in range(70))


def rows():
    texts = [None, "", "   ", "\n\n", LONG, "Same text.", "same TEXT.", PASSAGE + " x", "y " + PASSAGE, "1234 5678", "é" * 5000, "a"]
    return [(i, t, "en" if i % 2 else "fr", "s", 0, "d", "t", 1, 2, 3, 4, 5, "k") for i, t in enumerate(texts)] + [(None, "no id here at all", None, *["s", 0, "d", "t", 1, 2, 3, 4, 5, "k"])]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), DOCS).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def tests(spark):
    return spark.createDataFrame([(1, PASSAGE, "x"), (2, None, "x"), (3, "short", "x"), (4, "", "x")], "item_id long, text string, h string")


OPERATORS = {
    "exact": lambda d, t: exact_dedup.exact_dedup(d),
    "exact_keep": lambda d, t: exact_dedup.keep_unique(d),
    "simhash": lambda d, t: simhash.simhash_near_dups(d),
    "simhash_keep": lambda d, t: simhash.keep_one_of_each(d),
    "langid": lambda d, t: langid.identify(d, per_language=4, steps=3),
    "langid_keep": lambda d, t: langid.keep_identified(d, per_language=4, steps=3),
    "lm": lambda d, t: lm_score.lm_scores(d),
    "lm_routed": lambda d, t: lm_score.lm_scores(d, broadcast_bytes=0),
    "lines": lambda d, t: line_dedup.line_dedup(d),
    "suffix": lambda d, t: suffix_dedup.repeated_passages(d),
    "suffix_drop": lambda d, t: suffix_dedup.drop_repeats(d),
    "decontaminate": lambda d, t: decontaminate.overlaps(d, t),
    "decontaminate_keep": lambda d, t: decontaminate.drop_contaminated(d, t),
    "pack": lambda d, t: packing.pack(d, tokenizer_path()),
}
PER_ROW = {"exact", "simhash", "langid", "lm", "lm_routed", "lines", "suffix_drop"}


@pytest.mark.parametrize("name", OPERATORS)
def test_odd_rows(docs, tests, name):
    got = OPERATORS[name](docs, tests).collect()
    if name in PER_ROW:
        assert len(got) == len(rows())
    if name.endswith("_keep") or name == "suffix_drop":
        assert OPERATORS[name](docs, tests).columns == docs.columns


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(none, tests, name):
    assert OPERATORS[name](none, tests).count() == 0


@pytest.mark.parametrize("name", OPERATORS)
def test_repeated_rows(docs, tests, name):
    twice = docs.unionByName(docs)
    got = OPERATORS[name](twice, tests).count()
    if name in PER_ROW:
        assert got == 2 * len(rows())


def test_values(docs, tests):
    exact = {r["doc_id"]: r for r in exact_dedup.exact_dedup(docs).collect()}
    assert exact[5]["keep_id"] == 6 and not exact[5]["kept"] and exact[6]["kept"] and exact[5]["group_size"] == 2
    assert exact[0]["keep_id"] == 1 and exact[0]["text_sha256"] == exact[1]["text_sha256"]
    sim = {r["doc_id"]: r for r in simhash.simhash_near_dups(docs).collect()}
    assert sim[0]["fingerprint"] == "0" * 16 and sim[0]["n_near"] == 3 and sim[3]["component_id"] == 0
    assert sim[5]["fingerprint"] == sim[6]["fingerprint"] and sim[6]["component_id"] == 5
    lang = {r["doc_id"]: r for r in langid.identify(docs, per_language=4, steps=3).collect()}
    assert all(lang[i]["lang_pred"] == "und" for i in (0, 1, 2, 3, 9)) and lang[4]["lang_pred"] != "und"
    hit = decontaminate.overlaps(docs, tests).collect()
    assert {(r["doc_id"], r["item_id"], r["matched"]) for r in hit} == {(7, 1, 70), (8, 1, 70)}
    spans = suffix_dedup.repeated_passages(docs).filter("doc_id in (7, 8)").collect()
    assert {(r["doc_id"], r["first"], r["start_word"], r["n_words"]) for r in spans} == {(7, True, 0, 70), (8, False, 1, 70)}
    packed = packing.pack(docs, tokenizer_path()).filter("doc_id = 0").collect()
    assert [(r["piece"], r["start"], r["length"]) for r in packed] == [(0, 0, 1)]


def test_pages(spark):
    schema = "page_id long, url string, html string, text string, block string, headers string"
    pages = spark.createDataFrame([(1, None, None, "", "", ""), (2, "u", "", "", "", ""), (None, "u", "<p>a", "", "", ""), (4, "u", "<div>" * 3000 + "deep" + "</div>" * 3000, "", "", ""), (4, "u", "<<>>&&;<a", "", "", "")], schema)
    got = html_extract.extract(pages).collect()
    assert len(got) == 5 and {r["text"] for r in got} >= {"", "a", "deep"}
    assert html_extract.extract(pages.limit(0)).count() == 0
    made = warc_derivatives.derive(warc_derivatives.responses_of_pages(pages), ["page_id"])
    assert made.count() == 10 and made.filter("warc_type = 'conversion'").count() == 5
    assert warc_derivatives.derive(warc_derivatives.responses_of_pages(pages.limit(0))).count() == 0
    raw = spark.createDataFrame([(None, None, None, None), ("u", "d", '{"WARC-Record-ID": "<x>"}', bytearray(b"HTTP/1.1 200 OK\r\nContent-Type: image/png\r\n\r\nxx"))], "target_uri string, warc_date string, headers string, block binary")
    odd = warc_derivatives.derive(raw).collect()
    assert [r["warc_type"] for r in odd] == ["metadata", "metadata"] and odd[1]["refers_to"] == "<x>"


def test_paths_beyond_the_bounds(docs, tests, monkeypatch):
    """The ways taken when a broadcast would be too large give the same rows."""
    key = lambda d: sorted(map(repr, d.collect()))
    near = key(decontaminate.overlaps(docs, tests))
    monkeypatch.setattr(decontaminate, "BROADCAST_BYTES", 0)
    assert key(decontaminate.overlaps(docs, tests)) == near
    lines = key(line_dedup.line_dedup(docs))
    monkeypatch.setattr(line_dedup, "BROADCAST_LINES", -1)
    assert key(line_dedup.line_dedup(docs)) == lines
    exact = key(exact_dedup.exact_dedup(docs))
    monkeypatch.setattr(exact_dedup, "BROADCAST_IDS", -1)
    monkeypatch.setattr(exact_dedup, "SALT_ROWS", 1)
    assert key(exact_dedup.exact_dedup(docs, files_per_batch=1)) == exact
    assert key(suffix_dedup.repeated_passages(docs)) == key(suffix_dedup.repeated_passages(docs, hot_key=1))
    assert key(simhash.simhash_near_dups(docs)) == key(simhash.simhash_near_dups(docs, hot_bucket=1))


def test_digest_collisions_are_settled_by_bytes(spark):
    d = spark.createDataFrame([(1, "a"), (2, "b"), (3, "A"), (4, "b"), (5, "c")], "doc_id long, text string")
    got = exact_dedup.exact_dedup(d, digest=lambda c: F.lit(b"\0").cast("binary")).collect()
    assert {(r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in got} == {(1, 3, 2, False), (3, 3, 2, True), (2, 4, 2, False), (4, 4, 2, True), (5, 5, 1, True)}


def test_entry_lists_all():
    import __spark_entry__ as e

    names = set(e.queries())
    assert {n.split("_")[0] for n in names if n.startswith("op")} >= {f"op{i}" for i in range(1, 11)} and "pipeline" in names
    assert os.path.exists(tokenizer_path())


def test_http_payloads():
    import gzip
    import zlib

    page = "<p>Grüße, wie geht es?</p>".encode() * 3000
    raw = zlib.compressobj(wbits=-15)
    raw = raw.compress(page) + raw.flush()
    text = lambda extra, body, kind="text/html; charset=utf-8": warc_derivatives.derive_one({}, "u", None, f"HTTP/1.1 200 OK\r\nContent-Type: {kind}\r\n{extra}\r\n".encode() + body)[-1][-1]
    want = "\n".join(["Grüße, wie geht es?"] * 3000)
    assert text("", page) == want
    for coding, body in (("gzip", gzip.compress(page)), ("gzip", gzip.compress(page[:30000]) + gzip.compress(page[30000:])), ("deflate", zlib.compress(page)), ("deflate", raw), ("gzip", page)):
        assert text(f"Content-Encoding: {coding}\r\n", body) == want
    noise = random.Random(1).randbytes(200_000)
    torn = gzip.compress(page + b"<!--" + noise)
    assert text("Content-Encoding: gzip\r\n", torn[: len(torn) // 2]).startswith("Grüße, wie geht es?\nGrüße")
    chunks = b"".join(b"%x;x=y\r\n%s\r\n" % (len(page[i : i + 1000]), page[i : i + 1000]) for i in range(0, len(page), 1000)) + b"0\r\n\r\n"
    assert text("Transfer-Encoding: chunked\r\n", chunks) == want
    for size in (b"-6", b"+6", b"0x6", b"6_0", b"zz", b""):
        assert "Gr" in text("Transfer-Encoding: chunked\r\n", size + b"\r\n" + page)
    for name in ("undefined", "idna", "punycode", "no-such", "hex", "base64", "utf-8\0", "unicode_escape", "utf-16"):
        assert isinstance(text("", page, f"text/html; charset={name}"), str)


@pytest.mark.parametrize("headers", ["[1]", "{", "3", "null", '{"WARC-Record-ID": 5}', '{"a": null}'])
def test_odd_headers(spark, headers):
    d = spark.createDataFrame([("u", "d", headers, bytearray(b"HTTP/1.1 200 OK\r\n\r\nx"))], "target_uri string, warc_date string, headers string, block binary")
    assert [r["warc_type"] for r in warc_derivatives.derive(d).collect()] == ["metadata", "conversion"]


def test_repeated_ids(spark):
    """Rows that share an id are told apart by their texts, in either order, in every removal."""
    lines = [(1, "a\nb\nc\nd"), (2, "x\ny"), (2, "a\nb\nq"), (None, "no id\nat all")]
    for rows in (lines, lines[::-1]):
        got = line_dedup.line_dedup(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)).collect()
        assert sorted(map(repr, [(r["doc_id"], r["text"]) for r in got])) == sorted(map(repr, [(1, "a\nb\nc\nd"), (2, "x\ny"), (2, "q"), (None, "no id\nat all")]))
    texts = [(1, PASSAGE + " x"), (2, "kept as it is"), (2, "y " + PASSAGE), (None, "z z z")]
    for rows in (texts, texts[::-1]):
        d = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
        assert sorted(map(repr, map(tuple, suffix_dedup.drop_repeats(d).collect()))) == sorted(map(repr, [texts[0], texts[1], (2, "y "), texts[3]]))
    same = [(5, "Same"), (5, "SAME"), (5, "other"), (4, "same"), (None, "same"), (7, "twice"), (7, "twice"), (None, "alone"), (None, "alone")]
    kept = exact_dedup.keep_unique(spark.createDataFrame(same, "doc_id long, text string")).collect()
    assert sorted((r["text"].lower() for r in kept)) == ["alone", "other", "same", "twice"] and {r["doc_id"] for r in kept} == {5, 7, None}
    near = [(3, PASSAGE), (3, PASSAGE + " more"), (3, "something else altogether"), (8, PASSAGE), (9, "twice"), (9, "twice"), (None, PASSAGE)]
    kept = simhash.keep_one_of_each(spark.createDataFrame(near, "doc_id long, text string")).collect()
    assert len(kept) == 3 and {r["doc_id"] for r in kept} == {3, 9} and {r["text"] for r in kept if r["doc_id"] == 9} == {"twice"}


def test_exact_state_lasts(spark, tmp_path):
    """A second call adds rows to the kept state and looks former texts up by their locators."""
    state, table = f"file://{tmp_path}/state", f"file://{tmp_path}/texts"
    first = spark.createDataFrame([(1, "A"), (2, "b"), (9, "c")], "doc_id long, text string")
    first.write.parquet(table + "/1")
    one = spark.read.parquet(table + "/1")
    got = exact_dedup.exact_dedup(one, locator=exact_dedup.file_locator(), state=state).collect()
    assert {(r["doc_id"], r["keep_id"], r["kept"]) for r in got} == {(1, 1, True), (2, 2, True), (9, 9, True)}
    spark.createDataFrame([(5, "a"), (6, "B"), (7, "d"), (3, "C")], "doc_id long, text string").write.parquet(table + "/2")
    two = spark.read.parquet(table + "/2")
    former = spark.read.parquet(table + "/1").select("text", exact_dedup.file_locator().alias("locator"))
    got = exact_dedup.exact_dedup(two, locator=exact_dedup.file_locator(), state=state, earlier=former).collect()
    assert {(r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in got} == {(1, 5, 2, False), (5, 5, 2, True), (2, 6, 2, False), (6, 6, 2, True), (9, 9, 2, True), (3, 9, 2, False), (7, 7, 1, True)}
    with pytest.raises(Exception, match="leads to no text"):
        exact_dedup.exact_dedup(spark.createDataFrame([(8, "a")], "doc_id long, text string"), state=state).collect()


def test_null_ids_are_compared_by_bytes(spark):
    d = spark.createDataFrame([(None, "a"), (None, "b"), (1, "a")], "doc_id long, text string")
    got = exact_dedup.exact_dedup(d, digest=lambda c: F.lit(b"\0").cast("binary")).collect()
    assert sorted((str(r["doc_id"]), str(r["keep_id"]), r["group_size"]) for r in got) == [("1", "1", 2), ("None", "1", 2), ("None", "None", 1)]


def test_no_letters():
    assert not any(map(langid.has_letter, ["½ ² Ⅷ", "123", "__", "!?"])) and langid.has_letter("1a") and langid.has_letter("ß")


def test_language_stage_rejects(spark):
    """The pipeline's stage drops texts of no known language and random letters, and keeps the others."""
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rng = random.Random(5)
    bad = ["Съешь же ещё этих мягких французских булок, да выпей чаю и снова " * 5, "Η γλώσσα είναι ένα σύστημα επικοινωνίας που " * 6, "这是一个用于测试的中文句子没有任何特别的意义" * 6, "".join(rng.choice("abcdefghijklmnopqrstuvwxyz   ") for _ in range(600)), "".join(rng.choice("ABCDEFabcdefghijklmnopqrs0123456789+/") for _ in range(600)), "½ ² 12", None]
    more = spark.createDataFrame([(10**6 + i, t, None, "s", 0) for i, t in enumerate(bad)], d.schema)
    kept = {r["doc_id"] for r in langid.keep_identified(d.unionByName(more)).select("doc_id").collect()}
    gone = {r["doc_id"] for r in d.select("doc_id").collect()} - kept
    assert not any(k >= 10**6 for k in kept) and gone == set()
    english = {r["lang"] for r in langid.keep_identified(d, wanted=["en"]).join(d.select(F.col("doc_id"), F.col("lang").alias("l")), "doc_id").groupBy("lang").count().filter("count > 3").collect()}
    assert english == {"en"}
