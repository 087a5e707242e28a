import gzip
import io
import lzma
import zipfile

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from lingweave.functions import text as T
from lingweave.operators import features
from lingweave.sinks import corpora
from lingweave.sources import files, html, warc


def value(spark, column, **row):
    return spark.createDataFrame([Row(**row)]).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(("text", "n", "grams"), [("Hello this is a test", 3, ["Hello this is", "this is a", "is a test"]), ("Hello this is a test", 5, ["Hello this is a test"]), ("Not enough", 5, []), ("a\nb  c", 2, ["a b", "b c"]), ("", 1, []), ("x", 1, ["x"])])
def test_ngrams(spark, text, n, grams):
    assert value(spark, T.ngrams(T.tokens(F.col("t")), n), t=text) == grams


def test_scalar_functions(spark):
    assert value(spark, T.normalise_space(F.col("t")), t=" a \t b\r \n \n\n c d\n") == "a b\nc d"
    assert value(spark, T.decode64(T.encode64(F.col("t"))), t="é" * 200) == "é" * 200
    assert value(spark, T.decode64(F.col("t")), t="@@@") is None
    assert "\n" not in value(spark, T.encode64(F.col("t")), t="x" * 200)
    assert value(spark, T.strip_punctuation(F.col("t")), t="«foo,»") == "foo"
    assert value(spark, T.normalise_markup(F.col("t")), t='<?xml encoding="x"?>a&#160;b\tc') == "<?xml ?>a b c"
    assert value(spark, T.escape_xml(F.col("t")), t="a<&>") == "a&lt;&amp;&gt;"
    assert value(spark, T.unescape_tokens(F.col("t")), t="&quot;a&apos;&amp;") == "\"a'&"
    assert [value(spark, T.seconds(F.col("t")), t=x) for x in ("3s", "2m", "1h", "1d", "1w", "5x", "")] == [3, 120, 3600, 86400, 604800, None, None]
    assert value(spark, T.number_paragraphs(F.col("t")), t="a\nb") == "a\t1:2\nb\t2:2"
    assert value(spark, T.strip_invalid_xml(F.col("t")), t="a\u0001b\n😀") == "ab\n😀"
    assert value(spark, T.edit_distance(F.lit("kitten"), F.lit("sitting")), t="") == 3 / 7
    assert value(spark, T.edit_distance(F.lit(""), F.lit("x")), t="") == 0
    assert value(spark, T.registered_domain(F.lit("http://www.a.co.uk/x")), t="") == "a.co.uk"
    assert value(spark, T.registered_domain(F.lit("http://my.blogspot.com:80/x")), t="") == "my.blogspot.com"
    assert value(spark, T.without_origin(F.lit("http://a.b/c http://a.b/d"), F.lit("http://a.b/c")), t="") == "/c /d"
    assert [value(spark, T.language_code(F.col("t")), t=x) for x in ("French", "Serbo_Croatian_Cyrillic", "Serbo_Croatian_Latin", "de", "Klingon")] == ["fr", "sr", "hbs", "de", None]


def test_line_join_fails_on_unequal_lines(spark):
    assert value(spark, T.join_lines([F.lit("a\nb"), F.lit("c\nd")]), t="") == "a\tc\nb\td"
    with pytest.raises(Exception, match="number of lines"):
        value(spark, T.join_lines([F.lit("a\nb"), F.col("t")]), t="c")


def test_page_features(spark):
    page = """<html><body><A HREF="no"><a href=" /x/y">1 2 3 4</a><a href='http://o.org/z'></a><img class=q src="i.png"><script>1</script></body></html>"""
    assert value(spark, T.links(F.col("t")), t=page) == ["/x/y", "http://o.org/z"]
    assert value(spark, T.images(F.col("t")), t=page) == ["i.png"]
    assert value(spark, features.resolved_links(F.lit("http://h.org/a/b"), T.links(F.col("t"))), t=page) == ["http://h.org/x/y", "http://o.org/z"]
    assert features.resolve("http://h.org/", "http://[bad") == "http://[bad"
    assert features.tags_of("plain") == " " and features.tags_of("") == " " and features.tags_of(None) == " "
    assert features.tags_of("<html><p>a b c d</p></html>") == "_html__p_" + "__" + "_p__html_"
    assert value(spark, features.structure_similarity(F.lit("_html__p_"), F.lit("_html__p_")), t="") == 1
    same = value(spark, T.jaccard(F.array(F.lit("a"), F.lit("b")), F.array(F.lit("b"), F.lit("c"))), t="")
    assert same == 1 / 3
    assert value(spark, T.jaccard(F.array().cast("array<string>"), F.array().cast("array<string>")), t="") == 0


def test_record_predicates(spark):
    urls = ["http://a/x.gif", "http://a/robots.txt", "http://a/x.GIF", "http://a/gif", "http://a/x.swf"]
    d = spark.createDataFrame([(u,) for u in urls], "u string")
    assert [r[0] for r in d.where(html.may_hold_text(F.col("u"))).collect()] == ["http://a/x.GIF", "http://a/gif"]
    r = spark.createDataFrame([("application/http", "text/html", 10), ("text/dns", None, 1), (None, "text/html", 1), ("x", "image/png", 1), ("x", "text/html", 5_242_881), ("x", "text/css", 1), ("x", None, 5)], "c string, h string, n long")
    assert r.where(html.acceptable_response(F.col("c"), F.col("h"), F.col("n"))).count() == 2
    langs = spark.createDataFrame([(x,) for x in ("en", "fr", "un", None, "de")], "l string")
    assert [x[0] for x in langs.where(html.wanted_languages(F.col("l"), ["%de"])).collect()] == ["en", "fr"]
    assert html.simple_text("<p>a<br>b<script>no</script><b>c</b>") == "\na\nb c "
    assert value(spark, html.html_to_text(F.col("t")), t="<p>a &amp; b</p><p>c</p>") == "a & b\nc"
    assert value(spark, html.decode_bytes(F.col("t"), F.lit("latin-1")), t=bytearray(b"\xe9")) == "é"
    assert value(spark, html.decode_bytes(F.col("t")), t=bytearray("é".encode())) == "é"


def test_warc(spark, tmp_path):
    one = {"WARC-Type": "response", "WARC-Target-URI": "<http://a/\tb>", "WARC-Record-ID": "<1>"}
    two = {"WARC-Type": "request", "WARC-Target-URI": "http://a/", "WARC-Record-ID": "<2>"}
    (tmp_path / "two.warc.gz").write_bytes(warc.record_bytes(one, b"HTTP/1.1 200 OK\r\n\r\n<p>x") + warc.record_bytes(two, b"GET"))
    (tmp_path / "torn.warc.gz").write_bytes(warc.record_bytes({**one, "WARC-Target-URI": "unknown"}, b"") + warc.record_bytes(two, b"GET" * 999)[:-20])
    got = warc.read_warc(spark, str(tmp_path))
    assert got.count() >= 3
    kept = warc.pages_of(got).collect()
    assert [(r["target_uri"], bytes(r["block"])[-4:]) for r in kept] == [("http://a/ b", b"<p>x")]
    assert files.split_every(got, 1, "record_no").agg(F.max("chunk")).first()[0] == 1


def test_files(spark, tmp_path):
    def packed(**parts):
        b = io.BytesIO()
        with zipfile.ZipFile(b, "w") as z:
            for k, v in parts.items():
                z.writestr(k.replace("__", "/").replace("_", "."), v)
        return b.getvalue()

    assert files.payloads("a.odt", packed(content_xml="<x/>", other_txt="no")) == [b"<x/>"]
    assert files.payloads("a.docx", packed(word__document_xml="w")) == [b"w"]
    assert files.payloads("a.pptx", packed(ppt__slides__slide1_xml="1", ppt__slides__slide2_xml="2")) == [b"1", b"2"]
    assert files.payloads("a.epub", packed(a_xhtml="a", b_css="b")) == [b"a"]
    assert files.payloads("a.odt", b"broken") == [] and files.payloads("a.html", b"<p>") == [b"<p>"]
    d = tmp_path / "site" / "sub"
    d.mkdir(parents=True)
    (d / "x.odt").write_bytes(packed(content_xml="<x/>"))
    (d / "y.html").write_bytes(b"<p>y")
    (d / "z.pdf").write_bytes(b"%PDF")
    got = {(r["url"], bytes(r["content"])) for r in files.read_directory(spark, str(tmp_path / "site")).collect()}
    assert got == {("sub/x.odt.converted", b"<x/>"), ("sub/y.html", b"<p>y")}
    with_pdf = files.read_directory(spark, str(tmp_path / "site"), pdf=lambda b: b"<pdf>")
    assert with_pdf.filter("url = 'sub/z.pdf.converted'").count() == 1
    pre = '<doc url="http://a" title="T" lang="French"><p class="good">a  b</p><p class="bad">c</p></doc>'
    (tmp_path / "p.gz").write_bytes(gzip.compress(pre.encode()))
    assert [(r["lang"], r["text"]) for r in files.read_prevertical(spark, str(tmp_path / "p.gz"), False).collect()] == [("fr", "a b")]
    (tmp_path / "l.xz").write_bytes(lzma.compress(b"one\ntwo\n"))
    assert [(r["line_no"], r["line"]) for r in files.read_lines(spark, str(tmp_path / "l.xz")).collect()] == [(0, "one"), (1, "two")]
    (tmp_path / "t.lett").write_text("en\ttext/html\tutf-8\thttp://www.a.org/x\tPHA+\te30=\n")
    assert files.read_lett(spark, str(tmp_path / "t.lett")).select("html", "text", "domain").first() == Row(html="<p>", text="{}", domain="a.org")
    for lang in ("en", "fr"):
        (tmp_path / f"c.{lang}.gz").write_bytes(gzip.compress(f"a {lang}\nb {lang}\n".encode()))
    assert {(r["src_text"], r["trg_text"]) for r in files.read_parallel(spark, [str(tmp_path / "c")], "en", "fr").collect()} == {("a en", "a fr"), ("b en", "b fr")}
    assert files.numbered_sources(["b.org"], ["a.org", "b.org"], 3) == [(4, "a.org"), (5, "b.org")]
    with pytest.raises(ValueError, match="no host"):
        files.numbered_sources(["-bad-"], [])


def test_sinks(spark, tmp_path):
    d = spark.createDataFrame([("u1", "v1", "a\tb", None)], "src_url string, trg_url string, src_text string, trg_text string")
    corpora.write_tsv(d, str(tmp_path / "t"))
    back = files.read_tsv(spark, str(tmp_path / "t")).first()
    assert (back["src_text"], back["trg_text"]) == ("a b", "")
    g = spark.createDataFrame([("a<b", "c", ["u2", "u1"], ["v"])], "src_text string, trg_text string, src_urls array<string>, trg_urls array<string>")
    unit = corpora.tmx_units(g, "en", "fr").first()["tu"]
    assert "<seg>a&lt;b</seg>" in unit and unit.count("source-document") == 3
    corpora.write_tmx(corpora.tmx_units(g, "en", "fr"), str(tmp_path / "m"), "en")
    import xml.etree.ElementTree as ET

    memories = [r["value"] for r in spark.read.text(str(tmp_path / "m"), wholetext=True).collect()]
    assert sum(len(ET.fromstring(m.encode()).findall(".//tu")) for m in memories) == 1
