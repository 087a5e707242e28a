"""Pages as rows: predicates on records, markup to text, encodings, boilerplate."""

from __future__ import annotations

from collections.abc import Callable
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T

#: Case-sensitive ends of addresses that hold no text.
NO_TEXT = r"(\.gif|\.jpg|\.jpeg|\.png|\.css|\.js|\.mp3|\.mp4|\.ogg|\.midi|\.swf|/robots\.txt)$"
NO_TEXT_TYPES = r"(?i)^(image/|audio/|video/|font/|.*(javascript|/css|flash|octet-stream|font))"
MOST_BYTES = 5_242_880


def may_hold_text(url: Column) -> Column:
    return ~url.rlike(NO_TEXT)


def acceptable_response(content_type: Column, http_type: Column, length: Column) -> Column:
    return content_type.isNotNull() & (content_type != "text/dns") & (length <= MOST_BYTES) & ~F.coalesce(http_type.rlike(NO_TEXT_TYPES), F.lit(False))


_BREAKS = frozenset("p div h1 h2 h3 h4 h5 h6 ul ol li table tr td th dl dt dd pre blockquote form section article header footer main aside nav address fieldset figure title body html".split())


class _Simple(HTMLParser):
    """A line break at both ends of block tags and at br and hr; a space at other ends."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.out: list[str] = []
        self.mute: str | None = None

    def handle_starttag(self, tag, attrs):
        if tag in ("script", "noscript", "style"):
            self.mute = tag
        if tag in _BREAKS or tag in ("br", "hr"):
            self.out.append("\n")

    def handle_endtag(self, tag):
        if tag == self.mute:
            self.mute = None
        self.out.append("\n" if tag in _BREAKS else " ")

    def handle_data(self, data):
        if self.mute is None:
            self.out.append(data)


def simple_text(html: str | None) -> str:
    parser = _Simple()
    try:
        parser.feed(html or "")
        parser.close()
    except (AssertionError, ValueError):
        pass
    return "".join(parser.out)


def html_to_text(html: Column) -> Column:
    return T.normalise_space(T.in_python(simple_text, "string", html))


def decode_bytes(data: Column, declared: Column | None = None) -> Column:
    """UTF-8 where it is, else the declared encoding, else the first of a list that fits."""

    @F.pandas_udf("string")
    def run(blocks: pd.Series, names: pd.Series) -> pd.Series:
        def one(b, name):
            if b is None:
                return None
            for e in ["utf-8", name, "windows-1252", "iso-8859-1"]:
                try:
                    if e:
                        return bytes(b).decode(e)
                except (UnicodeError, LookupError, ValueError):  # 'undefined' and 'idna' are names too
                    continue
            return None

        return pd.Series([one(b, n) for b, n in zip(blocks, names)])

    return run(data, declared if declared is not None else F.lit(None).cast("string"))


def unescape(text: Column) -> Column:
    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        from html import unescape as decode

        return texts.map(lambda t: None if t is None else decode(t))

    return run(text)


def without_boilerplate(html: Column) -> Column:
    """Native: menus, scripts, styles, asides, footers and forms go, markup included."""
    c = html
    for tag in ("script", "style", "nav", "aside", "footer", "form", "noscript"):
        c = F.regexp_replace(c, rf"(?is)<{tag}\b.*?</{tag}\s*>", " ")
    return F.regexp_replace(c, r"(?s)<!--.*?-->", " ")


def plain_text(html: Column) -> Column:
    """Native: markup becomes blanks, block ends line breaks, the common references characters."""
    c = F.regexp_replace(without_boilerplate(html), r"(?i)<(?:/?(?:p|div|li|ul|h[1-6]|article|body|tr|table|title|head|html)|br|hr)\b[^>]*>", "\n")
    c = F.regexp_replace(c, r"<[^>]*>", " ")
    for a, b in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&amp;", "&")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return T.normalise_space(c)


def page_language(html: Column) -> Column:
    return F.lower(F.regexp_extract(html, r"(?i)<html[^>]*\blang\s*=\s*[\"']?([a-zA-Z]{2,3})", 1))


#: Frequent short words by language, for :func:`guess_language`.
COMMON_WORDS = {
    "de": "der die das und ist nicht ein eine zu den von mit auf für sich dem auch als",
    "en": "the and of to in is that it was for on with as be this are by not",
    "es": "el los las que y en un una por con para no se del es lo como más",
    "fr": "le les des et est un une que dans pour pas sur qui au avec ce il du",
    "it": "il che di e la un una per non sono con del della gli nel anche come si",
    "nl": "de het een van en in is dat op te zijn met voor niet aan er ook maar",
    "pt": "o os as que e em um uma para com não se do da por mais dos ao",
}


def guess_language(text: Column) -> Column:
    """Native default of a detector: the language most of whose frequent words the text uses; of equal
    ones the first by name; null where it uses none. Any Column function of the text takes its place."""
    frequent = F.array(*[F.struct(F.lit(-i).alias("i"), F.lit(lang).alias("lang"), F.split(F.lit(w), " ").alias("w")) for i, (lang, w) in enumerate(COMMON_WORDS.items())])
    # the text's words as a lambda's variable are split once
    score = lambda words: F.array_max(F.transform(frequent, lambda f: F.struct(F.size(F.array_intersect(words, f["w"])).alias("n"), f["i"].alias("i"), f["lang"].alias("lang"))))
    best = F.get(F.transform(F.array(F.array_distinct(T.words(F.lower(text)))), score), F.lit(0))
    return F.get(F.transform(F.filter(F.array(best), lambda x: x["n"] > 0), lambda x: x["lang"]), F.lit(0))


def wanted_languages(lang: Column, include: list[str] | None = None) -> Column:
    """By a list of codes; ``%``-prefixed ones are banned; 'un' never passes."""
    include = include or []
    banned = [x[1:] for x in include if x.startswith("%")]
    wanted = [x for x in include if not x.startswith("%")]
    ok = lang.isNotNull() & (lang != "un") & (lang != "")
    ok = ok & lang.isin(wanted) if wanted else ok
    return ok & ~lang.isin(banned) if banned else ok


def preprocess(pages: DataFrame, include: list[str] | None = None, deboilerplate: bool = False, seen: DataFrame | None = None, keep_html: bool = False, detect: Callable[[Column], Column] | None = None) -> DataFrame:
    """url, lang, text, text_hash: filters, normalises, extracts and keeps the first page of each text. ``detect``
    tells a text's language; without it the page's own claim does, and :func:`guess_language` where it has none.
    ``seen`` (text_hash) are texts of a former crawl. With ``keep_html`` also html, as given."""
    html = T.normalise_markup(F.col("html"))
    out = pages.where(may_hold_text(F.col("url"))).select("page_id", "url", html.alias("html"), *[F.col("html").alias("raw")] * keep_html)
    out = out.withColumn("text", plain_text(F.col("html")) if deboilerplate else html_to_text(F.col("html"))).where("text <> ''")
    claimed = F.nullif(page_language(F.col("html")), F.lit(""))
    out = out.withColumn("lang", detect(F.col("text")) if detect else F.coalesce(claimed, guess_language(F.col("text")))).where(wanted_languages(F.col("lang"), include))
    out = out.withColumn("text_hash", F.xxhash64("text"))
    if seen is not None:
        out = out.join(seen.select("text_hash"), "text_hash", "left_anti")
    best = out.groupBy("text").agg(F.min_by(F.struct("page_id", "url", "lang", "text_hash", *["raw"] * keep_html), "page_id").alias("b"))
    return best.select("b.page_id", "b.url", "b.lang", "text", "b.text_hash", *[F.col("b.raw").alias("html")] * keep_html)
