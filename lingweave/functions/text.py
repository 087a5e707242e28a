"""Scalar text functions as Catalyst expressions: no Python runs per row."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: ASCII punctuation and digits: what the noise filter counts.
NOISE = r"[!-/:-@\[-`{-~0-9]+"
#: Marks stripped from both ends of a word: ASCII punctuation and the common Unicode ranges.
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~¡§«¶·»¿‐‑‒–—―‖‗‘’‚‛“”„‟†‡•‣․‥…‧‰′″‹›※‼‽⁂、。〈〉《》「」『』【】〔〕！＂＃％＆＇（）＊，－．／：；？＠［＼］＿｛｝｡｢｣､･"


def in_python(f: Callable, kind: str, *columns: Column | str, rows: int = 128) -> Column:
    """``f`` of each row's values, as Spark's type ``kind``. Of an Arrow batch only ``rows`` are Python objects at a time."""
    arrow = {"string": pa.string(), "array<string>": pa.list_(pa.string())}[kind]

    @F.arrow_udf(kind)
    def run(*values: pa.Array) -> pa.Array:
        parts = [pa.array([f(*x) for x in zip(*(v.slice(at, rows).to_pylist() for v in values))], arrow) for at in range(0, len(values[0]), rows)]
        return pa.concat_arrays(parts) if parts else pa.array([], arrow)

    return run(*columns)


def tokens(text: Column, separators: str = "[ \n]+") -> Column:
    """Non-empty pieces between separators."""
    return F.array_remove(F.split(text, separators), "")


def words(text: Column) -> Column:
    """Pieces between Unicode white space."""
    return F.array_remove(F.split(text, r"(?U)\s+"), "")


def word_tokens(text: Column) -> Column:
    """Lower-cased runs of letters and digits, and single other marks."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}_]+|[^\s\p{L}\p{N}_]"), 0)


def ngrams(t: Column, n: int) -> Column:
    """All runs of ``n`` tokens joined by a space; none where there are fewer tokens."""
    grams = t
    for k in range(1, n):
        grams = F.zip_with(F.slice(grams, 1, F.greatest(F.size(grams) - 1, F.lit(0))), F.slice(t, k + 1, F.greatest(F.size(t) - k, F.lit(0))), lambda a, b: F.concat(a, F.lit(" "), b))
    return F.when(F.size(t) >= n, grams).otherwise(F.array().cast("array<string>"))


_MARKS = "[" + "".join("\\" + c if c.isascii() else c for c in PUNCTUATION) + "]+"


def _plain_end(char: Column) -> Column:
    """True of ASCII letters and digits and of Latin letters beyond: none is among the marks."""
    c = F.ascii(char)
    return c.between(97, 122) | c.between(48, 57) | c.between(65, 90) | c.between(192, 591)


def strip_punctuation(word: Column) -> Column:
    """Most words have letters at both ends, or one mark at the last, which is cheap to see; the
    others go by a pattern."""
    first, last = _plain_end(word), F.substring(word, -1, 1)
    one = first & last.isin(*".,;:!?") & _plain_end(F.substring(word, -2, 1))
    return F.when(first & _plain_end(last), word).when(one, F.substring(word, F.lit(1), F.length(word) - 1)).otherwise(F.regexp_replace(word, f"^{_MARKS}|{_MARKS}$", ""))


def encode64(text: Column) -> Column:
    """Base64 on one line."""
    return F.translate(F.base64(F.encode(text, "UTF-8")), "\r\n", "")


def decode64(text: Column) -> Column:
    """Null where the text is no base64."""
    return F.decode(F.try_to_binary(text, F.lit("base64")), "UTF-8")


def normalise_space(text: Column) -> Column:
    """No-break spaces and runs of blanks become one space, lines lose their blanks, empty lines go."""
    c = F.translate(text, " \r", " ")
    c = F.regexp_replace(c, "[ \t\u000b\f]+", " ")
    c = F.regexp_replace(c, " *\n *", "\n")
    c = F.regexp_replace(c, "\n+", "\n")
    return F.btrim(c, F.lit(" \n"))


def normalise_markup(html: Column) -> Column:
    """Declared encodings go; no-break references and tabs become spaces."""
    c = F.regexp_replace(html, '(?i)encoding *= *"[^"]+"', "")
    return F.translate(F.replace(c, F.lit("&#160;"), F.lit(" ")), "\t", " ")


def strip_invalid_xml(text: Column) -> Column:
    return F.regexp_replace(text, r"[^\x09\x0A\x0D\x20-퟿-�\x{10000}-\x{10FFFF}]", "")


def escape_xml(text: Column) -> Column:
    c = text
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def unescape_tokens(text: Column) -> Column:
    """References that tokenisers write for quotes and ampersands."""
    c = text
    for a, b in (("&apos;", "'"), ("&quot;", '"'), ("&amp;", "&")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def links(html: Column) -> Column:
    return F.regexp_extract_all(html, F.lit(r"""href\s*=\s*['"]\s*([^'"]+)['"]"""), 1)


def images(html: Column) -> Column:
    return F.regexp_extract_all(html, F.lit(r"""<img [^>]*src\s*=\s*['"]\s*([^'"]+)['"]"""), 1)


def origin(url: Column) -> Column:
    """Scheme and host; empty where there is none."""
    return F.regexp_extract(url, r"(https?://[^/:]+)", 1)


def without_origin(text: Column, of: Column) -> Column:
    return F.when(origin(of) == "", text).otherwise(F.replace(text, origin(of), F.lit("")))


def host(url: Column) -> Column:
    return F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/@]*@)?([^/:?#]+)", 1)


def registered_domain(url: Column) -> Column:
    """The last two labels (three under a two-letter suffix of short second labels); blog hosts whole."""
    h = F.lower(host(url))
    blog = h.contains(".blogspot.") | h.contains(".wordpress.")
    three = F.regexp_extract(h, r"([^.]+\.(?:com?|org|net|gov|edu|ac)\.[a-z]{2})$", 1)
    two = F.regexp_extract(h, r"([^.]+\.[^.]+)$", 1)
    return F.when(blog, h).when(three != "", three).when(two != "", two).otherwise(h)


def jaccard(a: Column, b: Column) -> Column:
    """Of two lists as sets; 0 where both are empty."""
    return F.coalesce(F.try_divide(F.size(F.array_intersect(a, b)).cast("double"), F.size(F.array_union(a, b)).cast("double")), F.lit(0.0))


def edit_distance(a: Column, b: Column) -> Column:
    """Edits over the longer length; 0 where either is empty."""
    longer = F.greatest(F.length(a), F.length(b)).cast("double")
    return F.when((F.length(a) == 0) | (F.length(b) == 0), F.lit(0.0)).otherwise(F.try_divide(F.levenshtein(a, b).cast("double"), longer))


def tfidf(tf: Column, n: Column, df: Column) -> Column:
    return F.ln(tf + 1.0) * F.ln(n / (1.0 + df))


def digits_only(text: Column) -> Column:
    return F.regexp_replace(text, r"[^0-9]", "")


def letters_only(text: Column) -> Column:
    """Without white space, marks and signs, in any script."""
    return F.regexp_replace(text, r"(?U)\W", "")


def seconds(duration: Column) -> Column:
    """``<int><s|m|h|d|w>`` in seconds; null for any other form."""
    n = F.try_to_number(F.regexp_extract(duration, r"^(\d+)[smhdw]$", 1), F.lit("999999999999")).cast("long")
    unit = F.regexp_extract(duration, r"^\d+([smhdw])$", 1)
    return F.when(unit == "s", n).when(unit == "m", n * 60).when(unit == "h", n * 3600).when(unit == "d", n * 86400).when(unit == "w", n * 604800)


def number_paragraphs(text: Column) -> Column:
    """Each line followed by a tab and its number of how many, from 1."""
    lines = F.split(text, "\n")
    n = F.size(lines).cast("string")
    return F.array_join(F.transform(lines, lambda x, i: F.concat(x, F.lit("\t"), (i + 1).cast("string"), F.lit(":"), n)), "\n")


def join_lines(texts: list[Column], separator: str = "\t") -> Column:
    """Line by line; an error where the numbers of lines differ."""
    split = [F.split(t, "\n") for t in texts]
    out = split[0]
    for s in split[1:]:
        out = F.zip_with(out, s, lambda a, b: F.concat(a, F.lit(separator), b))
    same = F.lit(True)
    for s in split[1:]:
        same = same & (F.size(s) == F.size(split[0]))
    return F.when(same, F.array_join(out, "\n")).otherwise(F.raise_error(F.lit("texts differ in their number of lines")).cast("string"))


ISO_639_1 = {
    "Albanian": "sq", "Arabic": "ar", "Basque": "eu", "Bosnian": "bs", "Bulgarian": "bg", "Catalan": "ca", "Croatian": "hr", "Czech": "cs", "Danish": "da", "Dutch": "nl",
    "English": "en", "Estonian": "et", "Finnish": "fi", "French": "fr", "Galician": "gl", "German": "de", "Greek": "el", "Hungarian": "hu", "Icelandic": "is", "Irish": "ga",
    "Italian": "it", "Latvian": "lv", "Lithuanian": "lt", "Macedonian": "mk", "Maltese": "mt", "Montenegrin": "me", "Norwegian": "no", "Polish": "pl", "Portuguese": "pt",
    "Romanian": "ro", "Russian": "ru", "Serbian": "sr", "Slovak": "sk", "Slovenian": "sl", "Spanish": "es", "Swedish": "sv", "Turkish": "tr", "Ukrainian": "uk",
}


def language_code(name: Column) -> Column:
    """ISO 639-1 code of an English language name; Serbo-Croatian by its script; codes stay."""
    table = F.create_map(*[F.lit(x) for kv in ISO_639_1.items() for x in kv])
    serbo = F.when(name.endswith("Cyrillic"), "sr").otherwise("hbs")
    return F.when(name.startswith("Serbo_Croatian"), serbo).otherwise(F.coalesce(table[name], F.when(F.length(name) == 2, F.lower(name))))
