"""Features of candidate document pairs from their pages and addresses."""

from __future__ import annotations

from html.parser import HTMLParser
from math import log2
from urllib.parse import urljoin, urlparse

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T


def page_features(pages: DataFrame, id_col: str = "doc_idx") -> DataFrame:
    """doc_idx and what the pair features read of a page: one pass, native but the tag string
    and the resolved links."""
    links = T.links(F.coalesce("html", F.lit("")))
    return pages.select(
        id_col,
        "url",
        links.alias("links"),
        T.images(F.coalesce("html", F.lit(""))).alias("images"),
        T.without_origin(F.array_join(links, ""), F.col("url")).alias("link_text"),
        T.without_origin(F.col("url"), F.col("url")).alias("path"),
        resolved_links("url", links).alias("targets"),
        tag_string("html").alias("tags"),
    )


def pair_features(candidates: DataFrame, src: DataFrame, trg: DataFrame, id_col: str = "doc_idx") -> DataFrame:
    """``candidates`` with the six page features. Each side's features are looked up once."""
    names = ["url", "links", "images", "link_text", "path", "targets", "tags"]
    side = lambda d, p: d.select(F.col(id_col).alias(f"{p}_idx"), *[F.col(c).alias(f"{p}_{c}") for c in names])
    both = candidates.join(side(src, "src"), "src_idx").join(side(trg, "trg"), "trg_idx")
    return both.select(
        *candidates.columns,
        T.jaccard(F.col("src_images"), F.col("trg_images")).alias("images_overlap_score"),
        structure_similarity("src_tags", "trg_tags").alias("structure_distance"),
        T.edit_distance(F.col("src_link_text"), F.col("trg_link_text")).alias("document_urls_distance"),
        F.array_contains("trg_targets", F.col("src_url")).cast("double").alias("src_doc_linked_by_trg_doc"),
        T.edit_distance(F.col("src_path"), F.col("trg_path")).alias("urls_distance"),
        T.jaccard(F.col("src_links"), F.col("trg_links")).alias("urls_overlap_score"),
    )


def resolve(base: str, link: str) -> str:
    """Against the page's address; links with a host, and malformed ones, stay as they are."""
    try:
        return link if urlparse(link).netloc else urljoin(base, link)
    except ValueError:
        return link


def resolved_links(url: str | Column, links: Column) -> Column:
    return T.in_python(lambda u, found: sorted({resolve(u or "", x) for x in found or []}), "array<string>", url, links)


class _Tags(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.out: list[str] = []
        self.skip = 0

    def handle_starttag(self, tag, attrs):
        if tag in ("script", "noscript"):
            self.skip += 1
        else:
            self.out.append(f"_{tag}_")

    def handle_endtag(self, tag):
        if tag in ("script", "noscript"):
            self.skip = max(0, self.skip - 1)
        else:
            self.out.append(f"_{tag}_")

    def handle_data(self, data):
        n = len(data.split())
        if n and not self.skip:
            self.out.append("_" * int(log2(n)))


def tags_of(html: str | None) -> str:
    """Tags and text lengths of a page; one space for what is no HTML."""
    parser = _Tags()
    try:
        parser.feed(html or "")
        parser.close()
    except (AssertionError, ValueError):
        return " "
    text = "".join(parser.out)
    parts = text.split("_")
    return text if len(parts) >= 2 and parts[1].endswith("ml") and text.isascii() else " "


def tag_string(html: str | Column) -> Column:
    return T.in_python(tags_of, "string", html)


def encode_tags(text: str, alphabet: dict[str, str]) -> str:
    """A character for each distinct tag from 32 on, but 95, which stands for text."""
    out = []
    for part in text.split("_"):
        if not part:
            out.append("_")
            continue
        if part not in alphabet:
            code = 32 + len(alphabet)
            alphabet[part] = chr(code + (code >= 95))
        out.append(alphabet[part])
    return "".join(out)


def structure_similarity(src: str | Column, trg: str | Column, per_side: bool = False) -> Column:
    """1 - edits / longer length of the tag strings. Both sides share one alphabet;
    ``per_side`` gives each its own. Encoding runs in Arrow batches, the distance natively."""

    def encoder(shared: bool, which: int):
        def one(x: str | None, y: str | None) -> str:
            alphabet: dict[str, str] = {}
            first = encode_tags(x or " ", alphabet)
            second = encode_tags(y or " ", alphabet if shared else {})
            return (first, second)[which]

        return T.in_python(one, "string", src, trg)

    s, t = encoder(not per_side, 0), encoder(not per_side, 1)
    longer = F.greatest(F.length(s), F.length(t)).cast("double")
    return 1.0 - F.coalesce(F.try_divide(F.levenshtein(s, t).cast("double"), longer), F.lit(0.0))
