"""Main-text extraction by composite text density (Sun, Song and Liao, "DOM based
content extraction via text density", SIGIR 2011).

A page is parsed into a tree. Every node gets its link-adjusted characters per tag, the composite
text density, and the node whose children's densities have the largest sum is the content. The least
density on the way from that node to the body is the threshold that admits subtrees beside it, if
they, or their children on average, are also as dense as that node's children on average.
Elements, roles and names that tell of menus, comments, notices and the like weigh a subtree's
densities down; within the content such a part goes unless it is as dense as the content or nearly all of it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape
from math import e, log

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)""", re.S
)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))|([^\s=/"'>]+)""")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Their content is no markup.
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul".split()
)
_CONTAINERS = frozenset("article body div main section td html center".split())
#: Never text of an article.
_NO_TEXT = frozenset("script style noscript template head title button select option textarea input iframe object svg canvas map audio video applet noframes".split())
_ASIDE_TAGS = frozenset("nav footer aside form dialog menu search".split())
_ASIDE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
_STRONG_NAMES = "ads?|advert\\w*|adsense|adbox|adslot|sponsor\\w*|nav|navbar|navigation|menu\\w*|breadcrumbs?|sidebar\\w*|side-?bar|footer\\w*|masthead|topbar|comments?|commentlist|respond|replies|disqus\\w*|cookies?|consent\\w*|gdpr|popup|newsletter|subscri\\w*|signup|login|share|sharing|social\\w*|pagination|pager|toolbar|skip-?link"
_WEAK_NAMES = "promo\\w*|banner|aside|header|discussion|notices?|modal|overlay|related|recommend\\w*|widgets?|disclaimer|copyright"
_NAMES = re.compile(rf"(?:^|[\s_-])(?:({_STRONG_NAMES})|(?:{_WEAK_NAMES}))(?:$|[\s_-])", re.I)
#: Marks of a node, and what they weigh.
PLAIN, WEAK, STRONG, ASIDE, NO_TEXT = range(5)
_WEIGHT = (1.0, 0.5, 0.15, 0.1, 0.0)
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_BESIDE = ("has-", "no-", "with-", "without-", "hide-", "show-")
#: Open elements that a start tag ends, and where the search for them stops.
_ENDS = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}


class Tree:
    """Nodes in page order: parent, tag, mark, cut (never text); text pieces by node."""

    def __init__(self) -> None:
        self.parent, self.tag, self.mark, self.cut, self.pieces = [-1], ["#root"], [PLAIN], [False], []

    def add(self, parent: int, tag: str, mark: int) -> int:
        self.parent.append(parent)
        self.tag.append(tag)
        self.mark.append(mark)
        self.cut.append(mark == NO_TEXT or self.cut[parent])
        return len(self.tag) - 1


def parse(html: str, prune: bool = True) -> Tree:
    """Forgiving, linear in the page: unclosed and stray tags are mended as browsers do, roughly.
    ``prune`` marks parts that may be no article text; scripts, styles and comments never count."""
    tree, stack, at, article = Tree(), [0], 0, 0
    text = tree.pieces.append
    find = _TOKEN.search
    while m := find(html, at):
        if m.start() > at:
            text((stack[-1], html[at : m.start()]))
        at = m.end()
        name = m[2] or m[5]
        if not name:
            if m[0].startswith("<![CDATA["):
                continue
            continue
        name, closing = name.lower(), m[1] or m[4]
        if closing:
            if name == "p" and not any(tree.tag[k] == "p" for k in stack):
                text((stack[-1], None))
                continue
            for k in range(len(stack) - 1, 0, -1):
                t = tree.tag[stack[k]]
                if t == name:
                    article -= sum(tree.tag[x] in ("article", "main") for x in stack[k:])
                    del stack[k:]
                    break
                if (t in BLOCK and name not in BLOCK) or (t in ("td", "th", "table") and name not in ("tr", "table", "tbody", "thead", "tfoot", "td", "th", "body", "html", "div", "article", "section", "main")):
                    break
            if name in BLOCK:
                text((stack[-1], None))
            continue
        if name in BLOCK:
            _end_implied(tree, stack, name)
            text((stack[-1], None))
        elif name == "br":
            text((stack[-1], None))
        attributes = m[3] or m[6] or ""
        if not prune:
            mark = NO_TEXT if name in ("script", "style", "template", "noscript", "head", "title") else PLAIN
        elif name in _NO_TEXT:
            mark = NO_TEXT
        else:
            mark = _marked(attributes) if attributes and name not in ("html", "body") else PLAIN
            if name in _ASIDE_TAGS or (name == "header" and not article):
                quoted = name == "footer" and any(tree.tag[k] == "blockquote" for k in stack)  # whom it quotes
                mark = mark if quoted else max(mark, ASIDE)
            elif mark < ASIDE and name in _HEADINGS:
                mark = PLAIN
            elif mark == STRONG and name in ("article", "main"):
                mark = WEAK
        node = tree.add(stack[-1], name, mark)
        if name in RAW and not attributes.endswith("/") or name == "script":
            end = re.compile(rf"</{name}(?=[\s/>])[^>]*>", re.I).search(html, at)
            stop = end.start() if end else len(html)
            if name == "textarea":
                text((node, html[at:stop]))
            at = end.end() if end else len(html)
        elif name not in VOID:
            stack.append(node)
            article += name in ("article", "main")
    if at < len(html):
        text((stack[-1], html[at:]))
    return tree


def _end_implied(tree: Tree, stack: list[int], name: str) -> None:
    for k in range(len(stack) - 1, 0, -1):  # an open paragraph ends where a block begins
        t = tree.tag[stack[k]]
        if t == "p":
            del stack[k:]
            break
        if t in BLOCK:
            break
    if name in _ENDS:
        ends, stops = _ENDS[name]
        for k in range(len(stack) - 1, 0, -1):
            t = tree.tag[stack[k]]
            if t in stops:
                break
            if t in ends:
                del stack[k:]
                if name != "tr":
                    break


def _marked(attributes: str) -> int:
    mark = PLAIN
    for m in _ATTRIBUTE.finditer(attributes):
        key, value = (m[1] or m[5]).lower(), m[2] or m[3] or m[4] or ""
        if key in ("class", "id"):
            for token in value.split():  # has-sidebar is said of what stands beside one
                if not token.lower().startswith(_BESIDE) and (n := _NAMES.search(re.sub(r"(?<=[a-z])(?=[A-Z])", "-", token))):
                    mark = max(mark, STRONG if n[1] else WEAK)
        elif key == "role" and value.lower() in _ASIDE_ROLES:
            mark = max(mark, ASIDE)
        elif key == "hidden" or (key == "aria-hidden" and value.lower() == "true"):
            return NO_TEXT
        elif key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return NO_TEXT
    return mark


def _joined(tree: Tree, wanted: list[bool] | None = None) -> str:
    """The text of the nodes: references decoded, white space made one space, blocks in page order."""
    parts = [" " if piece is None else piece for node, piece in tree.pieces if piece is None or (not tree.cut[node] and (wanted is None or wanted[node]))]
    return " ".join(unescape("".join(parts)).split())


def page_text(html: str | None) -> str:
    """All visible text of a page."""
    return _joined(parse(html, prune=False)) if html else ""


def page_lines(html: str | None) -> str:
    """All visible text of a page, one line a block."""
    if not html:
        return ""
    tree, lines, line = parse(html, prune=False), [], []
    for node, piece in [*tree.pieces, (0, None)]:
        if piece is None:
            if text := " ".join(unescape("".join(line)).split()):
                lines.append(text)
            line = []
        elif not tree.cut[node]:
            line.append(piece)
    return "\n".join(lines)


def main_text(html: str | None) -> str:
    """The article of a page; empty if there is none."""
    return _content(parse(html)) if html else ""


def densities(tree: Tree) -> tuple[list[float], list[int], list[int]]:
    """Composite text density, characters and characters in links of every node: with C and T the characters and
    tags under it, LC and LT those of links, and LCb and Cb the body's,
    C/T * log(C/LC * T/LT) to the base ln(C/(C-LC) * LC + LCb/Cb * C + e); 0 without text."""
    n, parent, tag, cut = len(tree.tag), tree.parent, tree.tag, tree.cut
    chars, tags, link_chars, link_tags = [0] * n, [0] * n, [0] * n, [0] * n
    in_link = [False] * n
    for k in range(1, n):
        in_link[k] = tag[k] == "a" or in_link[parent[k]]
    for node, piece in tree.pieces:
        if piece is not None and not cut[node]:
            c = len(unescape(piece).strip()) if "&" in piece else len(piece.strip())
            chars[node] += c
            if in_link[node]:
                link_chars[node] += c
    for k in range(n - 1, 0, -1):
        if not cut[k]:
            p = parent[k]
            chars[p] += chars[k]
            link_chars[p] += link_chars[k]
            tags[p] += tags[k] + 1
            link_tags[p] += link_tags[k] + (tag[k] == "a")
    body = _body(tree, chars)
    share = link_chars[body] / max(chars[body], 1)

    def density(k: int) -> float:
        c, lc = chars[k], link_chars[k]
        if not c or cut[k]:
            return 0.0
        t = max(tags[k], 1)
        base = max(log(max(log(c / max(c - lc, 1) * lc + share * c + e), 1.0)), 0.1)
        return c / t * max(log(c / max(lc, 1) * t / max(link_tags[k], 1)), 0.0) / base

    return [density(k) for k in range(n)], chars, link_chars


def _body(tree: Tree, chars: list[int]) -> int:
    return next((k for k in range(len(tree.tag)) if tree.tag[k] == "body" and chars[k]), 0)


def _content(tree: Tree) -> str:
    n, parent, tag, cut, mark = len(tree.tag), tree.parent, tree.tag, tree.cut, tree.mark
    raw, chars, link_chars = densities(tree)
    if not chars[0]:
        return ""
    body = _body(tree, chars)
    own = [0] * n
    for node, piece in tree.pieces:
        if piece is not None and not cut[node]:
            own[node] += len(piece.strip())
    weight, plain, inside = [1.0] * n, own[:], [False] * n
    inside[body] = True
    for k in range(body + 1, n):
        weight[k] = weight[parent[k]] * _WEIGHT[mark[k]]
        inside[k] = inside[parent[k]] and not cut[k]
    for k in range(n - 1, body, -1):  # text that nothing marks
        if mark[k] == PLAIN and inside[k]:
            plain[parent[k]] += plain[k]
    dense = [d * w for d, w in zip(raw, weight)]
    total, children = [0.0] * n, [0] * n
    for k in range(1, n):
        total[parent[k]] += dense[k]
        children[parent[k]] += chars[k] > 0
    mean = lambda k: total[k] / max(children[k], 1)
    best = max((k for k in range(n) if inside[k]), key=lambda k: (total[k], -k))
    while best != body and tag[best] not in _CONTAINERS:  # a paragraph's or list's holder is the content
        best = parent[best]
    top, k = best, best
    while k != body:  # within a marked article all of it
        k = parent[k]
        if tag[k] in ("article", "main"):
            top = k
    if top == body:
        marked = [k for k in range(n) if inside[k] and tag[k] in ("article", "main") and tag[parent[k]] != "main"]
        if len(marked) == 1 and 2 * plain[marked[0]] >= plain[body]:
            top = marked[0]
    wanted, kept = [False] * n, [False] * n
    path, k, least = [], top, dense[top]
    while k != body:
        k = parent[k]
        path.append(k)
        least = min(least, dense[k])
    if top == body:
        path, least = [body], dense[body]
        kept[body] = 2 * own[body] >= plain[body]  # text that stands in no element
    else:
        wanted[top] = True
    if tag[top] not in ("article", "main"):
        on = {top, *path}
        for k in range(body + 1, n):
            if parent[k] in path and k not in on and inside[k] and dense[k] >= least and max(dense[k], mean(k)) >= mean(top) and 2 * link_chars[k] < chars[k]:
                wanted[k] = True
    rest = sum(plain[k] for k in range(n) if wanted[k])
    drop = [False] * n
    for k in range(body + 1, n):
        drop[k] = cut[k] or drop[parent[k]]
        wanted[k] = wanted[k] or wanted[parent[k]]
        if wanted[k] and not drop[k] and mark[k]:
            as_dense = mark[k] == WEAK and raw[k] >= raw[top] and chars[k] >= 140
            drop[k] = not as_dense and chars[k] <= 4 * rest
    return _joined(tree, [(w or x) and not d for w, x, d in zip(wanted, kept, drop)])


def extract(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, url, text, n_chars (code points).

    Null and empty html give the empty string; a page of plain text is its own article;
    repeated rows are each extracted; an empty table gives no rows; other columns aren't
    read. Of equal density sums the first node in page order wins.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [main_text(x.as_py()) for x in b.column(2)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], ["page_id", "url", "text", "n_chars"])

    return pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string")).mapInArrow(run, "page_id long, url string, text string, n_chars long")
