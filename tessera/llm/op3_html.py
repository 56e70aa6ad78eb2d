"""Main text of web pages by composite text density."""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tessera.llm.common import frugal, ship

#: Elements whose content is not text of the page.
UNSEEN = frozenset("script style noscript template head title svg math object embed iframe canvas audio video map".split())
#: Elements whose content runs to their own end tag, whatever it holds.
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
#: Elements that never hold the article.
APART = frozenset("nav header footer aside form button select option textarea input label dialog menu fieldset".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul caption".split()
)
#: An open element on the left is closed by a start tag on the right.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "option": {"option", "optgroup"}, "thead": {"tbody", "tfoot"}, "tbody": {"tbody", "tfoot"}}
#: Elements whose start ends an open paragraph.
ENDS_P = BLOCKS - frozenset("body caption html tbody td tfoot th thead tr dd dt".split()) | {"dd", "dt"}
#: Of these, the ones that may hold a whole page, where nothing else has text.
WRAPS = frozenset("header aside form dialog fieldset".split())
#: Names (class, id, role) of parts around an article. Only whole names count: has-sidebar and no-header stand for the page.
AROUND = re.compile(
    r"(?:^|\s)(?:ads?|advert\w*|adbox|sponsor\w*|promo\w*|banner|nav\w*|menu\w*|breadcrumbs?|sidebar\w*|side|aside|widget\w*|footer\w*|foot|header|masthead|topbar|toolbar|cookies?|consent|gdpr|notices?|popup|modal|overlay|newsletter|subscribe\w*|signup|share\w*|sharing|social\w*|related\w*|recommend\w*|comments?|commentlist|respond|reply|replies|disqus|pagination|pager|copyright|legal|disclaimer|login|search\w*|navigation|complementary|contentinfo|alert|dialog|skip\w*|tags?|hidden)(?:$|\s)",
    re.I,
)
#: Of these, the ones that may as well name what a page is about; they count only where the part holds the lesser share of the page's text.
ABOUT = re.compile(r"(?:promo\w*|banner|widget\w*|header|notices?|modal|overlay|legal|disclaimer|copyright|search\w*|alert|dialog|tags?|side|related\w*)", re.I)
#: A quote opens a value only behind an equals sign. No part of a tag is tried twice.
TAG = re.compile(r"<!--.*?(?:-->|--!>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"([^\s=/>]++)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
SPACE = re.compile(r"\s+")


class Node:
    __slots__ = ("tag", "apart", "about", "parent", "parts", "chars", "tags", "link_chars", "link_tags", "density", "sum")

    def __init__(self, tag: str, parent: Node | None, apart: bool = False, about: bool = False):
        self.tag, self.parent, self.apart, self.about, self.parts = tag, parent, apart, about, []


def parse(page: str, spare: int = 0) -> Node:
    """The element tree of a page, forgiving as browsers are. Parts are texts (references decoded) and nodes, in page order.

    spare keeps more of the page: from 1 on no element is apart that may wrap a page, from 2 on none for its names.
    Elements whose names may tell a page's matter, and elements that may wrap a page, are kept where they hold most of its
    text. The names of open elements
    are counted, so an end tag without a start costs nothing.
    """
    root = node = Node("#root", None)
    open_: dict[str, int] = {}
    about: list[Node] = []
    at, n = 0, len(page)

    def rise(to: Node) -> None:
        nonlocal node
        while node is not to:
            open_[node.tag] -= 1
            node = node.parent

    def text(a: int, b: int) -> None:
        if a < b:
            node.parts.append(html.unescape(page[a:b]))

    while at < n:
        m = TAG.search(page, at)
        if m is None:
            text(at, n)
            break
        text(at, m.start())
        at = m.end()
        close, name, said = m[1], m[2], m[3]
        if not name:
            if m[0].startswith("<![CDATA["):
                node.parts.append(m[0][9:].removesuffix("]]>"))
            continue
        name = name.lower()
        if close:
            if not open_.get(name):
                continue
            up = node
            while up is not root and up.tag != name:
                # an end tag of an inline element does not reach through a block, nor any through a table cell's
                if up.tag in ("td", "th", "table") and name not in ("td", "th", "tr", "table", "tbody", "thead", "tfoot", "body", "html") or name not in BLOCKS and up.tag in BLOCKS:
                    up = root
                    break
                up = up.parent
            if up is not root:
                rise(up.parent)
            continue
        if name in ENDS_P and open_.get("p"):
            up = node
            while up is not root and up.tag != "p" and (up.tag not in BLOCKS):
                up = up.parent
            if up.tag == "p":
                rise(up.parent)
        if name in CLOSED_BY and any(map(open_.get, CLOSED_BY[name])):
            up, to = node, None
            while up is not root and up.tag not in ("ul", "ol", "dl", "table", "select", "div", "article", "section"):
                if up.tag in CLOSED_BY[name]:
                    to = up.parent
                    if name not in ("tr", "tbody", "tfoot"):
                        break
                up = up.parent
            if to is not None:
                rise(to)
        if name in ("html", "body") and open_.get(name):
            continue
        child = Node(name, node, name in APART and not (spare and name in WRAPS), name in WRAPS)
        if said and (not child.apart or child.about):
            apart, by_matter = _is_apart(name, said, spare < 2)
            child.apart, child.about = child.apart or apart, by_matter if apart else child.about
        if child.apart and child.about:
            about.append(child)
        node.parts.append(child)
        if name in RAW:
            end = re.compile(rf"</{name}(?=[\s/>])[^>]*>", re.I).search(page, at)
            at = end.end() if end else n
        elif name not in VOID and (not said.rstrip().endswith("/") or name in BLOCKS):
            open_[name] = open_.get(name, 0) + 1
            node = child
    if about:
        _spare_matter(root, about)
    return root


#: The elements that a start tag on the left closes.
CLOSED_BY: dict[str, set[str]] = {}
for _open, _starts in CLOSES.items():
    for _start in _starts:
        CLOSED_BY.setdefault(_start, set()).add(_open)


def _spare_matter(root: Node, about: list[Node]) -> None:
    """Elements apart for a matter or as a wrapping element alone stay where they hold more than half of the page's text."""
    order, stack, chars = [], [root], {}
    while stack:
        v = stack.pop()
        order.append(v)
        stack += [x for x in v.parts if isinstance(x, Node) and x.tag not in UNSEEN]
    for v in reversed(order):
        chars[id(v)] = sum(len(SPACE.sub(" ", x).strip()) if isinstance(x, str) else chars.get(id(x), 0) for x in v.parts)
    for v in about:
        if 2 * chars.get(id(v), 0) > chars[id(root)]:
            v.apart = False


def _up(node: Node) -> Iterator[Node]:
    while node is not None:
        yield node
        node = node.parent


def _way(node: Node, body: Node) -> list[Node]:
    """The node and those above it, up to the body (the root for nodes outside it)."""
    way = []
    for v in _up(node):
        way.append(v)
        if v is body:
            break
    return way


#: Names of an article's own parts, which the list above would take for others.
OWN = re.compile(r"(?:article|entry|post|story|content|page)[_-]?(?:header|title|headline|heading|body|content|text|main)", re.I)


def _is_apart(name: str, said: str, by_name: bool = True) -> tuple[bool, bool]:
    """Whether an element is not the article's by its attributes, and whether only by names that may tell a page's matter."""
    if name in ("html", "body", "article", "main", "p", "a", "b", "i", "em", "strong", "span", "br", "img"):
        hidden = name not in ("html", "body") and re.search(r"(?:^|\s)hidden(?:\s|=|$)", said, re.I) is not None
        if hidden or name not in ("p", "span", "a"):
            return hidden, False
    about = False
    for m in ATTRIBUTE.finditer(said):
        key, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if key == "hidden" or key == "aria-hidden" and value.lower() == "true" or key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return True, False
        if by_name and key in ("class", "id", "role"):
            named = [w for w in OWN.sub("", value).split() if AROUND.match(w)]
            if any(not ABOUT.fullmatch(w) for w in named):
                return True, False
            about |= bool(named)
    return about, about


def measure(root: Node) -> tuple[list[Node], Node]:
    """Sets characters, tags, links, density and density sum of every node that may hold the article.

    Returns these nodes in page order, and the body (or what stands for it).
    """
    order, stack = [], [root]
    while stack:
        v = stack.pop()
        order.append(v)
        stack += reversed(_seen(v))
    for v in reversed(order):
        v.chars = v.tags = v.link_chars = v.link_tags = 0
        for x in v.parts:
            if isinstance(x, str):
                v.chars += len(SPACE.sub(" ", x).strip())
            elif not x.apart and x.tag not in UNSEEN:
                v.chars += x.chars
                v.tags += x.tags + 1
                v.link_chars += x.link_chars
                v.link_tags += x.link_tags
        if v.tag == "a":
            v.link_chars, v.link_tags = v.chars, v.link_tags + 1
    body = next((v for v in order if v.tag == "body"), root)
    ratio = body.link_chars / body.chars if body.chars else 0.0
    for v in order:
        v.density = _density(v, ratio)
    for v in order:
        v.sum = sum(x.density for x in _seen(v))
        # text that stands in the node itself counts as a child without tags
        own = sum(len(SPACE.sub(" ", x).strip()) for x in v.parts if isinstance(x, str))
        v.sum += own if own and v.tag in BLOCKS else 0
    return order, body


def _density(v: Node, ratio: float) -> float:
    """Characters a tag, less for links: the logarithm's base grows with the share of linked characters."""
    if not v.chars:
        return 0.0
    tags, linked, link_tags = max(v.tags, 1), max(v.link_chars, 1), max(v.link_tags, 1)
    base = math.log(v.chars / max(v.chars - v.link_chars, 1) * v.link_chars + ratio * v.chars + math.e)
    grown = v.chars / linked * tags / link_tags
    return v.chars / tags * math.log(grown) / math.log(max(base, 1.001)) if grown > 1 else 0.0


def _seen(v: Node) -> list[Node]:
    return [x for x in v.parts if isinstance(x, Node) and not x.apart and x.tag not in UNSEEN]


#: Elements that hold an article rather than a part of its text.
HOLDS = frozenset("div section article main center td th body html #root".split())


def _whole(best: Node, way: list[Node], order: list[Node]) -> Node:
    """The article that the winner is a part of: an article element, or a main element without any, or what holds the winner."""
    article = next((v for v in way if v.tag == "article"), None)
    if article is not None:
        return article
    apart = {id(u) for v in order if v.tag == "article" and v.chars for u in _up(v)}
    main = next((v for v in way if v.tag == "main" and id(v) not in apart), None)
    if main is not None:
        return main
    return next((v for v, up in zip(way, way[1:]) if v.tag in HOLDS or up.tag in ("body", "html", "#root")), best)


def main_nodes(root: Node) -> list[Node]:
    """Subtrees that hold the article, in page order.

    The greatest density sum marks the article's node; of equal ones an article or main element. A
    winner inside an article element gives way to it, so no heading is lost. The threshold is the least density on the way from it up to the body. Besides the
    node itself, what stands next to that way and is as dense as the threshold asks, at least half as dense as
    the article and hardly linked, belongs to it: an article may be laid over several elements.
    """
    order, body = measure(root)
    best = max(order, key=lambda v: (v.sum, v.tag in ("article", "main")))
    if not best.chars:
        return []
    way = _way(best, body)
    best = _whole(best, way, order)
    way = _way(best, body)
    limit = min(v.density for v in way)
    on_way = set(map(id, way))
    alike = lambda v: v.density >= max(limit, 0.5 * best.density) and v.link_chars < 0.3 * v.chars
    keep, stack = [], [way[-1]]
    while stack:
        v = stack.pop()
        if v is best or id(v) not in on_way and alike(v):
            keep.append(v)
        elif id(v) in on_way:
            stack += reversed(_seen(v))
    return keep


def text_of(nodes: list[Node]) -> str:
    """Blocks in page order, one a line; white space inside a block is one space."""
    blocks: list[str] = []
    run: list[str] = []

    def flush() -> None:
        if run and (s := SPACE.sub(" ", "".join(run)).strip()):
            blocks.append(s)
        run.clear()

    stack: list = list(reversed(nodes))
    while stack:
        x = stack.pop()
        if x is None:
            flush()
        elif isinstance(x, str):
            run.append(x)
        elif x.tag == "br":
            run.append(" ")
        elif not x.apart and x.tag not in UNSEEN:
            if x.tag in BLOCKS or x.tag == "#root":
                flush()
                stack.append(None)
            stack += reversed(x.parts)
    flush()
    return "\n".join(blocks)


def main_text(page: str | None) -> str:
    """The article of a page; empty for null, empty and textless pages. Where exclusion leaves nothing, less is excluded."""
    if not page:
        return ""
    for spare in range(3):
        if text := text_of(main_nodes(parse(page, spare))):
            break
    return text


_OUT = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of each row of pages (page_id, url, html); other columns are not read.

    A null or empty page has an empty text; repeated rows each give a row. Pages that are not well formed are
    read as browsers read them. Memory is bounded by an Arrow batch and the tree of one page.
    """
    ship(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x.as_py()) for x in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1).cast(pa.string()), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], schema=_OUT)

    return pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string")).mapInArrow(frugal(run), "page_id long, url string, text string, n_chars long")
