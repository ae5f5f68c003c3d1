"""Main-text extraction by composite text density.

Every element of the page's tree gets its characters, tags, link characters and
link tags; its composite density is the characters per tag, lowered by the
share of links in them:

    C / T * log(C * T / (LC * LT)) to the base ln(C * LC / NLC + body_LC * C / body_C + e)

(counts of 0 read 1).  A block element's density sum is the sum over its child
blocks, its own text and inline elements being one of them.  The block with the
largest sum under the body gives the threshold: the smallest density on its path
to the body.  Blocks below the threshold can't start the article; of the others,
the one with the largest sum does.  On its path to the body it is widened to each
element that adds more text in blocks at or above the threshold than below it: a
title, or a ``WIDEN``-th of the article's own length.

Cut from the tree before are only elements whose markup says what they are:
menus, headers, footers, asides, forms, scripts, styles, hidden parts and their
ARIA roles.  Class names and ids come after the densities: a part that is named
like an advert, a notice, a sidebar or reader comments is measured with the page,
can't be the article, and is left out of it, unless it wraps most of the page's text
without being mostly links (then the density decides).  Comments, and elements with
just such a name, are left out unless hardly any text is outside of them; so are others
beside an ``article`` or ``main`` of some length.
Text blocks follow block elements; white space in a block reads as one space.

A page is one row, parsed by itself; nothing is shared between rows.  Nulls: a
null or empty html, or one without text, gives an empty text; a null url or id
is kept.  Unclosed and truncated markup is read as far as it goes.  An empty
table gives an empty result.  Input columns named text or n_chars are replaced.
"""

from __future__ import annotations

import html as _html
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

_TOKEN = re.compile(r"<!--.*?(?:-->|$)|<[!?][^>]*(?:>|$)|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*)(?:>|$)", re.S)
_ATTRIBUTE = re.compile(r"""[\s/]*([^\s/>=][^\s/>=]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]*)))?""")
_RAW = {"script", "style", "template", "noscript", "textarea", "title", "iframe", "noembed", "noframes", "xmp"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
_CUT = _RAW | {"head", "nav", "footer", "aside", "form", "menu", "button", "select", "dialog", "svg", "object", "canvas", "audio", "video"}
_INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd", "label",
           "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr"}
_CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
_SCOPE = {"ul", "ol", "dl", "table", "td", "th", "body", "html", "article", "section", "main", "div", "blockquote", "nav", "aside", "header", "footer",
          "form", "menu", "dialog", "button", "select", "svg", "object", "canvas", "audio", "video"}
_PHRASING = {"button", "select", "svg", "object", "canvas", "audio", "video"}      # leave a paragraph open
_IN_HEAD = {"base", "basefont", "bgsound", "link", "meta", "title", "script", "style", "noscript", "template"}
_OPTIONAL_END = {"p", "li", "dt", "dd", "td", "th", "tr", "option", "head"}
_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "form", "menu", "menubar", "alertdialog"}
_NAMES = re.compile(r"(?:^|[\s_-])(?:ad|ads|adv|advert|adverts|advertisement|adsense|banner|sponsor|sponsored|promo|cookie|cookies|consent|notice|gdpr|popup|modal|newsletter|"
                    r"subscribe|sidebar|side-bar|menu|nav|navbar|navigation|breadcrumb|breadcrumbs|footer|share|sharing|social|related|recommended|"
                    r"pagination|pager|toolbar|widget)(?:$|[\s_-])", re.I)
_READERS = re.compile(r"(?:^|[\s_-])(?:comment|comments|comment-list|disqus|respond|replies)(?:$|[\s_-])", re.I)
_LAYOUT = re.compile(r"(?<!\S)(?:(?:no|has|with|without)[_-]\S*|related[_-]works?(?!\S))", re.I)     # says what is beside it, or is a heading of papers
_HEADER = re.compile(r"(?:^|[\s_-])(?:header|masthead)(?:$|[\s_-])", re.I)     # an article's own header holds its title
_SPACE = re.compile(r"\s+")
WIDEN = 4


class Node:
    __slots__ = ("tag", "up", "items", "chars", "tags", "link_chars", "link_tags", "density", "total", "cut", "ended", "block", "named")

    def __init__(self, tag: str, up: "Node | None"):
        self.tag, self.up, self.items = tag, up, []        # items: nodes and texts in page order
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.total = 0.0
        self.cut, self.ended = "", tag in _OPTIONAL_END    # cut: "", ALWAYS, or by a name
        self.block, self.named = tag not in _INLINE, False  # named: inside a part that is left out by its name


ALWAYS, NAMED, SURE = "always", "named", "sure"          # SURE: comments, or the name and nothing else


def attributes_of(text: str) -> dict[str, str]:
    """Names in lower case and values of a start tag; of a repeated name, the first."""
    out: dict[str, str] = {}
    for name, a, b, c in _ATTRIBUTE.findall(text):
        out.setdefault(name.lower(), _html.unescape(a or b or c))
    return out


def _cut_of(tag: str, attributes: str, at: "Node") -> str:
    """Whether, and how, an element under ``at`` is cut."""
    if tag in _CUT or tag == "header" and _within(at, "article", "main") is None:
        return ALWAYS
    if not attributes or attributes.isspace():
        return ""
    given = attributes_of(attributes)
    if ("hidden" in given or given.get("role", "").strip().lower() in _ROLES or given.get("aria-hidden", "").strip().lower() == "true"
            or re.search(r"display\s*:\s*none", given.get("style", ""), re.I)):
        return ALWAYS
    if tag in ("html", "body", "article", "main"):
        return ""
    names = [_LAYOUT.sub("", given[k]) for k in ("class", "id") if k in given]
    if any(_READERS.search(x) for x in names):
        return SURE
    found = [(x, m) for x in names if (m := _NAMES.search(x) or _HEADER.search(x) if _within(at, "article", "main") is None else _NAMES.search(x))]
    if any(m[0].strip(" _-") == x.strip() for x, m in found):
        return SURE
    return NAMED if found else ""


def parse(page: str) -> Node:
    """The tree below the body, without the parts that are cut by their markup; parts left out by name are marked."""
    root = Node("body", None)
    at, pos, raw = root, 0, None
    while pos < len(page):
        if raw:                                             # script and the like: text up to the closing tag
            end = re.compile(f"</{raw}(?=[\\s/>]|$)", re.I).search(page, pos)
            raw, pos = None, end.start() if end else len(page)
            continue
        m = _TOKEN.search(page, pos)
        if m is None or m.start() > pos:
            text = page[pos:m.start() if m else len(page)]
            if at.tag == "head" and not text.isspace():     # text ends a head
                at = at.up
            at.items.append(text)
        if m is None:
            break
        pos = m.end()
        if m[2] is None:
            continue
        tag, closing = m[2].lower(), bool(m[1])
        if at.tag == "head" and not closing and tag not in _IN_HEAD:
            at = at.up
        if tag in ("html", "body"):
            continue
        if closing:
            node = at
            while node.up is not None and node.tag != tag and (tag not in _INLINE or node.tag in _INLINE):
                node = node.up
            if node.up is not None and node.tag == tag:
                node.ended, at = True, node.up
            continue
        if tag in _RAW:
            raw = tag
            continue
        cut = _cut_of(tag, m[3], at)
        if tag in _VOID or m[3].endswith("/") and (tag in ("svg", "math") or _within(at, "svg", "math") is not None):
            if not cut:
                at.items.append(Node(tag, at))
            continue
        if tag == "main":                                   # can't lie in these: an end tag is missing
            around = _within(at, "nav", "aside", "header", "footer")
            at = around.up if around is not None else at
        if tag not in _INLINE and tag not in _PHRASING:     # a block ends an open paragraph
            at = _close(at, ("p",) + _CLOSES.get(tag, ()))
        node = Node(tag, at)
        node.cut = cut
        at.items.append(node)
        at = node
    _prune(root)
    return root


def _prune(root: Node) -> None:
    """Takes cut elements out of the tree and marks the named ones, but for wrappers of most of the page's text."""
    order, todo = [], [root]
    while todo:
        node = todo.pop()
        order.append(node)
        todo += [x for x in node.items if isinstance(x, Node) and not (x.cut == ALWAYS and x.ended)]
    size = {}
    for n in reversed(order):
        chars = links = 0
        for x in n.items:
            c, k = size.get(x, (0, 0)) if isinstance(x, Node) else (len(_SPACE.sub(" ", x).strip()), 0)
            chars, links = chars + c, links + k
        size[n] = chars, chars if n.tag == "a" else links
    whole, marked, todo = size[root][0], 0, [root]
    while todo:
        for x in todo.pop().items:
            if isinstance(x, Node) and not x.cut:
                if x.tag in ("article", "main"):
                    marked += size[x][0]
                else:
                    todo.append(x)

    def wraps(n: Node) -> bool:
        chars, links = size[n]
        beside = marked if _within(n, "article", "main") is None else 0
        return chars * 10 > whole * (9 if n.cut == SURE else 5) and 2 * links <= chars and 4 * beside < chars

    todo = [root]
    while todo:
        node = todo.pop()
        out = {x for x in node.items if isinstance(x, Node) and x.cut and not (x in size and wraps(x))}
        node.items = [x for x in node.items if x not in out or x.cut != ALWAYS]
        for x in node.items:
            if isinstance(x, Node):
                x.named = node.named or x in out
                todo.append(x)


def _within(node: Node | None, *tags: str) -> Node | None:
    while node is not None and node.tag not in tags:
        node = node.up
    return node


def _close(at: Node, tags: tuple[str, ...]) -> Node:
    node, out = at, at
    while node is not None and node.tag not in _SCOPE - set(tags):
        if node.tag in tags and node.up is not None:
            out = node.up
        node = node.up
    return out


def _measure(root: Node) -> list[Node]:
    """Counts and densities, children first; gives the nodes in that order."""
    order, todo = [], [root]
    while todo:
        node = todo.pop()
        order.append(node)
        todo += [x for x in node.items if isinstance(x, Node)]
    order.reverse()
    for n in order:
        for x in n.items:
            if isinstance(x, Node):
                n.chars += x.chars
                n.tags += x.tags + 1
                n.link_chars += x.link_chars
                n.link_tags += x.link_tags + (x.tag == "a")
            else:
                n.chars += len(_SPACE.sub(" ", x).strip())
        if n.tag == "a":
            n.link_chars = n.chars
    share = root.link_chars / max(root.chars, 1)
    for n in order:
        if n.chars:
            c, t, lc, lt = n.chars, max(n.tags, 1), max(n.link_chars, 1), max(n.link_tags, 1)
            base = math.log(c * lc / max(c - n.link_chars, 1) + share * c + math.e)
            n.density = max(0.0, c / t * math.log(max(c * t / (lc * lt), 1.0)) / math.log(max(base, 1.0 + 1e-9))) if base > 1 else c / t
        own = tags = 0                                          # the text outside of child blocks is one more
        for x in n.items:
            if not isinstance(x, Node):
                own += len(_SPACE.sub(" ", x).strip())
            elif x.block:
                n.block = True
                n.total += x.density
            else:
                own, tags = own + x.chars - x.link_chars, tags + x.tags + 1
        n.total += own / max(tags, 1)
    return order


def main_node(root: Node) -> Node:
    """The element that holds the article: the largest density sum, widened on its path to the body."""
    order = [n for n in reversed(_measure(root)) if n.block and not n.named]
    best = max(order, key=lambda n: n.total)                    # the first in page order among equals
    threshold, node = best.density, best
    while node is not None:
        threshold, node = min(threshold, node.density), node.up
    best = max((n for n in order if n.density >= threshold), key=lambda n: n.total)
    top, node = best, best
    while node.up is not None:
        dense, thin, title = _beside(node.up, node, threshold)
        node = node.up
        if dense > thin and (title or WIDEN * dense >= top.chars):
            top = node
    return top


def _beside(parent: Node, child: Node, threshold: float) -> tuple[int, int, bool]:
    """Characters under ``parent``, outside ``child`` and named parts, in blocks from the threshold on and below it; whether a title is there."""
    dense = thin = 0
    title = False
    todo = [x for x in parent.items if x is not child]
    while todo:
        x = todo.pop()
        if isinstance(x, Node):
            if x.named:
                continue
            if any(isinstance(y, Node) and y.block for y in x.items):
                todo += x.items
                continue
            chars, full = x.chars, x.density >= threshold and 2 * x.link_chars <= x.chars
            title |= full and x.tag == "h1"
        else:                                                   # text beside blocks: one tag
            chars = len(_SPACE.sub(" ", x).strip())
            full = chars >= threshold
        dense, thin = dense + chars * full, thin + chars * (not full)
    return dense, thin, title


def blocks_of(top: Node) -> list[str]:
    """The text blocks under a node in page order."""
    out, text = [], []

    def end() -> None:
        block = _SPACE.sub(" ", _html.unescape("".join(text))).strip()
        text.clear()
        if block:
            out.append(block)

    todo: list = [top]
    while todo:
        x = todo.pop()
        if x is None:
            end()
        elif isinstance(x, str):
            text.append(x)
        elif x.named:
            if x.tag not in _INLINE:
                end()
        elif x.tag in _INLINE:
            if x.tag in ("br", "wbr"):
                text.append(" " if x.tag == "br" else "")
            todo += reversed(x.items)
        else:
            end()
            todo += [None, *reversed(x.items)]
    end()
    return out


def extract(page: str | None) -> str:
    if not page:
        return ""
    return "\n\n".join(blocks_of(main_node(parse(page))))


def extract_text(pages: DataFrame, html: str = "html") -> DataFrame:
    """``pages`` without ``html``, with ``text`` and ``n_chars`` (its code points)."""
    kept = [c for c in pages.columns if c not in (html, "text", "n_chars")]
    base = pages.select(*kept, F.col(html).alias("_html"))
    schema = ", ".join(f"`{c}` {base.schema[c].dataType.simpleString()}" for c in kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = [extract(x.as_py()) for x in batch.column("_html")]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(text, pa.string()), pa.array([len(t) for t in text], pa.int64())],
                                             names=[*kept, "text", "n_chars"])

    return base.mapInArrow(run, f"{schema}{', ' if kept else ''}text string, n_chars long")
