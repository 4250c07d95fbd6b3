"""Operator 12: main text of web pages by composite text density.

A page is read into a tree of its elements.  Every element gets its composite
text density: characters per tag, adjusted by the shares of linked characters
and tags against those of the whole body.  Each element then sums the densities
of its children; the element of the largest sum holds the text, as paragraphs
are children of one element.  The least density on the path from it to the body
is the threshold: what lies beside that path and is at least as dense belongs to
the text, too (sections of one article), what is thinner (menus, teasers) does not.

Elements that name themselves as no text (navigation, scripts, forms, adverts,
comments, ...) are left out before densities are taken, and where a page marks
its ``article`` or ``main``, the search starts there.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read_table

# Element names of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s "
                   "samp small span strike strong sub sup time tt u var wbr br img".split())
ENDS_P = frozenset("address article aside blockquote center details dialog dir div dl dd dt fieldset figcaption figure footer form h1 h2 h3 "
                   "h4 h5 h6 header hgroup hr li main menu nav ol p pre search section summary table ul".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
LISTS = frozenset("ul ol dl div section table nav aside menu".split())
#: Start tag -> open elements that it ends, and those that it cannot reach beyond.
ENDS = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
        "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
        "thead": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}), "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}),
        "tfoot": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}),
        "option": ({"option"}, {"select"}), "a": ({"a"}, {"table", "td", "th"}), "body": ({"head", "title"}, set())}
#: Elements and roles that are never text of a page.
NO_TEXT = frozenset("script style head title template noscript iframe object embed applet svg canvas math audio video map form button select "
                    "option input textarea fieldset nav footer aside menu dialog noembed noframes datalist search".split())
NO_TEXT_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar tablist "
                          "status tooltip".split())
#: Words of class and id values of elements that are no text of a page.
NO_TEXT_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising adsense adslot sponsor sponsored promo promos promotion banner banners "
    "nav navbar navigation menu menus breadcrumb breadcrumbs pagination pager paging toc sidebar sidebars sidenav aside widget widgets masthead topbar "
    "header footer foot copyright legal disclaimer cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe "
    "subscription signup login register share sharing social related recommended recommendations teaser teasers trending popular comment "
    "comments commentlist commentarea disqus respond reply replies guestbook discussion skip hidden".split())
COMMENTS = frozenset("comment comments commentlist commentarea disqus respond reply replies guestbook discussion".split())
WORDS = re.compile(r"[a-z]+")
P_FENCE = {"button", "table", "td", "th", "caption", "li", "blockquote", "div", "section", "article"}

TOKEN = re.compile(r"<!--.*?(?:--!?>|\Z)|<(/?)([a-zA-Z][^\s/>\x00]*)((?:[^>\"'=]+|=\s*\"[^\"]*(?:\"|\Z)|=\s*'[^']*(?:'|\Z)|[\"'=])*)(>|\Z)"
                   r"|<[!?/][^>]*(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'=<>`]+)))?")


class Node:
    """An element: its children are elements and texts in page order."""

    __slots__ = ("tag", "attrs", "parent", "children", "named", "main", "chars", "link_chars", "tags", "link_tags", "density", "sum")

    def __init__(self, tag: str, attrs: str, parent: Node | None):
        self.tag, self.attrs, self.parent, self.children = tag, attrs, parent, []
        if parent is not None:
            parent.children.append(self)


class Tree:
    """A page under construction: the innermost open element, and how many
    elements of each name are open, so no search walks up in vain."""

    def __init__(self):
        self.root = self.here = Node("#page", "", None)
        self.open: Counter = Counter()

    def leave(self, until: Node) -> None:
        while self.here is not until:
            self.open[self.here.tag] -= 1
            self.here = self.here.parent

    def end(self, names: set, fence: set) -> None:
        """The outermost open element of ``names`` within ``fence`` ends."""
        if not any(self.open[n] for n in names):
            return
        node, out = self.here, self.here
        while node.parent is not None and node.tag not in fence:
            if node.tag in names:
                out = node.parent
            node = node.parent
        self.leave(out)

    def start(self, name: str, attrs: str) -> None:
        if name in ("html", "body") and self.open[name]:
            return  # a second one adds nothing
        if name in ENDS_P:
            self.end({"p"}, P_FENCE)
        if name in HEADINGS and self.here.tag in HEADINGS:
            self.leave(self.here.parent)
        if name in ENDS:
            self.end(*ENDS[name])
        elif name in ENDS_P:  # a block ends the head
            self.end({"head"}, {"body"})
        node = Node(name, attrs, self.here)
        if name not in VOID:
            self.here = node
            self.open[name] += 1

    def close(self, name: str) -> None:
        if name == "br":
            Node("br", "", self.here)
        if not self.open[name]:
            return
        node = self.here
        while node.tag != name:
            if name in INLINE and node.tag not in INLINE:  # an end tag does not reach out of its block
                return
            node = node.parent
        self.leave(node.parent)


def parse(page: str) -> Node:
    """The page's tree.  Unclosed, crossed and stray tags are mended as
    browsers do in the plain cases; a tag cut off by the page's end is dropped."""
    tree, at, end = Tree(), 0, len(page)
    while at < end:
        m = TOKEN.search(page, at)
        if m is None:
            tree.here.children.append(html.unescape(page[at:]))
            break
        if m.start() > at:
            tree.here.children.append(html.unescape(page[at:m.start()]))
        at = m.end()
        if m[2] is None:
            continue
        name = m[2].lower()
        if not m[4]:  # cut off
            break
        if m[1]:
            tree.close(name)
            continue
        tree.start(name, m[3])
        if name in RAW:
            stop = re.compile(rf"</{name}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I).search(page, at)
            tree.close(name)
            at = stop.end() if stop else end
    return tree.root


def _attributes(node: Node) -> dict[str, str]:
    return {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in ATTRIBUTE.finditer(node.attrs)} if node.attrs else {}


def _named(node: Node) -> bool:
    """Whether the element's role, class or id, or that it is hidden, says that it is no text."""
    attrs = _attributes(node)
    if not attrs:
        return False
    style = attrs.get("style", "").replace(" ", "").lower()
    if "hidden" in attrs or attrs.get("aria-hidden", "").lower() == "true" or "display:none" in style or "visibility:hidden" in style:
        return True
    if attrs.get("role", "").lower() in NO_TEXT_ROLES:
        return True
    for value in (attrs.get("class", ""), attrs.get("id", "")):
        for part in value.split():
            words = WORDS.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", part).lower())
            if words and (words[0] in NO_TEXT_NAMES or words[-1] in NO_TEXT_NAMES):
                return True
    return False


def _mark(root: Node) -> None:
    """Set ``named``, and ``main``: whether the element holds what a page marks as its main part."""
    for node in reversed(_subtree(root)):
        node.named, node.main = _named(node), False
        for c in node.children:
            if isinstance(c, Node):
                node.main |= c.tag in ("main", "body") or (c.tag in ("article", "h1") and not c.named) or (c.main and (c.tag == "form" or not c.named))


def prune(root: Node) -> None:
    """Take out the elements that say they are no text.  One that wraps the
    main part of the page (a form around everything, ``has-sidebar``) stays,
    but for readers' comments, whose parts may be articles of their own."""
    _mark(root)
    stack = [(root, False)]
    while stack:
        node, in_article = stack.pop()
        kept = []
        for c in node.children:
            if isinstance(c, Node):
                if c.tag in ("html", "body", "main") or (c.tag == "article" and not c.named):
                    pass
                elif c.tag in NO_TEXT and c.tag not in ("form", "fieldset"):
                    continue
                elif (c.tag in NO_TEXT or c.named or (c.tag == "header" and not (in_article and _headed(c)))) and (not c.main or c.tag in HEADINGS or _comments(c)):
                    continue
                stack.append((c, in_article or c.tag == "article"))
            kept.append(c)
        node.children = kept


def _headed(node: Node) -> bool:
    return any(x.tag in HEADINGS for x in _subtree(node))


def _comments(node: Node) -> bool:
    attrs = _attributes(node)
    return any(w in COMMENTS for v in ("class", "id") for w in WORDS.findall(attrs.get(v, "").lower()))


def _subtree(root: Node) -> list[Node]:
    """The elements of the subtree, parents before their children."""
    out = [root]
    for node in out:
        out += [c for c in node.children if isinstance(c, Node)]
    return out


def measure(body: Node) -> list[Node]:
    """Set every element's counts, composite density and sum; the elements."""
    nodes = _subtree(body)
    for node in reversed(nodes):
        kids = [c for c in node.children if isinstance(c, Node)]
        own = sum(len(c) - c.count(" ") - c.count("\n") for c in node.children if isinstance(c, str))
        node.chars = own + sum(k.chars for k in kids)
        # line breaks and inline marks of a paragraph are not structure
        node.tags = sum(k.tags + (k.tag not in INLINE or k.tag == "a") for k in kids)
        if node.tag == "a":
            node.link_chars, node.link_tags = node.chars, 1 + node.tags
        else:
            node.link_chars, node.link_tags = sum(k.link_chars for k in kids), sum(k.link_tags for k in kids)
    share = body.link_chars / body.chars if body.chars else 0.0
    for node in nodes:
        node.density = composite(node.chars, node.link_chars, node.tags, node.link_tags, share)
    for node in nodes:
        node.sum = sum(c.density for c in node.children if isinstance(c, Node) and c.tag not in INLINE)
    return nodes


def composite(chars: int, link_chars: int, tags: int, link_tags: int, share: float) -> float:
    """Characters per tag times the logarithm of (characters per linked one times
    tags per link), to a base that grows with linked text: ln(linked times characters over
    unlinked, plus the body's share of linked characters times characters, plus e).  Counts are one at least."""
    if not chars:
        return 0.0
    tags, linked = max(tags, 1), max(link_chars, 1)
    base = math.log(chars / max(chars - link_chars, 1) * linked + share * chars + math.e)
    return chars / tags * math.log(chars / linked * (tags / max(link_tags, 1))) / math.log(base)


def _linked(node: Node) -> bool:
    """A list or box that consists of links."""
    return node.tag in LISTS and node.link_tags >= 2 and node.link_chars >= 0.8 * node.chars


def blocks(chosen: list[Node], skip) -> list[str]:
    """The texts of the blocks of some subtrees in page order, white space as one space."""
    out, held = [], []

    def flush():
        text = " ".join("".join(held).split())
        held.clear()
        if text:
            out.append(text)

    for top in chosen:
        stack: list = [top]
        while stack:
            x = stack.pop()
            if x is None:
                flush()
            elif isinstance(x, str):
                held.append(x)
            elif x.tag == "br":
                held.append(" ")
            elif x is top or not skip(x):
                if x.tag in INLINE:
                    stack += reversed(x.children)
                else:
                    flush()
                    stack.append(None)
                    stack += reversed(x.children)
        flush()
    return out


def main_text(page: str | None) -> str:
    """The main text of a page: blocks in page order, joined by one space."""
    if not page:
        return ""
    root = parse(page)
    prune(root)
    bodies = [n for n in _subtree(root) if n.tag == "body"]
    body = bodies[0] if bodies else root
    nodes = measure(body)
    starts = [n for n in nodes if n.tag == "article" and n.chars]
    starts = starts or [n for n in nodes if (n.tag == "main" or (n.attrs and _attributes(n).get("role") == "main")) and n.chars]
    if starts:
        own = [n for s in starts for n in _subtree(s)]
    else:
        own = nodes
    best = max((n for n in own if n.tag not in INLINE), key=lambda n: (n.sum, n.chars), default=body)
    path = [best]
    while path[-1] is not body:
        path.append(path[-1].parent)
    inside = [n for n in path if n in starts]
    if inside:  # the page says where its text begins and ends
        return " ".join(blocks([inside[-1]], _linked))
    if best is body:
        return " ".join(blocks([body], _linked))
    threshold = min(n.density for n in path[:-1])
    on_path = {id(n): n for n in path}

    def thin(x: Node) -> bool:
        """Beside the path and below its threshold; headings go with what they head."""
        if id(x) in on_path:
            return False
        if id(x.parent) in on_path and x.parent is not best:
            return x.density < threshold and not (x.tag in HEADINGS and x.link_chars < x.chars)
        return _linked(x)

    return " ".join(blocks([path[-2]], thin))


def text_column(page: str = "html") -> Column:
    """The main text of a column of pages; null and empty pages give the empty string."""
    @F.pandas_udf("string")
    def extract(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for pages in batches:
            yield pd.Series([main_text(p) for p in pages], dtype=object)

    return extract(F.col(page).cast("string"))


def extract_pages(pages: DataFrame, page: str = "html") -> DataFrame:
    """``pages`` with ``main_text`` added, or set anew where there is such a column.

    Null and empty pages, and pages without text, give the empty string; pages
    of any length are read whole; repeated rows stay repeated; an empty table
    gives no rows; other columns keep their names and values, whatever they are called.
    """
    return pages.withColumn("main_text", text_column(page))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract_pages(pages).select("page_id", "url", F.col("main_text").alias("text"),
                                       F.length("main_text").cast("long").alias("n_chars"))
