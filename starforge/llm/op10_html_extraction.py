"""Main text of web pages by composite text density.

For every DOM node the density is its characters per tag, adjusted for the characters
and tags that belong to links (a menu has few characters per tag, nearly all linked).
The sum of its children's densities says how much text a node gathers; the node with the
largest sum in the body is the article's container.  The smallest density on the path from
the body to that node is the threshold: every other subtree at or above it adds its own
largest-sum node.  A container inside ``main`` is widened to the outermost one, so that a heading or
further articles beside it stay; one inside ``article`` is widened to that, and other articles are added if they
reach the threshold.

Before that, subtrees that are no article text by their element, role or class name (menus,
headers, footers, sidebars, notices, adverts, forms, comments, scripts, styles) are cut,
unless they hold the page's article (or, without one, its main heading) themselves.  Inside an ``article`` or
``main`` a class name that only contains such a word beside others (``related-work``) decides nothing: the block
goes if its density is under a quarter of the threshold or half of it is linked.  Lists of links inside them stay, too, unless they are
side matter by name.

Text: character references decoded, white space inside a block turned into one space, blocks
trimmed and joined by one newline in page order; ``br`` counts as white space.

Defined results: null, empty or text-free html gives an empty text; null ids, null urls and
repeated rows are returned as they are; an empty table gives an empty result; other columns
of the input are ignored.
"""
from __future__ import annotations

import math
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame

# FIXED VALUES: element names of HTML by role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption "
                  "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section "
                  "summary table tbody td tfoot th thead tr ul".split())
CLOSES_P = BLOCK - frozenset("body html caption legend td th tr tbody thead tfoot".split())
NEVER_TEXT = frozenset("applet audio button canvas datalist embed frame frameset head iframe input map math noframes "
                       "noscript object option script select style svg template textarea title video".split())
SIDE = frozenset("aside dialog footer menu nav".split())
SIDE_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search "
                       "toolbar".split())
SIDE_NAMES = frozenset("ad ads adv advert advertisement advertisements advertising adverts alert aside banner banners "
                       "breadcrumb breadcrumbs comment commentlist comments consent cookie cookies copyright disclaimer "
                       "disqus footer footnav gdpr header login masthead menu menus modal nav navbar navigation "
                       "newsletter notice notices notification notifications overlay pager pagination popup promo "
                       "promoted promotion recommendations recommended related replies reply respond responses search "
                       "share sharing sidebar sidebars signup skip social sponsor sponsored subscribe subscription "
                       "tagcloud toolbar topbar trending".split())
# Names that say so only when they are a whole class name.
SIDE_WHOLE = frozenset("hidden invisible tags widget widgets".split())
# Words that say nothing beside a name: ``ad-box`` is an advert.
PLAIN_WORDS = frozenset("area bar block body bottom box btn button buttons container content bottom group inner item items js left link "
                        "links list main module outer page panel post right row section site slot text title top wrap "
                        "wrapper".split())
# Class names that density confirms.
DOUBTFUL_WHOLE = frozenset({"print"})
# A doubtful block is prose from this share of the threshold on (small blocks have lower densities).
DOUBTFUL_SHARE = 0.25
# An open element of the first kind ends when one of the second starts.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
        "th": {"td", "th"}, "option": {"option"}}
SCOPE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table", "tr"},
         "th": {"table", "tr"}, "option": {"select"}}
_NAME = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


class Node:
    __slots__ = ("tag", "attrs", "parent", "children", "chars", "tags", "link_chars", "link_tags", "density", "total", "doubtful")

    def __init__(self, tag: str, attrs: dict, parent):
        self.tag, self.attrs, self.parent, self.children, self.doubtful = tag, attrs, parent, [], False


class Dom(HTMLParser):
    """A lenient tree of elements and texts, with the implied ends that matter for text.

    The depths of the open elements of each name are kept, so that asking for one costs no walk.
    """

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("html", {}, None)
        self.depth = 0
        self.depths: dict[str, list[int]] = {}

    def handle_starttag(self, tag, attrs):
        if tag == "html" or tag == "body" and self._open("body"):
            return
        if tag == "body" and self._open("head"):
            self._end("head")
        if tag in CLOSES_P and self._open("p", {"td", "th", "button", "table"}):
            self._end("p")
        for name in ENDS.get(tag, ()):
            if self._open(name, SCOPE[tag]):
                self._end(name)
        node = Node(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.children.append(node)
        if tag not in VOID:
            self.at = node
            self.depth += 1
            self.depths.setdefault(tag, []).append(self.depth)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        if tag not in ("body", "html") and self._open(tag):
            self._end(tag)

    def handle_data(self, data):
        self.at.children.append(data)

    def _open(self, tag, stop=frozenset()):
        """Whether an element of this name is open, with none of ``stop`` opened in it."""
        own = self.depths.get(tag)
        return bool(own) and all(not self.depths.get(name) or self.depths[name][-1] <= own[-1] for name in stop)

    def _end(self, tag):
        last = self.depths[tag][-1]
        while self.depth >= last:
            self.depths[self.at.tag].pop()
            self.at = self.at.parent
            self.depth -= 1


def elements(root: Node) -> list[Node]:
    """All elements under ``root``, itself first, parents before children."""
    out, stack = [], [root]
    while stack:
        node = stack.pop()
        out.append(node)
        stack.extend(c for c in reversed(node.children) if isinstance(c, Node))
    return out


def inside(node: Node, tags) -> bool:
    while node is not None:
        if node.tag in tags:
            return True
        node = node.parent
    return False


def is_side(node: Node) -> bool:
    """Whether its element, role or class name says that a node is no article text."""
    if node.tag in SIDE or node.tag == "header" and not inside(node.parent, ("article", "main")):
        return True
    a = node.attrs
    if not a or node.tag in ("html", "body"):
        return False
    if "hidden" in a or a.get("aria-hidden") == "true" or _HIDDEN.search(a.get("style", "")):
        return True
    if SIDE_ROLES & set(a.get("role", "").lower().split()):
        return True
    classes = a.get("class", "") + " " + a.get("id", "")
    names = {w.lower() for w in _NAME.findall(classes)} & SIDE_NAMES
    if names == {"header"} and inside(node.parent, ("article", "main")):
        return False
    return bool(names or (SIDE_WHOLE | DOUBTFUL_WHOLE) & set(classes.lower().split()))


def is_doubtful(node: Node) -> bool:
    """Whether only a part of a class name, beside words of content, says that a node is side matter."""
    if node.tag in SIDE or "header" == node.tag or SIDE_ROLES & set(node.attrs.get("role", "").lower().split()):
        return False
    a = node.attrs
    if "hidden" in a or a.get("aria-hidden") == "true" or _HIDDEN.search(a.get("style", "")):
        return False
    for name in (a.get("class", "") + " " + a.get("id", "")).split():
        words = {w.lower() for w in _NAME.findall(name)}
        if name.lower() in SIDE_WHOLE or words & SIDE_NAMES and not words - SIDE_NAMES - PLAIN_WORDS:
            return False
    return True


def anchors(nodes: list[Node], side: set[int]) -> list[Node]:
    """What marks the article: article and main elements, else main headings; those outside side matter first."""
    beside: set[int] = set()       # nodes that are or lie in side matter
    for n in nodes:
        if id(n) in side or n.parent is not None and id(n.parent) in beside:
            beside.add(id(n))
    for tags in (("article", "main"), ("h1",)):
        found = [n for n in nodes if n.tag in tags and id(n) not in beside]
        if found:
            return found
    return [n for n in nodes if n.tag in ("article", "main", "h1") and id(n) not in side]


def prune(root: Node) -> None:
    """Cut what is no text, and side matter that does not hold the article itself."""
    nodes = elements(root)
    side = {id(n) for n in nodes if is_side(n)}
    holds = set()  # nodes around what marks the article
    for n in anchors(nodes, side):
        up = n.parent
        while up is not None and id(up) not in holds:
            holds.add(id(up))
            up = up.parent
    within: set[int] = set()       # nodes in an article or main element
    for n in nodes:
        if n.parent is not None and (n.parent.tag in ("article", "main") or id(n.parent) in within):
            within.add(id(n))
    stack = [(root, False)]
    while stack:
        node, in_comments = stack.pop()
        kept = []
        for c in node.children:
            if isinstance(c, Node):
                comments = in_comments or "comment" in (c.attrs.get("class", "") + c.attrs.get("id", "")).lower()
                if c.tag in NEVER_TEXT or c.tag == "form" and (id(c) not in holds or comments):
                    continue
                if id(c) in side and (id(c) not in holds or comments):
                    if not (id(c) in within and is_doubtful(c)):
                        continue
                    c.doubtful = True
                stack.append((c, comments))
            kept.append(c)
        node.children = kept


def measure(nodes: list[Node], body: Node) -> None:
    """Counts, composite density and sum of child densities of every node."""
    for n in nodes:
        n.chars = sum(len("".join(c.split())) for c in n.children if isinstance(c, str))
        n.tags, n.link_chars, n.link_tags, n.total = 0, 0, 0, 0.0
    for n in reversed(nodes):
        if n.tag == "a":
            n.link_chars, n.link_tags = n.chars, n.link_tags + 1
        if n is not body and n.parent is not None:
            p = n.parent
            p.chars += n.chars
            p.tags += n.tags + 1
            p.link_chars += n.link_chars
            p.link_tags += n.link_tags
    linked = body.link_chars / max(body.chars, 1)
    for n in reversed(nodes):
        n.density = composite_density(n, linked)
        if n is not body and n.parent is not None:
            n.parent.total += n.density


def composite_density(n: Node, linked: float) -> float:
    """Characters per tag times the logarithm of how little of both belongs to links.

    ``linked`` is the share of the body's characters in links; the more links a node or the
    page has, the larger the logarithm's base and the smaller the density.
    """
    if not n.chars:
        return 0.0
    tags = max(n.tags, 1)
    unlinked = (n.chars / max(n.link_chars, 1)) * (tags / max(n.link_tags, 1))
    base = math.log(n.chars / max(n.chars - n.link_chars, 1) * n.link_chars + linked * n.chars + math.e)
    return n.chars / tags * max(math.log(unlinked), 0.0) / math.log(max(base, math.e)) if unlinked > 1 else 0.0


def is_link_list(n: Node) -> bool:
    return n.tag in ("ul", "ol", "div", "section", "table", "dl") and n.link_tags >= 3 and n.link_chars >= 0.9 * n.chars


def containers(body: Node, nodes: list[Node]) -> tuple[set[int], float]:
    """Ids of the nodes whose whole text is article text, and the density threshold."""
    best = max(nodes, key=lambda n: n.total)
    if not best.total:
        best = body
    path, node = [], best
    while node is not None and node is not body:
        path.append(node.density)
        node = node.parent
    threshold = min([*path, body.density])
    around = [best, *_ancestors(best)]
    chosen = next((n for tag in ("main", "article") for n in reversed(around) if n.tag == tag), best)
    marked = {id(chosen)}
    if chosen.tag != "main":
        # other dense subtrees beside the container; beside an article only articles
        holding = {id(n) for n in _ancestors(chosen)}
        stack = [c for c in body.children if isinstance(c, Node)]
        while stack:
            n = stack.pop()
            if id(n) in marked:
                continue
            if id(n) in holding:
                stack.extend(c for c in n.children if isinstance(c, Node))
            elif chosen.tag == "article":
                if n.tag == "article":
                    if n.density >= threshold > 0:
                        marked.add(id(n))
                else:
                    stack.extend(c for c in n.children if isinstance(c, Node))
            elif n.density >= threshold > 0:
                marked.add(id(max(elements(n), key=lambda x: x.total) if n.total else n))
    return marked, threshold


def _ancestors(node: Node) -> Iterator[Node]:
    while node.parent is not None:
        node = node.parent
        yield node


def is_cut(node: Node, marked: set[int], threshold: float, by_density: bool) -> bool:
    """Whether a block of the chosen text goes after all: doubtful ones by density and links, lists of links only from
    a container that density alone has chosen."""
    if node.doubtful and (node.density < DOUBTFUL_SHARE * threshold or node.link_chars >= 0.5 * node.chars):
        return True
    return by_density and is_link_list(node) and id(node) not in marked


def block_text(body: Node, marked: set[int], threshold: float) -> str:
    """Texts under marked nodes, one line a block."""
    lines, words = [], []

    def flush() -> None:
        line = " ".join("".join(words).split())
        if line:
            lines.append(line)
        words.clear()

    # an element, whether its text counts, and whether no article or main element is around it
    stack: list = [(body, id(body) in marked, True)]
    while stack:
        item, on, bare = stack.pop()
        if item is None:
            flush()
        elif isinstance(item, str):
            if on:
                words.append(item)
        elif item.tag == "br":
            words.append(" ")
        else:
            on = on or id(item) in marked
            bare = bare and item.tag not in ("article", "main")
            if on and is_cut(item, marked, threshold, bare):
                continue
            if item.tag in BLOCK:
                flush()
                stack.append((None, on, bare))
            stack.extend((c, on, bare) for c in reversed(item.children))
    flush()
    return "\n".join(lines)


def main_text(html: str | None) -> str:
    """The article's text of one page."""
    if not html:
        return ""
    dom = Dom()
    dom.feed(html)
    dom.close()
    prune(dom.root)
    body = next((n for n in dom.root.children if isinstance(n, Node) and n.tag == "body"), dom.root)
    nodes = elements(body)
    measure(nodes, body)
    return block_text(body, *containers(body, nodes))


def extract_main_text(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of ``pages`` (page_id, url, html), one row per row."""

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h) for h in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return pages.selectExpr("cast(page_id as long) page_id", "cast(url as string) url", "cast(html as string) html") \
        .mapInArrow(extract, "page_id long, url string, text string, n_chars long")
