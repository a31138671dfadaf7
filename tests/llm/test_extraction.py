"""Composite density against a plain recursion, what density decides inside articles, deep pages."""
import math
import random
import time

import pytest

from starforge.llm import op10_html_extraction as op10
from starforge.llm.op10_html_extraction import Dom, Node, main_text

PROSE = "Prose of some length that tells a story, sentence after sentence, without any links in it. " * 3
LONG = f"<p>{PROSE}</p>" * 4


def clean(n=1):
    return " ".join(PROSE.split()) if n == 1 else "\n".join([clean()] * n)


def random_page(rng, depth=0):
    out = []
    for _ in range(rng.randint(1, 4)):
        kind = rng.random()
        if kind < 0.35 or depth > 5:
            out.append("word " * rng.randint(1, 20))
        elif kind < 0.5:
            out.append(f"<a href=x>{'link ' * rng.randint(1, 6)}<i>more</i></a>")
        else:
            tag = rng.choice(["div", "p", "section", "ul", "b", "span"])
            out.append(f"<{tag}>{random_page(rng, depth + 1)}</{tag}>")
    return "".join(out)


def counted(node, linked=False):
    """(characters, tags, linked characters, link tags) under a node, by plain recursion."""
    chars = tags = link_chars = link_tags = 0
    linked = linked or node.tag == "a"
    for c in node.children:
        if isinstance(c, str):
            n = len("".join(c.split()))
            chars, link_chars = chars + n, link_chars + n * linked
        else:
            a, b, d, e = counted(c, linked)
            chars, tags, link_chars, link_tags = chars + a, tags + b + 1, link_chars + d, link_tags + e + (c.tag == "a")
    return chars, tags, link_chars, link_tags


def density(chars, tags, link_chars, link_tags, page):
    if not chars:
        return 0.0
    t = max(tags, 1)
    inner = chars / max(chars - link_chars, 1) * link_chars + page * chars + math.e
    top = (chars / max(link_chars, 1)) * (t / max(link_tags, 1))
    return chars / t * math.log(top) / math.log(max(math.log(inner), math.e)) if top > 1 else 0.0


def test_density_and_sums_as_counted():
    rng = random.Random(1)
    for _ in range(60):
        dom = Dom()
        dom.feed("<body>" + random_page(rng))
        dom.close()
        body = next(c for c in dom.root.children if isinstance(c, Node))
        nodes = op10.elements(body)
        op10.measure(nodes, body)
        whole = counted(body)
        page = whole[2] / max(whole[0], 1)
        sums = {}
        for n in nodes:
            if n.tag != "a":        # a link counts itself among its links
                assert (n.chars, n.tags, n.link_chars, n.link_tags) == counted(n)
                assert n.density == pytest.approx(density(*counted(n), page))
            sums[id(n)] = sum(c.density for c in n.children if isinstance(c, Node))
            assert n.total == pytest.approx(sums[id(n)])
        marked, threshold = op10.containers(body, nodes)
        best = max(sums.values())
        if best:
            assert any(id(n) in marked and n.total == pytest.approx(best) for n in nodes)
            assert 0 <= threshold <= max(n.density for n in nodes)


@pytest.mark.parametrize("block", ['<section class="related-work">', '<div class="social-history">', '<div class="print">',
                                   '<div id="commentRules">'])
def test_prose_stays_whatever_its_class_name_holds(block):
    end = "</section>" if block.startswith("<section") else "</div>"
    assert main_text(f"<body><article>{LONG}{block}<p>{PROSE}</p>{end}</article>") == clean(5)


@pytest.mark.parametrize("block", [
    '<div class="related"><p>Read this</p></div>', '<div class="ad-box">Buy now, today only</div>', '<div class="share-buttons">Share</div>',
    '<div id="siteNav_links">Home</div>', '<aside>Aside</aside>', '<div role="complementary">More</div>', '<div class="tags">x</div>',
    '<div class="related-work"><a href=x>One linked thing</a> <a href=y>Another one</a></div>', '<form><p>Your name</p></form>',
    '<div class="related-history"><i>a</i><b>b</b><i>c</i><b>d</b><u>e</u></div>'])
def test_side_matter_in_an_article_goes(block):
    assert main_text(f"<body><article>{LONG}{block}</article>") == clean(4)


def test_lists_of_links_in_an_article_stay():
    sources = "<ul>" + "".join(f"<li><a href={i}>Source {i}</a></li>" for i in range(5)) + "</ul>"
    listed = "\n".join(f"Source {i}" for i in range(5))
    assert main_text(f"<body><article>{LONG}{sources}</article>") == clean(4) + "\n" + listed
    assert main_text(f"<body><main><h1>Title</h1>{LONG}{sources}</main>") == "Title\n" + clean(4) + "\n" + listed
    menu = sources.replace("<ul>", "<ul class=menu>")
    assert main_text(f"<body><article>{LONG}{menu}</article>") == clean(4)
    # no article or main element: density alone has chosen, and the list has none
    assert main_text(f"<body><div>{LONG}{sources}</div>") == clean(4)


def test_main_keeps_its_heading_and_all_articles():
    page = f"<body><div class=nav>x</div><main><h1>Day</h1><p>A lead.</p><article>{LONG}</article><article>{LONG}</article></main>"
    assert main_text(page) == "Day\nA lead.\n" + clean(8)


def test_several_articles_without_main():
    page = f"<body><article>{LONG}</article><p>between</p><article>{LONG}</article><article><a href=x>teaser</a></article>"
    assert main_text(page) == clean(8)


def test_no_article_element():
    page = f"<body><ul><li><a href=a>Home</a><li><a href=b>Shop</a></ul><div><h2>Head</h2>{LONG}</div><div><a href=c>legal</a></div>"
    assert main_text(page) == "Head\n" + clean(4)


@pytest.mark.parametrize("html", ["<div>" * 100_000 + "x", "<ul><li>" * 50_000 + "x", "<p>" * 100_000 + "x",
                                  "<article><header>" * 30_000 + "x", "<table><tr><td>" * 30_000 + "x", "</div>" * 100_000 + "x"])
def test_deep_pages_take_seconds(html):
    start = time.time()
    assert main_text("<body>" + html) in ("x", "")
    assert time.time() - start < 20
