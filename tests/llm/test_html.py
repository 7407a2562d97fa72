import random
import time
from xml.etree import ElementTree

import pytest

from tallyhouse.llm import html_text
from tallyhouse.llm.html_text import Page


@pytest.mark.parametrize("html, text", [
    ("", ""),
    ("<article><h1>T &amp; t</h1><p>a\n\t b&nbsp;c<br>d<p>e <b>f</b>g</article>", "T & t\na b c d\ne fg"),
    ("<body><nav><ul><li>x</ul></nav><p>y</p><footer>z</footer>", "y"),
    ("<div class='page with-sidebar'><article>in</article></div>", "in"),
    ("<article>x<article class='comment'>c</article><div id='comments'><article>d</article></div>y</article>", "x\ny"),
    ("<main><p>m</p></main><p>out</p>", "m"),
    ("<main><p>m</p><article>a</article></main>", "a"),
    ("<header>site</header><article><header>head</header>text</article>", "head\ntext"),
    ("<article>a<script>var t='</p>';</script><style>p{}</style><form>f</form><p hidden>h</p>b</article>", "a\nb"),
    ("</p></b>x<i>y</p>z", "xy\nz"),
    ("<table><tr><td>1<td>2<tr><td>3</table>", "1\n2\n3"),
    ("<ul><li>a<ul><li>b</ul><li>c</ul>", "a\nb\nc"),
    ("<p>&#233;&lt;&notit;", "é<¬it;"),
])
def test_text(html, text):
    assert Page().finish(html).text() == text


def site(n):
    """Pages without marked furniture: a menu, a notice in two wordings, an own text and one paragraph that pages share."""
    rows = []
    for i in range(n):
        body = f"<div><span>Home</span><span>About us</span></div><div>Notice {i % 2}</div><p>Own text {i}.</p>"
        rows.append((i, f"http://www.site.example/{i}", f"<html><body>{body}</body></html>"))
        rows.append((n + i, f"http://other.example/{i}", f"<article><p>Shared.</p><p>Text {i}</p></article><div>Notice 1</div>"))
    rows += [(2 * n + i, f"http://copies.example/{i}", "<body><p>The same page.</p></body>") for i in range(n)]
    return rows


@pytest.mark.parametrize("broadcast_keys", [1000, 0])  # the second takes the joins
def test_templates_go_and_shared_texts_stay(spark, broadcast_keys):
    pages = spark.createDataFrame(site(12), "page_id long, url string, html string")
    found = {r["page_id"]: r["text"] for r in html_text.main_text(pages, broadcast_keys=broadcast_keys).collect()}
    assert all(found[i] == f"Own text {i}." for i in range(12))
    assert all(found[12 + i] == f"Shared.\nText {i}" for i in range(12))
    assert all(found[24 + i] == "The same page." for i in range(12))


def test_small_hosts_have_no_template(spark):
    pages = spark.createDataFrame(site(3), "page_id long, url string, html string")
    found = {r["page_id"]: r["text"] for r in html_text.main_text(pages).collect()}
    assert found[0] == "HomeAbout us\nNotice 0\nOwn text 0."


@pytest.mark.parametrize("html, text", [
    ("<article><div class='market-share'>Market.</div><p class='notice'>No</p><div class='related-work'>RW</div></article>", "Market.\nRW"),
    ("<div class='share-buttons'>tweet</div><p>own</p>", "own"),
    ("<p>x<script>var a='<p>'</script>y<style>p{}</style>z</p>", "xyz"),
    ("<div>" + "Own text. " * 20 + "</div><article>Teaser 1</article><article>Teaser 2</article>", ("Own text. " * 20).strip()),
    ("<article>short</article><article>" + "long " * 9 + "</article>", ("long " * 9).strip()),
    ("<p>a < b &amp; c<d", "a < b & c"),
    ("<p title='a>b' x=\"<p>\">t<!-- <p>no</p> --><!doctype x><?pi?>u", "tu"),
    ("a<!-- never ends <p>b", "a"),
    ("<textarea><p>a</textarea><p>b&lt;/p&gt;", "b</p>"),
])
def test_more_text(html, text):
    assert Page().finish(html).text() == text


@pytest.mark.parametrize("piece", ["<a ", "<!--", "<blockquote>", "<div class=ad>x", "<p><b>", "<script>", "</p>", "<ul><li>", "<", "<a b='", "&"])
def test_a_megabyte_of_anything_takes_seconds(piece):
    html = piece * (1_000_000 // len(piece))
    begin = time.process_time()
    Page().finish(html).text()
    assert time.process_time() - begin < 6  # 2 on a quiet machine


# --- a brute-force version on well-formed pages ---


def plain_subtrees(node, inside, found):
    """Adds (subtree as text, holds running text) of what counts; returns the subtree, its longest text, whether it holds an article."""
    own = inside or node.tag in ("article", "main")
    pieces, longest, holds = [node.tag, node.get("class") or ""], 0, False
    for text in [node.text, *[x for child in node for x in (child, child.tail)]]:
        if text is None or isinstance(text, str):
            if text and text.strip():
                pieces.append(" ".join(text.split()))
                longest = max(longest, len(pieces[-1]))
        else:
            inner, length, held = plain_subtrees(text, own, found)
            holds |= held or (text.tag in ("article", "main") and not own)
            longest = max(longest, length)
            pieces.append(f"({inner})")
    whole = "|".join(pieces)
    counts = not holds and not (node.tag in ("article", "main") and not inside) and len(pieces) > 2
    if counts and not (inside and (longest >= 100 or node.tag in ("p", "li", "b", "h1"))):
        found[whole] = longest >= 100
    return whole, longest, holds


def plain_text(node, inside, template):
    """The blocks of a page without template subtrees; blocks are parted by None."""
    found = {}
    whole, _, _ = plain_subtrees(node, inside, found)
    if whole in found and whole in template:
        return [None]
    own = inside or node.tag in ("article", "main")
    out = [] if node.tag == "b" else [None]
    out.append(node.text or "")
    for child in node:
        out += plain_text(child, own, template)
        out.append(child.tail or "")
    return out if node.tag == "b" else [*out, None]


def plainly(pages):
    counts, total = {}, {}
    for html in set(pages):
        found = {}
        plain_subtrees(ElementTree.fromstring(html), False, found)
        total[html] = found
        for whole, running in found.items():
            counts[whole] = (counts.get(whole, (0, 0))[0] + 1, running)
    template = {w for w, (n, running) in counts.items() if n >= 5 and (not running or n >= 0.01 * len(total))}
    texts = []
    for html in pages:
        root = ElementTree.fromstring(html)
        article = root.find(".//article")
        parts = plain_text(article if article is not None else root, False, template)
        blocks, held = [], ""
        for part in [*parts, None]:
            if part is None:
                blocks += [" ".join(held.split())] if held.strip() else []
                held = ""
            else:
                held += part
        texts.append("\n".join(blocks))
    return texts


def random_site(rng, n):
    """Pages with a menu, boxes inside and outside the article, and paragraphs of their own and shared ones."""
    passage = "A passage that many pages of this host share and that nobody may take for a template. " * 3
    pages = []
    for i in range(n):
        words = " ".join(rng.choice("sun moon star sea hill road tree".split()) for _ in range(rng.randint(3, 40)))
        inner = [f"<p>{words} {i}<b> bold </b>end</p>", "<div class='x7'><b>Sign up</b><ul><li>mail</li></ul></div>", f"<p>{passage}</p>",
                 "<p>Short shared words</p>", f"<div class='x9'>{passage}</div>", f"<div><p>deep {i}</p><div class='box'>More of us</div></div>"]
        rng.shuffle(inner)
        content = "".join(inner[: rng.randint(2, 6)])
        menu = "<div><div class='m'><b>Home</b><b>About</b></div></div>"
        around = f"<article>{content}</article>" if i % 3 else f"<div class='c{i % 2}'>{content}</div>"
        pages.append(f"<body>{menu}{around}<div class='z'>imprint of the site, {'long ' * 30}</div></body>")
    return pages


def test_against_a_brute_force_version(spark):
    rng = random.Random(8)
    pages = random_site(rng, 60)
    pages += pages[:4]
    rows = [(i, f"http://one.example/{i}", html) for i, html in enumerate(pages)]
    found = {r["page_id"]: r["text"] for r in html_text.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    expected = plainly(pages)
    assert [found[i] for i in range(len(pages))] == expected
    changed = sum(Page().finish(html).text() != text for html, text in zip(pages, expected, strict=True))
    print(f"templates change {changed} of {len(pages)} pages")
    assert changed > 40


def test_a_menu_goes_from_a_host_of_any_size(spark):
    menu, long = "<div>Home</div>", "A sentence on one page in two hundred, which is long enough to be running text of these pages. " * 2
    rows = []
    for i in range(1200):
        extra = f"<div>{long}</div>" if i % 200 == 0 else ""
        rows.append((i, "http://large.example/", f"<body>{menu if i < 6 else ''}{extra}<p>Own {i}</p></body>"))
    found = {r["page_id"]: r["text"] for r in html_text.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert found[5] == "Own 5" and found[0] == f"{long.strip()}\nOwn 0"
