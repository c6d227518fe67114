from __future__ import annotations

import html
import itertools
import random
import re

import pytest
from pyspark.sql import functions as F

from deedlens.llm import extraction, queries
from deedlens.llm.extraction import UNTRAINED, blocks, main_text, minimum_cut

SF_DIR = "/root/testdata/sf0.01"


def cost(odds, edges, label):
    own = sum(max(o, 0) if not x else max(-o, 0) for o, x in zip(odds, label, strict=True))
    return own + sum(w for a, b, w in edges if label[a] != label[b])


def test_cut_against_all_labels():
    rng = random.Random(4)
    for _ in range(300):
        n = rng.randrange(1, 9)
        odds = [rng.choice([rng.uniform(-3, 3), rng.randrange(-2, 3)]) for _ in range(n)]
        edges = [(a, b, rng.uniform(0, 3)) for a in range(n) for b in range(a) if rng.random() < 0.5]
        best = min(cost(odds, edges, x) for x in itertools.product((False, True), repeat=n))
        assert cost(odds, edges, minimum_cut(odds, edges)) == pytest.approx(best, abs=1e-6)


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p>";</script></head><body>
<header><a href=/>Site</a></header><nav><ul><li><a href="/a">One</a></li><li><a>Two</a></li></ul></nav>
<div class="cookie-notice">We use cookies. Accept them all now, please.</div>
<article><h1>The&nbsp;title &amp; more</h1><p>First <b>bold</b> and<br>new line &lt;tag&gt;.</p><!-- <p>no</p> -->
<div class="ad">Buy this thing, it is very good.</div><p>Second
   paragraph<p>Unclosed one.<ul><li>An item of the article.</li></ul><form><label>Name</label><input></form></article>
<section id="comments"><p>A reader wrote a long comment here, with sentences. And more.</p></section>
<aside>Read also this</aside><footer>&copy; Site</footer></body></html>"""


def test_page():
    assert main_text(PAGE, UNTRAINED) == (
        "The title & more First bold and new line <tag>. Second paragraph Unclosed one. An item of the article."
    )


@pytest.mark.parametrize(
    "before,after",
    [
        ('<article class="post-123 post hentry tag-politics category-legal">', "</article>"),
        ('<article class="post legal" id="comment">', "</article>"),
        ('<div class="layout has-sidebar"><article>', "</article></div>"),
        ('<div class="sidebar layout"><div id="search"><main>', "</main></div></div>"),
        ('<main><div class="sidebar"><article>', "</article></div></main>"),
        ('<main><div class="post tag-social category-ads no-comments">', "</div></main>"),
    ],
)
def test_names_do_not_lose_the_article(before, after):
    text = "<h1>A headline</h1><p>Short one</p><p>And a sentence, with more of it.</p>"
    page = f'<body><nav><a href="/">Home</a></nav>{before}{text}{after}<footer>End</footer></body>'
    for weights in (UNTRAINED, UNTRAINED * 10):
        assert main_text(page, weights) == "A headline Short one And a sentence, with more of it."


@pytest.mark.parametrize(
    "name", ["ad", "cookie-notice", "site-footer", "nav-menu", "comment-list", "left-sidebar", "related-posts", "tags", "ad-slot-3"]
)
def test_names_of_boilerplate_within_an_article(name):
    for other in (f'class="{name}"', f"id={name}", f'data-x=1 CLASS="x {name} y"'):
        page = f"<article><p>One sentence.</p><div {other}><p>A long one of the others, with a comma.</p></div></article>"
        assert main_text(page, UNTRAINED) == "One sentence."


def test_comments_are_no_articles():
    comment = '<article class="comment-body"><p>A reader wrote this, at some length.</p></article>'
    comments = f'<div id="comments"><ol class="comment-list"><li>{comment}</li></ol></div>'
    assert main_text(f"<main><article><p>The text.</p></article>{comments}</main>", UNTRAINED) == "The text."
    assert main_text(f"<article><p>The text.</p><div class=related>{comment}</div></article>", UNTRAINED) == "The text."


def test_hidden_is_an_attribute_and_no_text_is_lost():
    kept = '<p title="The hidden cost of x" data-a=" hidden " alt="display:none">Cost.</p>'
    formula = "<p>Then <math><mi>x</mi><mo>=</mo><mfrac><mn>1</mn><mn>2</mn></mfrac></math> holds.</p>"
    others = "<xmp><b>raw</b> &amp; text</xmp><object data=a.pdf><p>A fallback.</p></object>"
    gone = '<p hidden>a</p><p HIDDEN="">b</p><p style="color:red; display : none">c</p><p aria-hidden=true>d</p><xmp hidden>e</xmp>'
    assert main_text(f"<article>{kept}{formula}{others}{gone}<p>End.</p></article>", UNTRAINED) == (
        "Cost. Then x = 1 2 holds. <b>raw</b> &amp; text A fallback. End."
    )


def test_page_without_content_markup():
    body = "".join(f"<p>This is sentence number {i}, and it goes on for some more words, as texts do.</p>" for i in range(4))
    page = f"<body><ul><li><a>Home</a></li><li><a>News</a></li></ul><div><h2>A heading</h2>{body}</div><footer>(c)</footer>"
    found = main_text(page, UNTRAINED)
    assert found.startswith("A heading This is sentence number 0") and "Home" not in found and "(c)" not in found


@pytest.mark.parametrize(
    "page", ["", " ", "<", "<p", "</p>", "<!--", "<script>", "&amp;", "<a href='x>y", "<p>" * 3000, "x" * 100_000]
)
def test_broken_pages(page):
    assert isinstance(main_text(page, UNTRAINED), str) and isinstance(blocks(page), list)


def test_query_against_known_template(spark):
    found = queries.QUERIES["op8_extraction"](spark, SF_DIR).collect()
    pages = {r.page_id: r for r in spark.read.parquet(f"{SF_DIR}/pages.parquet").collect()}
    assert len(found) == len(pages)
    for r in found:
        source = pages[r.page_id].html or ""
        article = re.search(r"<article>(.*?)</article>", source, re.S)
        text = re.sub(r"<[^>]*>", " ", article[1]) if article else ""
        assert r.text == " ".join(html.unescape(text).split()) and r.n_chars == len(r.text)


def test_edges(spark):
    df = spark.createDataFrame([(1, None, "x"), (None, "", None), (2, PAGE, "y"), (2, PAGE, "y")], "page_id long, html string, text string")
    weights = extraction.fit(df)
    found = [r[0] for r in df.select(extraction.extract(F.col("html"), weights)).collect()]
    assert found[:2] == ["", ""] and found[2] == found[3] == main_text(PAGE, weights)
    assert (extraction.fit(df.limit(0)) == UNTRAINED).all()
    assert df.limit(0).select(extraction.extract(F.col("html"), weights)).count() == 0
