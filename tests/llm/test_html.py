"""Main text of pages."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from skyledger.llm.html_text import extract, main_text

LONG = "A sentence of the article that says something at length, with commas and all. " * 3


@pytest.mark.parametrize("html, text", [
    ("", ""), ("<html><body></body></html>", ""), ("plain  text\nonly", "plain text only"), ("<p>a &amp; b &lt;c&gt; &eacute;&#233;&#x4e2d; &am &quot", 'a & b <c> éé中 &am "'),
    ("<nav><ul><li><a href=/>Menu</a></ul></nav><article><h1>Head</h1><p>One<br>two<p><b>Three</article><footer>&copy; x</footer>", "Head One two Three"),
    (f"<title>t</title><body><header>Site</header><main><h2>T</h2><p>{LONG}</p><p>No.</p><table><tr><td>1<td>2</table></main><aside>side</aside>", f"T {LONG.strip()} No. 1 2"),
    (f"<div class=wrap><div id=sidebar><p>{LONG}</p></div><div class=post><p>{LONG}</p><ul><li>x<li>y</ul></div><div class='ad box'>buy</div></div>", f"{LONG.strip()} x y"),
    (f"<article><p>{LONG}</p><form><p>name</p><input></form><script>var p = '</p>';</script><style>p{{}}</style><!-- no --></article>"
     f"<section id=comments><article class=comment><p>{LONG}</p></article></section>", LONG.strip()),
    ("<article><p>a<span>b</span> c</p>\n<p></p><p>d</p>", "ab c d"),
    ("<div class=cookie-notice>We use</div><div role=navigation>here</div><p>Text", "Text"),
    ("<article><p>unclosed <b>bold <p>next</b> end", "unclosed bold next end"),
])
def test_main_text(html, text):
    assert main_text(html) == text


def test_whole_pages(spark):
    body = "<article>" + "<p>word&nbsp;and word</p>" * 20_000 + "</article>"
    rows = [(1, "u", body), (2, None, None), (None, "v", "<p>x"), (2, None, None)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("text", F.lit(5))
    got = sorted(map(tuple, extract(pages).collect()), key=str)
    want = [(1, "u", " ".join(["word and word"] * 20_000)), (2, None, ""), (2, None, ""), (None, "v", "x")]
    assert got == sorted(want, key=str)
    assert extract(pages.limit(0)).count() == 0


@pytest.mark.parametrize("html, text", [
    ("<p>a<![foo[x]]>b</p>", "ab"), ("<p>a<![ bad", "a"), ("<p>x<a href=\"", "x"), ("<p>x<!-- not closed", "x"), ("<p>1 < 2", "1 < 2"),
    ("<title>t", ""), ("<script>x", ""), ("<p>x<?php echo ?> y", "x y"),
])
def test_broken_markup(html, text):
    assert main_text(html) == text


def test_deep_and_wide_pages_take_no_longer():
    for html in ("<div>" * 30_000 + "x" + "</div>" * 30_000, "<b>x" * 30_000, "<div><p>x" * 30_000, "<p>x" * 30_000, "<a>x<div>" * 30_000):
        assert main_text(html).startswith("x")


def test_all_dense_regions_are_kept():
    """No container of 80 % of the text leaves out what stands beside it."""
    body = f"<div class=body>{f'<p>{LONG}</p>' * 9}</div>"
    want = " ".join(["Title", LONG.strip(), *[LONG.strip()] * 9, "The end of the story comes here, after all that was said at length before it."])
    parts = f"<h1>Title</h1><p>{LONG}</p>{body}<p>The end of the story comes here, after all that was said at length before it.</p>"
    for outer in ("div", "article", "main"):
        assert main_text(f"<body><div><a href=/>Home</a> <a href=/x>More</a></div><{outer}>{parts}</{outer}>") == want
    # a short head alone passes no threshold: the article holds it
    assert main_text(f"<body><p><a href=/>Home</a></p><article><h1>T</h1><div>{f'<p>{LONG}</p>' * 9}</div></article>") == " ".join(["T", *[LONG.strip()] * 9])


@pytest.mark.parametrize("html", [
    "<div class='content has-sidebar'>{0}</div>", "<div id=page class='no-sidebar'><div class=sidebar>side</div>{0}</div>", "<div class=page-widget>{0}</div>",
    "<article><div class=article-header><h2>Head</h2></div>{0}</article>", "<article><h2 id=social-impact>Head</h2>{0}</article>",
    "<article><section id=related-work><p>Head</p></section>{0}</article>", "<article><p id=notice-3>Head</p>{0}</article>",
])
def test_names_of_elements_around_text(html):
    """A word in a class or id takes nothing from the article."""
    text = " ".join([LONG.strip()] * 4)
    page = html.format(f"<p>{LONG}</p>" * 4) + "<div class='box related'><p>You may like this as well</p></div><div id=ad-1>buy</div>"
    assert main_text(page) == ("Head " if "Head" in html else "") + text


def test_an_advert_longer_than_the_article_stays_out():
    assert main_text(f"<div class=ad>{LONG}</div><article><h1>Head</h1><p>Short.</article><div class=related>{LONG}</div>") == "Head Short."
    assert main_text("<ul class=menu><li><a href=/>Home</a></ul>") == ""
