"""HTML extraction: pages of several templates, the scan against brute force, and held-out accuracy."""

import html
import random
import re

import pytest
from pyspark.sql import functions as F

from footfall.llm import extraction
from footfall.llm.extraction import USUAL_COST, Page, learn, main_text
from footfall.llm.queries import QUERIES

SAY = "the committee met on tuesday to discuss what the river had done to the lower fields and who should pay for it"
BODY = [f"{SAY} {n} times over" for n in ("one", "two", "three", "four")]


def text_of(page, shares=None):
    return Page(page).text(dict(shares or {}), USUAL_COST)


def paragraphs(blocks):
    return "".join(f"<p>{b}</p>" for b in blocks)


MENU = '<nav><ul><li><a href="/">Home</a></li><li><a href="/a">About us</a></li></ul></nav>'
WANT = "\n".join(["Floods again", *BODY])
TEMPLATES = {
    "marked": f"<header><h1>Site</h1>{MENU}</header><article><h1>Floods again</h1>{paragraphs(BODY)}</article><footer>Imprint</footer>",
    "main": f"{MENU}<main><h1>Floods again</h1>{paragraphs(BODY)}<aside>See also the weather</aside></main><footer>Imprint and terms</footer>",
    "divs": f'<div id="header"><a href="/">Site</a></div><div class="main-menu"><ul><li><a>Home</a></ul></div><div id="content"><h1>Floods again</h1>{paragraphs(BODY)}</div>'
            '<div class="sidebar"><p>Popular posts of this week</p></div><div id="footer"><p>All rights reserved by the site</p></div>',
    "notices": f'<div class="cookie-notice"><p>We use cookies on this site to make it better for you and for us</p></div><article><h1>Floods again</h1>{paragraphs(BODY[:2])}'
               f'<div class="ad">Buy now, pay later, no questions asked at all</div>{paragraphs(BODY[2:])}</article>',
    "comments": f'<article><h1>Floods again</h1>{paragraphs(BODY)}<section class="comments"><h2>Readers</h2>{paragraphs(["I disagree " * 30])}</section></article>',
    "comments apart": f'<div><h1>Floods again</h1>{paragraphs(BODY)}</div><ol id="comment-list"><li><p>{"Me too " * 100}</p></li></ol><form><label>Your name</label><input></form>',
    "form around all": f"<form method=post><div>{MENU}</div><h1>Floods again</h1>{paragraphs(BODY)}</form>",
    "menu never closed": f"<nav><a href=/>Home</a><article><h1>Floods again</h1>{paragraphs(BODY)}</article>",
    "paragraphs never closed": '<p class="ad">Buy now<p class=ad>Buy more</p><article><h1>Floods again</h1>' + "".join(f"<p>{b}" for b in BODY),
    "raw": f'<title>Floods</title><style>p>b{{}}</style><script>var t="<p>no</p>";</script><noscript>Turn it on</noscript><article><h1>Floods again</h1>{paragraphs(BODY)}</article><script>x',
    "attributes": f'<article data-x="a>b" title=\'<p>\'><h1>Floods again</h1>{paragraphs(BODY)}</article><!-- <p>no</p> --><div hidden>no</div><div style="display: none">no</div>',
}


@pytest.mark.parametrize("name", TEMPLATES)
@pytest.mark.parametrize("around", ["{}", "<!DOCTYPE html><html><head><meta charset=utf-8></head><body>{}</body></html>"])
def test_templates(name, around):
    assert text_of(around.format(TEMPLATES[name])) == WANT


def test_text_of_blocks():
    page = "<article><h1>A&amp;B&nbsp; &lt;c&gt;</h1><p>one<b>two</b>\n\t three<br>four &eacute;&#233;&copy</p><p> </p><ul><li>five<li>six</ul>seven<table><tr><td>8<td>9</table></article>"
    assert text_of(page) == "A&B <c>\nonetwo three four éé©\nfive\nsix\nseven\n8\n9"


@pytest.mark.parametrize("page", ["", "   ", "<", "<<<>", "</p></div>", "<!--", "<script>x", "<a href='x", "<p", "<article></article>", "&", "<p>&#0;&#xD800;</p>", "\0"])
def test_broken_pages(page):
    assert isinstance(text_of(page), str)
    text_of(page + TEMPLATES["marked"])


def test_very_long_pages_are_read_in_one_pass():
    deep = "<div>" * 30_000 + "word " + "</section>" * 30_000 + "<p class='a>" * 20_000
    many = "<article>" + "<p>some words here</p>" * 50_000 + "</article>"
    assert text_of(deep) == "word" and len(text_of(many).split("\n")) == 50_000


def test_region_is_the_best_of_all_regions():
    rng = random.Random(3)
    for _ in range(60):
        parts = [rng.choice(["<p>", "</p>", "<div>", "</div>", "<li>", "<a href=x>", "</a>", "word ", "two words ", "<h2>", '<div class="ad">']) for _ in range(25)]
        page, shares = Page("".join(parts)), {}
        scores = {}
        for run in page.runs:
            for i in range(run[1]):
                scores[run[0] + i] = extraction._share(shares, page.run_kind(run, True))
        for tag in page.tags:
            scores[tag[0]] = -2.0 * extraction._share(shares, page.tag_kind(tag, True))
        line = [scores[i] for i in range(page.length)]
        best = max([sum(line[a:b]) for a in range(len(line)) for b in range(a + 1, len(line) + 1)] + [0.0])
        first, last = page.region(shares, 2.0)
        assert sum(line[first:last]) == pytest.approx(max(best, 0.0))


@pytest.fixture(scope="module")
def pages(spark):
    return spark.read.parquet("/root/testdata/sf0.01/pages.parquet")


def article(page):
    """The blocks of the test pages' article, by their template."""
    blocks = re.split(r"</?(?:p|h1|article)>", re.search(r"<article>(.*?)</article>", page, re.S)[1])
    lines = (" ".join(html.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in blocks)
    return "\n".join(line for line in lines if line)


def test_query_gives_the_article_of_every_page(spark, pages):
    got = {r.page_id: r for r in QUERIES["op12_html_extraction"](spark, "/root/testdata/sf0.01").collect()}
    want = {r.page_id: (r.url, article(r.html)) for r in pages.collect()}
    assert {i: (r.url, r.text) for i, r in got.items()} == want
    assert all(r.n_chars == len(r.text) for r in got.values())


def test_held_out_pages_without_marks(pages):
    """Learned on half of the pages, the other half is extracted with its marks taken out."""
    learned = pages.filter("page_id % 2 = 0")
    bare = pages.filter("page_id % 2 = 1").withColumn("html", F.regexp_replace("html", "</?article>", ""))
    shares, cost = learn(learned)
    assert any(k.startswith("word none part") for k in shares) and cost in extraction.COSTS
    want = {r.page_id: article(r.html).split() for r in pages.filter("page_id % 2 = 1").collect()}
    right = wrong = missed = 0
    for r in main_text(bare, weights=(shares, cost)).collect():
        got = r.text.split()
        common = len(got) - sum(a != b for a, b in zip(got, want[r.page_id])) if len(got) == len(want[r.page_id]) else 0
        right, wrong, missed = right + common, wrong + len(got) - common, missed + len(want[r.page_id]) - common
    assert 2 * right / (2 * right + wrong + missed) > 0.99


def test_nulls_repeats_and_clashing_names(spark):
    rows = [(1, "u", TEMPLATES["divs"]), (1, "u", TEMPLATES["divs"]), (None, None, None), (2, "v", "")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS text", "2 AS n_chars", "3 AS kind")
    got = sorted(map(tuple, main_text(frame).collect()), key=repr)
    assert got == sorted([(1, "u", WANT, len(WANT))] * 2 + [(None, None, "", 0), (2, "v", "", 0)], key=repr)
    assert main_text(frame.limit(0)).collect() == []
