import html
import re

import pytest

from lakeops.llm.html_extract import extracted, main_text
from lakeops.llm.queries import QUERIES
from tests.conftest import SF

BODY = (
    "<h1>Big News</h1><p>First paragraph, with some text. And more, for real; it goes on.</p><p>Short.</p>"
    "<p>A &lt; b &amp;&nbsp;c &#233; <a href='x'>link</a>, then\n more text. Fine, is it?</p><ul><li>one thing</li><li>two</li></ul>"
)
TEXT = "Big News\nFirst paragraph, with some text. And more, for real; it goes on.\nShort.\nA < b & c é link, then more text. Fine, is it?\none thing\ntwo"
AROUND = (
    "<html><head><title>T</title><style>p{{}}</style></head><body class='no-sidebar'><header><h1>Site</h1><p>Welcome, friends, to our site.</p></header>"
    "<nav><ul><li><a href='/'>Home</a></li></ul></nav><div id='cookie-notice'><p>We use cookies, and more. Accept, please.</p></div>{}"
    "<aside><p>A side bar, which is long enough. Yes.</p></aside><div class='ad'>Buy this, now. It is good.</div><section class='comments'><p>I like it, "
    "so much. Great, thanks.</p></section><form><p>Your name, please.</p></form><script>var t='</p>';</script><footer>(c) me, 2020.</footer></body></html>"
)


@pytest.mark.parametrize("frame", ["<article>{}</article>", "<main>{}</main>", "<div class='content'>{}</div>", "<div>{}</div>", "<div id='post-12'>{}</div>"])
def test_the_article_without_what_is_around_it(frame):
    assert main_text(AROUND.format(frame.format(BODY))) == TEXT


def test_broken_markup():
    assert main_text("") == ""
    assert main_text("plain words, no tags. Yes") == "plain words, no tags. Yes"
    assert main_text("<p>a<b>c</b>d <!-- <p>x > --> e<p>f<script>if(a<b){'</p>'}</script>g") == "acd e\nf g"
    assert main_text("1 < 2 and <3 <!-- open") == "1 < 2 and <3"
    assert main_text("<p title='a>b'>in</p><p title='open>next, and on.") != ""
    assert main_text("<div>" * 20_000 + "deep") == "deep"
    assert main_text("<p>" + "word, " * 100_000) == ("word, " * 100_000).strip()
    assert main_text("<p>x &amp &#x41;&unknown; &#0;</p>").startswith("x & A&unknown;")
    assert main_text("<table><tr><td>a, b.<td>c, d.</table>") == "a, b.\nc, d."


def test_every_page_of_the_table(spark):
    """The pages' articles by their own tags, which the operator is not told of."""
    pages = {r.page_id: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    out = QUERIES["op1_tag_path_ratios"](spark, SF).collect()
    assert len(out) == len(pages)
    for r in out:
        inside = re.search("<article>(.*)</article>", pages[r.page_id].html, re.S)[1]
        blocks = (" ".join(html.unescape(re.sub("<[^>]*>", "", x.replace("<br>", " "))).split()) for x in re.split("</?(?:p|h1)>", inside))
        assert r.text == "\n".join(b for b in blocks if b)
        assert (r.url, r.n_chars) == (pages[r.page_id].url, len(r.text))


def test_edge_cases(spark):
    rows = [(1, None, "x"), (2, "", "x"), (None, "<p>a, b.</p>", "x"), (3, "<nav>menu</nav>", None)]
    frame = spark.createDataFrame(rows, "page_id long, html string, text string")
    assert {(r.page_id, r.text) for r in extracted(frame).collect()} == {(1, ""), (2, ""), (None, "a, b."), (3, "")}
    assert extracted(frame.limit(0)).collect() == []


LONG = "<p>A paragraph of the story, which is long enough to be one. It goes on, and on; then it ends, at last.</p>"
SOURCES = "".join(f"<li><a href='{i}'>Author {i}, A title of some length, in a journal, 2001.</a></li>" for i in range(4))


def test_the_threshold_decides_inside_an_article():
    """Teasers below it go; lists of sources, and parts with names that elsewhere surround an article, stay."""
    parts = f"<h2 id='related-work'>Related work</h2>{LONG}<section id='discussion'>{LONG}</section><div class='legal'>{LONG}</div>"
    page = AROUND.format(f"<article>{LONG * 5}{parts}<ol>{SOURCES}</ol><div class='teaser'><span>More</span></div></article>")
    text = main_text(page)
    assert text.count("A paragraph of the story") == 8 and "Related work" in text
    assert text.count("A title of some length") == 4
    assert "More" not in text.split("\n") and "side bar" not in text and "I like it" not in text


def test_headings_with_such_names_without_an_article_element():
    text = main_text(AROUND.format(f"<div>{LONG * 4}<h2 id='related-work'>Related work</h2>{LONG}<h2 class='notice'>Notice</h2>{LONG}</div>"))
    assert text.count("A paragraph") == 6 and "Related work" in text and "Notice" in text and "side bar" not in text


def test_all_kinds_of_blocks_stay_in_an_article():
    kinds = (
        "<ul><li>one</li><li>two</li></ul><pre>x = 1</pre><blockquote><p>Said so</p></blockquote>"
        "<table><tr><th>a</th><td>1</td></tr></table><dl><dt>term</dt><dd>its meaning</dd></dl>"
    )
    text = main_text(AROUND.format(f"<article>{LONG}{kinds}{LONG}</article>"))
    want = ["one", "two", "x = 1", "Said so", "a", "1", "term", "its meaning"]
    assert text.split("\n")[1:-1] == want and text.count("A paragraph") == 2


@pytest.mark.parametrize(
    "open_tag", ["section class='comments'", "div class='comment'", "div class='cookie-notice'", "section class='advert'", "div id='social-share'", "section class='cookie-consent'"]
)
def test_what_stands_in_an_article_and_is_no_part_of_it(open_tag):
    tag = open_tag.split()[0]
    other = f"<{open_tag}><p>I like it, so much, and would say so again. Great, thanks; until next time.</p></{tag}>"
    text = main_text(AROUND.format(f"<article>{LONG * 3}{other}{LONG}</article>"))
    assert text.count("A paragraph") == 4 and "like it" not in text


def test_deep_pages_are_read_in_one_pass():
    """Many open elements, with end tags of other names, end tags left out, and a paragraph far out that a block ends."""
    n = 30_000
    assert main_text("<div>" * n + "</section>" * n + "deep") == "deep"
    assert main_text("<p><button>" + "<div>" * n + "x" * 50 + "</button>") == ""
    inside = "<div>" * n
    assert main_text(f"<ul><li>{'<span>a</span>' * 5}<ul>{'<li>b, c.' * n}</ul></ul>").count("b, c.") == n
    assert main_text(f"<table><tr><td>a, b.{inside}<td>c, d.</table>") == "a, b.\nc, d."
