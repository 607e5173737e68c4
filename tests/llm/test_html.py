from __future__ import annotations

import html
import re

import pytest

from airshed.llm import html_text as H
from airshed.llm import queries
from airshed.llm.common import table

from .conftest import SF

CASES = [
    ("<body><article><h1>A &amp; B</h1><p>One <b>t</b>wo<br>three<p>four</article><footer>no</footer>", "A & B One two three four"),
    ("<div class=menu>no</div><div id=content><p>Some longer text here, see <a href=x>this</a>.</p></div><div class='cookie-notice'>no</div>",
     "Some longer text here, see this."),
    ("<main><p>kept text</p><form>no</form><script>no('</p>')</script><style>p{}</style><div class=comments><p>nice post, long comment</p></div></main>", "kept text"),
    ("plain &eacute;&#233;&#xe9; text", "plain ééé text"), ("", ""), ("<div></div>", ""), ("<!-- a --><p>x<!-- y -->z", "xz"),
    ("<p>Energy <math><mi>E</mi><mo>=</mo><mi>m</mi><msup><mi>c</mi><mn>2</mn></msup><annotation>no</annotation></math> holds.", "Energy E=mc2 holds."),
    ("<article><p>Before it.</p><div class=legal><p>What the law says.</p></div><div class=legal-notice><p>no</p></div></article>", "Before it. What the law says."),
    ("<div><p class='a'' id=x>kept <a href=\"y\"\">more</a> text</p></div>", "kept more text"),
    ("<p title='a > b'>one</p><p title=it's>two</p><a href=?q=\"x\">three</a>", "one two three"),
    ("a<!-->b<!-- c --><![CDATA[<d>]]>e <![CDATA[ f> g <!-- h", "ab<d>e g"),
    ("<article><header><h1>Title</h1></header><aside>no</aside><p>a   b&nbsp;c</p></article>", "Title a b c"),
]


@pytest.mark.parametrize("page,want", CASES)
def test_cases(page, want):
    assert H.extract(page, None) == want


def test_pages_against_their_template(spark):
    """The table's pages hold their text in one article element of simple markup."""
    got = {r.page_id: r.text for r in queries.op3_html_text(spark, SF).collect()}
    pages = table(spark, SF, "pages").collect()
    assert len(got) == len(pages)
    for r in pages:
        inner = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        want = " ".join(html.unescape(re.sub(r"</?b>", "", re.sub(r"<(?:/?p|br|/?h1)>", " ", inner))).split())
        assert got[r.page_id] == want


def test_host_consensus_and_odd_rows(spark):
    body = "<div class=x1><p>%s</p></div><div class='y'><p>%s</p></div>"
    long, short = "the article of this page goes on and on " * 3, "short other words"
    rows = [(i, "http://h.org/a", body % (long, short)) for i in range(8)] + [(8, "http://h.org/b", body % ("tiny text", long))]
    rows += [(9, None, None), (10, "http://z.org", ""), (11, "http://h.org/a", "<p>no container</p>"), (11, "http://h.org/a", "<p>no container</p>")]
    df = spark.createDataFrame([(*r, 1, "p") for r in rows], "page_id long, url string, html string, host int, path string")
    got = sorted((r.page_id, r.text) for r in H.main_text(df).collect())
    assert got[8] == (8, "tiny text")  # the host's path wins over the page's own best container
    assert got[0][1] == long.strip() and got[9:] == [(9, ""), (10, ""), (11, "no container"), (11, "no container")]
    assert H.main_text(df.where("false")).count() == 0


def test_split_bodies(spark):
    """A body in sibling containers is taken whole, on the page alone and by the host's path; lists of links and short notes stay out."""
    words = "The council met again on Monday and heard the report of the river board, which "
    page = ("<html><body><div class=links><ul><li><a href=a>One link of many</a><li><a href=b>Another link</a></ul></div>"
            "<div id=content><div class=lead><p>%s opens.</p></div><div class=text><p>%s goes on.</p><p>%s ends.</p></div>"
            "<div class=more><figure><figcaption>Bridge</figcaption></figure><p>%s is added.</p></div></div>"
            "<div class=base><p>All rights kept</p></div></body></html>") % (words, words * 3, words * 2, words)
    want = " ".join(f"{words} opens. {words * 3} goes on. {words * 2} ends. Bridge {words} is added.".split())
    cells = page.replace("<div class=lead>", "<table><tr><td>").replace("opens.</p></div>", "opens.</p></td></tr></table>")
    assert H.extract(page, None) == H.extract(cells, None) == want
    docs = spark.createDataFrame([(i, "http://split.org/a", page) for i in range(4)], "page_id long, url string, html string")
    assert {(r.text, r.path) for r in H.main_text(docs).collect()} == {(want, "/html/body/div")}


NAMED = [  # names that hold a boilerplate word, and whether such an element inside the article's container stays
    ("class='content has-sidebar'", True), ("class=post-with-comments", True), ("class='page side'", True), ("id=legal-analysis", True),
    ("class=entry-header", True), ("class=post-comments", False), ("class='sidebar-left'", False), ("id=mainNav", False),
    ("class='box comment-list'", False), ("class=site-header", False),
]


@pytest.mark.parametrize("names,stays", NAMED)
def test_boilerplate_words_in_names(names, stays):
    long = "The council met again on Monday and heard the report of the river board. " * 3
    page = f"<div id=content><div {names}><p>Short words here.</p></div><p>{long}</p></div>"
    assert H.extract(page, None) == ("Short words here. " if stays else "") + long.strip()
    if stays:
        assert H.extract(f"<div {names}><p>{long}</p></div><p>x</p>", None) == long.strip()


def test_marked_element_with_most_of_the_text_stays():
    long = "The council met again on Monday and heard the report of the river board. " * 3
    other = "<div class=menu><a href=x>" + "a link " * 200 + "</a></div><div class=share>share this</div>"
    for names in ("class=widget", "id=notice", "class=promo"):
        assert H.extract(f"<body>{other}<div {names}><div class=side>note</div><p>{long}</p></div><p>end</p></body>", None).startswith(long.strip())
        assert H.extract(f"<body><div class=search><div {names}><p>{long}</p></div></div></body>", None) == long.strip()
    assert H.extract(f"<body><div class=text><p>kept text</p></div><div class=comments><p>{long}</p></div></body>", None) == "kept text"


def test_broken_markup_never_fails():
    for page in ("<" * 50, "<div" * 50, "</p></div></b>" * 20 + "x", "<p><b><i>" * 300 + "deep", "<script>never closed", "<a href='>x", "&#xZZ; &bogus;"):
        assert isinstance(H.extract(page, "/div"), str)


PATTERNS = {
    "nested": ("<div>", "text of it", "</div>"), "unclosed": ("<div><b>", "text", ""), "stray ends": ("<i>", "text", "</b></u></div>"),
    "inline under blocks": ("<b>", "x", "<div>y</div>"), "raw without end": ("<textarea>", "z", ""), "cdata": ("<![CDATA[", "z>", ""),
    "open tags": ("<a b ", "c", ""), "comments": ("<!-- -", "c", ">"), "quotes": ("<p x='", "c", "> \""), "classes": ("<div class=a/b>", "c", "</i></b>"),
}


@pytest.mark.parametrize("kind", PATTERNS)
def test_time_follows_the_length_of_a_page(kind):
    import time

    head, inner, tail = PATTERNS[kind]
    took = []
    for n in (15_000, 30_000):
        page = "<div><p>first</p>" + head * n + inner + tail * n
        best = float("inf")
        for _ in range(3):
            start = time.process_time()
            H.extract(page, "/div/div")
            best = min(best, time.process_time() - start)
        took.append(best)
    assert took[1] <= 2.5 * took[0] + 0.1


def test_memory_of_deep_pages():
    import tracemalloc

    page = "<div class='some long name of a class'>" * 40_000 + "deep text"
    tracemalloc.start()
    assert H.extract(page, None) == "deep text"
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 200 << 20


def test_paths_by_number():
    _, containers, paths = H.read("<body><div class='b2 a'><section>x</section></div><div class='a b'><p>y</p></div></body>")
    texts = [paths.text(c.path) for c in containers]
    assert texts == ["", "/body", "/body/div.a.b", "/body/div.a.b/section", "/body/div.a.b"]
    assert [paths.number(t) for t in texts[1:]] == [c.path for c in containers[1:]] and paths.number("/body/table") == paths.number("/x") == 0
