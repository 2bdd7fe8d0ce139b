import html
import re
import time

import pytest
from pyspark.sql import functions as F

from entityhealth.llm import pagetext

LONG = "A long sentence of the text that goes on for quite a while so that nobody takes it for a menu. "


def test_pages_against_their_articles(spark):
    """The pages of the tables hold their text in one article."""
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    rows = {r.page_id: r.html for r in pages.collect()}
    out = pagetext.extract(pages)
    assert out.columns == ["page_id", "url", "text", "n_chars"]
    for r in out.collect():
        article = re.search(r"<article>(.*?)(</article>|\Z)", rows[r.page_id], re.S)[1]
        blocks = (" ".join(html.unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in re.split(r"</?(?:p|h1|h2)>", article))
        assert r.text == "\n".join(b for b in blocks if b) and r.n_chars == len(r.text)


@pytest.mark.parametrize(
    "page,text",
    [
        (None, ""),
        ("", ""),
        ("plain &amp; simple", "plain & simple"),
        ("<p>one&nbsp;\n two<p>three <b>four</b>", "one two\nthree four"),
        ("<p>cut <b", "cut"),
        ("a <!-- b > c", "a"),
        ("<script>var t='</p>';</script><style>p{}</style><p>x</p><script>open", "x"),
        ("<article><p>&lt;b&gt; &#233; &eacute;</p><p>y<br>z</p></article>", "<b> é é\ny z"),
        ("<main><form><p>mail</p></form><p>two <select><option>x</select> three</p></main>", "two three"),
        ("<article><header><h1>A</h1><p>by me</p></header><p>x</p><aside>no</aside><footer>f</footer></article>", "A\nx"),
        ("<article><p>x</p><div class=ad>buy</article><p>outside</p>", "x"),
        ("<p title='a > b'>q</p>", "q"),
        ("<div hidden><p>no</p></div><p style='display: none'>k</p><p>y</p>", "y"),
        ("<table><tr><td>a</td><td>b</td></tr><tr><td>c</td></tr></table>", "a b\nc"),
        ("<ul><li>a</li><li>b</ul>", "a\nb"),
        ("<body><form id='page'><div>all in one form</div></form></body>", "all in one form"),
        ("<p data-hidden='x' width=3>shown</p><p class='a' hidden>not</p>", "shown"),
    ],
)
def test_small_pages(page, text):
    assert pagetext.main_text(page) == text


NAV = "<div id='nav'><ul>" + "<li><a href='/x'>A link of the menu</a></li>" * 9 + "</ul></div>"
FOOT = "<div class='site-footer'><p>&copy; somebody, all rights reserved, and some more words that fill the line up</p></div>"


@pytest.mark.parametrize(
    "body",
    [
        "<div class='content'><h1>T</h1><p>{0}</p><p>Short.</p><div class='ad-box'>Buy!</div><p>{0}</p></div>",
        "<div class='wrap'><h1>T</h1><p>{0}</p><p>Short.</p><p>{0}</p></div>",
        "<article class='post'><h1>T</h1><p>{0}</p><p>Short.</p><p>{0}</p><section class='comments'><p>{0}{0}</p></section></article>",
        "<main><h1>T</h1><p>{0}</p><p>Short.</p><p>{0}</p><aside><p>{0}</p></aside></main>",
        "<div><article><h1>T</h1><p>{0}</p><p>Short.</p><p>{0}</p></article><article class='comment'><p>{0}{0}{0}{0}</p></article></div>",
        "<div class='cookie-notice'><p>{0}</p></div><div class='entry-content'><h1>T</h1><p>{0}</p><p>Short.</p><p>{0}</p></div>",
        "<div role='main'><h1>T</h1><p>{0}</p><p>Short.</p><p>{0}</p></div><div id='disqus'><p>{0}{0}{0}</p></div>",
    ],
)
def test_pages_of_other_builds(body):
    page = f"<html><head><title>t</title></head><body class='has-sidebar'>{NAV}{body.format(LONG)}{FOOT}</body></html>"
    want = ["T", LONG.strip(), "Short.", LONG.strip()]
    assert pagetext.main_text(page).split("\n") == want


def test_link_lists_without_a_name_are_left_out():
    links = "".join(f"<p><a href='/{i}'>Another story that you may like to read {i}</a></p>" for i in range(12))
    page = f"<body><div>{links}</div><div></div><div><h2>Head</h2><p>{LONG * 3}</p><p>End.</p></div><div></div><div>{links}</div></body>"
    assert pagetext.main_text(page) == f"Head\n{(LONG * 3).strip()}\nEnd."


def test_odd_rows(spark):
    rows = [(1, None, None), (None, "u", "<p>a"), (2, "u", "<p>a"), (2, "u", "<p>a"), (3, "u", "<p>" + "word " * 300_000)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumns({"text": F.lit(1), "n_chars": F.lit(0)})
    got = sorted((r.page_id or 0, r.url or "", r.n_chars) for r in pagetext.extract(pages).collect())
    assert got == [(0, "u", 1), (1, "", 0), (2, "u", 1), (2, "u", 1), (3, "u", 1_499_999)]
    assert pagetext.extract(pages.limit(0)).collect() == []


WORDS = "Many words of the article that is told here at length. " * 8


@pytest.mark.parametrize(
    "body",
    [
        "<a href='#m'>Skip</a><div class='content-sidebar-wrap'><main><article><p>{0}</p></article></main><div id='sidebar'><p>Side.</p></div></div>",
        "<p>Skip to it.</p><div class='container right-sidebar'><article><p>{0}</p></article></div>",
        "<p>Skip to it.</p><form id='aspnet'><div class='page'><article><p>{0}</p></article></div></form>",
        "<form id='aspnet'><div class='page'><p>{0}</p></div></form>",
        "<div class='page-with-sidebar sidebar'><p>{0}</p></div><div class='comments'><p>Nice.</p></div>",
        "<div class='elementor-widget'><p>{0}</p></div><div class='widget'><a href='/'>Home</a></div>",
    ],
)
def test_wrappers_named_like_another_part_keep_the_article(body):
    assert pagetext.main_text(f"<body>{NAV}{body.format(WORDS)}{FOOT}</body>") == WORDS.strip()


def test_a_form_beside_a_line_keeps_its_text():
    page = f"<body><p>Skip.</p><form><p>{WORDS}</p><p>{WORDS}</p></form></body>"
    assert pagetext.main_text(page).endswith(f"{WORDS.strip()}\n{WORDS.strip()}")


def test_long_texts_in_parts_that_may_be_others_stay():
    page = (
        f"<article><p>{WORDS}</p><div class='related-work'><p>{WORDS}</p></div>"
        "<div class='related'><ul><li><a href='/a'>Another story.</a></li></ul></div><div class='share'>Share this</div><p>End.</p></article>"
    )
    assert pagetext.main_text(page).split("\n") == [WORDS.strip(), WORDS.strip(), "End."]


@pytest.mark.parametrize(
    "part",
    [
        "<div class='notice'><p>We use cookies to make the site better.</p></div>",
        "<p class='notice'>Closed on Mondays.</p>",
        "<div class='related'><p>Read more: another story of the same kind.</p></div>",
        "<div class='share-bar'><p>Tell your friends about it.</p></div>",
        "<section class='recommended'><p>You may like this one. And that one.</p></section>",
        "<div id='top-banner'><p>Order before midnight. Pay later.</p></div>",
        "<div class='sponsored'><p>Our partner sells good things. Buy them.</p></div>",
    ],
)
def test_notices_and_the_like_inside_an_article_go(part):
    want = [WORDS.strip(), "Short.", WORDS.strip()]
    body = f"<p>{WORDS}</p><p>Short.</p>{part}<p>{WORDS}</p>"
    for element in ("article", "div class='content'", "div"):
        page = f"<body>{NAV}<{element}>{body}</{element.split()[0]}>{FOOT}</body>"
        assert pagetext.main_text(page).split("\n") == want


def test_legal_lines_at_the_end_of_a_page_of_plain_divs_go():
    legal = "<div><p>Terms of use apply to everything on this site and to all that you send to us, whoever you are and wherever.</p></div><div>Copyright 2024 Somebody Inc. All rights reserved.</div>"
    page = f"<body><div><div><a href='/'>Home</a></div></div><div><p>{WORDS}</p><p>Short end.</p></div>{legal}</body>"
    assert pagetext.main_text(page) == f"{WORDS.strip()}\nShort end."
    assert pagetext.main_text("<body><div>Copyright 2024 Somebody</div></body>") == "Copyright 2024 Somebody"
    assert pagetext.main_text(f"<div><p>{WORDS}</p><p>The copyright is his.</p></div>").endswith("The copyright is his.")


MB = 1 << 20


@pytest.mark.parametrize(
    "shape",
    [
        "<a href=x ",
        "<a href='x ",
        '<a href="x>',
        "<div class='content'>text ",
        "<div><b>x",
        "<div class='ad'>x",
        "<section class='story'><p>word</section></div></b>",
        "</div></p>",
        "<form><main>",
        "<h2>x</h2><div></div><div></div>",
        "<!-- x <",
        "<script>",
        "<p>&#0000065;&amp;&#99999999999;",
        "<td>x</td>",
        "<header>a<h1>b",
        "<p>a <a href=x>b</a>",
    ],
)
def test_broken_pages_take_time_in_proportion(shape):
    """A megabyte of each shape, and half of it in about half the time."""
    took = []
    for size in (MB // 2, MB):
        start = time.perf_counter()
        pagetext.main_text(shape * (size // len(shape)))
        took.append(time.perf_counter() - start)
    assert took[1] < 6 and took[1] < 0.5 + 3.5 * took[0], took


def test_references_by_number():
    assert pagetext.main_text("<p>&#00000000065;&#x0000041;&#x1F600;|&#99999999999;|&#" + "9" * 6000 + ";|&#xFFFFFFFF;") == "AA\U0001f600|\ufffd|\ufffd|\ufffd"


@pytest.mark.parametrize(
    "body,want",
    [
        ("<main><p>{0}</p><p>{0}</p><article class='card'><p>A teaser of some words</p></article></main>", 2),
        ("<div class='content'><p>{0}</p><p>{0}</p></div><article class='card'><p>A teaser of some words</p></article>", 2),
        ("<section class='story'><p>{0}</p><p>{0}</p></section><section class='story'><p>{0}</p></section>", 3),
        ("<div><p>{0}</p><p>{0}</p><p>{0}</p></div><div><article><p>A teaser of some words</p></article></div>", 3),
        ("<main><article><p>{0}</p><p>{0}</p></article><article><p>{0}</p></article></main>", 3),
    ],
)
def test_the_fullest_element_is_chosen_and_its_like_neighbours(body, want):
    got = pagetext.main_text(f"<body>{NAV}{body.format(WORDS)}{FOOT}</body>").split("\n")
    assert got.count(WORDS.strip()) == want


def test_sums_decide_inside_an_element_too():
    links = "<ul>" + "".join(f"<li><a href='/{i}'>Another story to read {i}</a></li>" for i in range(8)) + "</ul>"
    body = f"<h1><a href='/'>Head</a></h1><p>{WORDS}</p><p><a href='/b'>One link.</a></p><p>{WORDS}</p>{links}"
    want = ["Head", WORDS.strip(), "One link.", WORDS.strip()]
    for element in ("article", "main", "section class='story'"):
        page = f"<body><{element}>{body}</{element.split()[0]}></body>"
        assert pagetext.main_text(page).split("\n") == want


def test_text_outside_an_element_stays_where_it_is_far_fuller():
    teasers = f"<main><article><p>{WORDS}</p></article></main>"
    assert pagetext.main_text(f"<body><h1>Head</h1>{teasers}<div><p>Some other line.</p></div></body>") == f"Head\n{WORDS.strip()}"
    short = "<main>" + "<div></div><div><p>A line of a few words.</p></div>" * 20 + "</main>"
    assert WORDS.strip() in pagetext.main_text(f"<body>{short}<div><p>{WORDS}</p></div></body>")


APART = "<div></div><div></div>"


@pytest.mark.parametrize(
    "body,text",
    [
        (f"<h1>Title</h1><div class='ad'>x</div><p>{WORDS}</p><p>More.</p><div class='ad'>y</div><p>Short end.</p>", f"Title\n{WORDS.strip()}\nMore.\nShort end."),
        (f"<div><h1>Title</h1></div>{APART}<div><p>{WORDS}</p></div>{APART}<p>Short end.</p>", f"Title\n{WORDS.strip()}\nShort end."),
        (APART.join(f"<p>A verse of number {i}.</p>" for i in range(5)), "\n".join(f"A verse of number {i}." for i in range(5))),
        (f"<article><p>{WORDS}</p>{APART * 2}<p>One.</p>{APART * 2}<p>Two.</p></article>", f"{WORDS.strip()}\nOne.\nTwo."),
        (f"<div><p>{WORDS}</p></div>{APART * 3}<p>Far away.</p>", WORDS.strip()),
    ],
)
def test_short_lines_beside_a_text_stay(body, text):
    assert pagetext.main_text(f"<body>{body}</body>") == text
