import re

import pytest

from shopgauge.llm.pages import between_surge_and_dive, extract, main_text

LONG = "A sentence that is long enough to be the text of an article, with commas, and an end. "


@pytest.mark.parametrize("page, want", [
    (None, ""),
    ("", ""),
    ("plain", "plain"),
    (LONG, LONG.strip()),
    (f"<p>{LONG}</p><p>Short.</p><p>{LONG}</p>", f"{LONG.strip()}\nShort.\n{LONG.strip()}"),
    (f"<nav><a href=x>Home</a></nav><div class='ad'>{LONG}</div><p>{LONG}</p><footer>{LONG}</footer>", LONG.strip()),
    (f"<ul><li><a>Menu one</a><li><a>Menu two</a><li><a>Menu three</a></ul><h1>Title</h1><p>{LONG}<p>{LONG}<div id=comments><p>{LONG}</p></div>", f"Title\n{LONG.strip()}\n{LONG.strip()}"),
    ("<article><h1>T</h1><p>Be.</article>", "T\nBe."),
    ("<article><p>a &amp;amp; b&nbsp; c &#233;\n d</p></article>", "a &amp; b c é d"),
    ("<article><p><b>One.<br><p>Two</article><p>after", "One.\nTwo"),
    (f"<body class='has-sidebar'><div class='post-content'>{LONG}</div><div class='sidebar'>{LONG}</div></body>", LONG.strip()),
    (f"<script>var t='<p>{LONG}</p>';</script><style>p{{}}</style><!-- {LONG} --><p title='a > b'>{LONG}</p>", LONG.strip()),
    (f"<div>{LONG}</div><form><p>{LONG}</p></form><div role='dialog'>{LONG}</div><aside>{LONG}</aside>", LONG.strip()),
    (f"<article><header><h1>Head</h1></header><p>{LONG}</p><div class='cookie-notice'>{LONG}</div><p>End</p></article>", f"Head\n{LONG.strip()}\nEnd"),
    (f"<p>{LONG} <a href=x>{'link ' * 3}</a> tail</p>", f"{LONG.strip()} link link link tail"),
    (f"<main><p class='ad'>{LONG}<p>{LONG}</main>", LONG.strip()),
    ("<p>unclosed <b", "unclosed"),
    ("<article>1 < 2 and 3 > 2</article>", "1 < 2 and 3 > 2"),
])
def test_pages(page, want):
    assert main_text(page) == want


def test_surge_and_dive():
    assert between_surge_and_dive([0, 5, 0, 50, 0, 9, 0, 0, 0, 4], 3, 40) == [False, True, True, True, True, True, False, False, False, False]
    assert between_surge_and_dive([], 3, 0) == []


def test_long_page():
    page = "<div>" + "<b>x</b> " * 100_000 + "<p>" * 50_000 + "</div>"
    assert len(main_text(page)) == 2 * 100_000 - 1


def test_frame(spark):
    rows = [(1, None, None, 7), (2, "u", "<article>é a</article>", 7), (2, "u", "<article>é a</article>", 7), (None, "u", "", 7)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    got = extract(frame)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    assert [(r.page_id, r.text, r.n_chars) for r in got.collect()] == [(1, "", 0), (2, "é a", 3), (2, "é a", 3), (None, "", 0)]
    assert extract(frame.limit(0)).collect() == []


def test_query(spark):
    """The pages of the test tables mark their article; its lines come back whole."""
    import html

    from shopgauge.llm.queries import QUERIES

    folder = "/root/testdata/sf0.01"
    got = {r.page_id: r for r in QUERIES["op7_html"](spark, folder).collect()}
    pages = spark.read.parquet(f"{folder}/pages.parquet").collect()
    assert len(got) == len(pages)
    for p in pages:
        article = re.search(r"<article>(.*?)</article>", p.html, re.S)[1]
        parts = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", x)).split()) for x in re.split(r"</?p>|</?h1>|<br>", article)]
        want = "\n".join(x for x in parts if x)
        assert (got[p.page_id].text, got[p.page_id].n_chars, got[p.page_id].url) == (want, len(want), p.url)


@pytest.mark.parametrize("page, want", [
    ('<svg class="logo"/><math/><article><p>one <svg class="i"/> two</p><p>three <svg/></p></article>', "one two\nthree"),
    ('<article><p>one <svg class="i"><g><path d="M0"/></g><title/><text>mark</text></svg> two</p><p>three</p></article>', "one two\nthree"),
    ("<article><p>so <math><mrow><mi>x</mi><mo>=</mo><mfrac><mn>1</mn><mn>2</mn></mfrac></mrow></math> holds</p></article>", "so x=12 holds"),
    ("<article><p>one <svg><path d='M0'> gone</p><p>two</p><svg><g><p>three</p></article>", "one\ntwo\nthree"),
    ("<article><p>one <svg><foreignObject><p>label</p></foreignObject></svg> two</p></article>", "one two"),
    ("<svg><g></g></svg></g><article>a <svg></g><style/>b</svg>c<style/>d</article>", "a c"),
])
def test_svg_and_math(page, want):
    assert main_text(page) == want


@pytest.mark.parametrize("page, want", [
    ("<article><h1><a href=x>Title</a></h1><p>Be.</p><ul><li><a href=1>One</a><li><a href=2>Two</a><li><a href=3>Three</a></ul></article>", "Title\nBe.\nOne\nTwo\nThree"),
    (f"<article><p>A</p>{'<p><a href=x>source</a></p>' * 4}<p>Z</p></article>", "A\n" + "source\n" * 4 + "Z"),
    (f"<div><a name=top><p>{LONG}</p><p>{LONG}</p><p>End</p></div>", f"{LONG.strip()}\n{LONG.strip()}\nEnd"),
    (f"<div><p>{LONG * 3}</p><article><a href=x>Card one</a></article><p>{LONG * 3}</p><article>Card two</article><p>{LONG}</p></div>",
     f"{(LONG * 3).strip()}\nCard one\n{(LONG * 3).strip()}\nCard two\n{LONG.strip()}"),
    (f"<div>{LONG}</div><article><p>{LONG * 2}</p></article>", (LONG * 2).strip()),
])
def test_article_whole_and_trusted(page, want):
    assert main_text(page) == want


@pytest.mark.parametrize("page, want", [
    ("<article><p>One.</p><section id='discussion'><h2>Discussion</h2><p>Two.</p></section></article>", "One.\nDiscussion\nTwo."),
    ("<article><section id='search-strategy'><p>One.</p></section><p>Two.</p></article>", "One.\nTwo."),
    ("<article><p class='side-effects'>One.</p><p>Two.</p></article>", "One.\nTwo."),
    ("<article><h2 id='related-work'>Related work</h2><p>Two.</p></article>", "Related work\nTwo."),
    (f"<body><form><div><p>{LONG}</p><p>{LONG}</p></div><input></form></body>", f"{LONG.strip()}\n{LONG.strip()}"),
    ("<body><form><article><p>One.</p></article></form></body>", "One."),
    ("<article><p>One.</p><div class='share-buttons'>Share</div><div class='related-posts'>More</div><ol class='comment-list'><li>Nice</ol></article>", "One."),
    ("<article><p>One.</p><div class='ad-box'>Buy</div><div id='newsletter-signup'>Join</div><div class='cookie-notice'>We</div></article>", "One."),
    (f"<p>{LONG}</p><form><p>{LONG}</p></form>", LONG.strip()),
    ("<form>Name <input></form>", ""),
])
def test_names_inside_an_article_and_pages_in_a_form(page, want):
    assert main_text(page) == want
