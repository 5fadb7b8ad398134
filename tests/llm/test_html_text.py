import pytest

from tributary.llm import QUERIES
from tributary.llm.html_text import extract, main_text

PAGE = """<html><head><title>T</title><script>var t="</p>";</script></head><body>
<header>Site name and a long slogan that goes on and on for many characters indeed</header>
<div id="sidebar"><p>Related stuff goes here and is long enough to be seen as text by the windows</p></div>
<div class="content"><h2>Head &amp; line</h2><p>First paragraph of the text that is long enough to surge the sums.
<p>Second   one<br>here &lt;b&gt;.</p><ul><li>item one<li>item two</ul></div>
<div class="comments"><p>I disagree with all of this, and here is my long rant about it all, which goes on.</p></div>
<form><p>Mail me lots of things <input name=x> and more and more things every single day</p></form>
<footer>bye</footer></body></html>"""


def test_page_without_marked_article():
    assert main_text(PAGE).split("\n\n") == [
        "Head & line",
        "First paragraph of the text that is long enough to surge the sums.",
        "Second one here <b>.",
        "item one",
        "item two",
    ]


@pytest.mark.parametrize(
    ("html", "text"),
    [
        ("", ""),
        ("plain text", "plain text"),
        ("<p>only <b>this</p>", "only this"),
        ("<article><p>a&amp;amp;b &#233;&nbsp; x</article><p>" + "after " * 30, "a&amp;b é x"),
        ("<main><p>one<div class='ad'>buy</div><p>two<aside>no</aside>three</main>", "one\n\ntwo\n\nthree"),
        ("<article><p>a</p><p>" + "long " * 20_000 + "</p><p>b</p></article>", "a\n\n" + ("long " * 20_000).strip() + "\n\nb"),
        ("<article>cut off in a <a href='x", "cut off in a"),
        ("<!-- only a comment", ""),
        ("<nav>menu</nav>", ""),
        ("<article><p>x<script>if (a<b) {}</script>y</p></article>", "xy"),
    ],
)
def test_small_pages(html, text):
    assert main_text(html) == text


BODY = "This is the text of the page, long enough to be found by the windows. " * 5
ASIDE = "<div class='ad'>Buy this now, it is a very good thing to have at home.</div>"


@pytest.mark.parametrize(
    "name",
    [
        "content with-sidebar", "layout no-sidebar", "site has-footer", "sticky-nav", "social-science",
        "elementor-widget elementor-widget-text-editor", "widget", "sidebar", "main-menu",
    ],
)
@pytest.mark.parametrize("inner", ["<article><p>{}</p></article>", "<p>{}</p>", "<div><main>{}</main></div>"])
def test_named_wrapper_keeps_the_text(name, inner):
    page = f"<body><p>Home</p><div class='{name}'>{inner.format(BODY)}{ASIDE}</div></body>"
    assert BODY.strip() in main_text(page) and "Buy" not in main_text(page)
    assert BODY.strip() in main_text(page.replace("class=", "id=", 1))


@pytest.mark.parametrize(
    "name", ["ad", "site-footer", "sidebar left", "x comments", "cookie-banner", "widget-2", "share-buttons", "side-bar"]
)
def test_named_boilerplate_goes(name):
    card = "<article><p>Another text that may be of interest.</p></article>"
    for extra in ("<p>Short or long, this is not the text of the page at all.</p>", card):
        page = f"<main><p>{BODY}</p></main><div class='{name}'>{extra}</div>"
        assert main_text(page) == BODY.strip()
    long = f"<main><p>{BODY}</p><div class='{name}'>{BODY * 3}</div></main>"
    assert main_text(long) == BODY.strip()
    short = f"<article><p>Short.</p></article><div class='{name}'>Not the text.</div>"
    assert main_text(short) == "Short."


@pytest.mark.parametrize("value", ['title="A hidden valley"', "data-x='is hidden '", "alt=' hidden'"])
def test_hidden_is_an_attribute_not_a_value(value):
    assert main_text(f"<p>Down in <a {value}>the valley</a> it rains.</p>") == "Down in the valley it rains."
    for own in ("hidden", "HIDDEN", "hidden=''", f"{value} hidden"):
        assert main_text(f"<main>a<div {own}>b</div>c</main>") == "a\n\nc"


@pytest.mark.parametrize("tag", ["article", "main"])
def test_text_beside_a_small_marked_card(tag):
    card = f"<{tag}><h3>Also of interest</h3></{tag}>"
    body = f"<div class='story'><h1>Title</h1><p>By one</p><p>May</p><p>{BODY}</p><p>{BODY}</p><p>End.</p></div>"
    text = ["Title", "By one", "May", BODY.strip(), BODY.strip(), "End."]
    assert main_text(body + card).split("\n\n") == [*text, "Also of interest"]
    assert main_text(card + body).split("\n\n") == ["Also of interest", *text]
    whole = f"<{tag}><p>{BODY * 5}</p><p>Short.</p></{tag}>"
    assert main_text(f"<p>{BODY}</p>{whole}<div>{BODY}</div>").split("\n\n") == [(BODY * 5).strip(), "Short."]


def test_short_lines_next_to_the_text():
    menu = "<ul><li><a href='/'>Home</a><li><a href='/b'>About</a></ul>"
    lines = ["A title", "by someone", "in May", "2024"]
    opening = "".join(f"<p>{x}</p>" for x in lines)
    page = f"<body>{menu}<div>{opening}<p>{BODY}</p>{ASIDE}{ASIDE}<p>The end.</p></div></body>"
    assert main_text(page).split("\n\n") == [*lines, BODY.strip(), "The end."]


def test_rows(spark):
    rows = [(1, "u", PAGE, 1), (1, "u", PAGE, 1), (2, None, None, 1), (None, "v", "", 1)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    got = {(r.page_id, r.url): (r.text, r.n_chars) for r in extract(df).collect()}
    assert got[2, None] == ("", 0) and got[None, "v"] == ("", 0)
    assert got[1, "u"] == (main_text(PAGE), len(main_text(PAGE)))
    assert extract(df).count() == 4 and extract(df.limit(0)).collect() == []


def test_query_keeps_every_article_paragraph(spark, sf_dir):
    """The pages here are one article each: every word between its tags is kept, none of the rest."""
    import re
    from html import unescape

    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").collect()
    got = {r.page_id: r.text for r in QUERIES["op2_html_extraction"](spark, sf_dir).collect()}
    assert len(got) == len(pages)
    for page in pages:
        inner = re.search(r"<article>(.*?)(</article>|\Z)", page.html, re.S)[1]
        assert got[page.page_id].split() == unescape(re.sub(r"<[^>]*>", " ", inner)).split()


PARTS = [f"Paragraph {n} " + "goes on for long enough to be found by the windows of the page. " * 3 for n in ("ONE", "TWO", "THREE")]


@pytest.mark.parametrize(
    "tags",
    [
        ('<p class="a"">', '<p class="b">', "<p>"),
        ("<p data-x=it's>", "<p title=\"it's\">", "<p>"),
        ('<p><img alt=5">', '<p x"y="z">', "<p>"),
        ("<p class = 'a' b=\"c>d\">", "<p / data-x=/a/b/>", "<p =x =>"),
        ("<p a='>'b>", '<p "">', "<p ''>"),
        ("<p a=>", "<p a= >", "<p a=\n'b'c=d>"),
    ],
)
@pytest.mark.parametrize("wrapper", ["<article>{}</article>", "<div>{}</div>"])
def test_quotation_marks_that_open_no_value(tags, wrapper):
    page = "<body>" + wrapper.format("".join(f"{t}{p}</p>" for t, p in zip(tags, PARTS, strict=True))) + "</body>"
    assert main_text(page).split("\n\n") == [p.strip() for p in PARTS]


@pytest.mark.parametrize("name", ["commentlist", "user-comments", "comment-list", "reader-comments", "left-rail"])
@pytest.mark.parametrize("wrapper", ["<article>{}</article>", "<div>{}</div>"])
def test_comments_and_rails_go(name, wrapper):
    rest = "What a nonsense, I have never read anything like it, and it goes on for a long time."
    body = "".join(f"<p>{p}</p>" for p in PARTS) + f"<ol class='{name}'><li>{rest}</li></ol>"
    assert main_text(f"<body>{wrapper.format(body)}</body>").split("\n\n") == [p.strip() for p in PARTS]


def test_tags_without_an_end_take_linear_time():
    import time

    start = time.perf_counter()
    for page in ("<p " + "a=" * 200_000, "<p " + 'a="' * 100_001, "<" * 300_000, "<p a='" + "x" * 500_000):
        main_text(page)
    assert time.perf_counter() - start < 10
