import re
from html import unescape

import pytest

from lakeops.llm.html_text import content_lines, extract, main_text, smoothed

PAGE = """<!DOCTYPE html><html><head><title>Site</title><style>p{{margin:0}}</style><script>var t="</p>";</script></head><body>
<header><h1>Site name</h1></header><nav><ul><li><a href=x>Home</a><li><a href=y>News</a></ul></nav>
<div id="cookie-notice"><p>We use cookies, and this notice about them has quite a lot of words in it, more than some articles.</p></div>
<div class="wrap"><div class="content">{0}</div><aside><p>Read also this other story with its long and tempting headline.</p></aside>
<div class="ad-box ad">Buy now, the offer of a lifetime, only today and only here.</div>
<form><p>Your mail address here, we never share it with anyone else.</p><input name=q></form>
<section id="comments"><p>I disagree with everything that was said here, and I say so at length.</p></section></div>
<footer>&copy; 2024 Site name</footer></body></html>"""
ARTICLE = ("<h2>A  title</h2><p>First paragraph, long enough to count &amp; be <b>bold <i>in</b> parts</i>,\n or so.<p>Second one "
           "goes on for a while; it has <a href=z>a link</a> in it.</p><p>Short.</p><ul><li>one<li>two</ul>"
           "<p>The last paragraph ends the article with some more words.")
TEXT = ("A title\nFirst paragraph, long enough to count & be bold in parts, or so.\nSecond one goes on for a while; it has a "
        "link in it.\nShort.\none\ntwo\nThe last paragraph ends the article with some more words.")


def test_article_in_a_layout():
    assert main_text(PAGE.format(ARTICLE)) == TEXT
    assert main_text(PAGE.format(f"<article>{ARTICLE}</article>")) == TEXT


@pytest.mark.parametrize("cut", [0, 1, 7, 8, 9, 10])
def test_pages_cut_off(cut):
    whole = "<article><p>Some text here and more</p><p>The next"
    tail = "</article>"[:cut]
    assert main_text(whole + tail) == "Some text here and more\nThe next"


def test_odd_markup():
    assert main_text(None) == main_text("") == main_text("<html></html>") == main_text("<script>x") == ""
    assert main_text("just text &lt;b&gt; &#233; &eacute &notit;") == "just text <b> é é ¬it;"
    assert main_text("<p>a < b &") == "a < b &"
    assert main_text("<head><title>t</title><body><p>text") == "text"
    assert main_text("<p>a<br>b<p>c  d") == "a b\nc d"
    assert main_text("<!-- <p>x</p> --><p>y<!-- open") == "y"
    assert main_text("<p hidden>x</p><p style='display: none'>z</p><p>y") == "y"


def test_headers_of_the_article_stay():
    body = "<p>Some text that is long enough for an article, with a second half.</p><p>More of it follows here.</p>"
    text = "Some text that is long enough for an article, with a second half.\nMore of it follows here."
    for head in ("<header><h1>T</h1></header>", '<div class="article-header"><h1>T</h1></div>'):
        assert main_text(f"<header>Site</header><main><article>{head}{body}</article></main>") == "T\n" + text
    assert main_text(f'<div class="header">Site</div><div class="post"><div class="entry-header"><h2>T</h2></div>{body}</div>') == "T\n" + text
    for ad in ('<div id="ad12">Buy</div>', '<div class="adSlot">Buy</div>', '<div class="entry-footer">Tags</div>', "<div role=search>Find</div>"):
        assert main_text(f"<article>{body}{ad}</article>") == text


PROSE = "".join(f"<p>Paragraph {i} of the article, which says a few things and then some more of them.</p>" for i in range(6))
LINES = "\n".join(f"Paragraph {i} of the article, which says a few things and then some more of them." for i in range(6))


@pytest.mark.parametrize("name", ["site-content has-sidebar", "layout no-sidebar", "post comments-open", "content right-sidebar",
                                  "sidebar", "widget-area"])
def test_wrappers_with_marks(name):
    side = '<div class="sidebar"><p>Read this, too.</p></div>'
    assert main_text(f'<body><div class="{name}"><article>{PROSE}</article></div>{side}</body>') == LINES
    assert main_text(f'<body><div class="{name}">{PROSE}</div>{side}</body>') == LINES
    assert main_text(f'<body><div class="{name}"><article><p>Short.</p></article></div></body>') == "Short."


@pytest.mark.parametrize("part,text", [
    ('<h2 id="related-work">Related work</h2>', "Related work"), ('<h2 id="advertising">Advertising</h2>', "Advertising"),
    ('<p class="notice-period">One month.</p>', "One month."),
    (f'<section id="search-algorithms"><h2>Search algorithms</h2>{PROSE}</section>', "Search algorithms\n" + LINES),
    (f'<section id="advertising"><h2>Advertising</h2>{PROSE}</section>', "Advertising\n" + LINES)])
def test_slugs_of_headings(part, text):
    assert main_text(f"<article>{PROSE}{part}{PROSE}{PROSE}</article>") == "\n".join([LINES, text, LINES, LINES])


def test_marks_of_small_elements():
    for name in ("comments", "related-posts", "ad-slot", "cookieNotice", "sidebar-right", "share social"):
        small = f'<div class="{name}"><p>Something that is not the article.</p></div>'
        assert main_text(f"<article>{PROSE}{small}{PROSE}</article>") == LINES + "\n" + LINES
    assert main_text(f'<article>{PROSE}<p>A line <span class="share">Share</span> with a button.</p></article>') == LINES + "\nA line with a button."


LONG = "".join(f"<p>Remark {i}, which goes on for a while and is not at all a part of the article.</p>" for i in range(14))


@pytest.mark.parametrize("rest", ['<div id="comments">{}</div>', '<section class="comments">{}</section>', '<div class="comment-list">{}</div>',
                                  '<div class="sidebar">{}</div>', '<div class="related-posts">{}</div>', '<div class="ad-slot">{}</div>',
                                  '<div class="cookie-notice">{}</div>', '<form>{}</form>', '<article class="comment">{}</article>'])
def test_boilerplate_goes_however_long(rest):
    """In, beside and without an article, also where it is longer than the article."""
    rest = rest.format(LONG)
    two = "".join(PROSE.partition("</p>")[:2]) * 2
    first = LINES.split("\n")[0]
    assert main_text(f"<body><article>{two}</article>{rest}</body>") == f"{first}\n{first}"
    if "<form" not in rest and "<article" not in rest:
        assert main_text(f"<body><article>{two}{rest}</article></body>") == f"{first}\n{first}"
    assert main_text(f"<body><main><h1>T</h1>{two}</main>{rest}</body>") == f"T\n{first}\n{first}"
    assert main_text(f'<body><div class="layout"><div class="main-column"><h1>T</h1>{PROSE}</div>{rest}</div></body>') == f"T\n{LINES}"
    if ("comment" in rest or "ad-slot" in rest) and "<article" not in rest:  # even if there is nothing else but a title
        assert main_text(f'<body><div class="page"><h1>T</h1>{rest}</div></body>') == "T"


@pytest.mark.parametrize("inner", ["{}", "<article>{}</article>", '<div class="content">{}</div>', '<div class="form-body widget">{}</div>'])
def test_form_around_the_page(inner):
    inner = inner.format(f"<h1>T</h1>{PROSE}")
    fields = '<input name=q><select><option>One<option>Two</select><button>Go</button><textarea>x</textarea>'
    page = f'<body><form id="aspnetForm" class="form">{fields}<nav>Home</nav>{inner}<div class="comments">{LONG}</div></form><footer>F</footer></body>'
    assert main_text(page) == f"T\n{LINES}"
    assert main_text(f'<body><form><p>Name <input></p><p>Mail <input></p></form></body>') == ""
    sign_up = f'<form class="newsletter"><p>Your mail address here, we never share it with anyone else.</p></form>'
    assert main_text(f'<body><form id="aspnetForm"><div class="post"><h1>T</h1>{PROSE}</div></form>{sign_up}</body>') == f"T\n{LINES}"


def block(name, n):
    return f"{name} " + "word " * (n // 5 - 2) + "end."


@pytest.mark.parametrize("around", ["{}", "<body><header>Site</header>{}<footer>Imprint</footer></body>"])
def test_layouts_without_article(around):
    a, b, c, d, long = block("a", 200), block("b", 200), block("c", 200), block("d", 120), block("long", 3000)
    for tag, inner in (("blockquote", "<p>{}</p>"), ("ul", "<li>{}"), ("table", "<tr><td>{}"), ("table", "<tr><td><p>{}</p>")):
        page = f"<div class=content><p>{a}</p><p>{b}</p><{tag}>{inner.format(long)}</{tag}><p>{c}</p></div>"
        assert main_text(around.format(page)) == "\n".join([a, b, long, c])
    body = f"<div class=body><p>{long}</p><p>{b}</p></div>"
    assert main_text(around.format(f"<div class=post><h1>Title</h1><p>{d}</p>{body}</div>")) == "\n".join(["Title", d, long, b])
    assert main_text(around.format(f"<div class=post><h1>Title</h1><p>Lead.</p>{body}</div>")) == "\n".join(["Title", "Lead.", long, b])
    assert main_text(around.format(f"<div class=post><div><h1>Title</h1></div>{body}</div>")) == "\n".join(["Title", long, b])
    page = f"<div class=post><div><p>{a}</p><p>{b}</p></div><div><p>{long}</p><p>{long}</p></div></div>"
    assert main_text(around.format(page)) == "\n".join([a, b, long, long])
    page = f"<div class=post><section><h2>One</h2><p>{d}</p></section><section><p>{long}</p></section><section><p>Two.</p></section></div>"
    assert main_text(around.format(page)) == "\n".join(["One", d, long, "Two."])
    page = f"<div class=post><div><p>{a}</p></div><div><h3>Part</h3></div><div><p>{b}</p><p>{long}</p></div><div><p>{long}</p></div></div>"
    assert main_text(around.format(page)) == "\n".join([a, "Part", b, long, long])


def test_long_and_nested():
    assert len(main_text("<div>" * 20_000 + "x")) == 1
    assert main_text("<p>" + "word " * 100_000) == ("word " * 100_000).strip()
    assert main_text("<a " * 50_000) == ""


def test_smoothing_and_clusters():
    import numpy as np
    flat = smoothed(np.ones(7), 1.0)
    assert flat == pytest.approx(np.ones(7))
    assert content_lines(flat).all()
    assert content_lines(np.array([1.0, 1.2, 9.0, 8.0, 1.1])).tolist() == [False, False, True, True, False]


def test_given_pages(spark):
    """The test pages hold their article in one element: everything in it, and nothing else."""
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    html = {r["page_id"]: r["html"] for r in pages.collect()}
    rows = extract(pages).collect()
    assert len(rows) == len(html) and rows[0].asDict().keys() == {"page_id", "url", "text", "n_chars"}
    for r in rows:
        inner = html[r["page_id"]].split("<article>")[1].split("</article>")[0]
        blocks = [" ".join(unescape(re.sub("<[^>]*>", " ", b)).split()) for b in re.split("</?(?:p|h1)>", inner)]
        assert r["text"] == "\n".join(b for b in blocks if b) and r["n_chars"] == len(r["text"])


def test_odd_rows(spark):
    schema = "page_id bigint, url string, html string, text string, n_chars string"
    rows = [(1, None, "<p>x", "t", "n"), (1, None, "<p>x", "t", "n"), (None, "u", None, None, None), (2, "u", "", None, None)]
    found = extract(spark.createDataFrame(rows, schema)).collect()
    assert sorted((str(r["page_id"]), r["text"]) for r in found) == [("1", "x"), ("1", "x"), ("2", ""), ("None", "")]
    assert extract(spark.createDataFrame([], schema)).count() == 0
