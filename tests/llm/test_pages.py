"""Wrapper inference on hand-made hosts."""

import json

import pytest

from boxscore.llm import html_wrapper as H

ARTICLE = """<!DOCTYPE html><html><head><title>t</title><style>p{{}}</style><script>var t="</p>";</script></head><body>
<nav><ul><li><a href="/a">Home</a></li></ul></nav><!-- ad --><div class="ad">Buy {i}</div>
<article><h1>Title {i}</h1><p><b>First {i}<br>line &amp; more<p>Second&nbsp;{i} &lt;x&gt;</p>{extra}</article>
<section class="comments"><article class="comment">me too {i}</article></section><footer>&copy; us {i}</footer>"""

PLAIN = """<html><body class="has-sidebar"><div class="cookie-notice">We use cookies</div><div class="wrap"><div class="content">
<h2>Title {i}</h2>{paragraphs}</div><div class="sidebar"><p>Read this</p></div></div><form>Search <button>Go</button></form>
<div class="foot">Contact us</div></body></html>"""


def plain(i):
    return PLAIN.format(i=i, paragraphs="".join(f"<p>Paragraph {i} {j} goes on for quite a while</p>" for j in range(2 + i)))


def rules(pages):
    w = H.as_wrapper(H.parse(pages[0]))
    for p in pages[1:]:
        w = H.aligned(w, H.as_wrapper(H.parse(p)))
    return json.loads(json.dumps(H.rules_of(w, len(pages))))


def test_article_part():
    pages = [ARTICLE.format(i=i, extra="<ul><li>one<li>two</ul>" if i else "") for i in range(3)]
    r = rules(pages)
    assert H.extract(pages[0], r) == "Title 0\n\nFirst 0 line & more\n\nSecond 0 <x>"
    assert H.extract(pages[2], r) == "Title 2\n\nFirst 2 line & more\n\nSecond 2 <x>\n\none\n\ntwo"


def test_dominant_part_and_constants():
    pages = [plain(i) for i in range(4)]
    r = rules(pages)
    assert r["dominant"][-1] == "div.content" and "We use cookies" in r["constants"]
    assert H.extract(pages[1], r).split("\n\n") == ["Title 1"] + [f"Paragraph 1 {j} goes on for quite a while" for j in range(3)]


def test_alignment_makes_optional_and_repeated_groups():
    a, b = (H.as_wrapper(H.parse(x)) for x in ("<div><p>x</p><p>y</p></div>", "<div><h2>t</h2><p>z</p></div>"))
    w = H.aligned(a, b)
    kinds = [(k[0], k[1], k[2]) for k in w[3][0][3]]
    assert kinds == [("h2", 1, 0), ("p", 0, 1)] and w[3][0][3][1][3][0][3] is None


SECTION = "<h2>Part {i} {j}</h2><p>Words of {i} {j} that no other page has, {w}</p><p>More words of {i} {j}, {w}</p>"


def sections(i, n, extra=""):
    words = " ".join(chr(97 + (i * 7 + j) % 26) * 5 for j in range(6))
    return f"<body><div class=top>Welcome back</div><div class=text>{''.join(SECTION.format(i=i, j=j, w=words) for j in range(n))}{extra}</div></body>"


def test_text_of_one_page_is_no_constant():
    pages = [sections(0, 1), sections(1, 1), sections(2, 2, "<blockquote>Said once</blockquote><ul><li>listed once</li></ul><table><tr><td>cell</table>")]
    r = rules(pages)
    got = H.extract(pages[2], r).split("\n\n")
    assert [b for b in got if b.startswith("Part")] == ["Part 2 0", "Part 2 1"]
    assert got[-3:] == ["Said once", "listed once", "cell"] and "Welcome back" not in got and "Welcome back" in r["constants"]


def test_article_text_like_a_constant_stays():
    pages = [sections(i, 2, "<h2>Conclusion</h2><p>Welcome back</p>" if i else "<h2>Conclusion</h2>") for i in range(4)]
    got = H.extract(pages[3], rules(pages)).split("\n\n")
    assert got[-2:] == ["Conclusion", "Welcome back"] and got.count("Welcome back") == 1


@pytest.mark.parametrize("tag", ["article", "main", "div"])
def test_copies_keep_their_text(tag):
    page = "<body><div class=top>Seen {i} times</div><" + tag + "><h1>One title</h1><p>One text on every page</p></" + tag + "></body>"
    pages = [page.format(i=i) for i in range(4)]
    r = rules(pages)
    assert all("One title\n\nOne text on every page" in H.extract(p, r) for p in pages)


def test_main_text_rows(spark):
    rows = [(i, f"https://a.example/{i}", ARTICLE.format(i=i, extra="")) for i in range(6)]
    rows += [(10 + i, f"http://user@B.example:80/{i}", plain(i)) for i in range(4)]
    rows += [(20, None, plain(9)), (21, "https://a.example/x", None), (22, "https://c.example", ""), (23, "https://c.example/y", "<p>" + "long words " * 50_000),
             (24, "::", "no tags < here &am &amp done"), (None, "https://a.example/1", ARTICLE.format(i=1, extra="")), (0, rows[0][1], rows[0][2])]
    df = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, rules string").repartition(4)
    got = H.main_text(df).collect()
    assert len(got) == len(rows) and all(r["n_chars"] == len(r["text"]) for r in got)
    text = {r["page_id"]: r["text"] for r in got}
    assert text[3].startswith("Title 3\n\nFirst 3") and "me too" not in text[3] and "Buy" not in text[3]
    assert text[11].startswith("Title 1\n\nParagraph 1 0") and "cookies" not in text[11]
    assert text[21] == text[22] == "" and text[24] == "no tags < here &am & done" and len(text[23]) == 549_999
    assert H.main_text(df.limit(0)).count() == 0


@pytest.mark.parametrize("html", ["<", "<p", "<!--", "<script>", "</p>", "<a href='>'>x", "&#x110000;", "<p>a</div>b</p>", "<li><li><li>", "<table><td>1<td>2<tr><td>3"])
def test_parse_takes_anything(html):
    H.extract(html, rules([html]))


def test_article_keeps_all_its_parts():
    html = "<article><p>{long}</p></article><article><p>short {i}</p></article>"
    pages = [html.format(i=i, long=f"words of page {i} " * 50) for i in range(4)]
    got = H.extract(pages[2], rules(pages))
    assert got.startswith("words of page 2") and got.endswith("short 2")


def test_repeated_teasers_of_other_articles_go():
    html = "<body><article class=post><h1>T {i}</h1><p>{long}</p></article><div><article class=teaser><p>other {i}</p></article><article class=teaser><p>more {i}</p></article></div>"
    pages = [html.format(i=i, long=f"words of page {i} " * 50) for i in range(4)]
    assert "other" not in H.extract(pages[1], rules(pages)) and H.extract(pages[1], rules(pages)).startswith("T 1")


def test_ids_of_headings_and_anchored_sections_are_no_furniture():
    html = ('<article><h2 id="related-work">Related {i}</h2><section id="search-results"><p>Found {i}</p></section>'
            '<section id="comments"><p>reader {i}</p></section><div id="sidebar">side {i}</div></article>')
    pages = [html.format(i=i) for i in range(3)]
    assert H.extract(pages[1], rules(pages)) == "Related 1\n\nFound 1"


@pytest.mark.parametrize("html, text", [
    ("<html><head><title>t</title><meta x><body><p>All of the page</p>", "All of the page"),
    ("<html><head><title>t</title><p>All of the page</p>", "All of the page"),
    ("<p title=it's>said</p><p class=\"a>b\">more</p><p a='x>y' b=\">\">last</p>", "said\n\nmore\n\nlast"),
    ("<p>x <math><mi>a</mi><mo>+</mo><mn>1</mn></math> y</p>", "x a+1 y")])
def test_lenient_markup(html, text):
    assert H.extract(html, H.NO_RULES) == text


@pytest.mark.parametrize("n", [500, 10_000])
def test_deep_pages(n):
    html = "<div>" * n + "deep text<nav>menu<p>in it</p></nav>" + "".join(f"</div>after {i % 3}" for i in range(n)) + "</span></b></article>" * 1000
    got = H.extract(html, H.NO_RULES).split("\n\n")
    assert got[0] == "deep text" and len(got) == n + 1 and "menu" not in got
    assert H.extract(html, rules([html] * 3)).startswith("deep text\n\nafter 0")


@pytest.mark.parametrize("html", ["<a " * 200_000, "<p =\"" * 200_000, "<a b=\"c\" " * 100_000, "<div>" * 100_000 + "</p>" * 100_000, "<li>" * 100_000])
def test_long_broken_pages_end(html):
    import time
    t0 = time.monotonic()
    H.extract(html, H.NO_RULES)
    assert time.monotonic() - t0 < 10


def test_hosts_that_begin_with_odd_space(spark):
    rows = [(i, f"{s}https://odd.example/{i}", f"<article><p>text {i}</p></article>") for i, s in enumerate("\xa0\x85\x1c  \t")]
    got = {r["page_id"]: r["text"] for r in H.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {i: f"text {i}" for i in range(6)}
