from __future__ import annotations

import itertools
import time

import pytest
from hypothesis import given, settings, strategies as st

from entitylake.llm import html
from entitylake.llm.mincut import minimum_cut

PARAGRAPH = "This is a paragraph of the article, with a few words in it."

PAGES = {
    "site": (
        '<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p>";</script></head><body class="has-sidebar">'
        '<header><h1>Site</h1></header><nav><ul><li><a href="/x">x</a></li></ul></nav><div id="content"><h1>Head line</h1>'
        f"<p>{PARAGRAPH}</p><ul><li>First item</li><li>Second <b>item</b></li></ul><div class=\"ad\">Buy now, it is cheap.</div><p>Last &amp; least.</p></div>"
        f'<div class="sidebar"><p>{PARAGRAPH}</p></div><section id="comments"><p>{PARAGRAPH}</p></section>'
        '<div class="cookie-notice">We use cookies.</div><form><p>Your mail, please</p><input></form><footer>&copy; 2024 me</footer></body></html>',
        "Head line\n" + PARAGRAPH + "\nFirst item\nSecond item\nLast & least.",
    ),
    "article": (
        f"<body><div class=ad>{PARAGRAPH}</div><article><header><h1>Title</h1></header><p><b>Bold.<br><p>{PARAGRAPH}</p><aside>See also this</aside>"
        f'<div class="share-buttons"><a href="#">Share</a></div><blockquote>Quoted words.</blockquote></article><footer>{PARAGRAPH}</footer>',
        f"Title\nBold.\n{PARAGRAPH}\nQuoted words.",
    ),
    "form around all": (f"<form action=x><main><p>{PARAGRAPH}</p></main><p>Search</p></form>", PARAGRAPH),
    "hidden": (f"<article><p>{PARAGRAPH}</p><p hidden>not seen at all</p><div style='display: none'><p>{PARAGRAPH}</p></div></article>", PARAGRAPH),
    "broken": (f"<article><p>one &lt; two &am &quot;x&quot &#233;&nbsp; y<div>three<p>{PARAGRAPH}", f'one < two &am "x" é y\nthree\n{PARAGRAPH}'),
    "less than": (f"<p>a < b and c > d, as everyone knows. {PARAGRAPH}</p>", f"a < b and c > d, as everyone knows. {PARAGRAPH}"),
    "open comment": (f"<p>{PARAGRAPH}</p><!-- <p>gone</p>", PARAGRAPH),
    "open script": (f"<p>{PARAGRAPH}</p><script>var x = '<p>gone</p>'", PARAGRAPH),
    "upper case": (f"<ARTICLE><P CLASS='x>y'>{PARAGRAPH}</P><SCRIPT>x</Script></ARTICLE>", PARAGRAPH),
    "white space": ("<article><pre>a \n\t b\n c</pre><p>  </p><p>x<i> y</i>z<br>w</p></article>", "a b c\nx yz w"),
    "cut off": (f"<article><p>{PARAGRAPH}</p><p>And a <b", f"{PARAGRAPH}\nAnd a"),
    "readers": (f"<main><article><p>{PARAGRAPH}</p><article><p>{PARAGRAPH}</p></article></article><div id=disqus_thread><p>{PARAGRAPH}</p></div></main>", PARAGRAPH),
    "article of a reader": (f"<article class='post'><p>{PARAGRAPH}</p></article><article class='comment'><p>{PARAGRAPH} Yes.</p></article>", PARAGRAPH),
    "topics of a post": (f"<article class='hentry post tag-social category-notice'><p>{PARAGRAPH}</p></article>", PARAGRAPH),
    "no hints": (f"<div><div><a href=x>Home</a> <a href=y>News</a></div><div><p>{PARAGRAPH}</p><p>Short one.</p><p>{PARAGRAPH}</p></div><div>© me</div></div>", f"{PARAGRAPH}\nShort one.\n{PARAGRAPH}"),
    "compound names": (f"<div class='cookiebar'><p>{PARAGRAPH}</p></div><div id=topnav>{PARAGRAPH}</div><div role=complementary><p>{PARAGRAPH}</p></div><div class=entry><p>{PARAGRAPH}</p></div>", PARAGRAPH),
    "nothing": ("", ""),
}
TEXT = " ".join([PARAGRAPH] * 3)
TEASER = "<article><p>A card.</p></article>"
COMMENTS = f"<div id=comments><div class=comment><div class='content text'><p>{PARAGRAPH}</p></div></div></div>"
WRAPPED = {
    "elementor": f"<div class=elementor-widget-wrap><div class='elementor-element elementor-widget'><div class=elementor-widget-container><p>{TEXT}</p><p>{TEXT}</p></div></div></div>",
    "two widgets": "".join(f"<div class='elementor-element elementor-widget'><div class=elementor-widget-container><p>{TEXT}</p></div></div>" for _ in "ab"),
    "genesis": f"<div class=content-sidebar-wrap><main class=content><article class='post entry'><div class=entry-content><p>{TEXT}</p><p>{TEXT}</p></div></article>{COMMENTS}</main><aside class=sidebar><p>{PARAGRAPH}</p></aside></div>",
    "has a sidebar": f"<div class=has-sidebar><p>{TEXT}</p><p>{TEXT}</p><div class='sidebar widget'><p>{PARAGRAPH}</p></div></div>",
    "no sidebar": f"<div class='no-sidebar'><div class=entry><p>{TEXT}</p><p>{TEXT}</p></div>{COMMENTS}</div>",
    "with a banner": f"<div class=page-with-banner><div class=banner-wrap><p>{PARAGRAPH}</p></div><p>{TEXT}</p><p>{TEXT}</p></div>",
    "commentary": f"<section class=commentary><p>{TEXT}</p><p>{TEXT}</p></section><section class=comments><p>{PARAGRAPH}</p></section>",
    "article in an article": f"<article><div><article><p>{TEXT}</p><p>{TEXT}</p></article></div></article>",
    "names around": f"<div class=nav-open><div id=social><article><p>{TEXT}</p><p>{TEXT}</p>{COMMENTS}</article><div class=related>{TEASER}</div></div></div>",
    "hidden": f"<main><p>{TEXT}</p><p>{TEXT}</p></main><div hidden><article><p>{TEXT}</p></article></div>",
}


AROUND = f"<nav><a href=x>Home</a></nav>{{}}<div class=social><p>{PARAGRAPH}</p></div><div class=newsletter>Your mail, please. It is free.</div><footer>© me</footer>"
LONG = "".join(f"<p>{TEXT}</p>" for _ in "abc")
CALLED = {
    "social page": f"<div class=social-page>{LONG}</div>",
    "sponsored content": f"<div class=sponsored-content>{LONG}</div>",
    "nav open": f"<div id=app class=nav-open><div class=story-body>{LONG}</div></div>",
    "modal ready": f"<div class=modal-ready><div class=article-body>{LONG}</div></div>",
    "search page": f"<div class=search-page><div class=entry-content>{LONG}</div></div>",
    "promotion history": f"<section class=promotion-history>{LONG}</section>",
    "form around all": f"<form id=aspnetForm><div id=content>{LONG}</div></form>",
    "many comments": f"<div class=story-body>{LONG}</div><section class=comments>{LONG}{LONG}</section>",
    "feedback": f"<div class=story-body>{LONG}</div><section class=feedback>{LONG}</section>",
    "two columns": f"<div class=story-body>{LONG}</div><div class=sidebar><p>{TEXT}</p></div>",
    "more stories": f"<article>{LONG}<h3>More stories</h3><ul><li><a href=x>One thing that happened</a></li><li><a href=y>Another</a></li></ul></article>",
}


@pytest.mark.parametrize("name", CALLED)
def test_names_count_less_the_more_they_hold(name):
    assert html.main_text(f"<body>{AROUND.format(CALLED[name])}</body>")[0] == "\n".join([TEXT] * 3)


def test_a_main_element_of_links_is_a_list():
    links = "".join(f"<li><a href={i}>Entry number {i}</a></li>" for i in range(5))
    page = f"<nav><ul><li><a href=x>Home</a></li></ul></nav><main><h1>All entries</h1><ul>{links}</ul><nav><a href=n>Next</a></nav></main>"
    assert html.main_text(page)[0] == "\n".join(["All entries", *(f"Entry number {i}" for i in range(5))])


def test_links_in_an_article_stay():
    page = f"<article>{LONG}<h2>Related work</h2><p>See also <a href=x>this one</a>, of which much is said here.</p></article>"
    assert html.main_text(page)[0].endswith("Related work\nSee also this one, of which much is said here.")


@pytest.mark.parametrize("name", WRAPPED)
def test_names_of_wrappers_do_not_empty_a_page(name):
    assert html.main_text(f"<body>{WRAPPED[name]}</body>")[0] == f"{TEXT}\n{TEXT}"


DROPPED = {
    "closed at once": "<p>a <svg class='icon'/> b <math/> c <iframe src='x'/> d <object data='y'/> e <canvas id='z' /> f <textarea/> g</p>",
    "without an end": "<div><p>a <button>no<p>b <select><option>no<p>c <video src=x>no</p><p>d <noscript>no</p><p>e <object>no <audio>no</p><p>f</p></div><button>no<article><p>g</p></article><button>no</button>",
    "in each other": "<p>a <svg><svg><text>no</text></svg>no</svg> b <object><object>no</object>no</object> c <object><svg><path/></svg><p>no<p>no</object> d</p><p>e <template><article>no</article></template> f g</p>",
    "blocks in them": "<p>a b <button><div>no</div></button> c d <select><option>no<option>no</select> e f g</p>",
    "raw text": "<p>a b <script/>no</script> c <iframe><p>no</iframe> d <style>p { }</style> e <xmp><b></xmp> f <script src=x /> g <script>no</script></p>",
}


@pytest.mark.parametrize("name", DROPPED)
def test_only_the_text_of_dropped_elements_goes(name):
    assert " ".join(b.text for b in html.blocks_of(DROPPED[name])) == "a b c d e f g"


@pytest.mark.parametrize("name", PAGES)
def test_main_text(name):
    page, expected = PAGES[name]
    assert html.main_text(page)[0] == expected


@settings(deadline=None, max_examples=150)
@given(st.data())
def test_cut_is_the_cheapest(data):
    n = data.draw(st.integers(0, 7))
    numbers = st.integers(-8, 8)
    gain = [float(data.draw(numbers)) for _ in range(n)]
    pairs = [(i, j) for i in range(n) for j in range(i)]
    edges = [(i, j, float(data.draw(st.integers(0, 4)))) for i, j in pairs if data.draw(st.booleans())]

    def cost(label) -> float:
        alone = sum(abs(g) for g, yes in zip(gain, label) if (g > 0) != yes and g)
        return alone + sum(c for i, j, c in edges if label[i] != label[j])

    found = minimum_cut(gain, edges)
    assert cost(found) == pytest.approx(min(cost(x) for x in itertools.product([True, False], repeat=n)))


def test_smoothness_decides_the_undecided():
    assert minimum_cut([5.0, -0.5, 5.0], [(0, 1, 1.0), (1, 2, 1.0)]) == [True, True, True]
    assert minimum_cut([-5.0, 0.5, -5.0], [(0, 1, 1.0), (1, 2, 1.0)]) == [False, False, False]
    assert minimum_cut([5.0, -3.0, 5.0], [(0, 1, 1.0), (1, 2, 1.0)]) == [True, False, True]


@pytest.mark.parametrize("page", ["<div " * 3000, '<a href="' * 5000 + ">", "<p>" * 20_000 + "x", "<b>" * 5000 + "<p>x" * 500, "<!--" * 3000, "<" * 50_000, ("<p>x</p><nav>y</nav>" * 3000)])
def test_bad_pages_take_no_time(page):
    start = time.perf_counter()
    html.main_text(page)
    assert time.perf_counter() - start < 20


def test_rows(spark):
    rows = [(i, f"u{i}", page, "r", "t", 1) for i, (page, _) in enumerate(PAGES.values())] + [(None, None, None, None, None, None)] * 2
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, row string, text string, found int")
    found = html.extracted(pages).select("row.page_id", "row.url", "text").collect()
    expected = [(i, f"u{i}", text) for i, (_, text) in enumerate(PAGES.values())] + [(None, None, "")] * 2
    assert sorted(map(tuple, found), key=repr) == sorted(expected, key=repr)
    assert html.extracted(pages.limit(0)).count() == 0
