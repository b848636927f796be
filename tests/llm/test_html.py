from __future__ import annotations

import pytest

from blockloom.llm import html

PAGES = {
    "plain": ("<html><body><p>One two.</p><p>Three.</p></body></html>", "One two.\n\nThree."),
    "article": (
        '<html><head><title>T</title><style>p{margin:0}</style><script>var t="</p><article>";</script></head><body>'
        '<nav><ul><li><a href="/a">A long menu entry that goes on and on</a></li></ul></nav><!-- ad <p>x</p> -->'
        '<div class="ad">Buy this long and wonderful product today, it is the best of all.</div>'
        "<article><h1>Title &amp; more</h1><p><b>Bold  start.<br>\n next<p>Short.</p><p>A &lt;p&gt; &#233;&nbsp;x</p>"
        '<section class="comments"><p>Reader says hello to everybody.</p></section></article>'
        "<footer>&copy; me</footer></body></html>",
        "Title & more\n\nBold start. next\n\nShort.\n\nA <p> é x",
    ),
    "unclosed advert": ('<div class="ad">Buy<article><p>Text</p></article>', "Text"),
    "unclosed aside in article": ("<article><p>Text</p><aside>side</article><p>after</p>", "Text"),
    "truncated": ("<article><p>Text goes on and on", "Text goes on and on"),
    "cut tag": ("<article><p>Text</p><p cla", "Text"),
    "no article": (
        '<div><a href="x">Home</a> <a href="y">News</a></div><ul><li><a href="z">Long entry in the list of links</a></li></ul>'
        "<div></div><div></div><div></div>"
        "<div>This is the first long paragraph of the text that counts.</div><div>Short one.</div><div>And <a href='q'>this</a> is the last of them.</div>"
        "<div></div><div></div><div></div><div>Imprint</div>",
        "This is the first long paragraph of the text that counts.\n\nShort one.\n\nAnd this is the last of them.",
    ),
    "form and header": ("<main><header>Site</header><form><input><label>Name</label></form><p>x &am y &amp z</p></main>", "x &am y & z"),
    "quotes": ("<article><p title=\"a > b\">ok</p><p x='\">'>two</p></article>", "ok\n\ntwo"),
    "stray": ("<article><p>1 < 2 and 3 > 2</p></article>", "1 < 2 and 3 > 2"),
    "empty": ("", ""),
    "only markup": ("<div><p></p></div>", ""),
}


@pytest.mark.parametrize("name", PAGES)
def test_main_text(name):
    assert html.main_text(PAGES[name][0]) == PAGES[name][1]


def test_stretches():
    assert html.stretches([0, 0, 50, 0, 3, 0, 0, 0, 9, 0], 40) == [(2, 5)]
    assert html.stretches([], 1) == [] and html.stretches([0, 0], 1) == []


def test_frame(spark):
    rows = [(1, "u", "<p>a</p>", "x"), (1, "u", "<p>a</p>", "x"), (None, None, None, "x"), (2, "v", "<p>" + "long " * 100_000, "x")]
    frame = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string")
    got = sorted((str(r.page_id), r.url, r.text[:9]) for r in html.extract(frame).collect())
    assert got == [("1", "u", "a"), ("1", "u", "a"), ("2", "v", "long long"), ("None", None, "")]
    assert html.extract(frame.limit(0)).collect() == []


LONG = "This is a paragraph of the article that is long enough to surge. " * 4
UNMARKED = {
    "wrapped": (f"<div><p>{LONG}</p></div><div><p>Short one.</p></div><div><section><p>{LONG}</p></section></div>", [LONG, "Short one.", LONG]),
    "inline advert": (f"<p>{LONG}</p><div class=ad><p>Buy</p><p>now</p></div><p>Short one.</p><aside>x</aside><div><nav>y</nav></div><p>{LONG}</p>", [LONG, "Short one.", LONG]),
    "parted": (f"<p>{LONG}</p><div></div><div> </div><div><p></p></div><p>{LONG}{LONG}</p><ul><li><a>A</a><li><a>B</a><li><a>C</a></ul><p>{LONG}</p>", [LONG, LONG + LONG, LONG]),
    "short beginning": (f"<h1>Title</h1><p>One.</p><p>Two.</p><p>Three.</p><p>{LONG}</p>", ["Title", "One.", "Two.", "Three.", LONG]),
    "two short": ("<div><p>A</p></div><div><p>B</p></div>", ["A", "B"]),
    "short, parted": ("<p>A</p><div></div><div></div><div></div><p>B</p>", ["A", "B"]),
}


@pytest.mark.parametrize("name", UNMARKED)
def test_all_pieces_of_an_unmarked_page_stay(name):
    page, want = UNMARKED[name]
    assert html.main_text(page).split("\n\n") == [" ".join(w.split()) for w in want]
