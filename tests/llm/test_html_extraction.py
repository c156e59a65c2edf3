"""op12: the cut against all labellings, its SQL on whole tables (test_oracles), and made pages."""

import itertools
import random

import pytest

from braid.llm import html_extraction as hx

SCORES = hx.scores(hx.prior())


def test_cut_is_the_least_of_all_labellings():
    rng = random.Random(2)
    for _ in range(1500):
        n = rng.randrange(1, 10)
        value = [rng.randrange(-5, 6) for _ in range(n)]
        ties = [(k - 1, k, rng.randrange(0, 5)) for k in range(1, n)] + [(rng.randrange(n), rng.randrange(n), rng.randrange(0, 4)) for _ in range(rng.randrange(n))]

        def cost(label, value=value, ties=ties):
            return sum(abs(v) for v, x in zip(value, label, strict=True) if v and (v > 0) != x) + sum(w for a, b, w in ties if label[a] != label[b])

        least = min((cost(x), sum(x)) for x in itertools.product([False, True], repeat=n))
        got = hx.cut(value, ties)
        assert (cost(got), sum(got)) == least, (value, ties)


def test_cut_of_a_long_page():
    rng = random.Random(5)
    value = [rng.choice([-3, 3]) for _ in range(20_000)]
    ties = [(k - 1, k, 4) for k in range(1, len(value))]
    got = hx.cut(value, ties)
    # on a chain the least cost follows from left to right
    cost = [0, 0]
    for k, v in enumerate(value):
        step = [min(cost[0], cost[1] + 4), min(cost[1], cost[0] + 4)] if k else [0, 0]
        cost = [step[0] + max(v, 0), step[1] + max(-v, 0)]
    assert sum(abs(v) for v, x in zip(value, got, strict=True) if (v > 0) != x) + sum(4 for a, b in itertools.pairwise(got) if a != b) == min(cost)


LONG = "The council said on Tuesday that the bridge would close for repairs, and that traffic would be sent along the river until the work is done."


def test_marked_boilerplate_goes():
    page = f"""<!doctype html><html class=no-js><head><title>T</title><style>p{{}}</style></head><body class="has-sidebar">
    <div id="cookie-notice"><p>{LONG}</p><button>Accept</button></div>
    <header class="site-header"><a href="/">Site</a><form><input name=q><label>Search</label></form></header><nav><ul><li><a href=1>Home</a><li><a href=2>About</a></ul></nav>
    <div class="layout with-sidebar"><main><article class="post"><header><h1>Title</h1></header><p>{LONG}</p><p>Short.</p><div class="ad"><p>{LONG}</p></div>
    <ul><li>One<li>T<b>w</b>o</ul><table><tr><td>a<td>b</table><blockquote>Quote &amp;amp; more&nbsp;&#x41;</blockquote>bare <i>text</i><p>with <a href="x">a link</a>
    <aside>{LONG}</aside><p>After.<br>Next</p></article>
    <section id="comments"><h2>3 comments</h2><article class="comment"><p>{LONG}</p></article><article><p>{LONG * 3}</p></article></section></main>
    <div class="sidebar"><h3>More</h3><p>{LONG}</p></div></div><form action="/s"><p>{LONG}</p></form><footer>© 2020 <a>Imprint</a></footer>
    <script>var a="<p>no</p>";</script><!-- <p>no</p> --><noscript>no</noscript></body></html>"""
    assert hx.text_of(page, SCORES).split("\n") == ["Title", LONG, "Short.", "One", "Two", "a", "b", "Quote &amp; more A", "bare text", "with a link", "After. Next"]


def test_neighbours_decide_where_nothing_is_marked():
    """A short line among long paragraphs stays, the same line among links goes."""
    links = "".join(f"<div><a href={i}>Other story {i}</a></div>" for i in range(6))
    page = f"<div>{links}<div>Yes</div>{links}</div><div><div>{LONG}</div><div>Yes</div><div>{LONG}</div></div>"
    assert hx.text_of(page, SCORES).split("\n") == [LONG, "Yes", LONG]
    p = hx.read(page)
    alone = [a + SCORES[b] for a, b in zip(hx.places(p), hx.shapes(p), strict=True)]
    assert alone[-2] < 0  # by itself it would go


def test_classifier_learns_from_marked_pages(spark):
    """Where articles are lists of short lines and menus are sentences, the weights follow the pages."""
    rows = [(i, f"u{i}", f"<nav><p>{LONG}</p><p>{LONG}</p></nav><article>{'<ul><li>red</li><li>blue</li></ul>' * 3}</article>") for i in range(20)]
    pages = spark.createDataFrame(rows, "page_id int, url string, html string")
    learned = hx.scores(hx.fit(pages))
    page = f"<div><p>{LONG}</p><p>{LONG}</p></div><div><ul><li>red</li><li>blue</li><li>red</li></ul></div>"
    assert hx.text_of(page, learned) == "red\nblue\nred" and hx.text_of(page, SCORES).startswith(LONG)


@pytest.mark.parametrize(
    "html, text",
    [
        (None, ""), ("", ""), ("   ", ""), ("<", ""), ("<article>", ""), ("<nav>only a menu</nav>", ""),
        ("<article><p>one<p>two", "one\ntwo"), ("<article>a < b & c <3</article>", "a < b & c <3"), ("<article>cut <scr", "cut <scr"),
        ("<article>x<script>never closed <p>y", "x"), ("<article>x<!-- never closed <p>y", "x"), ("<ARTICLE><P CLASS='ad'>no</P>yes</ARTICLE>", "yes"),
        ("<article>a&#0;b &unknown; &lt;p&gt;</article>", "a�b &unknown; <p>"), ('<article><p title="a>b">kept</p></article>', "kept"),
        ("<article>  a 　  b\x0b</article>", "a b"), ("</p></div><article>x</div>y</article>", "x\ny"), ("<article>a<b>b</b>c<br/>d</article>", "abc d"),
        ("<article><svg><text>no</text></svg>yes</article>", "yes"),
    ],
)
def test_edges(html, text):
    assert hx.text_of(html or "", SCORES) == text


def test_rows(spark):
    """Null and repeated rows, null ids, clashing names, no rows, a very long page."""
    long = "<article>" + "<p>word &amp; word.</p>" * 60_000 + "</article>"
    rows = [(1, "u", "<article>a</article>", "x", 1), (1, "u", "<article>a</article>", "x", 1), (None, None, None, None, None), (2, None, long, "y", 2)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string, n_chars int")
    w = hx.fit(df)
    got = sorted((tuple(r) for r in hx.extracted(df, w).collect()), key=repr)
    want = "\n".join(["word & word."] * 60_000)
    assert got == sorted([(1, "u", "a", 1), (1, "u", "a", 1), (None, None, "", 0), (2, None, want, len(want))], key=repr)
    assert hx.extracted(df.limit(0), hx.fit(df.limit(0))).collect() == []
