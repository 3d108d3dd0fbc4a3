import html
import re

import pytest

from ferrocar.llm import extract
from tests.conftest import SMALL

EVEN = dict.fromkeys([*extract.TAGS, ""], -0.3)


def test_given_pages_give_their_articles(spark):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet")
    texts = {r.page_id: r for r in extract.extracted(pages).collect()}
    for page in pages.collect():
        body = page.html.partition("<article>")[2].partition("</article>")[0]
        blocks = (" ".join(html.unescape(re.sub("<[^>]*>", "", b)).split()) for b in re.split("</?(?:p|h1)>", body))
        want = "\n".join(b for b in blocks if b)
        assert texts[page.page_id].text == want and texts[page.page_id].n_chars == len(want)


def test_region_matches_brute_force():
    items = [("text", "a b", False, False), ("tag", "a", False, False), ("tag", "a", False, False), ("text", "c", False, False), ("text", "d e f", True, False), ("tag", "p", False, False), ("text", "g h i", False, False)]
    for weight in (-0.1, -0.9, -1.5, -4):
        weights = dict.fromkeys([*extract.TAGS, ""], weight)

        def value(i):
            return 0 if items[i][2] else len(items[i][1].split()) if items[i][0] == "text" else weight

        runs = [(sum(map(value, range(a, b))), -a, b) for a in range(len(items)) for b in range(a + 1, len(items) + 1)]
        begin, end = extract.region(items, weights)
        assert sum(map(value, range(begin, end))) == pytest.approx(max(runs)[0])


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""),
        ("", ""),
        ("plain words", "plain words"),
        ("<p>a < b &amp; c &#8211; d&nbsp; e</p>", "a < b & c – d e"),
        ("<body><nav><ul><li><a>x y</a></ul></nav><main><h1>T</h1><p>one<br>two<p>th<b>re</b>e</main><footer>f f f</footer>", "T\none two\nthree"),
        ("<article><p>first words here</p><div class='ad-slot'>buy buy buy</div><aside>side</aside><p>last</p></article>", "first words here\nlast"),
        ("<article><p>text of it</p><section id=comments><article class=comment><p>nice nice nice nice</p></article></section></article>", "text of it"),
        ("<div class='cookie-notice'><p>we use cookies</p></div><p>body text here</p><form>name <input> <button>go</button></form>", "body text here"),
        ("<p>a b<script>if (x < 3) { '</p>' }</script> c<style>p{}</style></p><!-- no <p>x</p> -->", "a b c"),
        ("<script>never closed <p>x", ""),
        ("<p>a</p><!-- never closed <p>b</p>", "a"),
        ("<p title='1 > 0'>x</p><p title=\"unclosed>y</p>", "x\ny"),
        ("<header><p>site name</p></header><article><header><h1>Title here</h1></header><p>words</p></article>", "Title here\nwords"),
        ("<b>" * 3000 + "deep", "deep"),
    ],
)
def test_pages(page, text):
    assert extract.main_text(page, EVEN) == text


@pytest.mark.parametrize(
    "page",
    [
        '<div class="layout with-sidebar"><article><p>words of it</p></article></div>',
        '<div class="sidebar layout"><article><p>words of it</p></article></div>',
        '<article class="post related-on"><p>words of it</p></article>',
        '<form id=f><div class=menu>menu</div><main><p>words of it</p></main></form>',
        '<form><div class="social"><p>words of it</p></div><div class=ad>buy</div></form>',
    ],
)
def test_wrappers_of_content_are_kept(page):
    assert extract.main_text(f"<body>{page}<div class=share>share</div></body>", EVEN) == "words of it"


def test_a_run_of_links_is_cut_off():
    links = "".join(f"<div><a>l{i}</a></div>" for i in range(30))
    assert extract.main_text(f"{links}<p>{'word ' * 50}</p>{links}", EVEN | {"a": -1, "div": -1}) == ("word " * 50).strip()


def test_odd_tables(spark):
    schema = "page_id long, url string, html string, text string, tag string"
    rows = [(1, None, None, "t", "t"), (1, None, None, "t", "t"), (None, "u", "<p>x</p>", "t", "t"), (2, "u", "<p>" + "long words " * 100_000, "t", "t")]
    got = extract.extracted(spark.createDataFrame(rows, schema)).collect()
    assert sorted((r.page_id or 0, r.n_chars) for r in got) == [(0, 1), (1, 0), (1, 0), (2, 1_099_999)]
    assert extract.extracted(spark.createDataFrame([], schema)).count() == 0
