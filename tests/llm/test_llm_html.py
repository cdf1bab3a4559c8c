"""Wrapper induction: alignment, the given pages against their article element, written pages."""

import html
import re

from panelcast.llm.dom import Page, Shape, match
from panelcast.llm.wrapper_induction import main_texts
from tests.conftest import SF_SMALL

SCHEMA = "page_id long, url string, html string, host string, shape string, keep int, row string, text string, items int"


def extract(spark, rows):
    pages = spark.createDataFrame([(i, u, h, "h", "s", 1, "r", "t", 2) for i, u, h in rows], SCHEMA)
    out = main_texts(pages)
    assert out.columns == ["page_id", "url", "text"]
    return {r.page_id: r.text for r in out.collect()}


def test_shapes_join_equal_neighbours_and_close_open_elements():
    page = Page("<ul><li>a<li>b <i>c</i>&amp;d<br>e</ul><p>x<p>y<div>z</div><table><tr><td>1<td>2<tr><td>3</table>")
    assert page.shape.split("\n") == ["0 ", "1 ul", "2 li", "1 p", "1 div", "1 table", "2 tr", "3 td"]
    assert [t for _, t, _ in page.items] == ["a", "b c&d e", "x", "y", "z", "1", "2", "3"]


def test_hidden_markup_gives_no_text():
    page = Page('a<script>if (x<y) "</p>"</script>b<!-- <p>no</p> -->c<style>p{}</style><noscript>no</noscript>'
                '<p title="a > b">d</p>1 < 2 &lt;b&gt; &copy &am<svg><text>no</text></svg><unclosed')
    assert " ".join(t for _, t, _ in page.items) == "abc d 1 < 2 <b> © &am"


def test_match_keeps_order_and_prefers_equal_labels():
    a = Shape("0 \n1 div.ad\n1 div.text\n2 p\n1 div.end")
    b = Shape("0 \n1 div.text\n2 p\n1 div.end")
    assert match(a, b) == [0, -1, 1, 2, 3]
    assert match(b, a) == [0, 2, 3, 4]
    # A page with another order: an alignment never crosses.
    assert match(Shape("0 \n1 h1\n1 p"), Shape("0 \n1 p\n1 h1")) in ([0, 1, -1], [0, 2, -1], [0, -1, 1])


def test_deep_and_wide_pages():
    deep = Page("<div>" * 3000 + "x" + "</div>" * 3000)
    assert deep.items == [(3000, "x", 0)]
    wide = Page("".join(f"<p class=c{'abc'[k % 3]}>w{k}</p>" for k in range(300)))
    assert len(wide.items) == 300 and match(Shape(wide.shape), Shape(wide.shape)) == list(range(301))


def test_given_pages_equal_their_article(spark):
    from panelcast.llm.q12_html import op12_wrapper_induction
    rows = spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect()
    got = op12_wrapper_induction(spark, SF_SMALL)
    assert dict(got.dtypes) == {"page_id": "bigint", "url": "string", "text": "string", "n_chars": "bigint"}
    got = {r.page_id: r for r in got.collect()}
    assert len(got) == len(rows)
    for r in rows:
        body = re.search("<article>(.*?)</article>", r.html, re.S)[1]
        parts = re.split(r"</?(?:p|h1|br)>", re.sub("</?b>", "", body))
        want = " ".join(html.unescape(" ".join(parts)).split())
        assert (got[r.page_id].text, got[r.page_id].n_chars, got[r.page_id].url) == (want, len(want), r.url)


def soup(k, extra=""):
    """A layout whose names say nothing: only alignment tells template from content."""
    links = "".join(f"<a href=/{j}>Topic {k + j}</a> " for j in range(6))
    return (f"<html><body><div class=c1>The Daily Site</div><div class=c2>{links}</div>{extra}"
            f"<div class=c3><div class=c4>Title number {k}</div><div class=c5>Body of page {k}.<br>More &amp; more.</div>"
            f"<div class=c5>Second  block\n{k * k}</div></div><div class=c6>All rights reserved, call us.</div></body>")


def test_alignment_alone_finds_the_varying_slots(spark):
    rows = [(k, f"http://Soup.example/{k}", soup(k, "<div class=c9><div>Breaking now</div></div>" if k % 3 == 0 else ""))
            for k in range(9)]
    got = extract(spark, rows)
    for k in range(9):
        assert got[k] == f"Title number {k} Body of page {k}. More & more. Second block {k * k}" or (
            k % 3 == 0 and got[k].startswith("Breaking now Title")), got[k]
    # Five pages or more with the optional notice show that its text never varies.
    rows += [(k, f"http://soup.example/{k}", soup(k, "<div class=c9><div>Breaking now</div></div>")) for k in range(9, 20)]
    got = extract(spark, rows)
    assert all(got[k] == f"Title number {k} Body of page {k}. More & more. Second block {k * k}" for k in range(20))


def test_named_parts_go_and_lone_hosts_work(spark):
    page = """<!doctype html><html><head><title>No</title></head><body class="has-sidebar">
      <header class=site>Site <a href=/>home</a></header><div id="cookieNotice">We use cookies, fine?</div>
      <main><div role=navigation>Trail of links</div><article><header><h1>A &eacute;clair</h1></header>
      <p>First <a href=x>linked</a> words.<p hidden>secret<p>Second&nbsp;part<ul><li>one<li>two</ul>
      <form>Your name <input name=n> <button>Send</button></form><div class="share-bar">Tell a friend</div>
      <section class="comments"><p>Reader says hi</p></section></article></main>
      <aside>Side story</aside><div class="ad top">Buy</div><footer>Foot</footer></body></html>"""
    got = extract(spark, [(1, "https://one.example/a", page), (2, None, page), (3, "no scheme", "plain &lt;text&gt;"),
                          (4, "https://one.example/b", None), (5, "https://one.example/c", ""), (5, None, "")])
    want = "A éclair First linked words. Second part one two"
    assert got == {1: want, 2: want, 3: "plain <text>", 4: "", 5: ""}


def test_a_host_of_copies_keeps_its_article(spark):
    page = "<nav>menu</nav><article><h1>Same</h1><p>The same article.</p></article>"
    got = extract(spark, [(k, "http://copies.example/", page) for k in range(8)])
    assert set(got.values()) == {"Same The same article."}


def test_empty_table(spark):
    assert extract(spark, []) == {}
