import html
import re

from daymill.llm import queries, style_tree

SMALL = "/root/testdata/sf0.001"


def by_hand(page):
    body = re.search("<article>(.*?)</article>", page, re.S)[1]
    parts = (html.unescape(re.sub("<[^>]*>", "", p.replace("<br>", " "))) for p in re.split("</?(?:p|h1)>", body))
    return "\n\n".join(filter(None, (re.sub(r"\s+", " ", p).strip() for p in parts)))


def test_query_against_marked_articles(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect()}
    for r in queries.QUERIES["op6_style_tree"](spark, SMALL).collect():
        page = pages.pop(r.page_id)
        assert (r.url, r.text, r.n_chars) == (page.url, by_hand(page.html), len(by_hand(page.html)))
    assert not pages


def texts(page):
    return [b.text for b in style_tree.blocks(page)]


def test_blocks():
    page = (
        '<html><head><title>x</title></head><body class="has-sidebar"><header><h1>Site</h1></header><div id="cookie-notice">We use</div><main><h1>Hi &amp; you&nbsp;x</h1>'
        '<div class="share-box">Share</div><p>One\n two<p>Three<ul><li>a<li>b</ul><div class="comments">no</div></main><aside>z</aside></body></html>'
    )
    assert texts(page) == ["Hi & you x", "One two", "Three", "a", "b"]
    assert texts('<p>a &lt;b&gt; &#233; &notin; c</p><script>if(a<b){x="</p>"}</script><!-- <p>no --> <p>t') == ["a <b> é ∉ c", "t"]
    assert texts("<article><header><h1>Head</h1></header><p>in</p></article><p>out</p>") == ["Head", "in"]
    assert texts("<p>a <b>bold</b><br>line</p><table><tr><td>1<td>2<tr><td>3</table>") == ["a bold line", "1", "2", "3"]
    assert texts('<div role="navigation">menu</div><div hidden>h</div><form>f</form><p>kept</p>') == ["kept"]
    assert texts(None) == texts("") == texts("<script>never closed") == []
    assert texts("1 < 2 and <p title='a>b'>x") == ["1 < 2 and", "x"]


def test_very_long_and_deep_pages():
    assert len(texts("<div>" * 3000 + "x")) == 1
    assert len(texts("<p>word " * 20_000)) == 20_000
    assert texts("<" * 2000) == ["<" * 2000]


def test_branches_that_all_pages_share_go(spark):
    rows = [(i, f"http://h.com/{i}", f'<div class="top">Same words</div><div class="c"><p>Body {i}</p></div>') for i in range(8)]
    rows += [(50 + i, "http://copies.com/x", '<div class="c"><p>One text</p></div>') for i in range(9)]
    rows += [(98, None, '<div class="top">Same words</div>'), (99, "http://h.com/9", None), (100, "few.org", "<p>&amp;</p>")]
    frame = spark.createDataFrame([(*r, "x", "y") for r in rows], "page_id long, url string, html string, noise string, host string")
    found = style_tree.main_text(frame)
    assert found.columns == ["page_id", "url", "noise", "host", "text", "n_chars"]
    got = {r.page_id: r.text for r in found.collect()}
    assert [got[i] for i in range(8)] == [f"Body {i}" for i in range(8)]
    # Copies of one page count once, and are no reason to drop it.
    assert {got[50 + i] for i in range(9)} == {"One text"} and got[98] == "Same words" and got[99] == "" and got[100] == "&"
    assert style_tree.main_text(frame.limit(0)).count() == 0


def test_hosts(spark):
    urls = ["https://User@WWW.a.com:80/x?y#z", "//b.org", "no host", None, "http://c.de?q"]
    frame = spark.createDataFrame([(u,) for u in urls], "url string")
    assert [r[0] for r in frame.select(style_tree.host_of(frame.url)).collect()] == ["www.a.com", "b.org", None, None, "c.de"]
