import html
import re

import pytest
from pyspark.sql import functions as F

from tidewire.llm import html_main as hm

FOLDER = "/root/testdata/sf0.01"
PAGES = "page_id bigint, url string, html string"


def test_pages_equal_a_plain_reading(spark):
    pages = spark.read.parquet(f"{FOLDER}/pages.parquet")
    got = {r.page_id: r.text for r in hm.extract(pages).collect()}
    assert len(got) == pages.count()
    for p in pages.collect():
        inner = re.search(r"<article>(.*?)(</article>|$)", p.html, re.S)[1]
        parts = re.split(r"<br>|</?p>|</?h1>", re.sub(r"</?b>", "", inner))
        lines = [" ".join(html.unescape(x).split()) for x in parts]
        assert got[p.page_id] == "\n".join(x for x in lines if x)


CASES = [
    ("<p>a&nbsp;&amp;amp; <b>b</b>c<p>d", "a &amp; bc\nd"),
    ("<header>Top</header><div class=has-sidebar><h1>T</h1><ul><li>x<li>y</ul><form>f</form></div>", "T\nx\ny"),
    ("<div id=cookie-notice>k</div><div class='c comments'>z</div><p>t<aside>s</aside>u", "t\nu"),
    ("<article><header><h1>H</h1></header><p>x</p><footer>f</footer></article><p>outside", "H\nx"),
    ("<nav>n</nav><main>m<div class=ad>a</div><script>if (a<b) '</p>'</script>o</main>", "m\no"),
    ("<article class=comment>c</article><article>real</article><article>two</article>", "real\ntwo"),
    ("a < b <3 c <!-- x > y --> <!DOCTYPE d> e", "a < b <3 c e"),
    ("<p title='x>y'>k</p><p hidden", "k\n<p hidden"),
    ("<table><tr><td>1<td>2<tr><td>3</table>", "1\n2\n3"),
    ("<style>p{}", ""), ("", ""), (None, ""), ("<p>line one\n two<br>three", "line one two three"),
    ("</div></p>plain", "plain"), ("<p>" * 5000 + "deep", "deep"), ("<b>" * 3000 + "deep", "deep"),
]


@pytest.mark.parametrize(("source", "expected"), CASES)
def test_main_text(source, expected):
    assert hm.main_text(source, "h") == expected


def test_teaser_articles_beside_the_main_text():
    cards = "<article class=card>card one</article><article class=card>card two</article>"
    text = "<p>the main text of the page is here</p>"
    for page in (f"<main>{text}{cards}</main>", f"<div>{text}</div>{cards}", f"<main>{text}</main>{cards}"):
        assert hm.main_text(page, "h").startswith("the main text of the page is here")
    assert hm.main_text("<main><article><p>a</p></article></main><p>b", "h") == "a"


def test_site_style_tree_removes_what_every_page_shows(spark):
    """A box without a telling name, equal on all pages of one host; another host's boxes differ."""
    page = "<div class=wrap><div class=z7>{box}</div><p>text {i} of the page</p></div>"
    rows = [(i, "http://same.example/x", page.format(box="Read our story of the year", i=i)) for i in range(20)]
    rows += [(100 + i, "https://u:p@Other.example:80/", page.format(box=f"box {i}", i=i)) for i in range(20)]
    pages = spark.createDataFrame(rows, PAGES)
    got = {r.page_id: r.text for r in hm.extract(pages).collect()}
    assert got[3] == "text 3 of the page" and got[103] == "box 3\ntext 3 of the page"
    low = {r.host: len(r.low) for r in hm.low_nodes(pages).collect()}
    assert low["same.example"] > low.get("other.example", 0)


def test_copies_keep_their_text(spark):
    rows = [(i, "http://copies.example/", "<article><h1>H</h1><p>the same text</p></article>") for i in range(30)]
    got = hm.extract(spark.createDataFrame(rows, PAGES)).select("text").distinct().collect()
    assert [r.text for r in got] == ["H\nthe same text"]


def test_unique_pages_beside_many_copies(spark):
    page = "<article><h1>{0}</h1><p>text {0}</p><h2>Method</h2>{1}</article>"
    rows = [(i, "http://copies.example/", page.format("same", "")) for i in range(95)]
    rows += [(95 + i, "http://copies.example/", page.format(f"own {'x' * i}", "<blockquote>q</blockquote>")) for i in range(5)]
    got = {r.page_id: r.text for r in hm.extract(spark.createDataFrame(rows, PAGES)).collect()}
    assert got[0] == "same\ntext same\nMethod" and got[97] == "own xx\ntext own xx\nMethod\nq"


def test_odd_rows(spark):
    long = "<p>" + " ".join(f"w{i}" for i in range(100_000)) + "</p>"
    rows = [(1, None, "<p>x"), (2, "no url", None), (2, "no url", None), (None, "http://[bad", ""), (3, "http://a/b", long)]
    pages = spark.createDataFrame(rows, PAGES).withColumns({"host": F.lit("clash"), "low": F.lit(1), "text": F.lit("c")})
    got = sorted((str(r.page_id), len(r.text)) for r in hm.extract(pages).collect())
    assert got == [("1", 1), ("2", 0), ("2", 0), ("3", len(long) - 7), ("None", 0)]
    assert hm.extract(spark.createDataFrame([], PAGES)).count() == 0
