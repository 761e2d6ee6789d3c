import html
import math
import re

import pytest

from duosync.llm.common import Scratch
from duosync.llm.queries import op10_style_tree
from duosync.llm.styletree import Page, extract, style_tree
from pyspark.sql import functions as F

SCHEMA = "page_id long, url string, html string, text string, host string, low string, path int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z", 1) for r in rows], SCHEMA)


CASES = {
    "": "",
    "no markup &amp; no   tags": "no markup & no tags",
    "<p>a<p>b<b>c</b>d<br>e": "a bcd e",
    "<nav>m</nav><article><h1>T&eacute;</h1><p>x<!-- no --> y</article><p>out": "Té x y",
    "<article><p>t<div class='ad box'>n</div><aside>s</aside><form>f</form></article>": "t",
    "<article>t<ul class=share><li>s</ul><section id=comments><p>c</section>u</article>": "t u",
    "<script>var t='</p>';</script><style>p{}</style><div>k</div><!-- open": "k",
    "<div hidden>h</div><div aria-hidden='x'>v</div><div role=navigation>n</div>": "v",
    "<div class='site-header'>h</div><div class=header>h</div><p class='x-header'>k": "k",
    "<main><p>m</p><article>a</article></main>": "a",
    "<nav><ul><li>x<article>kept</article>": "kept",
    "<body class='has-sidebar'><p>t": "t",
    "<div class='with-sidebar'><article>a<aside>n</aside><div class=ad>m</div></article></div>": "a",
    "<article>a</article><div id=comments><article>c</article></div>": "a",
    "a < b and <3 <p>1 &lt; 2 &#8364; &bogus; &amp;amp;": "a < b and <3 1 < 2 € &bogus; &amp;",
    "<p>x\xa0\n\t y</p></div></p><span class=ad>n</span>z": "x y z",
    "<a href=\"x>y\">in</a>line<td>c1<td>c2": "inline c1 c2",
    "<article>" + "<div>" * 300 + "deep" + "</div>" * 300 + "</article>": "deep",
}


@pytest.mark.parametrize("source", CASES)
def test_page(source):
    assert Page(source).text() == CASES[source]


def test_given_pages(spark):
    sf = "/root/testdata/sf0.001"
    got = {r.page_id: r for r in op10_style_tree(spark, sf).collect()}
    for r in spark.read.parquet(f"{sf}/pages.parquet").collect():
        article = re.search("<article>(.*)</article>", r.html, re.S)[1]
        blocks = re.split(r"</?(?:p|h1|br)[^>]*>", re.sub("</?b>", "", article))
        want = " ".join(w for b in blocks for w in html.unescape(b).split())
        assert (got[r.page_id].text, got[r.page_id].n_chars) == (want, len(want))


def site(i, repeated="Same line on all pages", tail="own"):
    return (
        f"<html><body><div class=box><p>{repeated}</div>"
        f"<div class=text><p>{tail} {i} words<p>more {i * 7}</div></body></html>"
    )


def test_low_branches_of_a_site(spark):
    rows = [(i, "https://A.example.org/x", site(i)) for i in range(8)]
    # Too few pages of a host prove nothing, nor do pages without a host that differ.
    rows += [(20 + i, "http://b.example.org", site(i)) for i in range(2)]
    rows += [(30 + i, None, site(i, repeated=f"v{i}")) for i in range(8)]
    # An article that a whole site repeats is still the article.
    rows += [(50 + i, "http://c.org/", "<article>copy</article>") for i in range(9)]
    rows += [(70, "bad url :", None), (71, "http://a.example.org", ""), (None, None, None)]
    got = {r.page_id: r for r in extract(frame(spark, rows).repartition(3), Scratch(spark)).collect()}
    assert len(got) == len(rows)
    for i in range(8):
        assert got[i].text == f"own {i} words more {i * 7}"
        assert got[30 + i].text == f"v{i} own {i} words more {i * 7}"
    assert got[20].text == "Same line on all pages own 0 words more 0"
    assert {got[50 + i].text for i in range(9)} == {"copy"}
    assert got[70].text == got[71].text == got[None].text == "" and got[70].n_chars == 0


def test_importance_is_the_entropy(spark):
    """One node; block "a" on four pages, "b" twice on one page, page 5 without a block."""
    sources = ["<div>a</div>"] * 3 + ["<div>a</div><div>b</div><div>b</div>", "<div></div>"]
    pages = frame(spark, [(i, "u", s) for i, s in enumerate(sources)])
    tree = style_tree(pages.drop("host").withColumn("host", F.lit("h")), Scratch(spark))
    (row,) = tree.collect()
    assert row.pages == 5 and not row.content
    assert row.importance == pytest.approx(1 - (math.log(4) / math.log(5) + 0) / 2)


def test_repeats_and_empty(spark):
    rows = [(1, "u", "<p>t")] * 3
    assert [r.text for r in extract(frame(spark, rows), Scratch(spark)).collect()] == ["t"] * 3
    assert extract(frame(spark, []), Scratch(spark)).count() == 0


@pytest.mark.parametrize(
    "source, want",
    [
        ("<div class=post><p>text</div><div id=comments><article>c</article></div>", "text"),
        ("<div class=post><p>text</div><article class='comment-body'>c</article>", "text"),
        ("<main><p>text</main><div class=related><article>t</article></div>", "text"),
        ("<main><p>text<div class=related><article>t</article></div></main>", "text"),
        ("<article class='comment-body'>all there is</article>", "all there is"),
        ("<div class='has-sidebar'><p>the text</p><div class=sidebar>s</div></div>", "the text"),
        ("<p>skip<div class='page with-comments'><h1>T</h1><p>the text</div>", "skip T the text"),
        ("<div class='sidebar-layout'><p>the text</div>", "the text"),
        ("<form><p>the text<input><select><option>o</select></form>", "the text"),
        ("<div class=post>text</div><div id=comments>longer than the text is</div>", "text"),
        ("<div class=post>text</div><form>name</form><div class=my-share>s</div>", "text"),
    ],
)
def test_wrappers_and_strange_articles(source, want):
    assert Page(source).text() == want


@pytest.mark.parametrize("tag", ["main", "article"])
def test_repeated_block_inside_the_article(spark, tag):
    page = (
        f"<html><body><{tag}><div class=box><p>Same line on all pages</div>"
        "<h1>Title {0}</h1><p>own {0} words<p>more {1}<ul class=l><li>One<li>Two</ul>"
        f"</{tag}></body></html>"
    )
    rows = [(i, "http://a.org/x", page.format(i, i * 7)) for i in range(8)]
    rows += [(20 + i, "http://b.org/x", page.format(i, i * 7)) for i in range(3)]
    got = {r.page_id: r.text for r in extract(frame(spark, rows).repartition(3), Scratch(spark)).collect()}
    for i in range(8):
        assert got[i] == f"Title {i} own {i} words more {i * 7}"
    assert got[20].startswith("Same line") and got[20].endswith("One Two")


def test_repeated_wrapper_is_judged_by_the_tree(spark):
    """A wrapper with a telling word that holds most of each page, on all pages the same or not."""
    page = "<body><div class='has-sidebar'><p>{}</div><p>{}"
    rows = [(i, "http://a.org", page.format(f"own text {i}", "f")) for i in range(6)]
    rows += [(10 + i, "http://b.org", page.format("the same on all pages", f"own {i}")) for i in range(6)]
    got = {r.page_id: r.text for r in extract(frame(spark, rows), Scratch(spark)).collect()}
    assert got[0] == "own text 0" and got[11] == "own 1"


def texts(spark, rows):
    return {r.page_id: r.text for r in extract(frame(spark, rows).repartition(3), Scratch(spark)).collect()}


def test_mirrors_keep_their_text(spark):
    """Equal pages are one page; a host of few different pages proves nothing."""
    body = "<body><div class='post'><p>{}<p>second"
    rows = [(i, "http://a.org", body.format("the text")) for i in range(5)]
    rows += [(10 + i, "http://b.org", body.format(f"story {i % 2}")) for i in range(8)]
    # Forty copies of one story beside others, under the same notice.
    site_page = "<body><div class=box><p>Same notice</div><div class=post><p>story {0}<p>more {0}"
    rows += [(100 + i, "http://c.org", site_page.format(max(0, i - 39))) for i in range(50)]
    got = texts(spark, rows)
    assert {got[i] for i in range(5)} == {"the text second"}
    assert [got[10 + i] for i in range(8)] == [f"story {i % 2} second" for i in range(8)]
    assert [got[100 + i] for i in (0, 39, 45)] == [f"story {n} more {n}" for n in (0, 0, 6)]


def test_rows_that_repeat_an_id_keep_their_text(spark):
    got = texts(spark, [(1, "http://a.org", "<div><p>text")] * 6 + [(None, "http://b.org", "<p>t")] * 6)
    assert got == {1: "text", None: "t"}


@pytest.mark.parametrize("tag", ["main", "article"])
def test_headings_that_repeat_stay(spark, tag):
    page = f"<{tag}><h1>Daily report</h1><p>own {{0}}<h2>Outlook</h2><p>Sunny<div class=x><p>Like us</div></{tag}>"
    rows = [(i, "http://a.org", page.format(i)) for i in range(8)]
    got = texts(spark, rows)
    assert [got[i] for i in range(8)] == [f"Daily report own {i} Outlook Sunny" for i in range(8)]


def test_chrome_without_a_telling_tag_or_class(spark):
    """Menu, notice and closing lines in plain wrappers, told by entropy alone."""
    page = (
        "<body><div><div class=k><div>Home</div><div>News</div><div>About us</div></div>"
        "<div class=l><p>Title {0}<p>own text {0}<p>more of it {0}</div>"
        "<table class=m><tr><td>Read our terms<td>Write to us</table><div class=n>All rights kept</div></div>"
    )
    got = texts(spark, [(i, "http://a.org", page.format(i)) for i in range(12)])
    assert [got[i] for i in range(12)] == [f"Title {i} own text {i} more of it {i}" for i in range(12)]
