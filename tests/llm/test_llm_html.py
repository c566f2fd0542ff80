"""Page texts beside a plain reading of the given pages, and on hand-made sites."""

import html
import re

from eventmill.llm import html_text

SCHEMA = "page_id long, url string, html string, text string, key string"


def plain(page):
    """The given pages have one article of headings and paragraphs."""
    article = re.search("<article>(.*?)(?:</article>|$)", page, re.S)[1]
    parts = [" ".join(html.unescape(re.sub("<[^>]*>", "", x.replace("<br>", " "))).split()) for x in re.split("</?(?:p|h1)>", article)]
    return "\n".join(x for x in parts if x)


def test_given_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    found = {r["page_id"]: r["text"] for r in html_text.extract(pages).collect()}
    assert found == {r["page_id"]: plain(r["html"]) for r in pages.collect()}


def text(page):
    return "\n".join(b.text for b in html_text.candidates(page)[0])


def test_markup_names_noise():
    page = """<html><body class="has-sidebar"><header><a>Site</a></header><div id="site-nav">menu</div><div role="navigation">more</div>
    <main><article class="post share"><header><h1>The&nbsp;title</h1></header><p>One <b>bold</b>word &amp; <i>more</i>.<p>Two<br>lines
    <ul><li>a<li>b</ul><div class="cookie-notice">We use cookies</div><form>mail <input></form><table><tr><td>x<td>y</table>
    <script>var a = "<p>no</p>";</script><style>p{}</style><section class="comments"><article>Nice!</article></section><pre>1 &lt; 2</pre>
    <aside>see also</aside></article></main><div class="ad-slot">buy</div><footer>&copy;</footer></body></html>"""
    assert text(page) == "The title\nOne boldword & more.\nTwo lines\na\nb\nx\ny\n1 < 2"


def test_broken_and_empty_pages():
    assert text(None) == text("") == text("<nav>menu") == text("<!-- open <p>x") == ""
    assert text("no markup at all") == "no markup at all"
    assert text("<p>a < b and c<d") == "a < b and c"
    assert text("<div>one<div>two</div>three") == "one\ntwo\nthree"
    assert text("<p>cut off <b>here&am") == "cut off here&am"
    assert text("<script>never closed <p>x") == "" and text("<article></article><p>body") == "body"
    deep = "<div>" * 3000 + "deep" + "</div>" * 3000
    assert text(deep) == "deep" and len(text("<p>" + "word " * 100_000)) == 499_999


def site(n, host="a.example"):
    """Pages whose chrome has telling content only: no tag or class gives it away."""
    return [
        (i, f"http://{host}/{i}", f"<div><div>Welcome to the site</div><div><p>Story {i} of {host} is here.</p>" + "<p>More</p>" * (i % 3) + f"<p>And ends {i}.</p></div><div>All the best</div></div>", "x", "k")
        for i in range(n)
    ]


def test_the_tree_cuts_what_a_host_repeats(spark):
    found = html_text.extract(spark.createDataFrame(site(12), SCHEMA)).collect()
    assert {r["page_id"]: r["text"] for r in found} == {i: "\n".join([f"Story {i} of a.example is here.", *["More"] * (i % 3), f"And ends {i}."]) for i in range(12)}
    assert all(r["n_cut"] == 2 for r in found)


def test_small_hosts_and_odd_rows(spark):
    rows = site(3, "b.example") + [(None, None, None, "x", "k"), (None, None, "<p>t</p>", "x", "k"), (None, "::bad::[", "<p>u</p>", "x", "k"), (1, "http://b.example/1", "<p>again</p>", "x", "k")]
    found = sorted(((r["page_id"], r["url"], r["text"]) for r in html_text.extract(spark.createDataFrame(rows, SCHEMA)).collect()), key=repr)
    assert len(found) == 7 and all("Welcome" in t for i, _, t in found if i in (0, 2))
    assert {t for i, _, t in found if i is None} == {"", "t", "u"}
    assert html_text.extract(spark.createDataFrame([], SCHEMA)).count() == 0


def test_entropy_by_hand(spark):
    import math

    tree = html_text.style_tree(spark.createDataFrame(site(9), SCHEMA))
    weights = sorted(r["presentation"] for r in html_text.presentation(tree).collect())
    assert math.isclose(weights[-1], math.log(3) / math.log(9), rel_tol=1e-9) and math.isclose(weights[0], 0, abs_tol=1e-9)
    low = html_text.unimportant(tree).collect()
    assert len(low) == 2 and all(math.isclose(r["importance"], 0, abs_tol=1e-9) for r in low)
