"""Branches of pages go by the importance of what they hold; names are a prior only."""

import pytest

from eventmill.llm import html_text
from tests.llm.test_llm_html import plain

SCHEMA = "page_id long, url string, html string"


def text(page):
    return "\n".join(b.text for b in html_text.candidates(page)[0])


def extracted(spark, pages, host="d.example"):
    rows = [(i, f"http://{host}/{i}", page) for i, page in enumerate(pages)]
    return [r["text"] for r in html_text.extract(spark.createDataFrame(rows, SCHEMA)).orderBy("page_id").collect()]


@pytest.mark.parametrize("mark", ['class="page-with-sidebar"', 'class="sidebar-layout"', 'id="search-results"', 'class="legal-analysis"', 'class="ad"', 'class="comments"'])
def test_no_name_empties_a_page(mark):
    body = "<h1>Title</h1><p>All of the text is in here.</p>"
    assert text(f"<div {mark}>{body}</div>") == "Title\nAll of the text is in here."
    assert text(f'<div {mark}>{body}<div class="sidebar">side</div></div>') == "Title\nAll of the text is in here."
    assert text(f"<main><div {mark}>{body}</div></main>") == "Title\nAll of the text is in here."
    assert text(f'<div {mark}><div class="masthead">Site</div><main>{body}</main></div><p>outside of it there is much more text to read</p>').startswith("Title\nAll")


def test_given_pages_without_any_name(spark, monkeypatch):
    """Tags alone say the same on the given pages; no page is cut by the tree."""
    monkeypatch.setattr(html_text, "NOISE_NAMES", frozenset())
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()
    assert [text(r["html"]) for r in pages] == [plain(r["html"]) for r in pages]


def story(i):
    return f"<h1>Title {i}</h1>" + "".join(f"<p>Part {j} of story {i} says this and that.</p>" for j in range(i % 5 + 1))


def lines(i):
    return "\n".join([f"Title {i}", *[f"Part {j} of story {i} says this and that." for j in range(i % 5 + 1)]])


def test_lists_of_links_that_vary_go_without_a_name(spark):
    more = "<ul>{}</ul>"
    pages = [f"<div><div>{story(i)}</div>" + more.format("".join(f'<li><a href="/{i}{j}">Go on with story {i + j}</a></li>' for j in range(4))) + "</div>" for i in range(12)]
    assert extracted(spark, pages) == [lines(i) for i in range(12)]


def test_named_branches_in_articles_that_vary(spark):
    """Same place, same style, other texts: what is named as noise alone goes, what is also named as content stays."""
    pages = [
        f'<article>{story(i)}<div class="ad-slot"><p>Buy thing number {i}</p></div><div class="legal-analysis"><p>Analysis {i}</p></div>'
        f'<div class="related"><ul><li><a>See {i}</a></li><li><a>And {i + 1}</a></li></ul></div></article>'
        for i in range(12)
    ]
    assert extracted(spark, pages) == [f"{lines(i)}\nAnalysis {i}" for i in range(12)]


def test_weak_names_outside_articles_ask_the_host(spark):
    pages = [f'<div><div>{story(i)}</div><div class="search-results"><p>Found {i}</p><p>And found {i}</p></div></div>' for i in range(12)]
    assert extracted(spark, pages) == [f"{lines(i)}\nFound {i}\nAnd found {i}" for i in range(12)]
    assert extracted(spark, pages[:3]) == [lines(i) for i in range(3)]


def test_a_host_of_one_page_under_many_urls_keeps_its_article(spark):
    assert extracted(spark, [f'<div class="x">Welcome</div><article>{story(3)}<div class="ad">buy</div></article>'] * 12) == [lines(3)] * 12


def test_very_long_pages(spark):
    long = "<article>" + "".join(f"<div><p>word {i}</p><p>more {i}</p></div>" for i in range(20_000)) + "</article>"
    found = extracted(spark, [long, "<p>x</p>"])
    assert found[0].count("\n") == 39_999 and found[1] == "x"
