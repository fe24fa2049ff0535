"""Main text of pages: the given template by pattern, other templates by hand."""

import html
import re
import time

import pytest
from compare import TESTDATA

from paywarden.llm import html_extraction as extraction
from paywarden.llm.html_extraction import extract_page, extract_pages
from paywarden.llm.queries import op11_html_extraction


def plain(page):
    """The tables' pages: blocks of their one article, by pattern."""
    inner = re.search(r"<article>(.*?)</article>", page or "", re.DOTALL)
    parts = re.split(r"</?(?:h1|p)>", inner[1]) if inner else []
    parts = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", x)).split()) for x in parts]
    return "\n".join(x for x in parts if x)


def test_query_gives_every_article_of_the_tables(spark):
    for sf in ("sf0.001", "sf0.01"):
        want = {r.page_id: r for r in spark.read.parquet(str(TESTDATA / sf / "pages.parquet")).collect()}
        got = op11_html_extraction(spark, str(TESTDATA / sf)).collect()
        assert sorted(r.page_id for r in got) == sorted(want)
        for r in got:
            text = plain(want[r.page_id].html)
            assert (r.url, r.text, r.n_chars) == (want[r.page_id].url, text, len(text))


P1 = "The first paragraph of the story runs on for a while, as paragraphs do."
P2 = "A second one follows, with commas, clauses and a full stop at its end."
P3 = "Third and last, it sums up what was said before it and then it ends."
STORY = f"<p>{P1}</p><p>{P2}</p><p>{P3}</p>"
LINKS = "".join(f'<li><a href="/{i}">Section number {i} of this site</a></li>' for i in range(9))
REMARKS = "".join(f"<div class='item'><p>I, reader {i}, do not agree with any of this, and here is why I do not.</p></div>" for i in range(12))


@pytest.mark.parametrize(
    "page",
    [
        f"<html><body><header><h1>Site</h1></header><div id='main'><div class='post-12 content'><h1>T</h1>{STORY}</div></div><footer>bye to all</footer></body></html>",
        f"<body><div class=wrap><ul class=menu>{LINKS}</ul><main><h1>T</h1>{STORY}</main><aside><p>{P1} Not here.</p></aside></div>",
        f"<body><nav>{LINKS}</nav><article><header><h1>T</h1></header>{STORY}<footer>By someone else</footer></article><section class='comments'><h2>Comments</h2>{REMARKS}</section>",
        f"<body><div class='cookie-notice'><p>We use cookies, as all do, to make this site work well.</p></div><article><h1>T</h1><p>{P1}</p><div class='ad'>Buy this now, or else.</div><p>{P2}</p><form><label>Name</label><input></form><p>{P3}</p><div class='share'>Share <a href=#>this</a></div></article>",
        f"<body><form id=aspnetForm><div class='page has-sidebar'><div class=article-body><h1>T</h1>{STORY}</div><div class=sidebar>{STORY}</div></div></form>",
        f"<div class='SiteHeader'>Welcome to the one and only site there is of this kind</div><div class=entry><h1>T</h1><section>{STORY[: len(P1) + 7]}</section><section>{STORY[len(P1) + 7 :]}</section></div><div id=respond><p>{P2}</p></div>",
        f"<body><table><tr><td class=left><a href=a>One link of many</a><a href=b>Another link here</a></td><td><div class=text><h1>T</h1>{STORY}</div></td></tr></table>",
        f"<body><article><h1 id='related-ads'>T</h1>{STORY}<noscript>Turn it on</noscript></article><section id='comments'><article class='comment'><p>{P1}</p></article></section>",
        f"<BODY><ARTICLE><H1>T</H1><P>{P1}<P>{P2}<P>{P3}</ARTICLE><script>var x = '</p><p>no' + \"<p>\";</script><style>p {{}}</style><!-- <p>{P1}</p> -->",
    ],
)
def test_templates(page):
    assert extract_page(page)[0] == "\n".join(["T", P1, P2, P3])


def test_blocks_references_and_white_space():
    page = (
        "<article><h1>A &amp; B&nbsp;&#233;&#x41;</h1>\n<p>one<br>two <b>th</b>ree\t\n four &lt;p&gt; &am &amp</p>"
        "<ul><li>x<li>y</ul><table><tr><td>1</td><td>2</td></tr><tr><td>3<td>4</table>5 < 6 and a<b/>b <pre> p\n q </pre>"
        "<p title='a > b' class=\"x\" data-class='ads'>quoted</p><p>say <span class=advert>buy</span><a href=/>so</a></p></article>"
    )
    want = ["A & B éA", "one two three four <p> &am &", "x", "y", "1 2", "3 4", "5 < 6 and ab", "p q", "quoted", "say so"]
    assert extract_page(page)[0].split("\n") == want


def test_broken_pages():
    for page in (None, "", "   ", "<", "</", "<!--", "<!-- a", "<!-->", "<p", "<script>", "<html><head><title>x</title></head></html>", "&#xD800;", "\x00"):
        text, _, _ = extract_page(page)
        assert "<" not in text or page == "<"
    assert extract_page(f"<article><p>{P1}</p><p>{P2}</p><a href='")[0] == f"{P1}\n{P2}"
    assert extract_page(f"</div></p><article><div><p>{P1}</div></b></article></article>")[0] == P1


def test_time_is_linear_in_odd_pages():
    for unit in ("<div>", "<x ", "<p>a", "</b>", "<a href=\"", "<!--", "<td>", "<table><td>", "<li>", "</td></table>", "<b class=ad>", "< ", "&amp", "<script>"):
        begin = time.perf_counter()
        extract_page(unit * 20_000 + f"<p>{P1}</p>")
        assert time.perf_counter() - begin < 5, unit


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


@pytest.mark.parametrize("limit", [0, 1 << 24])
def test_a_page_follows_the_pages_of_its_host(spark, monkeypatch, limit):
    monkeypatch.setattr(extraction, "BROADCAST_BYTES", limit)
    talk = "".join(f"<p>And another reader {i} writes at length about this, that and all the rest of it.</p>" for i in range(30))
    page = lambda story, after: f"<body><div class='c1 n7'>{story}</div><div class=c2>{after}</div>"
    rows = [(i, f"https://User@News.example.org:80/{i}", page(STORY * 2, "<p>Short, but prose it is, for all that one can see.</p>")) for i in range(5)]
    odd = page(f"<p>{P1}</p>", talk).replace("n7", "n9")
    rows += [(5, "//news.example.org/x", odd), (6, "https://other.example.org/x", odd), (7, None, odd), (8, "nowhere", odd)]
    got = {r.page_id: r for r in extract_pages(pages(spark, rows)).collect()}
    assert got[0].text == "\n".join([P1, P2, P3] * 2)
    assert (got[5].text, got[5].path, got[5].voted) == (P1, "html/body/div.c#.n#", True)
    for i in (6, 7, 8):
        assert got[i].text != P1
    assert [got[i].voted for i in (6, 7, 8)] == [True, False, False]


def test_odd_rows(spark):
    rows = [(None, None, None), (None, None, None), (1, "http://a", ""), (1, "http://a", f"<article>{STORY}</article>"), (2, "", "x" * 300_000), (3, "http://a", f"<article>{STORY}</article>" * 200)]
    frame = pages(spark, rows).selectExpr("cast(page_id as string) as page_id", "url", "html", "1 as text", "'p' as path", "2 as id", "3 as host", "4 as paths")
    got = extract_pages(frame).collect()
    assert len(got) == len(rows)
    story = "\n".join([P1, P2, P3])
    assert sorted(len(r.text) for r in got) == sorted([0, 0, 0, len(story), 300_000, 200 * len(story) + 199])
    assert [(r.text, r.path) for r in got if r.page_id is None] == [("", None)] * 2
    assert extract_pages(frame.where("false")).collect() == []
