import html
import math
import re

import pytest
from pyspark.sql import functions as F

from flowguard.llm import html_extract as x


def text(page):
    return x.main_text(page, x.Importance([]))


@pytest.mark.parametrize(
    "page, want",
    [
        (None, ""),
        ("", ""),
        ("just <b>text</b> &amp; more", "just text & more"),
        ("<p>one<p>two<br>three</p><!-- <p>no</p> --><p> a\n\t b&nbsp;c </p>", "one\ntwo three\na b c"),
        ("<body><nav>menu</nav><header>site</header><div class='ad'>buy</div><article><header><h1>T</h1></header><p>x</p><aside>s</aside><div class='article-body'>y</div><section id='comments'><p>c</p></section></article><footer>f</footer>", "T\nx\ny"),
        ("<script>if (a < b) document.write('<p>x</p>')</script><style>p{}</style><noscript>n</noscript><p>ok", "ok"),
        ("<title>t</title><div id=cookieBanner>c</div><div role=navigation>n</div><div hidden>h</div><div style='display: none'>d</div><main><p>m</p><form>f</form></main><p>out", "m"),
        ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul><table><tr><td>1<td>2<tr><td>3</table>", "a\nb\nc\nd\n1\n2\n3"),
        ("<article>a<p>b</article><div class='comments'><article>reader</article></div><article><h2>c</h2></article>", "a\nb\nc"),
        ("<p>x &lt;b&gt; &#233; &#x41; &bogus; &amp", "x <b> é A &bogus; &"),
        ("<p>unclosed <b>bold <i>it<p>next</b> more<a href='x", "unclosed bold it\nnext more"),
        ("<p title='a>b'>q</p><p>1 < 2 and 3 > 2</p>", "q\n1 < 2 and 3 > 2"),
        ("<![CDATA[a <b>]]> z<?php x ?><!DOCTYPE html>", "a <b> z"),
        ("<nav>only a menu</nav>", ""),
    ],
)
def test_pages(page, want):
    assert text(page) == want


def plain(page):
    """For the article template of the test tables alone."""
    body = re.search(r"<article>(.*?)(?:</article>|$)", page, re.S)[1]
    blocks = re.split(r"</?(?:h1|p)>", body)
    blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in blocks]
    return "\n".join(b for b in blocks if b)


def test_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r.page_id: (r.url, r.text) for r in x.main_texts(df).collect()}
    assert got == {r.page_id: (r.url, plain(r.html)) for r in df.collect()}


def test_site_tree_finds_what_a_host_repeats(spark):
    rows = []
    for i in range(40):
        rows.append((i, f"https://U@Shop.example:80/{i}", f"<body><div><span>All rights with Acme</span></div><div class=x><p>story {i} told once</p></div><div class=k>Call us</div></body>"))
        rows.append((100 + i, f"https://b.example/{i}", f"<body><article><p>text {i}</p><p class=more>Read more here</p></article></body>"))
        rows.append((200 + i, "https://c.example/", "<body><article><p>the same article</p></article></body>"))
    rows += [(300, None, "<body><div><span>All rights with Acme</span></div>"), (301, "nonsense", None), (301, "nonsense", None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit(1)).withColumn("nodes", F.lit(2)).withColumn("text", F.lit(3))
    got = {r.page_id: r.text for r in x.main_texts(df).collect()}
    assert got[5] == "story 5 told once"
    assert got[105] == "text 5"
    assert got[205] == "the same article"  # never everything
    assert got[300] == "All rights with Acme" and got[301] == ""
    assert x.main_texts(df).count() == 123 and x.main_texts(df.where("false")).count() == 0


def test_importance_formula(spark):
    pages = [(i, "https://h.example/", f"<div>{'same' if i < 8 else i}</div>") for i in range(16)]
    df = x.with_host(spark.createDataFrame(pages, "page_id long, url string, html string"))
    nodes = x.site_trees(df).first().nodes
    leaf = [n for n in nodes if n.contents][0]
    # 8 pages share one text, 8 have their own: mean of log_16 8 over 16 occurrences
    assert leaf.content_entropy == pytest.approx(8 / 16 * math.log(8) / math.log(16))
    tree = x.Importance([tuple(n) for n in nodes])
    assert tree.of(leaf.path) == pytest.approx(1 - leaf.content_entropy)
    assert tree.of(12345) == 1.0


@pytest.mark.parametrize("n", [2, 3, 5, 7])
def test_hosts_of_few_pages(spark, n):
    rows = [(i, "https://few.example/", f"<body><div><span>All rights with Acme</span></div><div class=x><p>story {i} told once</p></div><div class=k>Call us</div></body>") for i in range(n)]
    rows += [(100, "https://one.example/", "<body><div><span>All rights with Acme</span></div><div class=x><p>story told once</p></div></body>")]
    rows += [(200 + i, "https://copies.example/", f"<article><h1>title {i}</h1><p>the same<p>in every<p>copy</article>") for i in range(n)]
    got = {r.page_id: r.text for r in x.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert [got[i] for i in range(n)] == [f"story {i} told once" for i in range(n)]
    assert got[100] == "All rights with Acme\nstory told once"
    assert got[200] == "title 0\nthe same\nin every\ncopy"


def test_copies_of_an_article_stay_whole(spark):
    rows = [(i, "https://copies.example/", f"<article><h1>title {i}</h1><p>the same<p>in every<p>copy</article>") for i in range(30)]
    got = x.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert all(r.text == f"title {r.page_id}\nthe same\nin every\ncopy" for r in got)


def test_names_of_ordinary_sections_need_the_tree(spark):
    page = "<article><h2 id='related-work'>Related work</h2><p>a {0}</p><section id='discussion'><p>b {0}</p></section><p class='legal-analysis'>c {0}</p><p id='search-results'>d {0}</p>{1}</article>"
    assert text(page.format(1, "")) == "Related work\na 1\nb 1\nc 1\nd 1"
    assert text(page.format(1, "<div class='related'><a href=x>other story</a> <a href=y>and one more</a></div>")) == "Related work\na 1\nb 1\nc 1\nd 1"
    rows = [(i, "https://h.example/", page.format(i, f"<div class='related'>See {'the archive' if i % 2 else 'our shop'}</div>")) for i in range(12)]
    got = {r.page_id: r.text for r in x.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    # two texts take turns: repeated enough for a branch with such a name; the heading is on every page
    assert got == {i: f"a {i}\nb {i}\nc {i}\nd {i}" for i in range(12)}


def test_deep_and_long_pages(spark):
    deep = "<div>" * 20_000 + "<p>bottom</p>" + "</div>" * 20_000
    long = "<body>" + "".join(f"<p>block {k}" for k in range(50_000))
    rows = [(i, "https://deep.example/", deep + f"<p>page {i}") for i in range(9)] + [(50, "https://long.example/", long)]
    got = {r.page_id: r.text for r in x.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[4] == "page 4"
    assert got[50].count("\n") == 49_999 and got[50].endswith("block 49999")
