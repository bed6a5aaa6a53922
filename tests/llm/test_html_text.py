"""Main text: the scan against brute force, known articles, and pages of other shapes."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from rosterframe.llm import html_text as H
from rosterframe.llm.registry import op4_html_main_text

SF = "/root/testdata/sf0.01"
A = " ".join(f"alpha{k}" for k in range(30)) + "."
B = "Second para with <b>bold</b>&nbsp;and <a href='/x'>a link</a> &amp; " + " ".join(f"beta{k}" for k in range(40))
B_TEXT = "Second para with bold and a link & " + " ".join(f"beta{k}" for k in range(40))


def test_scan_equals_brute_force():
    rng = random.Random(4)
    for _ in range(150):
        parts = [rng.choice(["one two three ", "<p>", "</p>", "<div>", "</div>", "<a>x y</a>", "w " * 9, "<nav>a b</nav>", "<br>"]) for _ in range(rng.randint(1, 25))]
        page = H.Page("".join(parts))
        w = {**H.DEFAULT, "<p": -0.5, "<br": -0.25}
        score = [page.words[i] * w[page.context(i)] if k == H.TEXT else w.get("<" + v, w["<"]) for i, (k, v) in enumerate(zip(page.kind, page.value))]
        best = max((sum(score[i:j]) for i in range(len(score)) for j in range(i + 1, len(score) + 1)), default=0.0)
        s, e = H.best_region(page, w)
        assert sum(score[s:e]) == pytest.approx(max(best, 0.0))


def test_known_articles(spark):
    """Every page of the table whose document is known: headline and paragraphs, exactly."""
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    pages = {r.page_id: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = op4_html_main_text(spark, SF).collect()
    assert len(got) == len(pages)
    known = 0
    for r in got:
        assert r.n_chars == len(r.text) and r.url == pages[r.page_id].url
        k = r.url.split("/")[4].split(".")[0].split("?")[0].split("#")[0]
        if k.isdigit() and int(k) in docs:
            known += 1
            lines = [" ".join(x.split()) for x in docs[int(k)].split("\n")]
            assert r.text.split("\n")[1:] == [x for x in lines if x]
    assert known > 200


@pytest.mark.parametrize("page", [
    f"<html><body><header><a href=/>Site name</a></header><nav><ul><li><a>Home page</a></ul></nav><main><h1>Title here</h1><p>{A}</p><p>{B}</p></main>"
    "<aside><p>Some words in the side bar of the page</p></aside><footer>Copyright words</footer></body></html>",
    f"<div id='top-menu'><a>one</a> <a>two</a></div><div class='cookieNotice'>We use cookies on this site to improve things for you all</div>"
    f"<div class='post-content'><h1>Title here</h1><p>{A}<div class='ad'>Buy this thing now</div><p>{B}</div>"
    f"<section id='comments'><article class='comment'><p>I liked this very much, {A} thanks to all</p></article></section>",
    f"<form id=aspnet><div class=sidebar><p>{A}</p></div><article><header><h1>Title here</h1></header><p>{A}</p><p>{B}</p>"
    "<form>Your name <input> <button>Send it</button></form></article></form>",
    f"<body><article><h1>Title here</h1><p>{A}<p><b>{B}<br></article><div class='related'>More to read on this</div><script>if (a<b) {{ x('</p>') }}</script>",
    f"<article><h1>Title here</h1><p>{A}</p><p style='display:none'>hidden words are here</p><!-- a > comment --><p>{B}</p><div role=complementary>side</div>",
])
def test_other_shapes(page):
    assert H.main_text(page, H.DEFAULT) == f"Title here\n{A}\n{B_TEXT}"


LONG = " ".join(f"gamma{k}" for k in range(400)) + "."


@pytest.mark.parametrize("name", ["entry-content", "article-body", "post-content", "story"])
@pytest.mark.parametrize(("outer", "close"), [("<article>", "</article>"), ("<main>", "</main>"), ("<main><article>", "</article></main>"),
                                              ("<div class=post>", "</div>")])
def test_headline_and_lead_beside_a_content_block(name, outer, close):
    page = (f"<body><nav><a>Home page</a></nav>{outer}<h1>Title of six words stands here</h1><p>The lead of the article is these ten words.</p>"
            f"<div class='{name}'><p>{LONG}</p></div><p>Last words of the article.</p>{close}<footer>Copyright words</footer>")
    want = f"Title of six words stands here\nThe lead of the article is these ten words.\n{LONG}"
    assert H.main_text(page, H.DEFAULT).removesuffix("\nLast words of the article.") == want
    if "article" in outer or "main" in outer:
        assert H.main_text(page, H.DEFAULT).endswith("Last words of the article.")


@pytest.mark.parametrize(("outer", "close"), [("<article>", "</article>"), ("<main>", "</main>"), ("<div class=post>", "</div>"), ("", "")])
@pytest.mark.parametrize("part", [
    "<h2 id='related-work'>Kept words here</h2>", "<h2 id='search-and-login'>Kept words here</h2>", "<h3 id='comments'>Kept words here</h3>",
    "<section id='social-impact'><p>Kept words here</p></section>", "<p class='share-price'>Kept words here</p>",
    "<div class='entry-header'><h1>Kept words here</h1></div>", "<div class='header'><h2>Kept words here</h2></div>",
    "<section id='reply-of-the-minister'><p>Kept words here</p></section>", "<h2 class='page-header'>Kept words here</h2>",
    "<div id='widget-theory'><p>Kept words here</p></div>", "<p class='promotion-round'>Kept words here</p>"])
def test_names_with_a_furniture_word_are_text(outer, close, part):
    page = f"<body>{outer}<p>{A}</p>{part}<p>{A}</p>{close}"
    assert H.main_text(page, H.DEFAULT) == f"{A}\nKept words here\n{A}"


@pytest.mark.parametrize(("outer", "close"), [("<article>", "</article>"), ("<div class=post>", "</div>"), ("", "")])
@pytest.mark.parametrize("part", [
    "<div class='ad'>Cut words here</div>", "<div class='share-buttons'>Cut words here</div>", "<div id='ad-slot-3'>Cut words here</div>",
    "<section id='comments'><p>Cut words here</p></section>", "<div class='newsletterSignup wide'>Cut words here</div>",
    "<ul class='related-reading'><li><a href=/1>Cut words here</a></ul>", "<div class='post-comments'>Cut words here</div>",
    "<div class='side' role=search>Cut words here</div>", "<div class='header'>Cut words here</div>", "<div class='cookie-banner'>Cut words here</div>"])
def test_furniture_in_an_article_is_cut(outer, close, part):
    assert H.main_text(f"<body>{outer}<p>{A}</p>{part}<p>{A}</p>{close}", H.DEFAULT) == f"{A}\n{A}"


@pytest.fixture(scope="module")
def learned(spark):
    pages, docs = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("pages", "documents"))
    doc_of = F.expr(r"try_cast(regexp_extract(url, '^[a-z]+://[^/]+/[^/]+/([0-9]+)', 1) as long)")
    return H.fit(H.labelled_sample(pages, docs, doc_of))


C = " ".join(f"delta{k}" for k in range(25)) + "."


@pytest.mark.parametrize(("page", "lines"), [
    (f"<p>{A}</p><p>{C}</p>", [A, C]),
    (f"<h2>Steps</h2><p>{A}</p><ul><li>First of all do this</li><li>Then do that</li><li>At last do it again</li></ul><p>Done now.</p>",
     ["Steps", A, "First of all do this", "Then do that", "At last do it again", "Done now."]),
    (f"<p>{A}</p><table><tr><th>Name</th><td>One value</td></tr><tr><th>Other</th><td>Two</td></tr></table><p>{C}</p>",
     [A, "Name", "One value", "Other", "Two", C]),
    (f"<body><nav><a>Home page</a></nav><h1>Title here</h1><p>{A}</p><footer>Copyright words</footer>", ["Title here", A]),
    (f"<body><div class=header><h1>Title here</h1></div><p>{A}</p><p>{C}</p><div class=ad>Buy it</div>", ["Title here", A, C]),
    (f"<main><article><h2>One</h2><p>{A}</p></article><article><h2>Two</h2><p>{C}</p></article></main>", ["One", A, "Two", C]),
    (f"<body><article><p>{A}</p></article><div class=ad>Buy it</div><article><p>{C}</p></article><footer>x y</footer>", [A, C]),
    (f"<body><ul><li><a>Home</a><li><a>All news</a></ul><h1>Title here</h1><p>{A}</p><blockquote>{C}</blockquote><p>Last words.</p>",
     ["Title here", A, C, "Last words."]),
    (f"<main><h1>Title here</h1><section><h2>Part</h2><ol><li>{A}<li>{C}</ol></section><pre>x = 1</pre><p>End.</p></main>", ["Title here", "Part", A, C, "x = 1", "End."]),
])
def test_nothing_of_an_article_is_lost(learned, page, lines):
    for w in (learned, H.DEFAULT):
        assert H.main_text(page, w) == "\n".join(lines)


def test_a_tag_that_no_labelled_article_holds_has_the_default_price():
    w = H.weights({("plain", True): 90, ("plain", False): 10, ("<li", False): 500, ("<p", True): 9, ("<p", False): 1}, 8.0)
    assert "<li" not in w and w["<"] == -4.0 and w["<p"] > w["<"]


def test_memory_of_a_very_long_page():
    """20 MB of short words between tags, in a process of its own."""
    import subprocess
    import sys

    code = ("import resource, sys; sys.path.insert(0, %r)\n"
            "from rosterframe.llm import html_text as H\n"
            "page = '<article>' + '<p>some <b>bold</b> words' * 800_000 + '</article>'\n"
            "before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss\n"
            "text = H.main_text(page, H.DEFAULT)\n"
            "assert text.count('some bold words') == 800_000\n"
            "print(len(page), (resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) // 1024)") % str(H.__file__).rsplit("/rosterframe/", 1)[0]
    size, grown = map(int, subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True).stdout.split())
    assert size > 19_000_000 and grown < 600


def test_headline_and_lead_before_an_article_in_main():
    head = "<h1>Title of six words stands here</h1><p>The lead of the article is these ten words.</p>"
    assert H.main_text(f"<main>{head}<article><p>{LONG}</p></article><p>x</p></main>", H.DEFAULT).startswith("Title of six words stands here\nThe lead")


@pytest.mark.parametrize(("page", "text"), [
    (None, ""), ("", ""), ("<p></p>", ""), ("plain words without any tag at all", "plain words without any tag at all"), ("<", "<"),
    ("<p>a &lt;tag&gt; &#233; &amp;amp; here is some text to read in the page", "a <tag> é &amp; here is some text to read in the page"),
    ("<p>one  two\n\tthree four five six<p>seven eight nine ten eleven", "one two three four five six\nseven eight nine ten eleven"),
    ("<nav>only a menu</nav>", ""), ("<script>never closed " + "x " * 50, ""), ("<p title=\"a > b\">" + "word " * 9 + "<a href=\"cut", "word " * 8 + "word"),
])
def test_small_pages(page, text):
    assert H.main_text(page, H.DEFAULT) == text


def test_labelled_counts_and_prices():
    page = H.Page(f"<nav><a>menu</a></nav><p>{A}</p><p>other words</p>")
    c = H.feature_counts(page, f"{A}\nunknown")
    assert c["plain", True] == 30 and c["plain", False] == 2 and c["other", False] == 1 and c["<a", True] == 0
    assert H.feature_counts(page, "nothing of it") == Counter()
    w = H.weights(c, 2.0)
    assert w["plain"] > 0 and all(x < 0 for f, x in w.items() if f[0] == "<")


def test_fit_and_edge_cases(spark):
    long = "<div>" * 20_000 + "<article>" + f"<p>{A}</p>" * 3000 + "</article>"
    rows = [(1, "u", None, "t"), (2, None, "", "t"), (None, "v", f"<p>{A}", "t"), (4, "w", long, "t"), (4, "w", long, "t")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, Text string").withColumn("_", F.lit(5)).withColumn("row", F.lit(6))
    got = H.extract(pages, H.DEFAULT).collect()
    assert got[0].asDict().keys() == {"page_id", "url", "_", "row", "text", "n_chars"}
    assert sorted((r.page_id or 0, r.n_chars, r._, r.row) for r in got) == sorted(
        [(1, 0, 5, 6), (2, 0, 5, 6), (0, len(A), 5, 6)] + [(4, 3000 * (len(A) + 1) - 1, 5, 6)] * 2)
    assert H.extract(pages.limit(0), H.DEFAULT).collect() == []
    docs = spark.createDataFrame([(4, A), (9, None)], "doc_id long, text string")
    sample = H.labelled_sample(pages, docs, F.col("page_id"))
    assert sample.count() == 2
    assert H.fit(sample)["<p"] < 0 and H.fit(sample.limit(0)) == H.DEFAULT
