"""Line dedup against brute force on small rows (the whole table is checked by SQL)."""

from __future__ import annotations

from collections import Counter, defaultdict

from pyspark.sql import functions as F
from llm_fixtures import docs_of  # noqa: F401

from rosterframe.llm import line_dedup as L


def slow(rows, ratio, least):
    pages, seen = Counter(), defaultdict(int)
    for _, text, _, site, *_ in rows:
        pages[site] += 1
        for x in {x.strip(" \t\n\r\x0b\f") for x in (text or "").split("\n")} - {""}:
            seen[site, x] += 1
    out = []
    for i, text, _, site, *_ in rows:
        def bad(x):
            n = seen[site, x.strip(" \t\n\r\x0b\f")]
            return site is not None and x.strip(" \t\n\r\x0b\f") and n >= least and n > ratio * pages[site]
        ls = text.split("\n") if text is not None else []
        keep = [x for x in ls if not bad(x)]
        out.append((i, None if text is None else "\n".join(keep), len(ls) - len(keep)))
    return sorted(out, key=str)


def run(df, **k):
    return sorted(map(tuple, L.drop_site_lines(df, **k).select("doc_id", "text", "n_lines_dropped").collect()), key=str)


def test_small_rows(docs_of):
    long = "\n".join(f"line {i}" for i in range(50_000)) + "\nfooter"
    rows = [(i, f"own {i}\n  footer \n\nshared {i % 2}\nfooter", "en", "a") for i in range(12)]
    rows += [(20, None, "en", "a"), (21, "", "en", "a"), (22, "footer", "en", "a"), (22, "footer", "en", "a"), (23, long, "en", "a")]
    rows += [(30 + i, "footer\nshared 0\n \t", "en", "b" if i else None) for i in range(3)]
    rows += [(None, "footer", None, "c")] * 4 + [(50 + i, "footer", None, None) for i in range(9)]
    df = docs_of(rows)
    assert run(df) == slow(rows, 0.1, 2)
    assert run(df, max_ratio=0.4, min_pages=3) == slow(rows, 0.4, 3)
    out = L.drop_site_lines(df)
    assert out.columns == [*df.columns, "n_lines_dropped"] and out.where("fp <> 'x'").count() == 0
    assert L.drop_site_lines(df.limit(0)).collect() == []


def test_a_line_on_one_page_stays(docs_of):
    """On a site of few pages one page is more than the ratio; two are boilerplate."""
    rows = [(1, "one\ntwo", "en", "a"), (2, "two\nown", "en", "a"), (3, "x", "en", "a"), (4, "alone\nalone", "en", "b")]
    assert run(docs_of(rows)) == [(1, "one", 1), (2, "own", 1), (3, "x", 0), (4, "alone\nalone", 0)]


def test_clashing_columns(docs_of):
    df = docs_of([(i, "a\nb", "en", "s") for i in range(4)])
    odd = df.withColumns({"N_lines_dropped": F.lit(9), "site": F.lit("q"), "row": F.lit(1), "hits": F.lit(2), "digest": F.lit(3)})
    got = L.drop_site_lines(odd)
    assert {(r.text, r.n_lines_dropped, r.row, r.hits, r.site) for r in got.collect()} == {("", 2, 1, 2, "q")}


def test_hosts(spark):
    urls = ["https://A.example.org/x?y", "http://u:p@b.example.net:80#z", "nothing", "", None, "ftp://c"]
    df = spark.createDataFrame([(u,) for u in urls], "u string").select(L.host_of(F.col("u")))
    assert [r[0] for r in df.collect()] == ["a.example.org", "b.example.net", None, None, None, "c"]
