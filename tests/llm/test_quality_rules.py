"""Quality rules: counts against brute force, and the guarantee on held-out labels."""

from __future__ import annotations

import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F
from llm_fixtures import docs_of  # noqa: F401

from rosterframe.llm import quality_rules as Q

SF = "/root/testdata/sf0.01"


def slow(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    inside = {i + k for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(inside)


@pytest.mark.parametrize("text", ["", " \n", "a b c", "a b c a b c", "a a a a", "é\xa0ü  x y", "#*$%&|<> x\nx\nx\n x", "z\x1cy z\x85 q"])
def test_counts(text):
    assert Q.text_stats(text.encode())[:5] == slow(text)


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = Q.judge(docs, spark.read.parquet(f"{SF}/labels.parquet"), keep=["doc_id"]).select("row.doc_id", "*").collect()
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    assert len(got) == len(texts)
    for r in got:
        w, c, s, d, rep = slow(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (w, c, s, d, rep)
        assert r.base_failed == (w < 50 or 100 * rep > 50 * w)
        assert not (r.kept and r.base_failed)


def test_binomial_tail():
    for n, k, p in [(10, 0, 0.1), (10, 3, 0.25), (50, 50, 0.5), (400, 3, 0.01)]:
        exact = sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
        assert Q.binomial_tail(n, k, p) == pytest.approx(exact, rel=1e-9)
    assert 0 <= Q.binomial_tail(2_000_000, 900, 0.001) < 1e-20


def test_a_repeated_document_is_one_trial(spark, docs_of):
    """100 clean documents certify nothing, and nothing more if each comes twenty times."""
    rows = [(i, shout(i) if i % 50 == 0 else clean(i)) for i in range(100)] + [(i, shout(i)) for i in range(200, 300)]
    labels = spark.createDataFrame([(i, 1) for i in range(100)] + [(i, 0) for i in range(200, 300)], "doc_id long, quality int")
    for times in (1, 20):
        got = Q.judge(docs_of(rows * times).repartition(4), labels, keep=["doc_id"])
        assert got.where("not kept and row.doc_id < 100").count() == 0


def clean(i):
    return " ".join(f"word{(i * 7 + k * k) % 9973} of" for k in range(40))


def shout(i):
    return clean(i).upper()


def symbols(i):
    return " ".join(w + "***" for w in clean(i).split())


def test_rules_are_learned_per_stratum_and_held_out_clean_documents_stay(spark, docs_of):
    n = 4000
    rows = [(i, clean(i) if i % 4 else (shout(i) if i % 8 else symbols(i)), "en") for i in range(n)]
    rows += [(n + i, shout(i), "xx") for i in range(20)] + [(2 * n + i, shout(i), None) for i in range(5)]
    docs = docs_of(rows).repartition(4)
    labels = spark.createDataFrame([(i, int(i % 4 > 0), 0) for i in range(0, n, 1) if i % 3], "doc_id long, quality int, toxic int")
    got = {r.row.doc_id: r.kept for r in Q.judge(docs, labels).collect()}
    assert all(got[i] == bool(i % 4) for i in range(n))  # learned in its stratum, for unlabelled rows too
    assert all(got[n + i] for i in range(20)) and all(got[2 * n + i] for i in range(5))  # no evidence there: nothing is rejected


def test_few_labels_certify_nothing(spark, docs_of):
    docs = docs_of([(i, clean(i) if i % 2 else shout(i)) for i in range(60)])
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(60)], "doc_id long, quality int, toxic int")
    assert Q.judge(docs, labels).where("not kept").count() == 0
    # a laxer risk is certified by the same labels
    assert Q.judge(docs, labels, max_false_rejection=0.999, delta=0.5).where("not kept").count() == 30


def test_risky_rules_are_not_certified(spark, docs_of):
    """Half of the clean documents shout too: rejecting shouting would break the limit."""
    rows = [(i, shout(i) if i % 2 else clean(i)) for i in range(3000)]
    labels = spark.createDataFrame([(i, int(i % 4 != 3), 0) for i in range(3000)], "doc_id long, quality int, toxic int")
    assert Q.judge(docs_of(rows), labels).where("not kept").count() == 0


def test_edge_cases(spark, docs_of):
    long = " ".join(f"w{k}" for k in range(400_000))
    rows = [(1, None), (2, ""), (3, long), (3, long), (None, clean(1)), (4, clean(2))]
    labels = spark.createDataFrame([(3, 1, 0), (3, 0, 0), (4, None, 0), (None, 1, 0), (99, 1, 0)], "doc_id long, quality int, toxic int")
    docs = docs_of(rows).withColumns({"stats": F.lit(1), "kept": F.lit(2), "n_words": F.lit(3)})
    got = Q.judge(docs, labels).collect()
    assert sorted((r.row.doc_id or 0, r.n_words, r.kept) for r in got) == [
        (0, 80, True), (1, 0, False), (2, 0, False), (3, 400_000, True), (3, 400_000, True), (4, 80, True)]
    assert got[0].row.asDict().keys() == set(docs.columns)
    assert Q.judge(docs.limit(0), labels).collect() == []
    assert Q.judge(docs, labels.limit(0)).where("kept").count() == 4
