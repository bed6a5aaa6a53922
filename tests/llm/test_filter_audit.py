"""The audit against brute force over every order and step."""

from __future__ import annotations

import re
from itertools import permutations

import pytest
from llm_fixtures import docs_of  # noqa: F401
from pyspark.sql import functions as F

from rosterframe.llm import filter_audit as A


def judge(text, i, rows):
    """Letters that a text fails, by the contract's words."""
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    out = set()
    if len(words) < 100:
        out.add("A")
    if 100 * len(set(words)) < 80 * len(words):
        out.add("B")
    if 100 * len(re.findall("[A-Z]", text)) > 10 * len(text):
        out.add("C")
    if re.search(r"[#$%&*|]", text):
        out.add("D")
    if i is not None and any(r[0] is not None and r[0] < i and (r[1] or "") == text for r in rows):
        out.add("E")
    return out


def slow(rows, labels, letters="ABCDE", judged=None):
    judged = judged or [judge(r[1], r[0], rows) for r in rows]
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    part_of = [(r[2] if len(r) > 2 else "en") or "" for r in rows]
    out = {}
    for part in set(part_of):
        mine = [k for k in range(len(rows)) if part_of[k] == part]
        shapley = dict.fromkeys(letters, 0)
        for order in permutations(letters):
            left = list(mine)
            for step, f in enumerate(order, 1):
                gone = [k for k in left if f in judged[k]]
                redundant = sum(f in judged[k] for k in mine) - len(gone)
                left = [k for k in left if f not in judged[k]]
                out[part, "".join(order), step] = [
                    len(left), len(gone), redundant, sum(judged[k] == {f} for k in mine),
                    sum(rows[k][0] in good for k in gone), sum(rows[k][0] in toxic for k in gone)]
                shapley[f] += len(gone)
        for order in permutations(letters):
            for step, f in enumerate(order, 1):
                out[part, "".join(order), step].append(shapley[f])
    return out


def run(df, labels, conditions=None):
    filters = conditions or A.text_filters(F.coalesce(df.text, F.lit("")))
    rows, failing = A.row_table(df, filters, df.lang, copies="E")
    marked = {n: A.label_ids(rows, labels.where(F.col(c) == 1).select("doc_id"), n) for n, c in (("good", "quality"), ("toxic", "toxic"))}
    got = A.audit(rows, failing, marked)
    assert got.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    return {(r.part, r.filter_order, r.step): list(r[3:]) for r in got.collect()}, got


def test_brute_force_with_edge_cases(spark, docs_of):
    def words(n, k=10**9):
        return " ".join(f"w{j % k}" for j in range(n))

    texts = [None, "", "short", words(99), words(100), words(100, 79), words(100, 80), words(120).upper(), words(110) + " #", "A" * 10 + "b" * 90,
             "A" * 11 + "b" * 89, "É" * 5, words(40_000), "a\x0bb\x0cc " + words(101), "x y z", words(100) + " | $", "#" * 3000]
    rows = [(k, t, lang) for k, t in enumerate(texts) for lang in ("en",)]
    rows += [(100 + k, t, "fr") for k, t in enumerate(texts[:9])]
    rows += [(300 + k, words(150), "hot") for k in range(60)]  # a group of copies with a third of the rows
    rows += [(400, "q", None), (401, "q", ""), (None, "q", "en"), (None, words(100), "en"), (402, words(130), "en"), (402, words(130), "en"), (403, words(130), "en")]
    labels = [(k, k % 3 % 2, None if k % 4 == 2 else int(k % 5 == 1)) for k in range(0, 460)] + [(3, 1, 1), (3, 0, 1), (None, 1, 1), (99999, 1, 1)]
    df = docs_of(rows).withColumns({"rid": F.lit(1), "part": F.lit("p"), "Digest": F.lit("d"), "fails": F.lit(0), "id": F.lit(5), "bit": F.lit(2)}).repartition(7)
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got, frame = run(df, table)
    assert got == slow(rows, labels)
    assert len(got) == 600 * 4
    plan = frame._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_empty_tables(spark, docs_of):
    df = docs_of([(1, "a")])
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert run(df.limit(0), none)[0] == {}
    assert run(df, none)[0] == slow([(1, "a")], [])


def test_joins_are_on_the_row_id_and_move_ids_once(spark, docs_of):
    df = docs_of([(k, f"t{k % 7}") for k in range(50)])
    rows, failing = A.row_table(df, A.text_filters(F.coalesce(df.text, F.lit(""))), df.lang, copies="E")
    assert set(failing) == set("ABCDE") and all(t.columns == ["rid", "part"] for t in failing.values())
    assert failing["E"].count() == 43 and failing["A"].count() == 50


def test_two_filters_by_name(spark, docs_of):
    df = docs_of([(k, "x" * k) for k in range(20)])
    rows, failing = A.row_table(df, {"a": F.length("text") > 10, "b": F.length("text") % 2 == 0}, df.lang)
    got = {(r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.shapley) for r in A.audit(rows, failing, {}).collect()}
    assert got == {("ab", 1): (11, 9, 0, 5, 14), ("ab", 2): (5, 6, 4, 6, 16), ("ba", 1): (10, 10, 0, 6, 16), ("ba", 2): (5, 5, 4, 5, 14)}


def test_too_many_filters(spark, docs_of):
    df = docs_of([(1, "a")])
    rows, failing = A.row_table(df, {c: F.lit(False) for c in "abcdefgh"}, df.lang)
    with pytest.raises(ValueError):
        A.audit(rows, failing, {})
