"""Preference formatting against a plain version (the whole table is checked by SQL)."""

from __future__ import annotations

from pyspark.sql import functions as F

from rosterframe.llm import chat as C


def plain(c, r):
    k = 0
    while k < min(len(c), len(r)) and c[k] == r[k]:
        k += 1

    def text(ts):
        return "".join(f"<|{a}|>\n{b}<|end|>\n" for a, b in ts)

    def runs(ts):
        return [x for a, b in ts for x in ((len(a) + 5, False), (len(b) + 8, a == "assistant"))]

    return (k, text(c[:k]), text(c[k:]), text(r[k:]), runs(c[k:]), runs(r[k:]))


def table(spark, convs):
    rows = [(i, t, a, b, "x") for i, ts in convs for t, (a, b) in enumerate(ts)]
    return spark.createDataFrame(rows, "pair_id long, turn long, role string, text string, prompt string").repartition(3)


def shown(df):
    return {r.pair_id: (r.n_prompt_turns, r.prompt, r.chosen, r.rejected, [tuple(x) for x in r.chosen_mask], [tuple(x) for x in r.rejected_mask])
            for r in df.collect()}


def test_pairs(spark):
    u, a, s = (lambda x: ("user", x)), (lambda x: ("assistant", x)), ("system", "be é 😀")
    chosen = [(1, [s, u("q"), a("good")]), (2, [u("q"), a("x")]), (3, [u("q"), a("x"), u("more"), a("y")]), (4, [u("only")]), (6, [u("z" * 300_000), a("")])]
    rejected = [(1, [s, u("q"), a("bad"), u("why"), a("b")]), (2, [u("q"), a("x")]), (3, [u("q"), a("x")]), (5, [u("left")]), (6, [u("z" * 300_000)])]
    got = shown(C.format_preferences(C.pair_by_id(table(spark, chosen), table(spark, rejected)), "pair_id"))
    c, r = dict(chosen), dict(rejected)
    assert got == {i: plain(c.get(i, []), r.get(i, [])) for i in {*c, *r}}
    for _, _, chosen_text, _, runs, _ in got.values():
        assert sum(n for n, _ in runs) == len(chosen_text)  # code points, so emoji count once


def test_nulls_ties_and_repeats(spark):
    rows = [(1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "user", "a"), (1, None, None, None), (None, 2, "assistant", "z"), (None, 1, "user", None)]
    df = spark.createDataFrame(rows, "pair_id long, turn long, role string, text string")
    lists = {r.pair_id: [tuple(t) for t in r.turns] for r in C.turn_lists(df, "pair_id").collect()}
    assert lists == {1: [("", ""), ("user", "a"), ("user", "a"), ("user", "b")], None: [("user", ""), ("assistant", "z")]}
    both = C.format_preferences(C.pair_by_id(df, df), "pair_id").collect()
    assert sorted(r.n_prompt_turns for r in both) == [2, 4] and all(r.chosen == r.rejected == "" for r in both)
    assert C.format_preferences(C.pair_by_id(df.limit(0), df.limit(0)), "pair_id").collect() == []


def test_mismatched_replies(spark):
    convs = [(0, [("user", "q"), ("assistant", "r0"), ("user", "bye")]), (1, [("user", "p"), ("assistant", "x"), ("user", "o"), ("assistant", "r1")]),
             (2, [("user", "alone"), ("assistant", "r2")]), (5, [("user", "no reply")])]
    df = table(spark, convs).withColumnRenamed("pair_id", "conv_id").withColumn("key", F.lit(0)).withColumn("for", F.lit(0))
    got = {r.conv_id: ([tuple(t) for t in r.chosen], [tuple(t) for t in r.rejected]) for r in C.mismatched_replies(df).collect()}
    assert got == {0: ([("user", "q"), ("assistant", "r0")], [("user", "q"), ("assistant", "r1")]),
                   1: (convs[1][1], [*convs[1][1][:3], ("assistant", "r0")]),
                   2: (convs[2][1], [("user", "alone"), ("assistant", "")]),
                   5: (convs[3][1], convs[3][1])}


def test_no_turn_is_lost(spark):
    convs = [(0, [("user", "q"), ("assistant", "r0"), ("user", "bye"), ("system", "end")]), (1, [("user", "p"), ("assistant", "x")]), (5, [("user", "no reply")])]
    df = table(spark, convs).withColumnRenamed("pair_id", "conv_id")
    rows = C.mismatched_replies(df).collect()
    assert {r.conv_id: [tuple(t) for t in r.chosen + r.after] for r in rows} == dict(convs)
    assert {r.conv_id: len(r.after) for r in rows} == {0: 2, 1: 0, 5: 0}


def test_turns_behind_the_last_reply_are_shown(spark):
    convs = [(0, [("user", "q"), ("assistant", "r0"), ("user", "bye")]), (1, [("user", "p"), ("assistant", "x")])]
    df = table(spark, convs).withColumnRenamed("pair_id", "conv_id")
    got = C.format_preferences(C.mismatched_replies(df), "conv_id", after="after").collect()
    assert {r.conv_id: r.after for r in got} == {0: "<|user|>\nbye<|end|>\n", 1: ""}


def test_main_path_is_native(spark):
    df = table(spark, [(1, [("user", "q")])]).withColumnRenamed("pair_id", "conv_id")
    plan = C.format_preferences(C.mismatched_replies(df), "conv_id")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
