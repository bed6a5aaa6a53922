"""Golden tests of the operators and the semantic rules N1-N16."""

from __future__ import annotations

import pytest
from conftest import d, rows
from golden import AS_OF, SEASON, tables
from pyspark.sql import functions as F

from rosterframe import schema as S
from rosterframe.functions.arith import fantasy_score, int_div, least_one, round_ratio
from rosterframe.functions.arrays import array_len0
from rosterframe.functions.dates import game_slug, month_diff, month_name, parse_date
from rosterframe.functions.text import blank_to_null, flag_text
from rosterframe.operators.history import history_rows, recent_arrays, recent_n
from rosterframe.operators.latest import latest_per_key
from rosterframe.operators.pivot import complete_rows, pivot_codes, unpivot_codes
from rosterframe.operators.team import last_team_game, team_games, team_records, team_state
from rosterframe.plans.features import season_window


@pytest.fixture(scope="module")
def gt(spark):
    return tables(spark)


def season(gt):
    return season_window(gt.games, F.lit(AS_OF).cast("date"), F.lit(SEASON).cast("date"))


def test_season_window_is_open_at_both_ends(gt):
    ids = {r.game_id for r in season(gt).collect()}
    assert 1 not in ids and 7 not in ids and 8 not in ids          # start day, as-of day, later (N8)
    assert {2, 3, 4, 5, 6} <= ids


def test_team_games_null_result_rules(gt):
    """A null result is 'not won' for both teams per game, but the record
    credits it to the away team."""
    got = {(r.game_id, r.team_id): (r.won, r.credited_win) for r in team_games(gt.games).collect()}
    assert got[(4, 1)] == (False, False) and got[(4, 3)] == (False, True)
    assert got[(3, 2)] == (False, False) and got[(3, 1)] == (True, True)   # tie: home not won (N1)


def test_team_records_need_a_win_and_a_loss(gt):
    """Team 2 in the window has wins and losses; team 4 only wins -> no row."""
    rec = {r.team_id: (r.wins, r.losses, r.pct) for r in team_records(season(gt)).collect()}
    assert 4 not in rec
    w, l, pct = rec[1]
    assert pct == pytest.approx(round(w / (w + l), 3), abs=1e-6)


def test_last_team_game_breaks_date_ties_by_game_id(gt):
    """Games 5 and 6 share a date; team 3 played both, the larger id wins."""
    lg = {r.team_id: (r.game_id, r.won_game) for r in last_team_game(season(gt), gt.teams).collect()}
    assert lg[3] == (6, False)
    assert lg[1] == (5, True)          # away win in game 5


def test_team_state_matches_separate_blocks(gt):
    st = {r.team_id: r for r in team_state(season(gt), gt.teams).collect()}
    rec = {r.team_id: r.pct for r in team_records(season(gt)).collect()}
    for team, pct in rec.items():
        assert st[team].team_winning_pct == pytest.approx(pct)
    assert st[4].team_winning_pct is None


def test_latest_per_key_and_tie_break(spark):
    df = spark.createDataFrame([(1, "2016-01-01", 1, "a"), (1, "2016-01-02", 1, "b"), (1, "2016-01-02", 2, "c"),
                                (2, "2016-01-01", 9, "z")] + [(1, "2015-01-01", i, "old") for i in range(200)],
                               "k int, t string, seq int, v string")
    got = rows(latest_per_key(df, ["k"], ["t", "seq"]), "k", "v")
    assert got == [(1, "c"), (2, "z")]


def test_pivot_takes_max_not_newest(gt):
    """A repeated (player, game, source) keeps the largest value."""
    wide = pivot_codes(gt.projections, ["player_id", "game_id"], "source_id", "pts",
                       {c: S.SOURCE_CODES[c] for c in ("nf", "bm", "rw", "fp")})
    got = {r.player_id: (r.nf, r.bm, r.rw, r.fp) for r in wide.collect()}
    assert got[10] == (21.0, 99.0, 23.0, 24.0)
    assert got[12] == (None, 10.0, None, None)
    assert {r.player_id for r in complete_rows(wide, ["nf", "bm", "rw", "fp"]).collect()} == {10, 11}


def test_pivot_then_unpivot_returns_the_maxima(gt):
    codes = {c: S.SOURCE_CODES[c] for c in ("nf", "bm", "rw", "fp")}
    wide = pivot_codes(gt.projections, ["player_id", "game_id"], "source_id", "pts", codes)
    back = unpivot_codes(wide, ["player_id", "game_id"], codes, "source_id", "pts")
    expect = gt.projections.groupBy("player_id", "game_id", "source_id").agg(F.max("pts").alias("pts"))
    assert rows(back, "player_id", "game_id", "source_id", "pts") == rows(expect, "player_id", "game_id", "source_id", "pts")


def test_recent_games_top_n_order_and_nulls(gt):
    """Ten latest games with minutes > 0, newest first, a null stat kept in place."""
    hist = history_rows(gt.stats, season(gt), gt.teams)
    rs = {r.player_id: r for r in recent_arrays(recent_n(hist, 10), "pts").collect()}
    p = rs[10]
    assert len(p.recent_of_stat) == 10 and len(p.recent_mins) == 10
    assert p.recent_game_dates[:3] == ["2016-11-05", "2016-10-20", "2016-10-12"]
    assert p.recent_of_stat[0] is None and p.recent_of_stat[1] == 20      # null kept, arrays parallel
    assert p.recent_mins[0] == pytest.approx(25.46)
    assert p.last_game_played_id == 5 and p.won_last_game_played is True
    assert [list(x) for x in p.recent_latlng[:1]] == [[pytest.approx(34.0), pytest.approx(118.2, abs=1e-4)]]
    assert len(rs[10].recent_of_stat) == 10
    three = {r.player_id: r for r in recent_arrays(recent_n(hist, 3), "pts").collect()}
    assert three[10].recent_game_dates == ["2016-11-05", "2016-10-20", "2016-10-12"]


def test_window_group_limit_is_planned(gt):
    hist = history_rows(gt.stats, season(gt), gt.teams)
    plan = recent_n(hist, 10)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_scalar_functions(spark):
    df = spark.createDataFrame(
        [(7, 2, "2016-11-15", "1990-12-31", None, 3, [1, 2, 3], "", 1751, 2000)],
        "a int, b int, s string, t string, n int, away int, arr array<int>, blank string, w int, tot int")
    r = df.select(
        int_div("a", "b").alias("q"), int_div(F.lit(-7), F.lit(2)).alias("neg"),
        month_diff(parse_date("s"), parse_date("t")).alias("m"),
        month_name(parse_date("s")).alias("mon"),
        game_slug(parse_date("s"), "away", "n").alias("slug_null"),
        game_slug(parse_date("s"), "away", "b").alias("slug"),
        array_len0("arr").alias("l3"), array_len0(F.lit(None).cast("array<int>")).alias("l0"),
        array_len0(F.array().cast("array<int>")).alias("le"),
        least_one(F.lit(1.2).cast("float")).alias("cap"), least_one(F.lit(None).cast("float")).alias("capnull"),
        round_ratio("w", "tot", 3).alias("half_up"),
        blank_to_null("blank").alias("bn"), flag_text(F.lit(None).cast("boolean")).alias("flag"),
        parse_date(F.lit("not-a-date"), strict=False).alias("bad")).first()
    assert (r.q, r.neg, r.m, r.mon) == (3, -3, 311, "NOV")
    assert r.slug_null is None and r.slug == "2016-11-15_3_2"      # || propagates null (F4)
    assert (r.l3, r.l0, r.le) == (3, 0, 0)
    assert r.cap == pytest.approx(1.0) and r.capnull == pytest.approx(1.0)
    assert r.half_up == 0.876                                     # 1751/2000 = 0.8755 rounds up exactly
    assert r.bn is None and r.flag == "false" and r.bad is None


def test_fantasy_score_exact_for_integers(spark):
    df = spark.createDataFrame([(10, 7, 3, 1, 1, 2)], "pts int, reb int, ast int, stl int, blk int, tov int")
    r = df.select(fantasy_score(exact=True).alias("x"), fantasy_score().alias("y")).first()
    assert r.x == 10 + 8.4 + 4.5 + 2 + 2 - 2
    assert r.y == pytest.approx(r.x)


def test_unknown_stat_is_rejected():
    with pytest.raises(ValueError):
        S.check_stat("pts; DROP TABLE x")


def test_date_helpers_accept_only_iso(spark):
    assert spark.range(1).select(parse_date(F.lit("2016-02-30"), strict=False).alias("x")).first().x is None
    assert spark.range(1).select(parse_date(F.lit("2016-02-03")).alias("x")).first().x == d("2016-02-03")


def test_int_div_is_exact_above_2_53(spark):
    r = spark.range(1).select(int_div(F.lit(2 ** 60 + 1), F.lit(1)).alias("a"), int_div(F.lit(-(2 ** 60) - 1), F.lit(3)).alias("b")).first()
    assert (r.a, r.b) == (2 ** 60 + 1, -((2 ** 60 + 1) // 3))


@pytest.mark.parametrize("zone", ["UTC", "America/Los_Angeles", "Asia/Tokyo"])
def test_date_in_zone_does_not_depend_on_the_session_zone(spark, zone):
    from rosterframe.functions.dates import date_in_zone
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        # 2024-01-15 05:00 and 2024-01-14 23:00 in Los Angeles
        for second, day in ((1705323600, "2024-01-15"), (1705302000, "2024-01-14")):
            assert str(spark.range(1).select(date_in_zone(F.timestamp_seconds(F.lit(second)))).first()[0]) == day
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_number_rows_equals_the_window(gt):
    from rosterframe.operators.history import number_rows, recent_n
    rows_ = gt.stats.join(gt.games.select("game_id", "game_date"), "game_id").select("player_id", "game_id", "game_date")
    assert sorted(map(tuple, number_rows(rows_).collect())) == sorted(map(tuple, recent_n(rows_, 10 ** 6).collect()))
