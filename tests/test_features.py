"""The feature queries on golden rows and on the driver tables."""

from __future__ import annotations

import pytest
from conftest import rows
from golden import AS_OF, SEASON, tables
from pyspark.sql import functions as F

from rosterframe.plans.backfill import ml_features_backfill
from rosterframe.plans.features import ml_features, ml_features_live
from rosterframe.sources.sinks import csv_safe


@pytest.fixture(scope="module")
def gt(spark):
    return tables(spark)


def test_golden_features(gt):
    out = {r.player_id: r for r in ml_features(gt, AS_OF, "pts", SEASON, training=True).collect()}
    # player 10: complete sources; player 11: complete; player 12: incomplete sources
    assert set(out) == {10, 11}
    p = out[10]
    assert p.actual_stat == 31
    assert p.bm == 99.0                                  # MAX over the repeated source row (N5)
    assert str(p.changed_on) == "2016-11-16 00:00:00"             # change on date + 1 counts, date + 2 does not (N8)
    assert p.current_team_id == 1 and p.is_home == "true" and p.team_spread == 4.5
    assert p.num_teammates_injured == 3 and p.num_opponents_injured == 0   # null array counts 0
    assert p.opponent_abbrev == "CCC"
    assert p.days_into_season == 45
    assert p.age == 317 and p.exp_months == 72
    assert p.team_won_last_game == "true"                # team 1's last game: game 5, an away win
    assert p.played_in_last_team_game == "true"
    # team 1's only attended home game in the window drew 16000 of 18000 seats
    assert p.stadium_avg_att == 16 and p.avg_att_pct == pytest.approx(0.889)
    q = out[11]
    assert q.is_starter == "false"                       # same-day changes: larger id, new_starting False
    assert q.current_team_id == 3 and q.is_home == "false" and q.team_spread == -4.5


def test_tpt_drops_nf(gt):
    df = ml_features(gt, AS_OF, "tpt", SEASON)
    assert "nf" not in df.columns and "bm" in df.columns


def test_no_leak_from_the_date_on(small_tables):
    """Changing every game on or after the date leaves history features unchanged."""
    t = small_tables
    as_of, season = "1998-11-18", "1998-01-01"
    later = F.col("game_date") >= F.lit(as_of).cast("date")
    games2 = t.games.select(*[
        F.when(later, ~F.col(c)).otherwise(F.col(c)).alias(c) if c == "home_team_won" else
        F.when(later, F.col(c) + 5000).otherwise(F.col(c)).alias(c) if c == "attendance" else F.col(c)
        for c in t.games.columns])
    hist_cols = ["player_id", "team_won_last_game", "team_winning_pct", "stadium_avg_att", "avg_att_pct",
                 "played_in_last_team_game", "won_last_game_played", "recent_of_stat", "recent_mins",
                 "recent_games_won", "recent_game_dates"]
    a = csv_safe(ml_features(t, as_of, "pts", season)).select(*hist_cols)
    b = csv_safe(ml_features(t.with_(games=games2), as_of, "pts", season)).select(*hist_cols)
    assert rows(a) == rows(b) and len(rows(a)) > 0


def test_backfill_equals_single_date(small_tables):
    t = small_tables
    bf = csv_safe(ml_features_backfill(t, "pts", training=True)).cache()
    for day in ("1998-11-18", "1998-11-10", "2000-06-15"):
        one = csv_safe(ml_features(t, day, "pts", day[:4] + "-01-01", training=True))
        sub = bf.where(F.col("as_of") == day).select(*one.columns)
        assert rows(one) == rows(sub), day
    bf.unpersist()


def test_backfill_date_filter(spark, small_tables):
    dates = spark.createDataFrame([("1998-11-18",)], "d string")
    a = csv_safe(ml_features_backfill(small_tables, "pts", dates=dates))
    assert {r.as_of for r in a.collect()} <= {"1998-11-18"}


def test_live_variant_shape(gt):
    df = ml_features_live(gt, "pts", SEASON, as_of=AS_OF)
    assert "game_month" in df.columns and "actual_stat" not in df.columns
    got = {r.bref_id: r for r in df.collect()}
    # Team 1: player 13 is inactive but has a null status, which fails != (P18);
    # team 3 has player 11, inactive and rostered.
    assert got["p10"].num_teammates_injured == 0 and got["p10"].num_opponents_injured == 1
    assert got["p10"].game_month == "NOV"


def test_parameters_are_validated(gt):
    with pytest.raises(ValueError):
        ml_features(gt, AS_OF, "points", SEASON)
    with pytest.raises(ValueError):
        ml_features(gt, AS_OF, "pts", SEASON, n_recent=0)


def test_season_functions(spark):
    from rosterframe.plans.backfill import calendar_season, october_season
    df = spark.createDataFrame([("2016-11-15",), ("2017-03-01",), ("2016-10-01",)], "d string")
    got = [(r.c, r.o) for r in df.select(calendar_season(F.col("d").cast("date")).cast("string").alias("c"),
                                         october_season(F.col("d").cast("date")).cast("string").alias("o")).collect()]
    assert got == [("2016-01-01", "2016-10-01"), ("2017-01-01", "2016-10-01"), ("2016-01-01", "2016-10-01")]


def test_changelog_slack_is_a_parameter(gt):
    no_slack = {r.player_id: str(r.changed_on)[:10] for r in ml_features(gt, AS_OF, "pts", SEASON, changelog_slack_days=0).collect()}
    two = {r.player_id: str(r.changed_on)[:10] for r in ml_features(gt, AS_OF, "pts", SEASON, changelog_slack_days=2).collect()}
    assert no_slack[10] == "2016-10-10" and two[10] == "2016-11-17"


def test_backfill_october_seasons(gt):
    from rosterframe.plans.backfill import october_season
    bf = {(r.player_id, str(r.as_of)): r for r in ml_features_backfill(gt, "pts", season_of=october_season).collect()}
    one = {r.player_id: r for r in ml_features(gt, AS_OF, "pts", SEASON).collect()}
    for pid, r in one.items():
        b = bf[(pid, AS_OF)]
        assert (b.team_winning_pct, b.recent_of_stat, b.changed_on, b.days_into_season) == \
            (r.team_winning_pct, r.recent_of_stat, r.changed_on, r.days_into_season)


def test_hot_keys_keep_results_exact(small_tables):
    """A third of the games on one home team and a third of the changelog on one
    player: the one-job backfill still equals the single-date query."""
    t = small_tables
    hot_game = F.col("game_id") % 3 == 0
    games = t.games.withColumn("home_team_id", F.when(hot_game, F.lit(1)).otherwise(F.col("home_team_id"))) \
        .withColumn("away_team_id", F.when(hot_game & (F.col("away_team_id") == 1), F.lit(2))
                    .otherwise(F.col("away_team_id")))
    changelog = t.player_changelog.withColumn(
        "player_id", F.when(F.col("change_id") % 3 == 0, F.lit(2)).otherwise(F.col("player_id")))
    hot = t.with_(games=games, player_changelog=changelog)
    assert games.where("home_team_id = 1").count() * 3 >= games.count()
    bf = csv_safe(ml_features_backfill(hot, "pts")).cache()
    for day in ("1998-11-18", "2000-06-15"):
        one = csv_safe(ml_features(hot, day, "pts", day[:4] + "-01-01"))
        assert rows(one) == rows(bf.where(F.col("as_of") == day).select(*one.columns)), day
    bf.unpersist()


def test_backfill_lineage_cut_changes_nothing(small_tables):
    a = csv_safe(ml_features_backfill(small_tables, "reb", n_recent=4))
    b = csv_safe(ml_features_backfill(small_tables, "reb", n_recent=4, cut_lineage=True))
    assert rows(a) == rows(b) and len(rows(a)) > 0


def test_backfill_counts_repeated_rows_once_for_each_use(small_tables):
    """Players stored twice come twice, with the recent games that they have once."""
    t = small_tables.with_(players=small_tables.players.unionByName(small_tables.players))
    once, twice = (csv_safe(ml_features_backfill(x, "pts", lo="1998-11-01", hi="1998-12-31", n_recent=3)) for x in (small_tables, t))
    assert rows(twice) == [r for r in rows(once) for _ in range(2)] and rows(once)


def test_backfill_shuffles_no_wide_row_for_each_lookup(spark, small_tables):
    """With every join by shuffle: attendance meets games, box scores meet the pivot, and a player's past is one shuffle."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        plan = ml_features_backfill(small_tables, "pts", cut_lineage=False)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(key, before)
    wide = [x for x in plan.splitlines() if "Exchange hashpartitioning" in x and "as_of" in x and "player_id" in x]
    assert len(wide) == 1, wide
