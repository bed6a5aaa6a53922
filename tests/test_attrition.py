"""Where the feature query's inner joins drop rows, against the
counts FIXTURES.md computed independently ("Parameters that give rows")."""

from __future__ import annotations

import pytest
from conftest import SF001, SF01
from pyspark.sql import functions as F

from rosterframe import schema as S
from rosterframe.functions.dates import as_date
from rosterframe.operators.pivot import pivot_codes
from rosterframe.operators.team import avg_attendance, team_state
from rosterframe.plans import features as FE
from rosterframe.sources.binding import bind

# FIXTURES.md: (as-of date, season start) -> pivot rows -> final rows, per scale.
EXPECTED = {
    SF001: {("1998-11-18", "1998-01-01"): (11, 7), ("1998-11-10", "1998-01-01"): (10, 3),
            ("2000-06-15", "1995-01-01"): (11, 8), ("1998-12-09", "1998-01-01"): (0, 0)},
    SF01: {("1998-11-18", "1998-01-01"): (33, 22), ("1998-11-10", "1998-01-01"): (21, 16),
           ("2000-06-15", "1995-01-01"): (14, 7), ("1998-12-09", "1998-01-01"): (43, 22)},
}


def stage_counts(t, day: str, season: str) -> list[tuple[str, int]]:
    d, s0 = as_date(day), as_date(season)
    on = t.games.where(F.col("game_date") == d).select("game_id")
    codes = {c: S.SOURCE_CODES[c] for c in FE.PROJECTION_SOURCES}
    raw = pivot_codes(t.projections.join(on, "game_id", "left_semi"), ["player_id", "game_id"], "source_id", "pts", codes)
    proj = FE.projections_on(t.projections, t.games, d, "pts")
    season_games = FE.season_window(t.games, d, s0)
    pl = FE.player_asof(t.players, t.player_changelog, d, s0)
    with_player = proj.join(pl, "player_id").join(t.games.select("game_id", "home_team_id"), "game_id")
    team = team_state(season_games, t.teams)
    last = team.where(F.col("last_team_game_id").isNotNull()).select(F.col("team_id").alias("current_team_id"))
    rec = team.where(F.col("team_winning_pct").isNotNull()).select(F.col("team_id").alias("current_team_id"))
    with_last = with_player.join(last, "current_team_id")
    with_att = with_last.join(avg_attendance(season_games, t.teams).select("home_team_id"), "home_team_id")
    with_rec = with_att.join(rec, "current_team_id")
    final = FE.ml_features(t, day, "pts", season)
    return [("pivot", raw.count()), ("complete", proj.count()), ("player", with_player.count()),
            ("last game", with_last.count()), ("attendance", with_att.count()), ("record", with_rec.count()),
            ("final", final.count())]


@pytest.mark.parametrize("sf_dir", [SF001, SF01])
def test_attrition_matches_fixtures(spark, sf_dir):
    t = bind(spark, sf_dir)
    for (day, season), (pivot_rows, final_rows) in EXPECTED[sf_dir].items():
        counts = stage_counts(t, day, season)
        values = [n for _, n in counts]
        assert values[0] == pivot_rows and values[-1] == final_rows, (day, counts)
        assert all(a >= b for a, b in zip(values, values[1:])), (day, counts)   # joins only drop rows
