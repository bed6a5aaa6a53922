"""Typed schemas of the nine league tables and the fixed code lists.

Every table is declared as an explicit ``StructType``; nothing is inferred at
run time.  Column types are the ones the queries need (see SURVEY section 1.3).
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values that must equal the source system's ---------------------
# Projection source codes: 1=nf, 2=bm, 3=rw, 4=fp, 5=fc.
SOURCE_CODES = {"nf": 1, "bm": 2, "rw": 3, "fp": 4, "fc": 5}
# Stat types, in the order the prediction report lists them.
STAT_TYPES = ("pts", "reb", "ast", "stl", "blk", "tov", "tpt")
# Fantasy score weights: pts + 1.2 reb + 1.5 ast + 2 stl + 2 blk - tov.
FANDUEL_WEIGHTS = {"pts": 1.0, "reb": 1.2, "ast": 1.5, "stl": 2.0, "blk": 2.0, "tov": -1.0}
# Player status literals.
STATUS_NOT_ON_ROSTER = "NOT_ON_ROSTER"
STATUS_PENDING = "PENDING"
STATUS_INCOMPLETE = "INCOMPLETE"
# Salary sites.
SITES = ("FAN_DUEL", "DRAFT_KINGS")
DEFAULT_RECENT_GAMES = 10
# Zone used for "today" when no date is given.
LEAGUE_TIME_ZONE = "America/Los_Angeles"
# ---------------------------------------------------------------------------


def _s(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


INT, LONG, DBL, FLT, STR, BOOL, DATE, TS = (
    T.IntegerType(), T.LongType(), T.DoubleType(), T.FloatType(), T.StringType(),
    T.BooleanType(), T.DateType(), T.TimestampType())
INT_ARRAY = T.ArrayType(INT)

GAMES = _s(
    ("game_id", LONG), ("game_date", DATE), ("game_time_24_et", STR), ("day_of_week", STR),
    ("away_team_id", INT), ("home_team_id", INT), ("bref_slug", STR), ("game_slug", STR),
    ("away_team_pts", INT), ("home_team_pts", INT),
    ("away_team_injured", INT_ARRAY), ("home_team_injured", INT_ARRAY),
    ("attendance", INT), ("home_team_won", BOOL), ("over_under", STR),
    ("home_spread", DBL), ("total_pred", DBL), ("away_pred_pts", DBL), ("home_pred_pts", DBL))

TEAMS = _s(
    ("team_id", INT), ("team_abbrev", STR), ("tz_hrs_over_utc", INT),
    ("stadium_lat_n", FLT), ("stadium_lng_w", FLT), ("stadium_capacity", INT))

PLAYERS = _s(
    ("player_id", LONG), ("player_name", STR), ("player_position", STR), ("current_team", INT),
    ("is_starter", BOOL), ("inactive", BOOL), ("usual_depth_pos", INT), ("current_depth_pos", INT),
    ("status", STR), ("bref_id", STR), ("dob", DATE), ("debut_date", DATE), ("draft_pick", INT),
    ("current_salary", INT), ("height", INT), ("weight", INT), ("games_played", INT),
    ("nf_id", STR), ("rw_id", STR), ("bm_id", STR), ("fp_id", STR), ("fc_id", STR))

# ``change_id`` orders changes made at the same time (the later id wins).
PLAYER_CHANGELOG = _s(
    ("player_id", LONG), ("changed_on", TS), ("change_id", LONG),
    ("new_current_depth", INT), ("new_usual_depth", INT), ("new_position", STR), ("new_team", INT),
    ("new_starting", BOOL), ("new_salary", INT), ("new_games_played", INT), ("new_status", STR),
    ("new_inactive", BOOL))

STAT_COLUMNS = ("mins", "pts", "reb", "ast", "stl", "blk", "tpt", "tov")

PROJECTIONS = _s(
    ("player_id", LONG), ("game_id", LONG), ("source_id", INT),
    *[(c, DBL) for c in STAT_COLUMNS],
    ("team_id", INT), ("depth_pos", INT), ("is_starter", BOOL))

STATS = _s(
    ("player_id", LONG), ("game_id", LONG), ("team_id", INT), ("mins", DBL),
    *[(c, INT) for c in STAT_COLUMNS[1:]])

PREDICTIONS = _s(
    ("source", STR), ("game_date", DATE), ("stat_type", STR), ("prediction", DBL),
    ("player_bref_id", STR), ("created", TS))

SALARIES = _s(("player_id", LONG), ("game_date", DATE), ("salary", INT), ("site", STR))

NEW_IDS = _s(("source_id", INT), ("new_id", STR), ("player_name", STR), ("id", STR))

TABLE_SCHEMAS = {
    "games": GAMES, "teams": TEAMS, "players": PLAYERS, "player_changelog": PLAYER_CHANGELOG,
    "projections": PROJECTIONS, "stats": STATS, "predictions": PREDICTIONS,
    "salaries": SALARIES, "new_ids": NEW_IDS,
}


def check_stat(stat: str) -> str:
    """Stat names are spliced into column references, so only known ones pass."""
    if stat not in STAT_TYPES:
        raise ValueError(f"unknown stat type {stat!r}; expected one of {STAT_TYPES}")
    return stat
