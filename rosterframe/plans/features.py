"""Point-in-time ML features per player and game (the flagship query).

``ml_features`` answers one date as the source query does; ``ml_features_live``
is the "today" variant.  Both are one lazy plan: history is restricted to the
players projected on the date before any history aggregate runs, every
per-team table is bounded by the number of teams and broadcast, and the only
per-player shuffles are the changelog aggregate and the top-N history window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.arith import int_div, least_one, round_ratio
from ..functions.arrays import array_len0, lat_lng
from ..functions.dates import as_date, month_diff, month_name, today_in_zone
from ..functions.text import bool_text, flag_text
from ..operators.history import history_rows, recent_arrays, recent_n
from ..operators.latest import latest_per_key
from ..operators.pivot import complete_rows, pivot_codes
from ..operators.team import avg_attendance, team_state
from ..sources.tables import Tables, prune_months
from . import partials as P
from . import validity as V
from .partials import Partials

PROJECTION_SOURCES = ("nf", "bm", "rw", "fp")


def source_columns(stat: str) -> list[str]:
    """``nf`` has no three-pointer projection, so it is left out for ``tpt``."""
    return [s for s in PROJECTION_SOURCES if not (stat == "tpt" and s == "nf")]


def season_window(games: DataFrame, as_of: Column, season_start: Column) -> DataFrame:
    """Games strictly after the season start and strictly before the date."""
    d = F.col("game_date")
    return prune_months(games, season_start, as_of).where((d > season_start) & (d < as_of))


def projections_on(projections: DataFrame, games: DataFrame, as_of: Column, stat: str,
                   extra_keys: tuple[str, ...] = ()) -> DataFrame:
    """Sources pivoted for the games on the date, only complete rows kept."""
    on_date = prune_months(games, as_of, as_of).where(F.col("game_date") == as_of).select("game_id")
    cols = source_columns(stat)
    wide = pivot_codes(prune_months(projections, as_of, as_of).join(on_date, "game_id", "left_semi"),
                       ["player_id", "game_id", *extra_keys], "source_id", stat,
                       {c: S.SOURCE_CODES[c] for c in cols})
    return complete_rows(wide, cols)


def changelog_asof(changelog: DataFrame, as_of: Column, season_start: Column,
                   slack_days: int = 1) -> DataFrame:
    """Latest change per player with ``season_start <= changed_on <= as_of + slack``."""
    upto = F.date_add(as_of, slack_days)
    window = prune_months(changelog, season_start, upto).where(F.col("changed_on").between(season_start, upto))
    return latest_per_key(window, ["player_id"], ["changed_on", "change_id"])


def player_asof(players: DataFrame, changelog: DataFrame, as_of: Column, season_start: Column,
                slack_days: int = 1, only: DataFrame | None = None, validity: DataFrame | None = None) -> DataFrame:
    """Player bio joined (left) to the latest change, as of the date; with ``validity``
    (``plans.validity``) the change in force is read from there, and the changelog not at all."""
    if validity is not None:
        ch = V.changelog_asof(validity, as_of, season_start, slack_days)
    else:
        if only is not None:
            # Only the changelog aggregate needs the restriction; players meet the
            # targets in an inner join later anyway.
            changelog = changelog.join(only, "player_id", "left_semi")
        ch = changelog_asof(changelog, as_of, season_start, slack_days)
    return (players.select("player_id", "bref_id", "height", "weight", "draft_pick", "dob", "debut_date")
            .join(ch, "player_id", "left")
            .select("player_id", "bref_id", "changed_on",
                    F.col("new_current_depth").alias("current_depth"),
                    F.col("new_usual_depth").alias("usual_depth"),
                    F.col("new_position").alias("player_position"),
                    F.col("new_team").alias("current_team_id"),
                    flag_text(F.col("new_starting").eqNullSafe(F.lit(True))).alias("is_starter"),
                    F.col("new_salary").alias("player_salary"),
                    F.col("new_games_played").alias("games_played"),
                    F.col("new_status").alias("player_status"),
                    F.col("new_inactive").alias("player_inactive"),
                    "height", "weight", "draft_pick",
                    month_diff(as_of, F.col("dob")).alias("age"),
                    month_diff(as_of, F.col("debut_date")).alias("exp_months")))


def _recent(t: Tables, season: DataFrame, targets: DataFrame | None, stat: str, n_recent: int,
            months: tuple[Column, Column] | None = None) -> DataFrame:
    stats = t.stats if months is None else prune_months(t.stats, *months)
    stats = stats if targets is None else stats.join(targets, "player_id", "left_semi")
    return recent_arrays(recent_n(history_rows(stats, season, t.teams), n_recent), stat)


def _game_block(t: Tables, team_col: str) -> tuple[Column, list[Column]]:
    """Columns that depend on whether the player's team is at home."""
    is_home = F.col("home_team_id") == F.col(team_col)
    cols = [
        flag_text(is_home).alias("is_home"),
        F.col("opponent_abbrev"),
        F.when(is_home, F.col("home_spread")).otherwise(-F.col("home_spread")).alias("team_spread"),
        F.when(is_home, F.col("home_pred_pts")).otherwise(F.col("away_pred_pts")).alias("team_pred_pts"),
    ]
    return is_home, cols


def _with_opponent(df: DataFrame, teams: DataFrame, team_col: str) -> DataFrame:
    """Opponent abbreviation: a scalar lookup in the source, one broadcast join here."""
    opp = teams.select(F.col("team_id").alias("_opp_id"),
                                   F.col("team_abbrev").alias("opponent_abbrev"))
    is_home = F.col("home_team_id") == F.col(team_col)
    df = df.withColumn("_opp_id", F.when(is_home, F.col("away_team_id")).otherwise(F.col("home_team_id")))
    return df.join(opp, "_opp_id", "left").drop("_opp_id")


def _season_to_date(t: Tables, season: DataFrame, targets: DataFrame, stat: str, n_recent: int, d: Column, s0: Column,
                    partials: Partials | None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(team, att, recent): last game and record per team, attendance per home team, recent games
    per player; from the season's rows or from monthly partials of them."""
    if partials is None:
        # Last game and record come from one per-team aggregate, joined once on the
        # player's team; attendance is keyed by the home team, so it is its own
        # (home games only) aggregate.  Both are bounded by the number of teams.
        state, att = team_state(season, t.teams), avg_attendance(season, t.teams)
        recent = _recent(t, season, targets, stat, n_recent, (s0, d))
    else:
        state = P.team_state(partials, t.games, t.teams, d, s0)
        att = state.where(F.col("avg_att").isNotNull()).select(F.col("team_id").alias("home_team_id"), "avg_att", "stadium_cap")
        recent = P.recent(partials, t, targets, stat, n_recent, d, s0)
    team = state.where(F.col("last_team_game_id").isNotNull() & F.col("team_winning_pct").isNotNull()).select(
        F.col("team_id").alias("current_team_id"), "last_team_game_id", "won_game", "team_winning_pct")
    return team, att, recent


def ml_features(t: Tables, as_of, stat: str, season_start, training: bool = False,
                n_recent: int = S.DEFAULT_RECENT_GAMES, changelog_slack_days: int = 1,
                partials: Partials | None = None, validity: DataFrame | None = None) -> DataFrame:
    """Features per (player, game) on ``as_of`` from data strictly before it.  With
    ``partials`` the season's whole months come from them (``plans.partials``), with
    ``validity`` the changes in force from their spans (``plans.validity``)."""
    stat = S.check_stat(stat)
    if n_recent < 1:
        raise ValueError("n_recent must be positive")
    d, s0 = as_date(as_of), as_date(season_start)
    season = season_window(t.games, d, s0)
    proj = projections_on(t.projections, t.games, d, stat)
    # Semi-join keys need no distinct: a repeated key matches the same rows.
    targets = proj.select("player_id")
    teams = t.teams

    pl = player_asof(t.players, t.player_changelog, d, s0, changelog_slack_days, targets, validity)
    games = prune_months(t.games, d, d).select(
        "game_id", "game_date", "game_time_24_et", "day_of_week", "home_team_id", "away_team_id",
        "home_spread", "home_pred_pts", "away_pred_pts", "home_team_injured", "away_team_injured")
    home_team = teams.select(F.col("team_id").alias("home_team_id"), F.col("tz_hrs_over_utc").alias("game_tz"),
                             F.array("stadium_lat_n", "stadium_lng_w").alias("game_lat_lng"))
    actual = prune_months(t.stats, d, d).select("player_id", "game_id", F.col(stat).alias("actual_stat"))
    own_team = teams.select(F.col("team_id").alias("current_team_id"), "team_abbrev",
                            F.col("tz_hrs_over_utc").alias("home_tz_over_utc"),
                            lat_lng("stadium_lat_n", "stadium_lng_w").alias("home_lat_lng"))
    team, att, recent = _season_to_date(t, season, targets, stat, n_recent, d, s0, partials)

    df = (proj.join(pl, "player_id")
          .join(games, "game_id")
          .join(home_team, "home_team_id")
          .join(actual, ["player_id", "game_id"])
          .join(own_team, "current_team_id", "left")
          .join(team, "current_team_id")
          .join(att, "home_team_id")
          .join(recent, "player_id"))
    df = _with_opponent(df, t.teams, "current_team_id")
    is_home, game_cols = _game_block(t, "current_team_id")
    cols = source_columns(stat)
    out = ([F.col("actual_stat")] if training else []) + [
        "bref_id", "team_abbrev", *cols,
        "player_id", "changed_on", "current_depth", "usual_depth", "player_position", "current_team_id",
        "is_starter", "player_salary", "games_played", "player_status", "player_inactive",
        "height", "weight", "draft_pick", "age", "exp_months",
        bool_text("won_game").alias("team_won_last_game"), "team_winning_pct",
        *game_cols,
        "game_time_24_et", "game_tz", "day_of_week",
        F.datediff(F.col("game_date"), s0).alias("days_into_season"),
        "game_lat_lng",
        F.when(is_home, array_len0("home_team_injured")).otherwise(array_len0("away_team_injured"))
         .alias("num_teammates_injured"),
        F.when(is_home, array_len0("away_team_injured")).otherwise(array_len0("home_team_injured"))
         .alias("num_opponents_injured"),
        int_div("avg_att", F.lit(1000)).cast("int").alias("stadium_avg_att"),
        least_one(round_ratio("avg_att", "stadium_cap", 3).cast("float")).alias("avg_att_pct"),
        "home_tz_over_utc", "home_lat_lng",
        flag_text(F.col("last_game_played_id") == F.col("last_team_game_id")).alias("played_in_last_team_game"),
        bool_text("won_last_game_played").alias("won_last_game_played"),
        "recent_of_stat", "recent_mins", "recent_games_won", "recent_game_dates",
        "recent_game_times", "recent_time_zones", "recent_latlng"]
    return df.select(*out)


def injured_counts(players: DataFrame) -> DataFrame:
    """Inactive rostered players per team (``status != 'NOT_ON_ROSTER'`` drops null status)."""
    hit = (F.col("inactive") == F.lit(True)) & (F.col("status") != S.STATUS_NOT_ON_ROSTER)
    return (players.where(hit & F.col("current_team").isNotNull())
            .groupBy(F.col("current_team").alias("team_id"))
            .agg(F.count(F.lit(1)).cast("bigint").alias("n_injured")))


def ml_features_live(t: Tables, stat: str, season_start, as_of=None,
                     n_recent: int = S.DEFAULT_RECENT_GAMES, partials: Partials | None = None) -> DataFrame:
    """The "today" variant: roster data from the player table, no changelog, no label.

    Builds the evident intent of the source text (N9): the date is an argument
    (default today in Los Angeles) and the completeness filter is well formed.
    """
    stat = S.check_stat(stat)
    d = today_in_zone() if as_of is None else as_date(as_of)
    s0 = as_date(season_start)
    season = season_window(t.games, d, s0)
    proj = projections_on(t.projections, t.games, d, stat, ("team_id", "depth_pos", "is_starter"))
    proj = proj.drop("team_id", "depth_pos", "is_starter")
    # Semi-join keys need no distinct: a repeated key matches the same rows.
    targets = proj.select("player_id")
    teams = t.teams

    pl = t.players.join(targets, "player_id", "left_semi").select(
        "player_id", "bref_id", "current_depth_pos",
        F.coalesce("usual_depth_pos", "current_depth_pos").alias("usual_depth_pos"),
        bool_text("is_starter").alias("is_starter"),
        "player_position", "height", "weight", "draft_pick", "games_played",
        int_div("current_salary", F.lit(10000)).cast("int").alias("current_salary"),
        month_diff(d, F.col("dob")).alias("age"), month_diff(d, F.col("debut_date")).alias("exp_months"),
        F.col("current_team").alias("current_team_id"))
    games = prune_months(t.games, d, d).select(
        "game_id", "game_date", "game_time_24_et", "day_of_week", "home_team_id", "away_team_id",
        "home_spread", "home_pred_pts", "away_pred_pts")
    home_team = teams.select(F.col("team_id").alias("home_team_id"), F.col("tz_hrs_over_utc").alias("game_tz"),
                             F.array("stadium_lat_n", "stadium_lng_w").alias("game_lat_lng"))
    own_team = teams.select(F.col("team_id").alias("current_team_id"), "team_abbrev",
                            F.col("tz_hrs_over_utc").alias("home_tz_over_utc"),
                            lat_lng("stadium_lat_n", "stadium_lng_w").alias("home_lat_lng"))
    team, att, recent = _season_to_date(t, season, targets, stat, n_recent, d, s0, partials)
    inj = injured_counts(t.players)
    inj_home = inj.select(F.col("team_id").alias("home_team_id"), F.col("n_injured").alias("_inj_home"))
    inj_away = inj.select(F.col("team_id").alias("away_team_id"), F.col("n_injured").alias("_inj_away"))

    df = (proj.join(pl, "player_id")
          .join(games, "game_id")
          .join(home_team, "home_team_id")
          .join(own_team, "current_team_id", "left")
          .join(team, "current_team_id")
          .join(att, "home_team_id")
          .join(recent, "player_id")
          .join(inj_home, "home_team_id", "left")
          .join(inj_away, "away_team_id", "left"))
    df = _with_opponent(df, t.teams, "current_team_id")
    is_home, game_cols = _game_block(t, "current_team_id")
    n_home = F.coalesce(F.col("_inj_home"), F.lit(0)).cast("bigint")
    n_away = F.coalesce(F.col("_inj_away"), F.lit(0)).cast("bigint")
    cols = source_columns(stat)
    return df.select(
        "bref_id", *cols, "current_depth_pos", "usual_depth_pos", "is_starter",
        "player_position", "height", "weight", "draft_pick", "games_played", "current_salary",
        "age", "exp_months", "team_abbrev",
        bool_text("won_game").alias("team_won_last_game"), "team_winning_pct",
        *game_cols,
        "game_time_24_et", "day_of_week", month_name("game_date").alias("game_month"), "game_tz",
        "game_lat_lng",
        F.when(is_home, n_home).otherwise(n_away).alias("num_teammates_injured"),
        F.when(is_home, n_away).otherwise(n_home).alias("num_opponents_injured"),
        int_div("avg_att", F.lit(1000)).cast("int").alias("stadium_avg_att"),
        round_ratio("avg_att", "stadium_cap", 3).cast("float").alias("avg_att_pct"),
        "home_tz_over_utc", "home_lat_lng",
        flag_text(F.col("last_game_played_id") == F.col("last_team_game_id")).alias("played_in_last_team_game"),
        bool_text("won_last_game_played").alias("won_last_game_played"),
        "recent_of_stat", "recent_mins", "recent_games_won", "recent_game_dates",
        "recent_game_times", "recent_time_zones", "recent_latlng")
