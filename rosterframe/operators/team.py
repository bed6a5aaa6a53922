"""Team-level records derived from games: last game, win percentage, attendance."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def team_games(games: DataFrame) -> DataFrame:
    """One row per (team, game) with both result rules of the source queries.

    * ``won`` - the per-game flag: home wins on ``home_team_won IS TRUE``, away on
      ``IS FALSE``; a null result is "not won" for both (N2, second half).
    * ``credited_win`` - the record rule: ``CASE WHEN home_team_won THEN home ELSE
      away`` credits a null result to the away team (N2, first half).
    """
    won = F.col("home_team_won")
    roles = F.array(
        F.struct(F.col("home_team_id").alias("team_id"), F.lit(True).alias("is_home"),
                 F.coalesce(won, F.lit(False)).alias("won"),
                 F.coalesce(won, F.lit(False)).alias("credited_win"),
                 F.col("attendance").alias("home_attendance")),
        F.struct(F.col("away_team_id").alias("team_id"), F.lit(False).alias("is_home"),
                 (won == F.lit(False)).eqNullSafe(F.lit(True)).alias("won"),
                 (~F.coalesce(won, F.lit(False))).alias("credited_win"),
                 F.lit(None).cast("int").alias("home_attendance")))
    return games.select("game_id", "game_date", F.inline(roles))


def last_team_game(season_games: DataFrame, teams: DataFrame) -> DataFrame:
    """Each team's latest game in the window (ties: larger game id), with its result.

    Replaces the correlated ``ON g.game_id = (SELECT ... ORDER BY date DESC LIMIT 1)``
    by an aggregate; ``max_by`` combines map-side, so a busy team is no hot spot.
    """
    last = (team_games(season_games)
            .groupBy("team_id")
            .agg(F.max_by(F.struct("game_id", "game_date", F.col("won").alias("won_game")),
                          F.struct("game_date", "game_id")).alias("_g"))
            .select("team_id", "_g.*"))
    # Only teams of the team table take part (the source joins nba_teams).
    return last.join(teams.select("team_id", "team_abbrev"), "team_id")


def team_records(season_games: DataFrame) -> DataFrame:
    """Wins, losses and ``round(w / (w + l), 3)`` as REAL, in one aggregation.

    A team without a win or without a loss has no row (N3: the source meets
    wins and losses by an inner join).
    """
    credited = F.col("credited_win")
    return (team_games(season_games)
            .groupBy("team_id")
            .agg(F.sum(F.when(credited, 1).otherwise(0)).cast("bigint").alias("wins"),
                 F.sum(F.when(credited, 0).otherwise(1)).cast("bigint").alias("losses"))
            .where((F.col("wins") > 0) & (F.col("losses") > 0))
            .withColumn("pct", _ratio3("wins", F.col("wins") + F.col("losses"))))


def avg_attendance(season_games: DataFrame, teams: DataFrame) -> DataFrame:
    """Average attendance per home stadium, rounded half up to an int, with capacity."""
    avg = (season_games.where(F.col("attendance").isNotNull())
           .groupBy("home_team_id")
           .agg(F.round(F.avg("attendance")).cast("int").alias("avg_att")))
    cap = teams.select(F.col("team_id").alias("home_team_id"),
                       F.col("stadium_capacity").alias("stadium_cap"))
    return avg.join(cap, "home_team_id")


def team_state(season_games: DataFrame, teams: DataFrame) -> DataFrame:
    """Last game, record and home attendance of every team in one aggregation.

    The three per-team blocks of the feature query read the same season games;
    one ``groupBy(team_id)`` (combined map-side) gives all of them.  Columns
    are null where the source's inner join would drop the team: no game
    (last game), no win or no loss (record, N3), no attended home game.
    """
    credited = F.col("credited_win")
    att = F.col("home_attendance")
    agg = (team_games(season_games)
           .groupBy("team_id")
           .agg(F.max_by(F.struct("game_id", F.col("won").alias("won_game")),
                         F.struct("game_date", "game_id")).alias("_g"),
                F.sum(F.when(credited, 1).otherwise(0)).cast("bigint").alias("wins"),
                F.sum(F.when(credited, 0).otherwise(1)).cast("bigint").alias("losses"),
                F.round(F.avg(att)).cast("int").alias("avg_att")))
    dims = teams.select("team_id", F.col("stadium_capacity").alias("stadium_cap"))
    return agg.join(dims, "team_id").select(
        "team_id", F.col("_g.game_id").alias("last_team_game_id"), F.col("_g.won_game").alias("won_game"),
        "wins", "losses",
        F.when((F.col("wins") > 0) & (F.col("losses") > 0),
               _ratio3("wins", F.col("wins") + F.col("losses"))).alias("team_winning_pct"),
        "avg_att", "stadium_cap")


def _ratio3(num, den):
    from ..functions.arith import round_ratio
    return round_ratio(num, den, 3).cast("float")
