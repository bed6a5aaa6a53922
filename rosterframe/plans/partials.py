"""Season-to-date features from monthly partials.

A season's games are summed up once a month instead of once a question.  For every month
the store keeps, per team, what can be merged (wins, losses, attendance sum and count, the
latest game), and, per player, the latest box scores of the month.  A date then reads the
partials of the whole months since the season's start and the games of its own month.

A season starts behind its first date, which as a rule is a first of a month; so a month's
partials keep that day apart (``first_day``), and such a start needs no games of its month.
Inserts and updates of stored games and box scores renew the months they touch
(``plans.stored``).
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.arith import round_ratio
from ..functions.arrays import lat_lng
from ..operators.history import history_rows
from ..operators.team import team_games
from ..sources.ledger import Ledger
from ..sources.tables import UNASSIGNED, file_in_place, month_of, partition_column, read_table

MONTH = "game_month"
TEAM_MONTHS = (f"team_id int, first_day boolean, wins long, losses long, attendance long, attended long, "
               f"last struct<game_date:date,game_id:long,won:boolean>, {MONTH} string")
_GAME = ("game_date:date,game_id:long,mins:double," + ",".join(f"{c}:int" for c in S.STAT_COLUMNS[1:])
         + ",team_won:boolean,game_time:string,tz:int,lat:float,lng:float")
PLAYER_MONTHS = f"player_id long, first_day boolean, games array<struct<{_GAME}>>, {MONTH} string"
_GAME_FIELDS = [x.split(":")[0] for x in _GAME.split(",")]


@dataclass(frozen=True)
class Partials:
    """``kept``: how many of a player's games a month keeps; no question may ask for more."""
    team_months: DataFrame
    player_months: DataFrame
    kept: int = S.DEFAULT_RECENT_GAMES


def _first_day(date: Column) -> Column:
    return F.dayofmonth(date) == 1


def team_months(games: DataFrame) -> DataFrame:
    """One row per team, month and whether it is the month's first day."""
    credited = F.col("credited_win").cast("long")
    return (team_games(games.where(F.col("game_date").isNotNull()))
            .groupBy("team_id", _first_day(F.col("game_date")).alias("first_day"), month_of(F.col("game_date")).alias(MONTH))
            .agg(F.sum(credited).alias("wins"), F.sum(1 - credited).alias("losses"),
                 F.sum(F.col("home_attendance").cast("long")).alias("attendance"), F.count("home_attendance").alias("attended"),
                 F.max(F.struct("game_date", "game_id", "won")).alias("last"))
            .select("team_id", "first_day", "wins", "losses", "attendance", "attended", "last", MONTH))


def _latest(rows: DataFrame, keys: list[str], kept: int) -> DataFrame:
    """The latest ``kept`` box scores of each key as one array; no more than that many
    rows of a key leave a map task."""
    order = Window.partitionBy(*keys).orderBy(F.col("game_date").desc(), F.col("game_id").desc())
    top = rows.withColumn("row_num", F.row_number().over(order)).where(F.col("row_num") <= kept)
    return top.groupBy(*keys).agg(F.collect_list(F.struct(*_GAME_FIELDS)).alias("games"))


def player_months(stats: DataFrame, games: DataFrame, teams: DataFrame, kept: int = S.DEFAULT_RECENT_GAMES) -> DataFrame:
    """One row per player, month and whether it is the month's first day."""
    rows = history_rows(stats.drop(MONTH), games.where(F.col("game_date").isNotNull()), teams)
    rows = rows.withColumns({"first_day": _first_day(F.col("game_date")), MONTH: month_of(F.col("game_date"))})
    return _latest(rows, ["player_id", "first_day", MONTH], kept).select("player_id", "first_day", "games", MONTH)


def partials_of(t, kept: int = S.DEFAULT_RECENT_GAMES) -> Partials:
    return Partials(team_months(t.games), player_months(t.stats, t.games, t.teams, kept), kept)


# ---- a season up to a date -------------------------------------------------------

def whole_months(partials: DataFrame, as_of: Column, season_start: Column) -> DataFrame:
    """The partials of the months between the season's first date and the date's month; of the
    season's own first month if the season starts behind its first day."""
    first, last = month_of(season_start), month_of(as_of)
    own = (F.col(MONTH) == first) & ~F.col("first_day") & _first_day(season_start)
    return partials.where((F.col(MONTH) < last) & ((F.col(MONTH) > first) | own))


def open_days(df: DataFrame, as_of: Column, season_start: Column) -> DataFrame:
    """Stored rows of the months that ``whole_months`` doesn't cover."""
    if partition_column(df) is None:
        return df
    return df.where((F.col(MONTH) == month_of(as_of)) | (F.col(MONTH) == UNASSIGNED)
                    | ((F.col(MONTH) == month_of(season_start)) & ~_first_day(season_start)))


def open_games(games: DataFrame, as_of: Column, season_start: Column) -> DataFrame:
    d = F.col("game_date")
    in_season = open_days(games, as_of, season_start).where((d > season_start) & (d < as_of))
    return in_season.where((month_of(d) == month_of(as_of)) | ((month_of(d) == month_of(season_start)) & ~_first_day(season_start)))


def team_state(partials: Partials, games: DataFrame, teams: DataFrame, as_of: Column, season_start: Column) -> DataFrame:
    """``operators.team.team_state`` of the season up to the date."""
    rows = whole_months(partials.team_months, as_of, season_start).unionByName(team_months(open_games(games, as_of, season_start)))
    merged = rows.groupBy("team_id").agg(F.sum("wins").alias("wins"), F.sum("losses").alias("losses"), F.sum("attendance").alias("s"),
                                         F.sum("attended").alias("n"), F.max("last").alias("last"))
    dims = teams.select("team_id", F.col("stadium_capacity").alias("stadium_cap"))
    games_played = F.col("wins") + F.col("losses")
    return merged.join(dims, "team_id").select(
        "team_id", F.col("last.game_id").alias("last_team_game_id"), F.col("last.won").alias("won_game"), "wins", "losses",
        F.when((F.col("wins") > 0) & (F.col("losses") > 0), round_ratio("wins", games_played, 3).cast("float")).alias("team_winning_pct"),
        F.when(F.col("n") > 0, F.round(F.col("s").cast("double") / F.col("n")).cast("int")).alias("avg_att"), "stadium_cap")


def recent(partials: Partials, t, players: DataFrame, stat: str, n: int, as_of: Column, season_start: Column) -> DataFrame:
    """``operators.history.recent_arrays`` of the players' latest ``n`` games of the season before
    the date.  What is merged is a short array for each of the season's months, no box score
    of a whole month is read."""
    if n > partials.kept:
        raise ValueError(f"the partials keep {partials.kept} games a month, not {n}")
    whole = whole_months(partials.player_months, as_of, season_start).join(players, "player_id", "left_semi")
    stats = open_days(t.stats, as_of, season_start).drop(MONTH).join(players, "player_id", "left_semi")
    month = history_rows(stats, open_games(t.games, as_of, season_start), t.teams)
    now = _latest(month, ["player_id"], n)
    merged = whole.select("player_id", "games").unionByName(now).groupBy("player_id").agg(F.flatten(F.collect_list("games")).alias("games"))
    latest = F.slice(F.reverse(F.array_sort("games")), 1, n)

    def each(make) -> Column:
        return F.transform("games", make)

    return merged.select("player_id", latest.alias("games")).select(
        "player_id", F.col("games")[0]["game_id"].alias("last_game_played_id"), F.col("games")[0]["team_won"].alias("won_last_game_played"),
        each(lambda g: g[stat]).alias("recent_of_stat"), each(lambda g: F.round(g["mins"], 2)).alias("recent_mins"),
        each(lambda g: g["team_won"]).alias("recent_games_won"), each(lambda g: F.date_format(g["game_date"], "yyyy-MM-dd")).alias("recent_game_dates"),
        each(lambda g: g["game_time"]).alias("recent_game_times"), each(lambda g: g["tz"]).alias("recent_time_zones"),
        each(lambda g: lat_lng(g["lat"], g["lng"])).alias("recent_latlng"))


# ---- stored partials -------------------------------------------------------------

_TABLES = {"team_months": TEAM_MONTHS, "player_months": PLAYER_MONTHS}


def read_partials(spark: SparkSession, root: str, kept: int = S.DEFAULT_RECENT_GAMES) -> Partials:
    return Partials(*(spark.read.schema(schema).parquet(f"{root}/{name}") for name, schema in _TABLES.items()), kept)


def _write(df: DataFrame, path: str) -> None:
    """Each task files the partials that it made under their months, without a second shuffle."""
    file_in_place(df, MONTH, path)


def write_partials(spark: SparkSession, root: str, kept: int = S.DEFAULT_RECENT_GAMES) -> None:
    """Partials of all that is stored under ``root``."""
    games, stats, teams = (read_table(spark, root, n) for n in ("games", "stats", "teams"))
    _write(team_months(games), f"{root}/team_months")
    _write(player_months(stats, games, teams, kept), f"{root}/player_months")


def renew(spark: SparkSession, root: str, months: Iterable[str], change: str | None = None, kept: int = S.DEFAULT_RECENT_GAMES) -> None:
    """Compute the partials of some months anew, where partials are stored.  Games and box
    scores of those months are read, nothing else.  ``change`` is the id of the change
    that touched them: its renewal is done once."""
    ledger, months = Ledger(spark, root), sorted(set(months) - {UNASSIGNED})
    kept_up = [name for name in _TABLES if months and ledger.has_files(name)]
    if not kept_up:
        return
    games, stats = (read_table(spark, root, n).where(F.col(MONTH).isin(months)) for n in ("games", "stats"))
    made = {"team_months": lambda: team_months(games), "player_months": lambda: player_months(stats, games, read_table(spark, root, "teams"), kept)}
    for name in kept_up:
        ledger.apply(name, change or uuid.uuid4().hex, made[name], _write, replaces=[f"{MONTH}={m}" for m in months])
