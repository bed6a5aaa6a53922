"""A player's recent games: rows, top-N per player, ordered parallel arrays."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.arrays import lat_lng


def history_rows(stats: DataFrame, season_games: DataFrame, teams: DataFrame) -> DataFrame:
    """Box scores with minutes > 0 joined to their game and home stadium.

    ``team_won`` uses the per-game rule (``IS TRUE`` / ``IS FALSE``; null is not won).
    """
    g = season_games.select("game_id", "game_date", F.col("game_time_24_et").alias("game_time"),
                            "home_team_id", "away_team_id", "home_team_won")
    t = teams.select(F.col("team_id").alias("home_team_id"), F.col("tz_hrs_over_utc").alias("tz"),
                     F.col("stadium_lat_n").alias("lat"), F.col("stadium_lng_w").alias("lng"))
    won = F.col("home_team_won")
    team_won = (((F.col("team_id") == F.col("home_team_id")) & won.eqNullSafe(F.lit(True))) |
                ((F.col("team_id") == F.col("away_team_id")) & won.eqNullSafe(F.lit(False))))
    return (stats.where(F.col("mins") > 0)
            .join(g, "game_id")
            .join(t, "home_team_id")
            .withColumn("team_won", F.coalesce(team_won, F.lit(False)))
            .drop("home_team_id", "away_team_id", "home_team_won"))


def number_rows(rows: DataFrame, key: str = "player_id") -> DataFrame:
    """Every row numbered from the latest game of its key; ties on the date go to
    the larger game id (N12).

    A row's number is the number of rows on later days plus its place within the
    day: the counts per day are combined map-side and summed over days, and the
    window over rows is partitioned by (key, day), so a key with a third of the
    rows is spread over its days instead of sorted in one task.
    """
    day = [key, "game_date"]
    later = Window.partitionBy(key).orderBy(F.col("game_date").desc()).rowsBetween(Window.unboundedPreceding, -1)
    per_day = (rows.groupBy(*day).agg(F.count(F.lit(1)).alias("_n"))
               .select(*day, F.coalesce(F.sum("_n").over(later), F.lit(0)).alias("_later")))
    in_day = F.row_number().over(Window.partitionBy(*day).orderBy(F.col("game_id").desc()))
    return (rows.withColumn("_place", in_day).join(per_day, day)
            .select(*rows.columns, (F.col("_later") + F.col("_place")).cast("int").alias("row_num")))


def recent_n(rows: DataFrame, n: int, key: str = "player_id") -> DataFrame:
    """Rows numbered from the latest game per key, kept up to ``n``.

    Ties on the date go to the larger game id (N12).  The filter on
    ``row_number`` lets Spark insert a partial ``WindowGroupLimit`` before the
    shuffle, so at most ``n`` rows per key leave each map task.
    """
    w = Window.partitionBy(key).orderBy(F.col("game_date").desc(), F.col("game_id").desc())
    return (rows.withColumn("row_num", F.row_number().over(w))
                .where(F.col("row_num") <= n))


def recent_arrays(recent: DataFrame, stat: str, key: str = "player_id") -> DataFrame:
    """Seven arrays in row-number order plus the latest game id and result.

    Structs are collected (not bare values) because ``collect_list`` drops
    nulls; a null stat inside the struct keeps the arrays parallel (N13).
    """
    item = F.struct(
        F.col("row_num"), F.col("game_id"), F.col(stat).alias("stat"),
        F.round(F.col("mins"), 2).alias("mins"), F.col("team_won"),
        F.date_format("game_date", "yyyy-MM-dd").alias("game_date"),
        F.col("game_time"), F.col("tz"), lat_lng("lat", "lng").alias("latlng"))
    items = F.array_sort(F.collect_list(item))
    return (recent.groupBy(key)
            .agg(items.alias("_r"))
            .select(
                key,
                F.col("_r")[0]["game_id"].alias("last_game_played_id"),
                F.col("_r")[0]["team_won"].alias("won_last_game_played"),
                F.col("_r.stat").alias("recent_of_stat"),
                F.col("_r.mins").alias("recent_mins"),
                F.col("_r.team_won").alias("recent_games_won"),
                F.col("_r.game_date").alias("recent_game_dates"),
                F.col("_r.game_time").alias("recent_game_times"),
                F.col("_r.tz").alias("recent_time_zones"),
                F.col("_r.latlng").alias("recent_latlng")))
