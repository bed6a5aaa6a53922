"""Table changes of the posting API, each a pure function returning the new table.

A sink writes the result as a new snapshot (``sources.tables.write_tables``);
nothing is edited in place, so a failed job leaves the old version intact and
a retried one writes the same rows (N15).  ``plans.stored`` applies the same rules
to the touched months of stored tables only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.dates import as_date, game_slug
from ..functions.text import blank_to_null
from ..operators.keys import assign_keys
from ..operators.mutate import append, apply_update, delete_matching, insert_ignore, only_record, set_where
from ..operators.pivot import unpivot_codes
from ..sources.ingest import PREDICTION_FIELDS, enrich_literals, ingest
from ..sources.tables import prune_months

ID_COLUMNS = {f"{name}_id": code for name, code in S.SOURCE_CODES.items()}


# ---- games -----------------------------------------------------------------

def insert_games(games: DataFrame, batch: DataFrame, order_col: str = "batch_seq") -> DataFrame:
    """Append posted games; ``game_id`` is generated after the stored maximum."""
    keyed = assign_keys(batch, games, "game_id", order_col).drop(order_col)
    return append(games, keyed)


def fill_game_slug(games: DataFrame) -> DataFrame:
    """``game_slug = 'YYYY-MM-DD_away_home'`` where it is null."""
    slug = game_slug("game_date", "away_team_id", "home_team_id")
    return set_where(games, F.col("game_slug").isNull(), {"game_slug": slug})


def load_games(games: DataFrame, batch: DataFrame, order_col: str = "batch_seq") -> DataFrame:
    """Insert, then fill slugs: one new table version instead of two writes."""
    return fill_game_slug(insert_games(games, batch, order_col))


def update_postgame(games: DataFrame, batch: DataFrame, order_col: str | None = "batch_seq") -> DataFrame:
    """Scores, inactive lists and attendance by game id, with the derived result.

    ``home_team_won`` is false on a tie or a missing score; ``over_under`` is
    'U' on a push or a missing total, since only ``>`` gives 'O' (N1).
    """
    home, away = F.col("u_home_team_pts"), F.col("u_away_team_pts")
    return apply_update(games, batch, ["game_id"], {
        "away_team_pts": away, "home_team_pts": home,
        "away_team_injured": "u_away_team_injured", "home_team_injured": "u_home_team_injured",
        "attendance": "u_attendance",
        "home_team_won": F.when(home > away, F.lit(True)).otherwise(F.lit(False)),
        "over_under": F.when(home + away > F.col("total_pred"), F.lit("O")).otherwise(F.lit("U")),
    }, order_col=order_col)


def update_spreads(games: DataFrame, batch: DataFrame, order_col: str | None = "batch_seq") -> DataFrame:
    return apply_update(games, batch, ["game_id"], {
        c: f"u_{c}" for c in ("home_spread", "total_pred", "away_pred_pts", "home_pred_pts")},
        order_col=order_col)


# ---- players ---------------------------------------------------------------

def insert_players(players: DataFrame, batch: DataFrame, order_col: str = "batch_seq") -> DataFrame:
    """Append full or incomplete player records; absent columns stay null and
    ``player_id`` is generated after the stored maximum in batch order."""
    keyed = assign_keys(batch, players, "player_id", order_col).drop(order_col)
    return append(players, keyed)


def update_player(players: DataFrame, batch: DataFrame, order_col: str | None = "batch_seq") -> DataFrame:
    """Team, depth, starter, inactive and status by player id."""
    return apply_update(players, batch, ["player_id"], {
        c: f"u_{c}" for c in ("current_depth_pos", "usual_depth_pos", "current_team", "is_starter",
                              "inactive", "status")}, order_col=order_col)


def mark_not_on_roster(players: DataFrame, player_ids: DataFrame) -> DataFrame:
    """Players in the id list: status NOT_ON_ROSTER, depths and team null,
    not starting, inactive.  The list is joined, not inlined, so it may be long."""
    flagged = player_ids.select("player_id").distinct().withColumn("_listed", F.lit(True))
    joined = players.join(flagged, "player_id", "left")
    out = set_where(joined, F.col("_listed"), {
        "status": F.lit(S.STATUS_NOT_ON_ROSTER), "current_depth_pos": F.lit(None),
        "usual_depth_pos": F.lit(None), "current_team": F.lit(None),
        "is_starter": F.lit(False), "inactive": F.lit(True)})
    return out.select(*players.columns)


def update_bio(players: DataFrame, batch: DataFrame, order_col: str | None = "batch_seq") -> DataFrame:
    """Biography fields by player id; the player becomes PENDING."""
    cols = ("bref_id", "height", "weight", "dob", "debut_date", "draft_pick", "games_played",
            "current_salary", "player_position")
    assign = {c: f"u_{c}" for c in cols}
    assign["status"] = F.lit(S.STATUS_PENDING)
    return apply_update(players, batch, ["player_id"], assign, order_col=order_col)


def update_source_ids(players: DataFrame, batch: DataFrame, order_col: str | None = "batch_seq") -> DataFrame:
    """All five external ids by player id; an empty or missing id becomes null."""
    return apply_update(players, batch, ["player_id"], {
        c: blank_to_null(F.col(f"u_{c}")) for c in ID_COLUMNS}, order_col=order_col)


def update_position(players: DataFrame, batch: DataFrame, order_col: str | None = "batch_seq") -> DataFrame:
    return apply_update(players, batch, ["player_id"], {"player_position": "u_player_position"},
                        order_col=order_col)


# ---- projections, stats, predictions, salaries -----------------------------

def insert_rows(base: DataFrame, batch: DataFrame) -> DataFrame:
    """Plain append of typed rows (projections, stats, salaries)."""
    return append(base, batch)


def fill_projection_roster(projections: DataFrame, players: DataFrame, games: DataFrame, date) -> DataFrame:
    """For games on ``date``: where team and depth are both null, copy the
    player's team, depth and starter flag (a player must exist to match).

    One pass over the projections: each row learns from its game whether it is of the
    date, and only rows to be filled carry a player key into the join.  A player id that
    ``players`` holds twice is an error.
    """
    on_date = (prune_months(games, as_date(date), as_date(date)).where(F.col("game_date") == as_date(date))
               .select("game_id", F.lit(True).alias("_on_date")))
    open_ = F.col("_on_date").isNotNull() & F.col("team_id").isNull() & F.col("depth_pos").isNull()
    todo = projections.join(on_date, "game_id", "left").withColumn("_fill", F.when(open_, F.col("player_id")))
    roster = only_record(players.select(F.col("player_id").alias("_fill"), F.col("current_team").alias("_team"),
                                        F.col("current_depth_pos").alias("_depth"), F.col("is_starter").alias("_starts")), ["_fill"])
    out = todo.join(roster.withColumn("_hit", F.lit(True)), "_fill", "left")
    put = {"team_id": "_team", "depth_pos": "_depth", "is_starter": "_starts"}
    return out.select(*[F.when(F.col("_hit"), F.col(put[c])).otherwise(F.col(c)).alias(c) if c in put else F.col(c)
                        for c in projections.columns])


def load_projections(projections: DataFrame, batch: DataFrame, players: DataFrame, games: DataFrame,
                     date) -> DataFrame:
    """Insert posted projections, then fill roster fields for the date."""
    return fill_projection_roster(append(projections, batch), players, games, date)


def insert_predictions(predictions: DataFrame, records: DataFrame, source: str, game_date, stat_type: str,
                       created=None) -> DataFrame:
    """Records ``{Scored Label, bref_id}`` of one request, with the request's
    source, date and stat type on each and ``created`` as the insert time
    (default: now, as the database default did)."""
    S.check_stat(stat_type)
    if created is None:
        created = F.current_timestamp()
    rows = prediction_rows(records, source, game_date, stat_type)[0]
    at = created if not isinstance(created, str) else F.lit(created).cast("timestamp")
    return append(predictions, rows.withColumn("created", at))


def prediction_rows(records: DataFrame, source: str, game_date, stat_type: str) -> tuple[DataFrame, DataFrame]:
    """The request's constants put on each record, then typed: (good, bad)."""
    posted = enrich_literals(records, predictionSrc=source, gameDate=str(game_date), statType=stat_type)
    return ingest(posted, PREDICTION_FIELDS)


# ---- pending external ids --------------------------------------------------

def insert_new_ids(new_ids: DataFrame, batch: DataFrame, order_col: str = "batch_seq") -> DataFrame:
    """Insert pending ids; an ``id`` already stored or seen earlier in the batch is skipped."""
    return insert_ignore(new_ids, batch.select(order_col, *new_ids.columns), ["id"], order_col)


def held_ids(players: DataFrame, player_ids: DataFrame | None = None) -> DataFrame:
    """(source_id, new_id) pairs that players already hold."""
    if player_ids is not None:
        players = players.join(player_ids.select("player_id").distinct(), "player_id", "left_semi")
    return unpivot_codes(players.select("player_id", *ID_COLUMNS), ["player_id"], ID_COLUMNS,
                         "source_id", "new_id")


def delete_source_ids(new_ids: DataFrame, players: DataFrame, player_ids: DataFrame | None = None) -> DataFrame:
    """Delete pending ids that the given players now hold, matched per source.

    The five ``source = k AND new_id IN (SELECT k_id ...)`` disjuncts become one
    anti-join on (source_id, new_id) against the unpivoted player ids.
    """
    return delete_matching(new_ids, held_ids(players, player_ids), ["source_id", "new_id"])


def resolve_source_ids(players: DataFrame, new_ids: DataFrame, batch: DataFrame,
                       order_col: str | None = "batch_seq") -> tuple[DataFrame, DataFrame]:
    """Set the players' ids, then drop the pending rows they now hold."""
    new_players = update_source_ids(players, batch, order_col)
    return new_players, delete_source_ids(new_ids, new_players, batch.select("player_id"))
