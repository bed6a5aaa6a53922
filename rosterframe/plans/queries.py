"""Listing and report queries (Q1-Q8 of the inventory)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.arith import fantasy_score, int_div
from ..functions.dates import as_date
from ..operators.pivot import complete_rows, pivot_codes
from ..sources.tables import Tables, prune_months

GAME_COLUMNS = ("game_id", "away_team_id", "home_team_id", "bref_slug")


def games(t: Tables, date_or_min=None, max_date=None) -> DataFrame:
    """Games on a date, in an inclusive range, or all; latest first (nulls first)."""
    g = t.games
    if date_or_min is not None and max_date is None:
        day = as_date(date_or_min)
        g = prune_months(g, day, day).where(F.col("game_date") == day)
    elif date_or_min is not None:
        lo, hi = as_date(date_or_min), as_date(max_date)
        g = prune_months(g, lo, hi).where(F.col("game_date").between(lo, hi))
    return g.orderBy(F.col("game_date").desc_nulls_first(), F.col("game_id")).select(*GAME_COLUMNS)


def _page(df: DataFrame, table: str, limit: int | None, *order: str) -> DataFrame:
    """The declared columns; with a limit the first rows in order (0 gives none).  Without one
    the order is the caller's: sorting a whole table moves every row of it."""
    rows = df.select(*S.TABLE_SCHEMAS[table].fieldNames())
    return rows if limit is None else rows.orderBy(*order).limit(limit)


def players(t: Tables, limit: int | None = None, status: str | None = None) -> DataFrame:
    """Players, optionally of one status; every one unless ``limit`` is given (the first by id)."""
    p = t.players
    if status is not None:
        p = p.where(F.col("status") == status)
    return _page(p, "players", limit, "player_id")


def projections(t: Tables, limit: int | None = None) -> DataFrame:
    return _page(t.projections, "projections", limit, "player_id", "game_id", "source_id")


def stats(t: Tables, limit: int | None = None) -> DataFrame:
    return _page(t.stats, "stats", limit, "player_id", "game_id")


def _ids_by_source(new_ids: DataFrame, suffix: str) -> DataFrame:
    codes = {f"{name}{suffix}": code for name, code in S.SOURCE_CODES.items()}
    return pivot_codes(new_ids, ["player_name"], "source_id", "new_id", codes)


def new_ids(t: Tables) -> DataFrame:
    """Pending external ids per player name, one column per source (``MAX`` of text)."""
    return _ids_by_source(t.new_ids, "_id").orderBy(F.col("player_name").asc_nulls_last())


def pending_source_ids(t: Tables) -> DataFrame:
    """The same listing under the short column names ``nf`` ... ``fc``."""
    return _ids_by_source(t.new_ids, "").orderBy(F.col("player_name").asc_nulls_last())


def pending_counts(t: Tables) -> DataFrame:
    """One row: player names with pending ids (a null name is one group) and
    incomplete players.  Two scalar subqueries, no join."""
    groups = t.new_ids.select("player_name").distinct().agg(F.count(F.lit(1)))
    return (t.players
            .agg(F.count_if(F.col("status") == S.STATUS_INCOMPLETE).alias("incomplete_players"))
            .select(groups.scalar().alias("new_source_id_players"), "incomplete_players"))


def prediction_scores(t: Tables, date=None, source: str = "model_a", created_after: str = "2017-03-01",
                      site: str | None = None) -> DataFrame:
    """Predicted against actual fantasy score, with value per thousand of salary.

    ``date=None`` scores every date in one job (the scale form); a date gives
    the single-date report.  Rows multiply by the player's games on the date
    and by salary sites unless ``site`` is given (N7).
    """
    day = None if date is None else as_date(date)
    pr = prune_months(t.predictions, day, day).where(
        (F.col("source") == source) & (F.col("created") > F.lit(created_after).cast("timestamp")))
    if day is not None:
        pr = pr.where(F.col("game_date") == day)
    wide = pivot_codes(pr, ["player_bref_id", "game_date", "source"], "stat_type", "prediction",
                       {s: s for s in S.STAT_TYPES})
    # tpt is pivoted but neither required nor scored.
    wide = complete_rows(wide, [s for s in S.STAT_TYPES if s != "tpt"])
    pl = t.players.select(F.col("bref_id").alias("player_bref_id"), "player_id", "player_position")
    games = prune_months(t.games, day, day).select("game_id", "game_date")
    act = (prune_months(t.stats, day, day).select("player_id", "game_id", "mins", *S.STAT_TYPES)
           .join(games, "game_id")
           .select("player_id", "game_date", "mins", *[F.col(s).alias(f"act_{s}") for s in S.STAT_TYPES]))
    sal = prune_months(t.salaries, day, day)
    sal = sal if site is None else sal.where(F.col("site") == site)
    pred_pts = fantasy_score()
    return (wide.join(pl, "player_bref_id")
            .join(act, ["player_id", "game_date"])
            .join(sal.select("player_id", "game_date", "salary"), ["player_id", "game_date"])
            .select("player_bref_id", "game_date", "player_position", "mins",
                    pred_pts.alias("pred_pts"),
                    (pred_pts / int_div("salary", F.lit(1000))).alias("value"),
                    fantasy_score("act_", exact=True).alias("actual_pts"),
                    "salary"))
