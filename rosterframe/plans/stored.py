"""Changes to stored tables that touch only what they must.

Inserts add files, exactly once for each batch id (``sources.ledger``).  Updates find the months of their rows (a list no longer than
the months stored), rewrite those and leave the rest.  The row-level rules are those of
``plans.mutations``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.dates import as_date
from ..sources.ledger import Ledger
from ..sources.tables import PARTITION_COLUMNS, UNASSIGNED, public, read_table, stored_form, write_rows
from . import mutations as M
from . import validity as V
from .partials import renew


LATE_TABLES = ("stats", "projections")


def _month_column(name: str) -> str:
    return PARTITION_COLUMNS[name]


def _months(files: list[str]) -> set[str]:
    """The months in whose folders files lie."""
    return {folder.split("=", 1)[1] for f in files for folder in f.split("/") if folder.startswith("game_month=")}


def load_games(spark: SparkSession, root: str, batch: DataFrame, order_col: str = "batch_seq", batch_id: str | None = None) -> None:
    """Insert posted games with generated ids and slugs, and file the box scores and
    projections that were posted before them under their months.

    A ``batch_id`` that was loaded before loads nothing again; a load that died is completed."""
    ledger, batch_id = Ledger(spark, root), batch_id or uuid.uuid4().hex

    def keyed() -> DataFrame:
        stored = public(read_table(spark, root, "games"))
        rows = M.assign_keys(batch, stored, "game_id", order_col, reserve=lambda n, last: ledger.reserve("games", n, last)).drop(order_col)
        return stored_form(M.fill_game_slug(M.append(stored.limit(0), rows)), "games")

    ledger.apply("games", batch_id, keyed, lambda df, path: write_rows(df, "games", path))
    files = ledger.files("games", batch_id)
    if files:
        new = spark.read.schema(S.GAMES).option("basePath", f"{root}/games").parquet(*files)
        for name in LATE_TABLES:
            file_late_rows(spark, root, name, new, f"{batch_id}/late")
        renew(spark, root, _months(files), f"games/{batch_id}")


def file_late_rows(spark: SparkSession, root: str, name: str, games: DataFrame, batch_id: str | None = None) -> bool:
    """Move the waiting rows of ``games`` (of all stored games, if need be) to their months.
    Only the folder of waiting rows is read and replaced; the rest of it keeps waiting.
    False if there is nothing to move."""
    ledger, part = Ledger(spark, root), _month_column(name)
    if not ledger.has_files(f"{name}/{part}={UNASSIGNED}"):
        return False
    waiting = read_table(spark, root, name).where(F.col(part) == UNASSIGNED)
    known = games.where(F.col("game_date").isNotNull())
    # the ids that wait, once each: the rows themselves are not shuffled for this
    if known.select("game_id").join(waiting.select("game_id").distinct(), "game_id", "left_semi").isEmpty():
        return False
    return ledger.apply(name, batch_id or uuid.uuid4().hex, lambda: stored_form(waiting, name, known),
                        lambda df, path: write_rows(df, name, path), replaces=[f"{part}={UNASSIGNED}"])


def insert_rows(spark: SparkSession, root: str, name: str, batch: DataFrame, batch_id: str | None = None, in_place: bool = False) -> bool:
    """Insert typed rows of a fact table; months of box scores and projections come
    from the stored games.  With a ``batch_id`` the batch is inserted once, however
    often and after whatever failure it is posted again; False if it was inserted before.
    ``in_place`` is for a bulk batch that lies by month (``tables.write_tables``)."""

    def rows() -> DataFrame:
        empty = public(read_table(spark, root, name)).limit(0)
        return stored_form(M.append(empty, batch), name, read_table(spark, root, "games") if name in LATE_TABLES else None)

    ledger, batch_id = Ledger(spark, root), batch_id or uuid.uuid4().hex
    fresh = ledger.apply(name, batch_id, rows, lambda df, path: write_rows(df, name, path, in_place))
    if name == "stats":
        renew(spark, root, _months(ledger.files(name, batch_id)), f"stats/{batch_id}")
    if name == "player_changelog":
        V.renew(spark, root, ledger.files(name, batch_id), f"changes/{batch_id}")
    return fresh


def _rewrite(spark: SparkSession, root: str, name: str, change: str, months: list[str], rows: Callable[[], DataFrame]) -> bool:
    """Replace whole months of a table by ``rows()``, exactly once and all together."""
    part = _month_column(name)
    return Ledger(spark, root).apply(name, change, rows, lambda df, path: write_rows(df, name, path), replaces=[f"{part}={m}" for m in months])


def update_games(spark: SparkSession, root: str, batch: DataFrame, update: Callable[[DataFrame, DataFrame], DataFrame],
                 batch_id: str | None = None) -> bool:
    """Apply a games update (``M.update_postgame``, ``M.update_spreads``) to the months of the
    batch's games.  An update that dies leaves all months as they were, or is completed by the next
    change; a ``batch_id`` that was applied before changes nothing (False)."""
    batch_id = batch_id or uuid.uuid4().hex
    Ledger(spark, root).recover()  # before the stored files are listed
    games, part = read_table(spark, root, "games"), _month_column("games")
    touched = games.join(batch.select("game_id"), "game_id", "left_semi").select(part).distinct()
    months = [r[0] for r in touched.collect()]  # no longer than the list of months
    if not months:
        return False
    fresh = _rewrite(spark, root, "games", batch_id, months, lambda: update(games.where(F.col(part).isin(months)), batch))
    renew(spark, root, months, f"games/{batch_id}")
    return fresh


def fill_projection_roster(spark: SparkSession, root: str, date, batch_id: str | None = None) -> bool:
    """Fill the roster fields of a date's projections: their month is read and written, once.  Rows that
    waited for a game of that month are filed there first; what keeps waiting is not read."""
    Ledger(spark, root).recover()
    day = as_date(date)
    month = spark.range(1).select(F.date_format(day, "yyyy-MM")).first()[0]
    games = read_table(spark, root, "games").where(F.col(_month_column("games")) == month)
    file_late_rows(spark, root, "projections", games)
    projections = read_table(spark, root, "projections").where(F.col(_month_column("projections")) == month)
    if projections.isEmpty():
        return False
    return _rewrite(spark, root, "projections", batch_id or uuid.uuid4().hex, [month],
                    lambda: M.fill_projection_roster(projections, read_table(spark, root, "players"), games, date))
