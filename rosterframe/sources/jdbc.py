"""Reading the league tables from the relational database they live in today.

Each table is read with ``spark.read.jdbc`` and cast to its declared schema,
so the rest of the library sees the same types as from Parquet.  Large tables
are split into parallel range reads on a numeric key (``partitioning``);
small ones are read in one task.  Arrays, dates and booleans arrive typed
from the driver; anything else is cast by name.

Not exercised against a live database in this repository (no server may be
started where it is tested); ``typed`` is tested on a DataFrame of the shape a
JDBC read returns.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema as S
from .tables import PARTITION_COLUMNS, Tables

# Source table names of the nine tables (fixed values of the stored schema).
SOURCE_TABLES = {
    "games": "nba_games", "teams": "nba_teams", "players": "nba_players",
    "player_changelog": "nba_player_changelog", "projections": "nba_projections", "stats": "nba_stats",
    "predictions": "nba_predictions", "salaries": "nba_salaries", "new_ids": "nba_new_ids",
}


def typed(df: DataFrame, name: str, tie_break: str | None = None) -> DataFrame:
    """Select the declared columns of table ``name`` and cast them to their types.

    Columns the source lacks become null, but for ``change_id``: changes made at the
    same time would have no order.  ``tie_break`` names the column that gives one.
    """
    if name == "player_changelog" and "change_id" not in df.columns:
        if tie_break is None or tie_break not in df.columns:
            raise ValueError("the changelog needs change_id, or a tie_break column that orders changes made at the same time")
        df = df.withColumn("change_id", F.col(tie_break))
    cols = []
    for f in S.TABLE_SCHEMAS[name].fields:
        c = F.col(f.name) if f.name in df.columns else F.lit(None)
        cols.append(c.cast(f.dataType).alias(f.name))
    return df.select(*cols)


def read_jdbc_tables(spark: SparkSession, url: str, properties: Mapping[str, str],
                     partitioning: Mapping[str, tuple[str, int, int, int]] | None = None,
                     names: Mapping[str, str] | None = None, tie_break: str | None = None) -> Tables:
    """Read the nine tables over JDBC.

    ``partitioning`` maps a table to ``(column, lower, upper, num_partitions)``
    for a parallel range read, e.g. ``{"stats": ("game_id", 1, 10**9, 400)}``.  The six
    fact tables need one: without bounds a table is read in one task.
    """
    partitioning = partitioning or {}
    missing = sorted(set(PARTITION_COLUMNS) - set(partitioning))
    if missing:
        raise ValueError(f"fact tables need read bounds: {missing}")
    names = {**SOURCE_TABLES, **(names or {})}
    out = {}
    for name in S.TABLE_SCHEMAS:
        opts = dict(properties)
        if name in partitioning:
            col, lo, hi, n = partitioning[name]
            df = spark.read.jdbc(url, names[name], column=col, lowerBound=lo, upperBound=hi,
                                 numPartitions=n, properties=opts)
        else:
            df = spark.read.jdbc(url, names[name], properties=opts)
        out[name] = typed(df, name, tie_break)
    return Tables(**out)


def write_jdbc_table(df: DataFrame, url: str, table: str, properties: Mapping[str, str], mode: str = "append",
                     num_partitions: int | None = None, batch_size: int = 10000) -> None:
    """Write a table version back over JDBC (``mode="overwrite"`` replaces it).

    ``num_partitions`` caps the concurrent connections (the service used at
    most ten); rows go in batches of ``batch_size`` per statement.
    """
    out = df if num_partitions is None else df.coalesce(num_partitions)
    (out.write.mode(mode).option("batchsize", batch_size)
     .jdbc(url, table, mode=mode, properties=dict(properties)))
