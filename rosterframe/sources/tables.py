"""The nine league tables as one lazily-read bundle, and their Parquet store.

Date-keyed facts are stored by the month of their game (or of the change), so that
season windows and single dates prune whole folders.  The month is a property of the
store, not of a row: it is computed whenever rows are written or appended, and the
library's listings return the declared columns only.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, fields, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schema as S


@dataclass(frozen=True)
class Tables:
    games: DataFrame
    teams: DataFrame
    players: DataFrame
    player_changelog: DataFrame
    projections: DataFrame
    stats: DataFrame
    predictions: DataFrame
    salaries: DataFrame
    new_ids: DataFrame

    def with_(self, **changes: DataFrame) -> "Tables":
        return replace(self, **changes)

    def items(self):
        return [(f.name, getattr(self, f.name)) for f in fields(self)]


PARTITION_COLUMNS = {"games": "game_month", "predictions": "game_month", "salaries": "game_month",
                     "stats": "game_month", "projections": "game_month", "player_changelog": "change_month"}
DATE_COLUMNS = {"game_month": "game_date", "change_month": "changed_on"}
# Month of rows whose date isn't known when they are written (a box score or a
# projection that comes before its game).  Every pruned read includes it.
UNASSIGNED = "unassigned"
# Tasks for each core that file rows in place.
FILING_TASKS = 3


def month_of(date: Column) -> Column:
    """The month as text, cut off the date's own text: a formatter would cost more than the rest of filing a row."""
    return F.coalesce(F.substring_index(date.cast("date").cast("string"), "-", 2), F.lit(UNASSIGNED))


def partition_column(df: DataFrame) -> str | None:
    """The month column a stored table carries besides its declared ones."""
    return next((c for c in DATE_COLUMNS if c in df.columns), None)


def public(df: DataFrame) -> DataFrame:
    """The declared columns: what ``SELECT *`` on the table means."""
    part = partition_column(df)
    return df if part is None else df.drop(part)


def read_tables(spark: SparkSession, root: str, only: tuple[str, ...] | None = None) -> Tables:
    """Read ``root/<table>`` Parquet directories with their declared schemas
    (month-partitioned tables also carry their partition column)."""
    return Tables(**{name: read_table(spark, root, name) if only is None or name in only else None
                     for name in S.TABLE_SCHEMAS})


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    part = PARTITION_COLUMNS.get(name)
    extra = [] if part is None else [T.StructField(part, T.StringType())]
    return spark.read.schema(T.StructType([*S.TABLE_SCHEMAS[name].fields, *extra])).parquet(f"{root}/{name}")


def with_month(name: str, df: DataFrame, games: DataFrame | None = None) -> DataFrame:
    """``df`` with the month its rows belong to, computed afresh.  Box scores and
    projections take it from ``games``; without a known game it is UNASSIGNED."""
    part = PARTITION_COLUMNS.get(name)
    if part is None:
        return df
    df = public(df)
    if DATE_COLUMNS[part] in df.columns:
        return df.withColumn(part, month_of(F.col(DATE_COLUMNS[part])))
    if games is None:
        return df.withColumn(part, F.lit(UNASSIGNED))
    months = games.select("game_id", month_of(F.col("game_date")).alias(part))
    return df.join(months, "game_id", "left").select(*df.columns, F.coalesce(part, F.lit(UNASSIGNED)).alias(part))


def _refuse_own_input(df: DataFrame, path: str) -> None:
    """Writing over files that the rows are read from would destroy them."""
    jvm, conf = df.sparkSession._jvm, df.sparkSession._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(path)
    full = target.getFileSystem(conf).makeQualified(target).toUri().getPath().rstrip("/") + "/"
    for f in df.inputFiles():
        if jvm.org.apache.hadoop.fs.Path(f).toUri().getPath().startswith(full):
            raise ValueError(f"{path} is read by the rows to be written; write to another root")


def file_writer(df: DataFrame, mode: str):
    """Writer of stored files: written once and read often, so packed tighter than by default."""
    return df.write.mode(mode).option("compression", "zstd")


def _writer(df: DataFrame, name: str, mode: str):
    part = PARTITION_COLUMNS.get(name)
    if part is None:
        return file_writer(df, mode)
    # AQE splits the rebalanced partitions of a large month and joins those of small ones.
    return file_writer(df.hint("rebalance", F.col(part)), mode).partitionBy(part)


@contextmanager
def open_months(spark: SparkSession, n: int = 512) -> Iterator[None]:
    """Writes within keep a file open for each month that a task meets (beyond ``n`` they sort), so
    that rows are filed under their months without a sort that would spill."""
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key)
    spark.conf.set(key, str(n))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def file_in_place(df: DataFrame, part: str, path: str, mode: str = "overwrite") -> None:
    """Each task files its own rows under their months (column ``part``), without a shuffle.

    A task opens a file for every month that it meets.  So that files don't number tasks times months, and
    stay as small as tasks are, the rows come in few tasks: some for each core, or a share of the session's
    partitions where these are many."""
    spark = df.sparkSession
    tasks = max(FILING_TASKS * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")) // 16)
    with open_months(spark):
        file_writer(df.coalesce(tasks), mode).partitionBy(part).parquet(path)


def write_tables(tables: Tables, root: str, mode: str = "errorifexists", only: tuple[str, ...] | None = None,
                 in_place: tuple[str, ...] = ()) -> None:
    """Write every table (or ``only`` some) as a new snapshot under ``root``.  A root that
    any of the rows are read from is refused, in any mode.

    The rows of tables named in ``in_place`` are not shuffled: each task files its own under their
    months.  That is for a bulk load, where a task brings enough rows of each of its months; a month
    that such rows carry already is taken as theirs."""
    for name, df in tables.items():
        if only is None or name in only:
            _refuse_own_input(df, f"{root}/{name}")
            part = PARTITION_COLUMNS.get(name)
            if name in in_place and part is not None:
                month = [F.col(part)] if part in df.columns else [month_of(F.col(DATE_COLUMNS[part])).alias(part)]
                file_in_place(df.select(*S.TABLE_SCHEMAS[name].fieldNames(), *month), part, f"{root}/{name}", mode)
            else:
                _writer(with_month(name, df, tables.games), name, mode).parquet(f"{root}/{name}")


def stored_form(df: DataFrame, name: str, games: DataFrame | None = None) -> DataFrame:
    """The columns of a stored table in order, the month last."""
    return with_month(name, df, games).select(*S.TABLE_SCHEMAS[name].fieldNames(), *filter(None, [PARTITION_COLUMNS.get(name)]))


def write_rows(df: DataFrame, name: str, path: str, in_place: bool = False) -> None:
    """Rows in their stored form as a new folder, laid out like the table ``name``; ``in_place`` as
    in ``write_tables``."""
    part = PARTITION_COLUMNS.get(name)
    if in_place and part is not None:
        file_in_place(df, part, path)
    else:
        _writer(df, name, "overwrite").parquet(path)


def append_rows(df: DataFrame, name: str, root: str, games: DataFrame | None = None) -> None:
    """Append rows to a stored table; nothing stored is read or rewritten."""
    _writer(stored_form(df, name, games), name, "append").parquet(f"{root}/{name}")


def prune_months(df: DataFrame, lo=None, hi=None) -> DataFrame:
    """Add a month-partition predicate matching a date range, if ``df`` is a
    month-partitioned stored table; a no-op for any other DataFrame.

    ``lo``/``hi`` are date Columns (literals or foldable expressions), so the
    predicate folds to constants and prunes partitions at planning time.  Rows of
    unknown month are always included.
    """
    part = partition_column(df)
    if part is None or (lo is None and hi is None):
        return df
    cond = F.lit(True)
    if lo is not None:
        cond = cond & (F.col(part) >= F.date_format(lo, "yyyy-MM"))
    if hi is not None:
        cond = cond & (F.col(part) <= F.date_format(hi, "yyyy-MM"))
    return df.where(cond | (F.col(part) == UNASSIGNED))
