"""When each logged change was in force, stored by month, for as-of lookups without a window.

A date asks for a player's latest change up to a midnight.  So of the changes that take effect at
one midnight only the last can ever be asked for, and a change is in force from its
midnight (``live_from``) until the next one's (``live_to``).  These spans are cut at the ends of
months and filed under each month they reach into: a date reads one folder, and no
two rows of a player hold the same midnight.  Spans behind the last filed month, most of them still
open, lie uncut in the folder ``open``, which every read includes.

A player has at most one row a day, however many changes are logged, and one a month at
least from the first change on.  A change of a wrong, early date is carried through all months since.

- Changes without a time were never in force.  Changes at the same time: the largest id counts.
- Players without an id are one player of their own, who meets nobody in a join.
- No changes: no rows; spans stored without rows are kept up like others.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schema as S
from ..sources.ledger import Ledger
from ..sources.tables import file_in_place, month_of, read_table

NAME, MONTH, OPEN = "changelog_validity", "valid_month", "open"
CHANGE = [c for c in S.PLAYER_CHANGELOG.fieldNames() if c != "player_id"]
SCHEMA = T.StructType([*S.PLAYER_CHANGELOG.fields, T.StructField("live_from", T.DateType()), T.StructField("live_to", T.DateType()),
                       T.StructField(MONTH, T.StringType())])


def _takes_effect(changed_on: Column) -> Column:
    """The first midnight that sees a change."""
    day = F.to_date(changed_on)
    return F.date_add(day, (changed_on > day.cast("timestamp")).cast("int"))


def spans(changes: DataFrame, first: dt.date, behind: dt.date) -> DataFrame:
    """The spans of ``changes`` in the months from ``first`` up to ``behind`` (both firsts of a
    month; ``behind`` is the one after the last filed month), and those from ``behind`` on."""
    start, end = F.lit(first), F.lit(behind)
    per_day = (changes.where(F.col("changed_on").isNotNull()).groupBy("player_id", _takes_effect(F.col("changed_on")).alias("effect"))
               .agg(F.max_by(F.struct(*CHANGE), F.struct("changed_on", "change_id")).alias("change")))
    until = F.lead("effect").over(Window.partitionBy("player_id").orderBy("effect"))
    lo, hi = F.greatest("effect", start), F.least(F.coalesce("until", end), end)
    filed = F.when(lo < hi, F.sequence(F.trunc(lo, "month"), F.trunc(F.date_sub(hi, 1), "month"), F.expr("interval 1 month")))
    rest = F.when(F.col("until").isNull() | (F.col("until") > end), F.array(end))
    none = F.array().cast("array<date>")
    cut = (per_day.withColumn("until", until)
           .withColumn("month", F.explode(F.concat(F.coalesce(filed, none), F.coalesce(rest, none)))))
    is_open, next_month = F.col("month") == end, F.add_months("month", 1)
    return cut.select("player_id", "change.*", F.greatest("effect", "month").alias("live_from"),
                      F.when(is_open, F.col("until")).otherwise(F.least(F.coalesce("until", next_month), next_month)).alias("live_to"),
                      F.when(is_open, F.lit(OPEN)).otherwise(month_of(F.col("month"))).alias(MONTH)).select(*SCHEMA.fieldNames())


def _month(day: dt.date) -> dt.date:
    return day.replace(day=1)


def _next(month: dt.date) -> dt.date:
    return _month(month + dt.timedelta(days=31))


def _reach(changes: DataFrame) -> tuple[dt.date, dt.date] | None:
    """The month of the first change and the month behind the last one that is not in the future."""
    effect = _takes_effect(F.col("changed_on"))
    first, last = changes.agg(F.min(effect), F.least(F.max(effect), F.current_date())).first()
    return None if first is None else (_month(first), _next(_month(max(first, last))))


def validity_of(changes: DataFrame) -> DataFrame:
    """The spans of a whole changelog."""
    reach = _reach(changes)
    return changes.sparkSession.createDataFrame([], SCHEMA) if reach is None else spans(changes, *reach)


# ---- lookups ---------------------------------------------------------------------

def _in_force(upto: Column) -> Column:
    return (F.col("live_from") <= upto) & (F.col("live_to").isNull() | (upto < F.col("live_to")))


def changelog_asof(validity: DataFrame, as_of: Column, season_start: Column, slack_days: int = 1) -> DataFrame:
    """``features.changelog_asof`` as a filter of one month's spans: no shuffle, no aggregate."""
    upto = F.date_add(as_of, slack_days)
    month = (F.col(MONTH) == month_of(upto)) | (F.col(MONTH) == OPEN)
    return validity.where(month & _in_force(upto) & (F.col("changed_on") >= season_start)).select("player_id", *CHANGE)


def between(validity: DataFrame, lo: Column | None, hi: Column | None, slack_days: int) -> DataFrame:
    """The spans that as-of dates from ``lo`` to ``hi`` (null: no bound) can ask for."""
    cond = F.lit(True)
    if lo is not None:
        cond = cond & (F.col(MONTH) >= month_of(F.date_add(lo, slack_days)))
    if hi is not None:
        cond = cond & (F.col(MONTH) <= month_of(F.date_add(hi, slack_days)))
    return validity.where(cond | (F.col(MONTH) == OPEN))


def asof_all(validity: DataFrame, asks: DataFrame, slack_days: int) -> DataFrame:
    """Each ask (player_id, as_of, season; distinct) with ``ch``, the change in force, null if there
    is none of its season.  Other columns of the asks come along.  A player and month have at most a month's days of asks and of
    spans, so no join key is hot."""
    kept = asks.columns
    asks = asks.withColumn("upto", F.date_add("as_of", slack_days)).withColumn(MONTH, month_of(F.col("upto")))
    span = F.struct(*CHANGE)

    def meet(left: DataFrame, right: DataFrame, keys: list[str], name: str) -> DataFrame:
        r = right.select(*(F.col(k).alias(f"_{k}") for k in keys), "live_from", "live_to", span.alias(name))
        on = _in_force(F.col("upto"))
        for k in keys:
            on = on & (F.col(k) == F.col(f"_{k}"))
        return left.join(r, on, "left").select(*left.columns, name)

    found = meet(asks, validity.where(F.col(MONTH) != OPEN), ["player_id", MONTH], "filed")
    found = meet(found, validity.where(F.col(MONTH) == OPEN), ["player_id"], "rest")
    ch = F.coalesce("filed", "rest")
    return found.select(*kept, F.when(ch["changed_on"] >= F.col("season"), ch).alias("ch"))


# ---- stored ----------------------------------------------------------------------

def read_validity(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(f"{root}/{NAME}")


def _write(df: DataFrame, path: str) -> None:
    """Each task files its players' spans under their months: a span reaches into many, and those rows
    are neither shuffled nor sorted once more."""
    file_in_place(df, MONTH, path)


def write_validity(spark: SparkSession, root: str) -> None:
    """Spans of the changelog stored under ``root``."""
    _write(validity_of(read_table(spark, root, "player_changelog")), f"{root}/{NAME}")


def renew(spark: SparkSession, root: str, files: list[str], change: str | None = None) -> bool:
    """Take newly stored changes into the spans, where spans are stored.  Only the months from the
    earliest new change on, and the spans behind them, are read and replaced; what was in force
    when they begin is filed in the first of them, so the changelog itself is not read."""
    ledger = Ledger(spark, root)
    if not files or not ledger.has_folder(NAME):
        return False
    new = spark.read.schema(S.PLAYER_CHANGELOG).parquet(*files)
    reach = _reach(new)
    if reach is None:
        return False
    stored = read_validity(spark, root)
    # every player has an open span, so the earliest begins where the filed months end
    earliest = stored.where(F.col(MONTH) == OPEN).agg(F.min("live_from")).first()[0]
    old_behind = reach[0] if earliest is None else _month(earliest)
    first, behind = min(reach[0], old_behind), max(reach[1], old_behind)
    # a change once: where it takes effect, or as what is in force when the first month begins
    begins = F.col("live_from") == _takes_effect(F.col("changed_on"))
    later = stored.where((F.col(MONTH) == OPEN) | (F.col(MONTH) == f"{first:%Y-%m}") | ((F.col(MONTH) > f"{first:%Y-%m}") & begins))
    folders, month = [f"{MONTH}={OPEN}"], first
    while month < old_behind:
        folders.append(f"{MONTH}={month:%Y-%m}")
        month = _next(month)
    fields = S.PLAYER_CHANGELOG.fieldNames()
    return ledger.apply(NAME, change or uuid.uuid4().hex, lambda: spans(later.select(*fields).unionByName(new.select(*fields)), first, behind),
                        _write, replaces=folders)
