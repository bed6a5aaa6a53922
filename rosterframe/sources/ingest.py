"""Typed ingestion of posted record batches.

A batch arrives as JSON objects whose keys follow the posting API (``gameId``,
``homePoints``, ...).  A field map names, in order, the record key, the table
column and the type.  ``ingest`` renames and casts in one ``select``; values
that do not parse are not passed on as nulls but split off with their record.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import parse_date


@dataclass(frozen=True)
class Field:
    key: str      # record key in the posted JSON
    column: str   # table column
    type: str     # string, int, long, double, bool, date, int_array


# --- fixed values: record keys of the posting API, in the order it lists them ---
GAME_FIELDS = [Field("gameDate", "game_date", "date"), Field("gameTime", "game_time_24_et", "string"),
               Field("dayOfWeek", "day_of_week", "string"), Field("awayTeamId", "away_team_id", "int"),
               Field("homeTeamId", "home_team_id", "int")]
POSTGAME_FIELDS = [Field("gameId", "game_id", "long"), Field("awayPoints", "away_team_pts", "int"),
                   Field("homePoints", "home_team_pts", "int"),
                   Field("awayTeamInactive", "away_team_injured", "int_array"),
                   Field("homeTeamInactive", "home_team_injured", "int_array"),
                   Field("attendance", "attendance", "int")]
SPREAD_FIELDS = [Field("gameId", "game_id", "long"), Field("homeSpread", "home_spread", "double"),
                 Field("total", "total_pred", "double"), Field("awayPredPts", "away_pred_pts", "double"),
                 Field("homePredPts", "home_pred_pts", "double")]
PLAYER_FIELDS = [Field("playerName", "player_name", "string"), Field("playerPosition", "player_position", "string"),
                 Field("team", "current_team", "int"), Field("rw_id", "rw_id", "string"),
                 Field("isStarting", "is_starter", "bool"), Field("inactive", "inactive", "bool"),
                 Field("depthPos", "usual_depth_pos", "int"), Field("currentDepth", "current_depth_pos", "int"),
                 Field("status", "status", "string"), Field("bref_id", "bref_id", "string"),
                 Field("birthdate", "dob", "date"), Field("debutDate", "debut_date", "date"),
                 Field("drafted", "draft_pick", "int"), Field("salary", "current_salary", "int"),
                 Field("height", "height", "int"), Field("weight", "weight", "int"),
                 Field("gamesPlayed", "games_played", "int")]
INCOMPLETE_PLAYER_FIELDS = [Field("playerName", "player_name", "string"), Field("team", "current_team", "int"),
                            Field("rw_id", "rw_id", "string"), Field("isStarting", "is_starter", "bool"),
                            Field("inactive", "inactive", "bool"), Field("depthPos", "usual_depth_pos", "int"),
                            Field("currentDepth", "current_depth_pos", "int"), Field("status", "status", "string")]
PROJECTION_FIELDS = [Field("playerId", "player_id", "long"), Field("gameId", "game_id", "long"),
                     Field("sourceId", "source_id", "int"),
                     *[Field(s, s, "double") for s in ("mins", "pts", "reb", "ast", "stl", "blk", "tpt", "tov")]]
STAT_FIELDS = [Field("playerId", "player_id", "long"), Field("gameId", "game_id", "long"),
               Field("teamId", "team_id", "int"), Field("mins", "mins", "double"),
               *[Field(s, s, "int") for s in ("pts", "reb", "ast", "stl", "blk", "tpt", "tov")]]
PREDICTION_FIELDS = [Field("predictionSrc", "source", "string"), Field("gameDate", "game_date", "date"),
                     Field("statType", "stat_type", "string"), Field("Scored Label", "prediction", "double"),
                     Field("bref_id", "player_bref_id", "string")]
SALARY_FIELDS = [Field("playerId", "player_id", "long"), Field("gameDate", "game_date", "date"),
                 Field("salary", "salary", "int"), Field("site", "site", "string")]
PLAYER_UPDATE_FIELDS = [Field("playerId", "player_id", "long"), Field("currentDepth", "current_depth_pos", "int"),
                        Field("depthPos", "usual_depth_pos", "int"), Field("team", "current_team", "int"),
                        Field("isStarting", "is_starter", "bool"), Field("inactive", "inactive", "bool"),
                        Field("status", "status", "string")]
PLAYER_BIO_FIELDS = [Field("playerId", "player_id", "long"), Field("brefId", "bref_id", "string"),
                     Field("height", "height", "int"), Field("weight", "weight", "int"), Field("birthdate", "dob", "date"),
                     Field("debutDate", "debut_date", "date"), Field("drafted", "draft_pick", "int"),
                     Field("gamesPlayed", "games_played", "int"), Field("salary", "current_salary", "int"),
                     Field("playerPosition", "player_position", "string")]
PLAYER_SOURCE_ID_FIELDS = [Field("playerId", "player_id", "long"),
                           *[Field(c, c, "string") for c in ("nf_id", "rw_id", "bm_id", "fp_id", "fc_id")]]
PLAYER_POSITION_FIELDS = [Field("playerId", "player_id", "long"), Field("playerPosition", "player_position", "string")]
NEW_ID_FIELDS = [Field("sourceId", "source_id", "int"), Field("playerId", "new_id", "string"),
                 Field("playerName", "player_name", "string"), Field("uniqueId", "id", "string")]
# -------------------------------------------------------------------------------

_SPARK_TYPES = {"string": "string", "int": "int", "long": "bigint", "double": "double", "bool": "boolean"}


def _typed(raw: Column, kind: str, source_type: T.DataType) -> Column:
    if kind == "date":
        if isinstance(source_type, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            return raw.cast("date")
        return parse_date(raw.cast("string"), strict=False)
    if kind == "int_array":
        return raw.try_cast("array<int>")
    if kind == "string":
        return raw.cast("string")
    return raw.try_cast(_SPARK_TYPES[kind])


@dataclass(frozen=True)
class _Checked:
    typed: list[Column]   # the table columns
    ok: Column            # every value that is present parses
    failed: Column        # the keys that don't
    record: Column        # the record as it came
    checks: dict[str, Column]


def _check(records: DataFrame, fields: Sequence[Field]) -> _Checked:
    types = {f.name: f.dataType for f in records.schema.fields}
    raw = {f.key: F.col(f"`{f.key}`") for f in fields}
    typed = {f.key: _typed(raw[f.key], f.type, types[f.key]) for f in fields}
    fine = {f.key: _survives(raw[f.key], typed[f.key], f.type) for f in fields}
    whole = {CORRUPT: F.col(CORRUPT).isNull()} if CORRUPT in records.columns else {}
    checks = {**fine, **whole}
    failed = F.array_compact(F.array(*[F.when(~check, F.lit(key)) for key, check in checks.items()]))
    text = F.to_json(F.struct(*[raw[f.key] for f in fields]))
    return _Checked([typed[f.key].alias(f.column) for f in fields], reduce(lambda a, b: a & b, checks.values()), failed,
                    F.coalesce(F.col(CORRUPT), text) if whole else text, checks)


def ingest(records: DataFrame, fields: Sequence[Field], keep: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Rename and type posted records by a field map.

    Returns ``(good, bad)``: ``good`` has the table columns (plus ``keep``
    columns such as a batch order); ``bad`` holds every record with a value
    that is present but does not parse, with the keys that failed.  The good
    path is one codegen'd projection and filter; the list of failed keys is
    only built for the rejected records.
    """
    c = _check(records, fields)
    kept = [F.col(f"`{k}`") for k in keep]
    good = records.where(c.ok).select(*kept, *c.typed)
    bad = records.where(~c.ok).select(*kept, c.failed.alias("failed_keys"), c.record.alias("record"))
    return good, bad


@dataclass(frozen=True)
class Landed:
    """A batch that was typed and written.  ``counts``: its records, those rejected, and for
    each key the records it failed in."""
    good: DataFrame
    bad: DataFrame
    records: int
    rejected: int
    failures: dict[str, int]


def land(records: DataFrame, fields: Sequence[Field], path: str, keep: Sequence[str] = ()) -> Landed:
    """``ingest`` in one pass: the batch is read, typed and written once, to two folders under
    ``path`` told apart by a flag, and counted on the way (``observe``).

    ``good`` and ``bad`` are those of ``ingest``, read back from what was written, so whatever
    works on them parses nothing again.  The job has one stage without a shuffle, whose
    counts take in each task once, also if a task runs again.  ``path`` is replaced, so a batch that
    died half-way is simply landed again.

    - A rejected record keeps none of its typed values, only its keys that failed and its text.
    - An empty batch gives two empty tables with their columns, and counts of zero.
    - The names ``failed_keys``, ``record`` and ``rejected`` belong to the landed form: a field map or ``keep``
      that has them is refused.
    """
    taken = {"failed_keys", "record", "rejected"} & {*keep, *(f.column for f in fields)}
    if taken:
        raise ValueError(f"names of the landed form: {sorted(taken)}")
    c = _check(records, fields)
    rows = records.select(*(F.col(f"`{k}`") for k in keep), (~c.ok).alias("rejected"), *(F.when(c.ok, t).alias(f.column) for t, f in zip(c.typed, fields)),
                          F.when(~c.ok, c.failed).alias("failed_keys"), F.when(~c.ok, c.record).alias("record"))
    seen = Observation()
    keys = list(c.checks)
    counts = [F.count_if(F.array_contains("failed_keys", k)).alias(f"key {i}") for i, k in enumerate(keys)]
    counted = rows.observe(seen, F.count(F.lit(1)).alias("records"), F.count_if("rejected").alias("rejected"), *counts)
    counted.write.mode("overwrite").partitionBy("rejected").parquet(path)
    found = seen.get
    back = records.sparkSession.read.schema(rows.schema).parquet(path)
    typed = [f.column for f in fields]
    return Landed(back.where(~F.col("rejected")).select(*keep, *typed), back.where("rejected").select(*keep, "failed_keys", "record"),
                  found["records"], found["rejected"], {k: found[f"key {i}"] for i, k in enumerate(keys)})


# Column in which the JSON reader leaves a line that is no record.
CORRUPT = "_corrupt_record"


def _survives(raw: Column, typed: Column, kind: str) -> Column:
    """A value that is present must have its type; of an array, every element."""
    if kind == "int_array":
        lost = F.size(F.filter(raw, lambda x: x.isNotNull())) != F.size(F.filter(typed, lambda x: x.isNotNull()))
        return raw.isNull() | (typed.isNotNull() & ~lost)
    return raw.isNull() | typed.isNotNull()


def raw_schema(fields: Sequence[Field]) -> T.StructType:
    """All-text read schema for a posted JSON batch (arrays as text arrays), with a
    place for malformed lines."""
    return T.StructType([T.StructField(f.key, T.ArrayType(T.StringType()) if f.type == "int_array"
                                       else T.StringType(), True) for f in fields]
                        + [T.StructField(CORRUPT, T.StringType(), True)])


def read_json_batch(spark: SparkSession, path: str, fields: Sequence[Field]) -> tuple[DataFrame, DataFrame]:
    """Read a posted JSON batch (one object per line) and type it by the field map.
    Lines that are no JSON object come back among the bad records."""
    return ingest(spark.read.schema(raw_schema(fields)).option("columnNameOfCorruptRecord", CORRUPT).json(path), fields)


def land_json_batch(spark: SparkSession, posted: str, fields: Sequence[Field], path: str) -> Landed:
    """A posted JSON batch (one object per line), read once and landed under ``path``."""
    return land(spark.read.schema(raw_schema(fields)).option("columnNameOfCorruptRecord", CORRUPT).json(posted), fields, path)


def enrich_literals(records: DataFrame, **values) -> DataFrame:
    """Put request-level constants (source, date, stat type) on every record."""
    return records.select("*", *[F.lit(v).alias(k) for k, v in values.items()])
