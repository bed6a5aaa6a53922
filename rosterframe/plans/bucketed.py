"""Tables without dates, stored by a hash bucket of their key.

Players and pending ids have no month to be stored under.  Each row lies in the folder of
its key's bucket instead, so a batch of a few keys reads and rewrites the buckets of those
keys and no other.  Changes go through the store's ledger: once for each batch id,
and whole even if a job dies.  The row-level rules are those of ``plans.mutations``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schema as S
from ..operators.mutate import dedupe_first
from ..sources.ledger import Ledger
from . import mutations as M

BUCKET = "key_bucket"
KEYS = {"players": "player_id", "new_ids": "id"}


def bucket_of(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def _buckets(ledger: Ledger, name: str) -> int:
    return ledger.note(f"buckets/{name}")["buckets"]


def _with_bucket(df: DataFrame, name: str, buckets: int) -> DataFrame:
    return df.select(*S.TABLE_SCHEMAS[name].fieldNames(), bucket_of(F.col(KEYS[name]), buckets).alias(BUCKET))


def _write(df: DataFrame, path: str) -> None:
    df.hint("rebalance", F.col(BUCKET)).write.mode("overwrite").partitionBy(BUCKET).parquet(path)


def write_bucketed(df: DataFrame, root: str, name: str, buckets: int = 64) -> None:
    """Store a whole table.  Its number of buckets is kept with it: as many as make a bucket
    some hundred MB."""
    _write(_with_bucket(df, name, buckets), f"{root}/{name}")
    Ledger(df.sparkSession, root).write_note(f"buckets/{name}", {"buckets": buckets})


def read_bucketed(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The stored rows with their bucket; ``select`` the declared columns for the table itself."""
    schema = T.StructType([*S.TABLE_SCHEMAS[name].fields, T.StructField(BUCKET, T.IntegerType())])
    return spark.read.schema(schema).parquet(f"{root}/{name}")


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return read_bucketed(spark, root, name).drop(BUCKET)


def _distinct_buckets(df: DataFrame) -> list[int]:
    """No longer than the list of buckets."""
    return sorted(r[0] for r in df.select(BUCKET).distinct().collect())


def _rewrite(spark: SparkSession, root: str, name: str, buckets: list[int], change: Callable[[DataFrame], DataFrame], batch_id: str | None) -> bool:
    ledger = Ledger(spark, root)
    if not buckets:
        return False
    n = _buckets(ledger, name)
    old = read_bucketed(spark, root, name).where(F.col(BUCKET).isin(buckets)).drop(BUCKET)
    return ledger.apply(name, batch_id or uuid.uuid4().hex, lambda: _with_bucket(change(old), name, n), _write,
                        replaces=[f"{BUCKET}={b}" for b in buckets])


def insert_players(spark: SparkSession, root: str, batch: DataFrame, order_col: str = "batch_seq", batch_id: str | None = None) -> bool:
    """Append players with generated ids.  The range of ids is reserved before the rows are
    numbered, so loads that run at the same time get different ones."""
    ledger = Ledger(spark, root)

    def rows() -> DataFrame:
        stored = table(spark, root, "players")
        keyed = M.assign_keys(batch, stored, "player_id", order_col, reserve=lambda n, last: ledger.reserve("players", n, last)).drop(order_col)
        return _with_bucket(M.append(stored.limit(0), keyed), "players", _buckets(ledger, "players"))

    return ledger.apply("players", batch_id or uuid.uuid4().hex, rows, _write)


def update_players(spark: SparkSession, root: str, batch: DataFrame, update: Callable[[DataFrame, DataFrame], DataFrame],
                   batch_id: str | None = None) -> bool:
    """Apply an update of ``plans.mutations`` whose batch has a ``player_id`` to the batch's buckets."""
    n = _buckets(Ledger(spark, root), "players")
    touched = _distinct_buckets(batch.select(bucket_of(F.col("player_id"), n).alias(BUCKET)))
    return _rewrite(spark, root, "players", touched, lambda old: update(old, batch), batch_id)


def insert_new_ids(spark: SparkSession, root: str, batch: DataFrame, order_col: str = "batch_seq", batch_id: str | None = None) -> bool:
    """Append the pending ids that are neither stored nor earlier in the batch.  Only the ids of
    the batch's buckets are read, and nothing is rewritten."""
    ledger = Ledger(spark, root)
    n = _buckets(ledger, "new_ids")

    def rows() -> DataFrame:
        first = _with_bucket(dedupe_first(batch.select(order_col, *S.NEW_IDS.fieldNames()), ["id"], order_col), "new_ids", n)
        touched = _distinct_buckets(first)
        stored = read_bucketed(spark, root, "new_ids").where(F.col(BUCKET).isin(touched)).select("id", BUCKET)
        return first.join(stored, ["id", BUCKET], "left_anti").select(*first.columns)

    return ledger.apply("new_ids", batch_id or uuid.uuid4().hex, rows, _write)


def delete_source_ids(spark: SparkSession, root: str, player_ids: DataFrame | None = None, batch_id: str | None = None) -> bool:
    """Delete pending ids that the stored players (of ``player_ids``) hold.  All pending ids are
    looked through, two columns of them; the buckets that lose a row are rewritten."""
    doomed = M.held_ids(table(spark, root, "players"), player_ids)
    hit = read_bucketed(spark, root, "new_ids").select("source_id", "new_id", BUCKET).join(doomed, ["source_id", "new_id"], "left_semi")
    return _rewrite(spark, root, "new_ids", _distinct_buckets(hit), lambda old: M.delete_matching(old, doomed, ["source_id", "new_id"]), batch_id)


def resolve_source_ids(spark: SparkSession, root: str, batch: DataFrame, order_col: str | None = "batch_seq", batch_id: str | None = None) -> None:
    """Set the players' external ids, then delete the pending rows that they now hold.  Under a
    ``batch_id`` a call that died between the two is completed by the next."""
    batch_id = batch_id or uuid.uuid4().hex
    update_players(spark, root, batch, lambda old, new: M.update_source_ids(old, new, order_col), f"{batch_id}/set")
    delete_source_ids(spark, root, batch.select("player_id"), f"{batch_id}/delete")
