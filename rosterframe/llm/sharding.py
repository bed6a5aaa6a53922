"""Sharding by weighted rendezvous hashing.

Every shard gets a score for a record's key: -ln(u) / weight, where u in (0, 1) is made
of a digest of seed, shard and key.  The record goes to the shard of the least score.  The
scores of a shard don't depend on the other shards, so a new shard takes records only
into itself, and about as many as its share of the weights; a shard that goes gives
up only its own.  DataFrame functions only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterframe.llm.common import numbered

#: u has 52 bits, which a double holds exactly.
_DIGITS, _SPAN = 13, float(1 << 52)


def stable_key(column: Column) -> Column:
    """A key that is never null: a value's text behind "=", or "null"."""
    return F.coalesce(F.concat(F.lit("="), column.cast("string")), F.lit("null"))


def shard_of(key: Column, weights: Sequence[float], seed: str = "shard") -> Column:
    """The shard (int from 0) of a key that isn't null; ties go to the smallest number.
    A shard of weight 0 takes nothing."""
    if not any(w > 0 for w in weights) or any(w < 0 for w in weights):
        raise ValueError("weights must not be negative, and one must be positive")
    shards = F.array(*(F.struct(F.lit(i).alias("i"), F.lit(float(w)).alias("w")) for i, w in enumerate(weights) if w))

    def score(s: Column) -> Column:
        digest = F.md5(F.concat_ws("|", F.lit(seed), s["i"].cast("string"), key))
        u = (F.conv(F.substring(digest, 1, _DIGITS), 16, 10).cast("double") + 0.5) / _SPAN
        return F.struct((-F.log(u) / s["w"]).alias("score"), s["i"].alias("i"))

    return F.array_min(F.transform(shards, score))["i"]


def assign(docs: DataFrame, weights: Sequence[float], added: Sequence[float] = (1.0,), key_col: str = "doc_id",
           seed: str = "shard") -> DataFrame:
    """The columns of ``docs`` plus ``shard``, ``slot`` (place in the shard, gapless from 0)
    and ``grown_shard`` (the shard once shards of the weights ``added`` have joined).

    The key and the weights alone decide the shard.  Slots follow the key's digest.

    - Null key: a key like any other, so such rows share a shard.
    - Repeated keys share a shard; their slots are adjacent, in no defined order.
    - Other columns (nulls, empty and very long texts) are carried along.
    - Empty table: no rows.  An input column with the name of a new one is replaced.
    """
    new = ["shard", "slot", "grown_shard"]
    kept = [c for c in docs.columns if c.lower() not in new]
    # the input as one struct, so that no name can clash
    rows = docs.select(F.struct(*(docs[c] for c in kept)).alias("row"), stable_key(docs[key_col]).alias("key"))
    rows = rows.select("row", F.md5(F.concat_ws("|", F.lit(seed), "key")).alias("place"),
                       shard_of(F.col("key"), weights, seed).alias("shard"),
                       shard_of(F.col("key"), [*weights, *added], seed).alias("grown_shard"))
    return numbered(rows, [F.col("place")], "slot", group="shard").select("row.*", *new)


def write_shards(assigned: DataFrame, path: str) -> None:
    """One folder ``shard=<n>`` a shard, whose files are in the order of the slots.  A shard's
    rows are dealt to tasks by ranges of slots, so a large shard is written by many tasks."""
    (assigned.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
     .write.partitionBy("shard").parquet(path))


def oracle(shards: int, seed: str = "shard") -> str:
    """DuckDB SQL for the registered query: equal weights, one shard more, unique doc_ids.
    CRC-32 is folded over the bytes with a table made by its rule."""
    return f"""
WITH RECURSIVE crc(k, t) AS (
  SELECT 0, range(256) UNION ALL
  SELECT k + 1, list_transform(t, lambda v: CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END) FROM crc WHERE k < 8),
lut AS MATERIALIZED (SELECT t AS lut FROM crc WHERE k = 8),
sized AS (
  SELECT doc_id, coalesce(octet_length(encode(text)), 0) + 16 AS size,
         xor(list_reduce(list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: CAST('0x' || h AS BIGINT)),
                         lambda c, b: xor(c // 256, lut[(xor(c, b) % 256) + 1]), 4294967295), 4294967295) AS text_crc32,
         coalesce('=' || doc_id, 'null') AS key
  FROM documents, lut),
scored AS (
  SELECT doc_id, s.i, -ln((CAST(CAST('0x' || md5('{seed}|' || s.i || '|' || key)[:{_DIGITS}] AS BIGINT) AS DOUBLE) + 0.5) / {_SPAN}) AS score
  FROM sized, (SELECT unnest(range({shards + 1})) AS i) s),
chosen AS (
  SELECT doc_id, min_by(i, score) FILTER (i < {shards}) AS shard, min_by(i, score) AS grown FROM scored GROUP BY doc_id)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(text_crc32 AS BIGINT) AS text_crc32, 'key' AS law, CAST(shard AS INTEGER) AS shard,
       row_number() OVER (PARTITION BY shard ORDER BY md5('{seed}|' || key)) - 1 AS slot, CAST(grown AS INTEGER) AS grown_shard
FROM sized JOIN chosen USING (doc_id)"""
