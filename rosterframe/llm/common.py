"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterframe.session import ensure_checkpoint_dir

#: A word, wherever a contract speaks of words: a run without ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet to the shared checkpoint folder and read it back.

    Cuts the lineage like a reliable checkpoint (the files outlive any executor) and
    gives the planner the true size, so that a later join is broadcast only if the
    table is measured below ``spark.sql.autoBroadcastJoinThreshold``."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def numbered(df: DataFrame, order: list[Column], name: str, group: str | None = None) -> DataFrame:
    """``df`` plus ``name``: each row's position from 0 in ``order`` (within ``group``, whose
    rows then lie together), without a window over the rows.

    Rows are range-partitioned on the order, with a last key that differs from row to row,
    so rows that tie are spread as well; the sorted rows are stored with their place
    in their partition, and a running sum over the partitions' counts (one row per partition
    and group) gives each partition its offset."""
    own = {c.lower() for c in df.columns}
    tie, part, at, off = (next(f"{x}{k}" for k in range(len(own) + 1) if f"{x}{k}" not in own) for x in ("tie", "part", "at", "off"))
    by = [*([F.col(group)] if group else []), *order, F.col(tie)]
    placed = materialize(
        df.withColumn(tie, F.monotonically_increasing_id())
        .repartitionByRange(shuffle_partitions(df.sparkSession), *by).sortWithinPartitions(*by).drop(tie)
        .withColumns({part: F.spark_partition_id(), at: F.monotonically_increasing_id()}), name)
    lot = [group] if group else []
    counts = placed.groupBy(*lot, part).agg(F.count("*").alias("rows"), F.min(at).alias("first"))
    before = F.sum("rows").over(Window.partitionBy(*lot).orderBy(part)) - F.col("rows") - F.col("first")
    offsets = materialize(counts.select(*(F.col(c).alias(f"{c}_") for c in [*lot, part]), before.alias(off)), "offsets")
    same_lot = F.col(part) == F.col(f"{part}_")
    if group:
        same_lot &= same(F.col(group), F.col(f"{group}_"))
    return placed.join(offsets, same_lot).select(*df.columns, (F.col(at) + F.col(off)).alias(name))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def same(a: Column, b: Column) -> Column:
    """Null-safe equality."""
    return a.eqNullSafe(b)


def row_parts(docs: DataFrame) -> list[Column]:
    """What to hash of a row so that different rows differ: Spark's hashes pass over nulls, so
    every column comes with whether it is null, and nested ones as JSON with their nulls."""
    nested = (T.ArrayType, T.MapType, T.StructType)
    values = [F.to_json(F.struct(docs[f.name]), {"ignoreNullFields": "false"}) if isinstance(f.dataType, nested) else docs[f.name]
              for f in docs.schema.fields]
    return [*values, *(docs[f.name].isNull() for f in docs.schema.fields)]


def total(df: DataFrame, column: str) -> int:
    """Sum of an integer column (one row to the driver)."""
    return df.agg(F.coalesce(F.sum(column), F.lit(0))).first()[0]
