"""Generated keys for inserted rows (what a database sequence gives).

``key = max(stored key) + position of the row in batch order``.  The position
is computed without moving the batch to one task: the batch is range-sorted,
each partition counts its rows, and a running sum over the (few) partition
counts gives every partition its offset.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpoint


def assign_keys(batch: DataFrame, base: DataFrame, key: str, order_col: str,
                reserve: Callable[[int, int], int] | None = None) -> DataFrame:
    """Add ``key`` = max(base.key) + 1, 2, ... in ``order_col`` order.  ``reserve(n, max)`` reserves
    n keys for this batch alone and gives the one before the first (``sources.ledger``).

    ``order_col`` must be unique within the batch.  The sorted, tagged batch is
    checkpointed so a recomputed task cannot renumber rows.
    """
    tagged = checkpoint(batch.orderBy(order_col)
                        .withColumn("_pid", F.spark_partition_id())
                        .withColumn("_mono", F.monotonically_increasing_id()))
    # One row per partition: a size bounded by the partition count.
    counts = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select("_pid", F.coalesce(
        F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0)).alias("_off"))
    largest = base.agg(F.coalesce(F.max(key), F.lit(0)).cast("bigint"))
    start = F.lit(reserve(tagged.count(), largest.first()[0])) if reserve else largest.scalar()
    # monotonically_increasing_id = partition index << 33 | row number in partition.
    pos = F.col("_mono") - F.shiftleft(F.col("_pid").cast("bigint"), 33)
    return (tagged.join(F.broadcast(offsets), "_pid")
            .withColumn(key, (start + F.col("_off") + pos + 1).cast("bigint"))
            .drop("_pid", "_mono", "_off"))
