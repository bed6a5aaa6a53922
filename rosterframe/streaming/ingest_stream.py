"""Continuous ingestion of posted batches with Structured Streaming.

The posting API receives record batches over time (box scores after each
game, projections each morning, salaries each slate).  A Spark deployment
lands each posted batch as a JSON file and lets a file stream type and append
it: the same field map and bad-row split as the batch path
(``sources.ingest``), exactly-once through the stream checkpoint, and the
rejected records written beside the table instead of dropped.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..plans.stored import insert_rows
from ..sources.ingest import CORRUPT, Field, ingest, raw_schema


def posted_stream(spark: SparkSession, landing: str, fields: Sequence[Field],
                  max_files_per_trigger: int | None = None) -> DataFrame:
    """A streaming DataFrame of raw posted records (all values as text)."""
    r = spark.readStream.schema(raw_schema(fields)).option("columnNameOfCorruptRecord", CORRUPT)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.json(landing)


def start_ingest(spark: SparkSession, landing: str, fields: Sequence[Field], table_path: str,
                 rejects_path: str, checkpoint: str, available_now: bool = False,
                 max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Type each micro-batch by ``fields``; land good rows under ``table_path``
    (Parquet) and bad records under ``rejects_path``.

    ``foreachBatch`` writes both outputs of a micro-batch into folders named by
    the query's id and the batch id, in overwrite mode: if the query dies after
    writing but before committing, the restart replays the same batch and rewrites
    the same folders, so no row is lost or doubled.  The query's id lives in the
    checkpoint; after a lost checkpoint a new query writes to new folders and
    overwrites nothing.  The micro-batch is read once and kept while it is written;
    ``max_files_per_trigger`` bounds it.  ``read_landed`` reads what has landed, for
    ``plans.stored.insert_rows`` to insert.
    """
    def land(good: DataFrame, run: str, batch_id: int) -> None:
        good.write.mode("overwrite").parquet(f"{table_path}/run={run}/batch={batch_id}")

    return _start(spark, landing, fields, land, rejects_path, checkpoint, available_now, max_files_per_trigger)


def start_insert(spark: SparkSession, landing: str, fields: Sequence[Field], root: str, name: str, rejects_path: str,
                 checkpoint: str, available_now: bool = False, max_files_per_trigger: int | None = None) -> StreamingQuery:
    """From posted files into the stored table ``root/name`` in one query.  The micro-batch's
    place in the query is its id in the table's ledger (``plans.stored.insert_rows``): one that
    died half-way is completed or done again, and one that is replayed inserts nothing."""
    def insert(good: DataFrame, run: str, batch_id: int) -> None:
        insert_rows(spark, root, name, good, batch_id=f"{run}/{batch_id}")

    return _start(spark, landing, fields, insert, rejects_path, checkpoint, available_now, max_files_per_trigger)


def _start(spark: SparkSession, landing: str, fields: Sequence[Field], put: Callable[[DataFrame, str, int], None],
           rejects_path: str, checkpoint: str, available_now: bool, max_files_per_trigger: int | None) -> StreamingQuery:
    def write(batch: DataFrame, batch_id: int) -> None:
        run = json.loads("".join(r.value for r in spark.read.text(f"{checkpoint}/metadata").collect()))["id"]
        kept = batch.persist()
        try:
            good, bad = ingest(kept, fields)
            put(good, run, batch_id)
            bad.write.mode("overwrite").json(f"{rejects_path}/run={run}/batch={batch_id}")
        finally:
            kept.unpersist()

    stream = posted_stream(spark, landing, fields, max_files_per_trigger)
    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()


def read_landed(spark: SparkSession, table_path: str) -> DataFrame:
    """All landed rows, without the folders' names as columns."""
    return spark.read.option("recursiveFileLookup", True).parquet(table_path)
