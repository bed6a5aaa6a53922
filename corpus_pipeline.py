"""Corpus pipeline: documents -> packed training sequences.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; its
result is written as Parquet and read again as the next one's ``docs``.  All stages but
the last return the columns of their input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterframe.llm import line_dedup, mixing, packing, quality_rules, simhash
from rosterframe.llm.common import materialize, read
from rosterframe.llm.registry import MIX, SITE_LINES


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule or a certified rule of their language rejects go."""
    judged = quality_rules.judge(docs, read(spark, sf_dir, "labels"), max_false_rejection=0.05, delta=0.05)
    return judged.where("kept").select("row.*")


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines on over a tenth of a source's documents go; ``n_chars`` follows the text."""
    cut = line_dedup.drop_site_lines(docs, **SITE_LINES).select(docs.columns)
    if "n_chars" not in docs.columns:
        return cut
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return simhash.one_per_class(docs, shingle=4, max_distance=4, seed=42)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target weight asks, once at least."""
    return mixing.mix(docs, **MIX).select(docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 1024 tokens."""
    return packing.pack(docs, capacity=1024)


STAGES = [
    ("quality_rules", quality_stage),
    ("line_dedup", line_stage),
    ("simhash_dedup", simhash_stage),
    ("source_mixing", mixing_stage),
    ("best_fit_packing", packing_stage),
]

#: SimHash, tokenising and subset sums are not expressible in SQL;
#: tests/llm/test_pipeline.py holds run() against a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
