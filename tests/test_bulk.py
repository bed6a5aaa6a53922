"""Bulk loads: box scores evaluated once, rows filed under their months where they are."""

from __future__ import annotations

from conftest import SF001, rows
from pyspark.sql import functions as F

from rosterframe.plans.registry import QUERIES, Raw
from rosterframe.plans import registry_operators as RO  # after the registry, which imports it
from rosterframe.sources.binding import dated
from rosterframe.sources.tables import FILING_TASKS, PARTITION_COLUMNS, UNASSIGNED, month_of, public, read_table, write_tables

KEY = "spark.sql.maxConcurrentOutputFileWriters"


def test_rows_filed_in_place_are_those_of_a_shuffled_write(spark, tmp_path, small_tables):
    before = spark.conf.get(KEY)
    t, root = dated(small_tables, str(tmp_path / "box_scores")), str(tmp_path / "t")
    names = ("stats", "projections", "salaries")
    write_tables(t, f"{root}/here", only=names, in_place=tuple(PARTITION_COLUMNS))
    write_tables(small_tables, f"{root}/dealt", only=names)
    assert spark.conf.get(KEY) == before
    for name in names:
        here, dealt = (read_table(spark, f"{root}/{x}", name) for x in ("here", "dealt"))
        assert here.exceptAll(dealt).isEmpty() and dealt.exceptAll(here).isEmpty(), name
        assert public(here).columns == getattr(small_tables, name).columns


def test_files_do_not_number_tasks_times_months(spark, tmp_path, small_tables):
    """Many small tasks file their rows together; the rows are the same."""
    many = 10 * FILING_TASKS * spark.sparkContext.defaultParallelism
    year = small_tables.player_changelog.where(F.year("changed_on") == 1998)
    t = small_tables.with_(player_changelog=year.repartition(many))
    write_tables(t, str(tmp_path), only=("player_changelog",), in_place=tuple(PARTITION_COLUMNS))
    back = read_table(spark, str(tmp_path), "player_changelog")
    tasks = {f.rsplit("part-", 1)[1][:5] for f in back.inputFiles()}
    assert 0 < len(tasks) <= FILING_TASKS * spark.sparkContext.defaultParallelism
    assert rows(public(back)) == rows(year)


def test_month_of_any_date(spark):
    days = spark.createDataFrame([("1998-01-31",), ("0987-12-01",), ("9999-12-31",), (None,)], "d string").select(F.col("d").cast("date").alias("d"))
    got = [tuple(r) for r in days.select(month_of(F.col("d")), month_of(F.col("d").cast("timestamp")), F.date_format("d", "yyyy-MM")).collect()]
    assert got == [(m, m, m) for m in ("1998-01", "0987-12", "9999-12")] + [(UNASSIGNED, UNASSIGNED, None)]


def test_dates_are_joined_before_projections_are_made(spark):
    plan = QUERIES["m_insert_projections"](spark, SF001)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate") < plan.index("Join")


def test_parts_of_a_pivot_grow_with_the_input(spark, small_tables, monkeypatch):
    raw = Raw(spark, SF001)
    n = raw("lineitem").count()
    monkeypatch.setattr(RO, "PIVOT_ROWS", n // 30)
    facts = RO._pivot_input(small_tables, raw)
    assert facts.rdd.getNumPartitions() >= 30
    assert rows(facts) == rows(small_tables.projections)


def test_parts_of_a_pivot_are_not_joined_again(spark, small_tables):
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    raw = Raw(spark, SF001)
    assert RO._pivot_input(small_tables, raw).rdd.getNumPartitions() == parts
    assert RO._op_complete_pivot(small_tables, raw).rdd.getNumPartitions() == parts
