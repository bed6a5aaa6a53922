"""Spans of changes in force: against the aggregate over the changelog, kept up by inserts."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from rosterframe import schema as S
from rosterframe.functions.dates import as_date
from rosterframe.plans import features as FE
from rosterframe.plans import stored as ST
from rosterframe.plans import validity as V
from rosterframe.plans.backfill import _changes_asof, ml_features_backfill
from rosterframe.sources.sinks import csv_safe
from rosterframe.sources.tables import read_table, read_tables, write_tables

ASKED = ["1997-01-01", "1998-01-30", "1998-01-31", "1998-02-14", "1998-02-27", "1998-02-28", "1998-05-06", "1998-12-31", "2001-03-03", "2400-01-01"]


def changes(spark, seed, n, lo="1998-01-05", days=140, first_id=1):
    """Changes of few players, many at midnights, at one time or on one day; some without a time or a player."""
    rng, out = random.Random(seed), []
    for i in range(n):
        at = dt.datetime.fromisoformat(lo) + dt.timedelta(days=rng.randrange(days), seconds=rng.choice([0, 0, 1, 43_200, 86_399]))
        out.append((rng.choice([1, 1, 1, 1, 2, 3, None]), None if rng.random() < 0.05 else at, first_id + i, i % 7, i % 5, rng.choice("GFC"),
                    rng.choice([1, 2, None]), rng.choice([True, False, None]), i, i % 82, "ACTIVE", False))
    return spark.createDataFrame(out, S.PLAYER_CHANGELOG)


def disjoint(spans):
    """No midnight in two spans of a player."""
    live = [(r.player_id, r.live_from, r.live_to or dt.date.max) for r in spans.collect()]
    assert all(a < b for _, a, b in live)
    ordered = sorted(live, key=lambda x: (str(x[0]), x[1]))
    assert all(x[0] != y[0] or x[2] <= y[1] for x, y in zip(ordered, ordered[1:]))


def same_answers(spans, changelog, starts=("1900-01-01", "1998-02-01")):
    for day in ASKED:
        for start in starts:
            for slack in (0, 1):
                want = FE.changelog_asof(changelog, as_date(day), as_date(start), slack)
                got = V.changelog_asof(spans, as_date(day), as_date(start), slack)
                assert sorted(map(str, got.collect())) == sorted(map(str, want.select(*got.columns).collect())), (day, start, slack)


@pytest.fixture(scope="module")
def log(spark):
    # a hot player, and changes years behind the others, one of them in the future
    far = changes(spark, 2, 2, "2000-06-01", 1, 5000).unionByName(changes(spark, 3, 2, "2390-06-01", 1, 6000))
    return changes(spark, 1, 400).unionByName(far).coalesce(2).cache()


def test_equals_the_aggregate(spark, log):
    spans = V.validity_of(log).cache()
    disjoint(spans)
    same_answers(spans, log)
    assert spans.where("valid_month > '2000-06' and valid_month != 'open'").isEmpty() is False  # filed up to today
    assert spans.where("valid_month >= '2300' and valid_month != 'open'").isEmpty()             # never beyond


def test_every_ask_at_once(spark, log):
    asks = spark.createDataFrame([(p, dt.date.fromisoformat(d), dt.date.fromisoformat(s)) for p in (1, 2, 3, 9) for d in ASKED
                                  for s in ("1900-01-01", "1998-02-01")], "player_id long, as_of date, season date")
    want = _changes_asof(log, asks, 1).select("player_id", "as_of", "season", "ch.change_id")
    got = V.asof_all(V.validity_of(log), asks, 1).select("player_id", "as_of", "season", "ch.change_id")
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and got.count() == 80


def test_empty_and_timeless(spark):
    none = changes(spark, 1, 1).limit(0)
    timeless = changes(spark, 1, 3).withColumn("changed_on", F.lit(None).cast("timestamp"))
    for log in (none, timeless):
        spans = V.validity_of(log)
        assert spans.schema.simpleString() == V.SCHEMA.simpleString() and spans.isEmpty()
        assert V.changelog_asof(spans, as_date("1998-01-01"), as_date("1997-01-01")).isEmpty()


@pytest.mark.parametrize("order", [(0, 1, 2, 3), (3, 1, 0, 2), (2, 3, 1, 0)])
def test_kept_up_by_inserts(spark, small_tables, tmp_path, order):
    """Batches in any order, one of them empty, each posted twice; at first nothing is stored."""
    parts = [changes(spark, 10, 60, days=60), changes(spark, 11, 40, "1998-04-01", 30, 1000),
             changes(spark, 12, 5, "1999-12-20", 40, 2000), changes(spark, 13, 1, first_id=3000).limit(0)]
    root = str(tmp_path / "league")
    write_tables(small_tables.with_(player_changelog=parts[0].limit(0)), root, only=("player_changelog",))
    V.write_validity(spark, root)
    for k in order:
        for _ in range(2):
            ST.insert_rows(spark, root, "player_changelog", parts[k], batch_id=f"part {k}")
    log, spans = read_table(spark, root, "player_changelog").drop("change_month"), V.read_validity(spark, root)
    assert log.count() == 105
    disjoint(spans)
    same_answers(spans, log, ("1900-01-01",))
    fresh = V.validity_of(log)
    assert rows(csv_safe(spans).select("player_id", "change_id", "live_from", "valid_month").na.fill(-1)) == \
        rows(csv_safe(fresh).select("player_id", "change_id", "live_from", "valid_month").na.fill(-1))


def test_untouched_months_and_one_folder_read(spark, small_tables, tmp_path):
    root = str(tmp_path / "league")
    write_tables(small_tables.with_(player_changelog=changes(spark, 20, 80)), root, only=("player_changelog",))
    V.write_validity(spark, root)

    def early():
        return {f for f in V.read_validity(spark, root).inputFiles() if any(f"valid_month=1998-0{m}" in f for m in (1, 2, 3, 4))}

    old = early()
    ST.insert_rows(spark, root, "player_changelog", changes(spark, 21, 5, "1998-05-02", 20, 1000))
    spans = V.read_validity(spark, root)
    assert len(old) >= 4 and old == early()
    df = V.changelog_asof(spans, as_date("1998-05-10"), as_date("1998-01-01"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Aggregate" not in plan and "Window" not in plan
    assert "PartitionFilters: [((valid_month" in plan


def test_backfill_reads_spans_of_its_dates(spark, small_tables, tmp_path):
    root = str(tmp_path / "league")
    write_tables(small_tables, root)
    V.write_validity(spark, root)
    t, spans = read_tables(spark, root), V.read_validity(spark, root)
    dates = spark.createDataFrame([(dt.date(1998, 11, 18),), (dt.date(1998, 1, 31),), (None,)], "d date")
    for cut in ({"dates": dates}, {"lo": "1998-11-01", "hi": "1998-11-30"}, {"lo": "1998-12-31"}):
        got = ml_features_backfill(t, "pts", validity=spans, cut_lineage=False, **cut)
        want = ml_features_backfill(t, "pts", cut_lineage=False, **cut)
        assert sorted(map(str, csv_safe(got).collect())) == sorted(map(str, csv_safe(want).collect()))
        text = got._jdf.queryExecution().executedPlan().toString()
        assert "/player_changelog]" not in text
        assert "dates" not in cut or "dynamicpruning" in text
