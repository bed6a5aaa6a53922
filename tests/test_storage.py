"""Stored tables: month partitions, pruning, and results equal to the binding."""

from __future__ import annotations

import datetime as dt
import re

import pytest
from conftest import SF001, rows

from rosterframe import schema as S
from rosterframe.functions.dates import as_date
from rosterframe.plans import mutations as M
from rosterframe.plans import queries as Q
from rosterframe.plans import stored as ST
from rosterframe.plans.backfill import ml_features_backfill
from rosterframe.plans.features import ml_features
from rosterframe.sources.binding import bind, materialize
from rosterframe.sources.sinks import csv_safe, write_csv, write_json
from rosterframe.sources.tables import prune_months, read_tables, write_tables


def test_materialized_tables_prune_and_match(spark, tmp_path):
    stored = materialize(spark, SF001, str(tmp_path / "league"))
    bound = bind(spark, SF001)
    f = lambda t: csv_safe(ml_features(t, "1998-11-18", "pts", "1998-01-01"))
    assert rows(f(stored)) == rows(f(bound))
    g = lambda t: csv_safe(Q.prediction_scores(t, "1998-11-18"))
    assert rows(g(stored)) == rows(g(bound))
    formatted = Q.games(stored, "1998-11-18")._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert re.search(r"PartitionFilters: \[.*game_month", formatted)
    feats = ml_features(stored, "1998-11-18", "pts", "1998-01-01")._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "change_month" in feats and "(game_month#" in feats       # changelog and facts pruned by month


def test_written_tables_round_trip(spark, tmp_path, small_tables):
    write_tables(small_tables, str(tmp_path / "t"))
    back = read_tables(spark, str(tmp_path / "t"))
    for name, df in small_tables.items():
        got = getattr(back, name).select(*df.columns)
        assert got.count() == df.count(), name
    write_json(small_tables.teams, str(tmp_path / "teams_json"))
    write_csv(small_tables.games.limit(5), str(tmp_path / "games_csv"))
    assert spark.read.json(str(tmp_path / "teams_json")).count() == small_tables.teams.count()
    csv = spark.read.option("header", True).csv(str(tmp_path / "games_csv"))
    assert csv.count() == 5 and "home_team_injured" in csv.columns


# ---- changes to stored tables ------------------------------------------------

def _explain(df):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("store") / "league")
    return root, materialize(spark, SF001, root)


def test_appended_rows_are_found_by_pruned_reads(spark, store):
    """A row inserted into a stored table is in every pruned read that asks for its date."""
    _, t = store
    day = "1998-11-18"
    before = Q.games(t, day).count()
    new = spark.createDataFrame([(1, dt.date(1998, 11, 18), "20:00", "Wednesday", 1, 2)],
                                "batch_seq long, game_date date, game_time_24_et string, day_of_week string, away_team_id int, home_team_id int")
    assert Q.games(t.with_(games=M.load_games(t.games, new)), day).count() == before + 1
    lo = as_date(day)
    rows_of = {"predictions": ("model_x", dt.date(1998, 11, 18), "pts", 1.0, "p1", dt.datetime(2018, 1, 1)),
               "salaries": (1, dt.date(1998, 11, 18), 5, "S")}
    for name, row in rows_of.items():
        base = getattr(t, name)
        out = M.insert_rows(base, spark.createDataFrame([row], S.TABLE_SCHEMAS[name]))
        assert prune_months(out, lo, lo).count() == prune_months(base, lo, lo).count() + 1, name
    for name in ("stats", "projections"):  # their game may not be known yet
        base = getattr(t, name)
        row = spark.createDataFrame([(999_999, 999_999)], "player_id long, game_id long")
        assert prune_months(M.insert_rows(base, row), lo, lo).where("player_id = 999999").count() == 1


def test_listings_hide_the_month(spark, store):
    _, t = store
    for fn, name in ((Q.stats, "stats"), (Q.projections, "projections"), (Q.players, "players")):
        assert fn(t).columns == S.TABLE_SCHEMAS[name].fieldNames()
    assert Q.players(t, 0).count() == 0 and Q.stats(t, 5).count() == 5
    assert Q.players(t).count() == t.players.count()


def test_writing_over_the_own_input_is_refused(spark, store):
    root, t = store
    n = t.teams.count()
    for mode in ("overwrite", "append"):
        with pytest.raises(ValueError, match="another root"):
            write_tables(t, root, mode)
    with pytest.raises(Exception, match="(?i)already exists"):
        write_tables(bind(spark, SF001), root)
    assert read_tables(spark, root).teams.count() == n


def test_a_large_month_is_written_by_many_tasks(spark, small_tables, tmp_path):
    """The rows of one month are split among files; small months share none of theirs with it."""
    hot = small_tables.games.limit(1).crossJoin(spark.range(200_000)).select(
        "id", *[c for c in small_tables.games.columns if c != "game_id"]).withColumnRenamed("id", "game_id")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        write_tables(small_tables.with_(games=hot.select(small_tables.games.columns)), str(tmp_path / "t"), only=("games",))
        write_tables(small_tables, str(tmp_path / "s"), only=("games",))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    month, = (tmp_path / "t" / "games").glob("game_month=*")
    assert len(list(month.glob("*.parquet"))) > 1
    files = [len(list(p.glob("*.parquet"))) for p in (tmp_path / "s" / "games").glob("game_month=*")]
    assert sum(files) <= 2 * len(files)


def test_updates_rewrite_only_the_touched_months(spark, tmp_path, small_tables):
    root = str(tmp_path / "league")
    write_tables(small_tables, root, only=("games", "players", "projections"))
    stamp = lambda name: {p: p.stat().st_mtime_ns for p in (tmp_path / "league" / name).rglob("*.parquet")}
    before = stamp("games")
    batch = spark.createDataFrame([(1, small_tables.games.agg({"game_id": "min"}).first()[0], 1.0, 2.0, 3.0, 4.0)],
                                  "batch_seq long, game_id long, home_spread double, total_pred double, away_pred_pts double, home_pred_pts double")
    ST.update_games(spark, root, batch, M.update_spreads)
    kept = {p for p, t in stamp("games").items() if before.get(p) == t}
    months = {p.parent.name for p in before}
    assert {p.parent.name for p in kept} == months - {p.parent.name for p in set(before) - kept} and len({p.parent.name for p in set(before) - kept}) == 1
    got = rows(csv_safe(read_tables(spark, root, only=("games",)).games.drop("game_month")))
    assert got == rows(csv_safe(M.update_spreads(small_tables.games, batch)))


def test_roster_fill_reads_projections_once_and_pruned(spark, store):
    _, t = store
    plan = _explain(M.fill_projection_roster(prune_months(t.projections, as_date("1998-11-18"), as_date("1998-11-18")),
                                             t.players, t.games, "1998-11-18"))
    scans = [x for x in plan.split("\n\n") if "/projections]" in x and "Scan parquet" in x]
    assert len(scans) == 1 and "PartitionFilters: [" in scans[0] and "game_month" in scans[0]


def test_backfill_of_a_range_prunes_every_fact(spark, store):
    _, t = store
    df = ml_features_backfill(t, "pts", lo="1998-11-10", hi="1998-11-20", cut_lineage=False)
    scans = [x for x in _explain(df).split("\n\n") if "Scan parquet" in x]
    for name in ("games", "stats", "projections", "player_changelog"):
        own = [x for x in scans if f"/{name}]" in x]
        assert own and all("PartitionFilters: [" in x and "_month" in x for x in own), name
    whole = ml_features_backfill(t, "pts", cut_lineage=False).where("as_of between '1998-11-10' and '1998-11-20'")
    assert rows(csv_safe(df)) == rows(csv_safe(whole))
    assert rows(csv_safe(ml_features_backfill(t, "pts", lo="1998-11-10", hi="1998-11-20"))) == rows(csv_safe(df))
