"""Season to date from monthly partials; months pruned by a table of dates."""

from __future__ import annotations

import datetime as dt

import pytest
from conftest import SF001, rows
from pyspark.sql import functions as F

from rosterframe import schema as S
from rosterframe.functions.dates import as_date
from rosterframe.operators import team as TM
from rosterframe.operators.history import history_rows, recent_arrays, recent_n
from rosterframe.plans import mutations as M
from rosterframe.plans import partials as P
from rosterframe.plans import stored as ST
from rosterframe.plans.registry import QUERIES  # noqa: F401  (imports registry_stored)
from rosterframe.plans import registry_stored as RS
from rosterframe.plans.backfill import ml_features_backfill
from rosterframe.plans.features import ml_features, season_window
from rosterframe.sources.binding import materialize
from rosterframe.sources.sinks import csv_safe
from rosterframe.sources.tables import public, read_table, read_tables


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("partials") / "league")
    t = materialize(spark, SF001, root)
    P.write_partials(spark, root)
    return root, t


def same(a, b):
    return sorted(map(str, a.collect())) == sorted(map(str, b.select(*a.columns).collect()))


def scans(df):
    text = df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    return [x for x in text.split("\n\n") if "Scan parquet" in x]


@pytest.mark.parametrize("start, day", [
    ("1998-01-01", "1998-11-18"),   # the rule: behind a first of a month
    ("1998-01-01", "1998-11-01"),   # the date's month is empty
    ("1998-01-01", "1998-01-20"),   # one month only
    ("1998-03-17", "1998-06-05"),   # a start within a month
    ("1998-03-31", "1998-06-05"),   # behind a last of a month
    ("1997-10-01", "1998-04-02")])  # across years
def test_equals_the_season(spark, store, start, day):
    root, t = store
    p, d, s0 = P.read_partials(spark, root), as_date(day), as_date(start)
    season = season_window(t.games, d, s0)
    assert rows(P.team_state(p, t.games, t.teams, d, s0)) == rows(TM.team_state(season, t.teams))
    players = t.players.select("player_id")
    for n, stat in ((10, "pts"), (3, "tov")):
        want = recent_arrays(recent_n(history_rows(t.stats, season, t.teams), n), stat)
        assert rows(csv_safe(P.recent(p, t, players, stat, n, d, s0))) == rows(csv_safe(want.join(players, "player_id", "left_semi")))
    if start in ("1998-01-01", "1998-03-17") and day > "1998-06":
        assert rows(csv_safe(ml_features(t, day, "pts", start, partials=p))) == rows(csv_safe(ml_features(t, day, "pts", start)))


def test_unstored_tables(small_tables):
    t = small_tables
    p = P.partials_of(t, kept=4)
    a = csv_safe(ml_features(t, "1998-11-18", "reb", "1998-01-01", n_recent=4))
    assert rows(csv_safe(ml_features(t, "1998-11-18", "reb", "1998-01-01", n_recent=4, partials=p))) == rows(a)
    with pytest.raises(ValueError):
        ml_features(t, "1998-11-18", "reb", "1998-01-01", n_recent=5, partials=p)


def test_a_date_reads_one_month_of_games(spark, store):
    root, t = store
    d, s0 = as_date("1998-11-18"), as_date("1998-01-01")
    p = P.read_partials(spark, root)
    for df in (P.team_state(p, t.games, t.teams, d, s0), P.recent(p, t, t.players.select("player_id"), "pts", 10, d, s0)):
        for table in ("games", "stats"):
            for scan in (x for x in scans(df) if f"/{table}]" in x):
                line = next(x for x in scan.split("\n") if x.startswith("PartitionFilters"))
                assert "1998-11" in line and "1998-01" not in line and "<" not in line and ">" not in line
        whole = [x for x in scans(df) if "_months]" in x]
        assert whole and all("PartitionFilters: [" in x and "1998-11" in x for x in whole)
    # no window over the season: the only box scores that are ranked are the open month's
    plan = P.recent(p, t, t.players.select("player_id"), "pts", 10, d, s0)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") <= 2


def test_changes_keep_partials_up(spark, tmp_path, small_tables):
    root = str(tmp_path / "league")
    t = materialize(spark, SF001, root)
    P.write_partials(spark, root)
    last = t.games.agg(F.max("game_id")).first()[0]
    some = [r[0] for r in t.games.where("home_team_won is null").select("game_id").limit(2).collect()]

    def check():
        p, now = P.read_partials(spark, root), read_tables(spark, root)
        fresh = P.partials_of(now)
        assert same(csv_safe(p.team_months), csv_safe(fresh.team_months))
        got, want = (x.player_months.select("player_id", "first_day", "game_month", F.array_sort("games").alias("g")) for x in (p, fresh))
        assert same(csv_safe(got), csv_safe(want))

    def box(*games):
        return spark.createDataFrame([(3, g, 1, 11.0, 5, 1, 1, 1, 1, 1, 1) for g in games], S.STATS)

    ST.insert_rows(spark, root, "stats", box(1, last + 1), batch_id="s")  # one waits for its game
    check()
    new = spark.createDataFrame([(1, dt.date(1998, 11, 1), "20:00", "Sunday", 1, 2), (2, dt.date(2031, 1, 5), "20:00", "Sunday", 3, 1)],
                                "batch_seq long, game_date date, game_time_24_et string, day_of_week string, away_team_id int, home_team_id int")
    for _ in range(2):
        ST.load_games(spark, root, new, batch_id="g")
        check()
    assert P.read_partials(spark, root).player_months.where("player_id = 3 and game_month = '1998-11' and first_day").count() == 1
    result = spark.createDataFrame([(1, g, 100, 101, None, None, 5000) for g in (*some, last + 2)],
                                   "batch_seq int, game_id long, away_team_pts int, home_team_pts int, away_team_injured array<int>, home_team_injured array<int>, attendance int")
    ST.update_games(spark, root, result, M.update_postgame)
    check()
    assert P.read_partials(spark, root).team_months.where("game_month = '2031-01' and wins = 1").count() == 1


def test_bulk_load_and_renewal_shuffle_no_row_for_its_month(spark, small_tables, monkeypatch):
    frame, hints = type(small_tables.games), []
    hint = frame.hint
    monkeypatch.setattr(frame, "hint", lambda self, name, *a: hints.append(name) or hint(self, name, *a))
    now, p = RS._kept_up(small_tables)
    assert "rebalance" not in hints
    assert rows(public(now.stats)) == rows(small_tables.stats)
    months = now.games.select("game_id", "game_month").join(now.stats.select("game_id", F.col("game_month").alias("m")), "game_id")
    assert months.where("m <> game_month").isEmpty()
    fresh = P.partials_of(now)
    assert same(csv_safe(p.team_months), csv_safe(fresh.team_months))
    got, want = (x.player_months.select("player_id", "first_day", "game_month", F.array_sort("games").alias("g")) for x in (p, fresh))
    assert same(csv_safe(got), csv_safe(want))


# ---- a table of dates --------------------------------------------------------------

def test_dates_prune_every_fact_while_the_job_runs(spark, store):
    _, t = store
    dates = spark.createDataFrame([(dt.date(1998, 11, 18),), (dt.date(1998, 11, 20),), (dt.date(1996, 2, 3),), (None,)], "d date")
    df = ml_features_backfill(t, "pts", dates=dates, cut_lineage=False)
    for name in ("games", "stats", "projections", "player_changelog"):
        own = [x for x in scans(df) if f"/{name}]" in x]
        assert own and all("dynamicpruning" in x and "_month" in x for x in own), name
    whole = csv_safe(ml_features_backfill(t, "pts", cut_lineage=False).where("as_of in ('1998-11-18', '1998-11-20', '1996-02-03')")).collect()
    assert sorted(map(str, csv_safe(df).collect())) == sorted(map(str, whole))
    later = csv_safe(ml_features_backfill(t, "pts", dates=dates, lo="1998-01-01")).collect()
    assert sorted(map(str, later)) == sorted(str(r) for r in whole if r.as_of >= "1998-01-01")


@pytest.mark.parametrize("bound, other", [({"lo": "1998-07-10"}, {"hi": "2030-01-01"}), ({"hi": "1998-11-20"}, {"lo": "1900-01-01"})])
def test_one_bound_alone(spark, store, bound, other):
    """As with both, the other one beyond every game."""
    _, t = store
    df = ml_features_backfill(t, "pts", cut_lineage=False, **bound)
    both = ml_features_backfill(t, "pts", cut_lineage=False, **bound, **other)
    got = sorted(map(str, csv_safe(df).collect()))
    assert got and got == sorted(map(str, csv_safe(both).collect()))
    for name in ("games", "stats", "projections", "player_changelog"):
        own = [x for x in scans(df) if f"/{name}]" in x]
        assert own and all("PartitionFilters: [" in x and "_month" in x for x in own), name
