"""Exactly-once changes: replays, writes that die at every step, late rows."""

from __future__ import annotations

import datetime as dt
import json
from pathlib import Path

import pytest
from conftest import rows
from pyspark.sql import functions as F

from rosterframe import schema as S
from rosterframe.plans import mutations as M
from rosterframe.plans import stored as ST
from rosterframe.sources.ingest import STAT_FIELDS
from rosterframe.sources.ledger import Ledger
from rosterframe.sources.tables import UNASSIGNED, public, read_table, stored_form, write_tables
from rosterframe.streaming.ingest_stream import start_insert

GAME = "batch_seq long, game_date date, game_time_24_et string, day_of_week string, away_team_id int, home_team_id int"


def stats(spark, *games, player=1):
    return spark.createDataFrame([(player, g, 1, 10.0, 5, 1, 1, 1, 1, 1, 1) for g in games], S.STATS)


@pytest.fixture()
def root(spark, tmp_path, small_tables):
    t = small_tables
    out = str(tmp_path / "league")
    few = t.games.where("game_id <= 30")
    write_tables(t.with_(games=few, stats=t.stats.where("game_id <= 30"), projections=t.projections.where("game_id <= 30"),
                         predictions=t.predictions.limit(50)), out, only=("games", "stats", "projections", "predictions"))
    return out


class Killed(Exception):
    pass


def die_at(monkeypatch, step):
    """The store's n-th file move never happens."""
    real, seen = Ledger._move, [0]

    def move(self, src, dst):
        seen[0] += 1
        if seen[0] == step:
            raise Killed
        real(self, src, dst)

    monkeypatch.setattr(Ledger, "_move", move)


def months(spark, root, name):
    return {r.game_month: r["count"] for r in read_table(spark, root, name).groupBy("game_month").count().collect()}


def test_a_replay_changes_nothing(spark, root):
    before = read_table(spark, root, "stats").count()
    assert ST.insert_rows(spark, root, "stats", stats(spark, 1, 2, 3), batch_id="b/1 %")
    assert not ST.insert_rows(spark, root, "stats", stats(spark, 1, 2, 3), batch_id="b/1 %")
    assert read_table(spark, root, "stats").count() == before + 3
    assert ST.insert_rows(spark, root, "stats", stats(spark, 1, 2, 3), batch_id="_b2")
    assert ST.insert_rows(spark, root, "stats", stats(spark, 1)) and ST.insert_rows(spark, root, "stats", stats(spark, 1))
    assert read_table(spark, root, "stats").count() == before + 8


@pytest.mark.parametrize("step", [1, 2, 3, 4])
def test_a_write_that_dies_is_done_once(spark, root, monkeypatch, step):
    """Steps: 1 the entry is logged, 2 and 3 two months' files are moved, 4 the change is marked as applied."""
    far = [r.game_id for r in read_table(spark, root, "games").groupBy("game_month").agg({"game_id": "min"}).toDF("m", "game_id").orderBy("m").limit(2).collect()]
    before = rows(read_table(spark, root, "stats"))
    batch = stats(spark, *far, player=77)
    with monkeypatch.context() as m:
        die_at(m, step)
        with pytest.raises(Killed):
            ST.insert_rows(spark, root, "stats", batch, batch_id="killed")
    if step > 1:  # decided: whoever comes next completes it
        ST.insert_rows(spark, root, "stats", stats(spark, 1), batch_id="other")
        assert read_table(spark, root, "stats").where("player_id = 77").count() == 2
        before = [*before, *rows(read_table(spark, root, "stats").where("player_id = 1 and game_id = 1 and mins = 10.0 and pts = 5"))]
    assert ST.insert_rows(spark, root, "stats", batch, batch_id="killed") == (step == 1)
    got = rows(read_table(spark, root, "stats"))
    assert len(got) == len(before) + 2 and read_table(spark, root, "stats").where("player_id = 77").count() == 2


def test_late_rows_move_to_their_month(spark, root):
    last = read_table(spark, root, "games").agg({"game_id": "max"}).first()[0]
    ST.insert_rows(spark, root, "stats", stats(spark, last + 1, last + 2, last + 99, player=5))
    assert months(spark, root, "stats")[UNASSIGNED] == 3
    before = months(spark, root, "stats")
    games = spark.createDataFrame([(1, dt.date(2031, 3, 1), "20:00", "Sat", 1, 2), (2, dt.date(2031, 4, 2), "20:00", "Wed", 2, 1)], GAME)
    ST.load_games(spark, root, games, batch_id="g")
    ST.load_games(spark, root, games, batch_id="g")
    got = months(spark, root, "stats")
    assert (got["2031-03"], got["2031-04"], got[UNASSIGNED]) == (1, 1, 1)
    assert {m: n for m, n in got.items() if m[:4] != "2031" and m != UNASSIGNED} == {m: n for m, n in before.items() if m != UNASSIGNED}
    ST.load_games(spark, root, spark.createDataFrame([], GAME), batch_id="none")
    assert months(spark, root, "stats") == got and read_table(spark, root, "games").where("game_id > " + str(last)).count() == 2
    assert not ST.file_late_rows(spark, root, "stats", read_table(spark, root, "games"))  # nothing to move
    assert not ST.file_late_rows(spark, root, "projections", read_table(spark, root, "games"))  # nothing waits


@pytest.mark.parametrize("step", range(1, 8))
def test_a_load_that_dies_files_late_rows_once(spark, root, monkeypatch, step):
    last = read_table(spark, root, "games").agg({"game_id": "max"}).first()[0]
    ST.insert_rows(spark, root, "stats", stats(spark, last + 1, last + 2, player=5))
    total = read_table(spark, root, "stats").count()
    games = spark.createDataFrame([(1, dt.date(2031, 3, 1), "20:00", "Sat", 1, 2)], GAME)
    with monkeypatch.context() as m:
        die_at(m, step)
        try:
            ST.load_games(spark, root, games, batch_id="g")
        except Killed:
            pass
    ST.load_games(spark, root, games, batch_id="g")
    got = months(spark, root, "stats")
    assert got["2031-03"] == 1 and got[UNASSIGNED] == 1 and sum(got.values()) == total
    assert read_table(spark, root, "games").where("game_date = '2031-03-01'").count() == 1


def test_stream_inserts_each_batch_once(spark, root, tmp_path, monkeypatch):
    landing, ck = tmp_path / "in", str(tmp_path / "ck")
    landing.mkdir()
    key = {f.column: f.key for f in STAT_FIELDS}
    good = {"player_id": "9", "game_id": "2", "team_id": "1", "mins": "10", "pts": "4", "reb": "1", "ast": "1", "stl": "1", "blk": "1", "tpt": "1", "tov": "1"}
    (landing / "a.json").write_text("\n".join(json.dumps({key[c]: v for c, v in (good | o).items()}) for o in ({}, {"game_id": "3"}, {"pts": "many"})))
    before = read_table(spark, root, "stats").count()
    args = (spark, str(landing), STAT_FIELDS, root, "stats", str(tmp_path / "bad"), ck, True)
    with monkeypatch.context() as m:
        die_at(m, 2)  # logged, not published, when the stream dies
        with pytest.raises(Exception, match="Killed"):
            start_insert(*args).awaitTermination()
    start_insert(*args).awaitTermination()
    (landing / "b.json").write_text(json.dumps({key[c]: v for c, v in (good | {"game_id": "4"}).items()}))
    start_insert(*args).awaitTermination()
    assert read_table(spark, root, "stats").count() == before + 3
    assert read_table(spark, root, "stats").where("player_id = 9").count() == 3
    assert spark.read.option("recursiveFileLookup", True).json(str(tmp_path / "bad")).count() == 1


# ---- updates -----------------------------------------------------------------------

def results(spark, root):
    """A result for two games in different months."""
    few = [r.game_id for r in read_table(spark, root, "games").groupBy("game_month").agg({"game_id": "min"}).toDF("m", "game_id").orderBy("m").limit(2).collect()]
    return few, spark.createDataFrame([(1, g, 100 + g, 101, None, None, 5000) for g in few],
                                      "batch_seq int, game_id long, away_team_pts int, home_team_pts int, away_team_injured array<int>, "
                                      "home_team_injured array<int>, attendance int")


@pytest.mark.parametrize("step", [1, 2, 3, 4])
def test_an_update_that_dies_is_done_wholly_or_not(spark, root, monkeypatch, step):
    """Steps: 1 the entry is logged, 2 and 3 the two months' files are moved, 4 the change is marked as applied."""
    few, batch = results(spark, root)
    before = sorted(map(str, public(read_table(spark, root, "games")).collect()))
    wanted = sorted(map(str, M.update_postgame(public(read_table(spark, root, "games")), batch).collect()))
    assert wanted != before
    with monkeypatch.context() as m:
        die_at(m, step)
        with pytest.raises(Killed):
            ST.update_games(spark, root, batch, M.update_postgame, batch_id="r")
    if step == 1:  # not decided: nothing has changed
        assert sorted(map(str, public(read_table(spark, root, "games")).collect())) == before
    assert ST.update_games(spark, root, batch, M.update_postgame, batch_id="r") == (step == 1)
    assert sorted(map(str, public(read_table(spark, root, "games")).collect())) == wanted
    later = batch.withColumn("attendance", F.lit(1))
    assert not ST.update_games(spark, root, later, M.update_postgame, batch_id="r")  # the same batch again
    assert sorted(map(str, public(read_table(spark, root, "games")).collect())) == wanted
    assert not ST.update_games(spark, root, later.where("game_id < 0"), M.update_postgame)  # no game of the store


def test_roster_fill_leaves_waiting_rows_alone(spark, root, small_tables):
    few, _ = results(spark, root)
    day = read_table(spark, root, "games").where(f"game_id = {few[0]}").first()
    write_tables(small_tables, root, only=("players",))
    last = read_table(spark, root, "games").agg({"game_id": "max"}).first()[0]

    def projected(game):
        return spark.createDataFrame([(3, game, 1, *[1.0] * 8, None, None, None)], S.PROJECTIONS)

    part = f"{root}/projections/game_month={UNASSIGNED}"
    for game in (few[0], last + 99):  # one was posted before the store knew its game
        stored_form(projected(game), "projections").write.mode("append").partitionBy("game_month").parquet(f"{root}/projections")
    was = months(spark, root, "projections")
    assert was[UNASSIGNED] == 2
    assert ST.fill_projection_roster(spark, root, day.game_date, batch_id="f")
    now = read_table(spark, root, "projections")
    assert months(spark, root, "projections") == was | {UNASSIGNED: 1, day.game_month: was[day.game_month] + 1}
    player = small_tables.players.where("player_id = 3").first()
    filled = now.where(f"game_id = {few[0]} and player_id = 3 and mins = 1.0 and pts = 1.0 and tov = 1.0").first()
    assert (filled.team_id, filled.depth_pos) == (player.current_team, player.current_depth_pos)
    waiting = {f.name for f in Path(part).glob("*.parquet")}
    assert not ST.fill_projection_roster(spark, root, day.game_date, batch_id="f")
    ST.fill_projection_roster(spark, root, day.game_date, batch_id="g")
    assert not ST.fill_projection_roster(spark, root, "2099-01-01")  # no projection of that month
    assert waiting == {f.name for f in Path(part).glob("*.parquet")} and months(spark, root, "projections") == was | {
        UNASSIGNED: 1, day.game_month: was[day.game_month] + 1}
