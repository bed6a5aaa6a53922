"""Mutations, ingestion and pipelines on golden rows."""

from __future__ import annotations

import datetime as dt

import pytest
from conftest import rows
from golden import AS_OF, tables
from pyspark.sql import functions as F

from rosterframe.operators.keys import assign_keys
from rosterframe.plans import mutations as M
from rosterframe.sources.ingest import PLAYER_FIELDS, POSTGAME_FIELDS, enrich_literals, ingest, raw_schema


@pytest.fixture(scope="module")
def gt(spark):
    return tables(spark)


def test_postgame_rules_and_repeated_keys(spark, gt):
    batch = spark.createDataFrame([
        (1, 7, 100, 100, [1], [2, 3], 17000),     # tie -> home not won; 200 = total 200 -> push -> 'U' (N1)
        (2, 4, 90, 100, [], None, 9000),          # earlier record for game 4 ...
        (3, 4, 100, 70, [4], [], 9100),           # ... overridden by the later one (N14)
        (4, 5, 80, 99, None, None, 9000),         # null total_pred -> 'U'
    ], "batch_seq long, game_id long, away_team_pts int, home_team_pts int, away_team_injured array<int>, "
       "home_team_injured array<int>, attendance int")
    out = {r.game_id: r for r in M.update_postgame(gt.games, batch).collect()}
    assert len(out) == gt.games.count()                       # no row multiplied
    assert (out[7].home_team_won, out[7].over_under) == (False, "U")
    assert (out[4].home_team_pts, out[4].away_team_pts, out[4].home_team_won) == (70, 100, False)
    assert out[4].away_team_injured == [4] and out[4].attendance == 9100
    assert out[5].over_under == "U"
    assert out[2].home_team_pts == 100                         # untouched row


def test_update_twice_equals_once(spark, gt):
    batch = spark.createDataFrame([(1, 2, -1.5, 199.0, 100.0, 101.5)],
                                  "batch_seq long, game_id long, home_spread double, total_pred double, "
                                  "away_pred_pts double, home_pred_pts double")
    once = M.update_spreads(gt.games, batch)
    twice = M.update_spreads(once, batch)
    assert rows(once) == rows(twice)


def test_fill_slug_only_where_null(gt):
    g = {r.game_id: r.game_slug for r in M.fill_game_slug(gt.games).collect()}
    assert g[2] == "2016-10-20_2_1"


def test_insert_with_generated_keys(spark, gt):
    recs = spark.createDataFrame([(30, "2016-12-01", "20:00", "Thursday", "1", "2"),
                                  (10, "2016-12-02", "20:00", "Friday", "3", "4"),
                                  (20, "2016-12-03", "20:00", "Saturday", "4", "1")],
                                 "batch_seq long, gameDate string, gameTime string, dayOfWeek string, "
                                 "awayTeamId string, homeTeamId string")
    from rosterframe.sources.ingest import GAME_FIELDS
    good, bad = ingest(recs, GAME_FIELDS, keep=["batch_seq"])
    assert bad.count() == 0
    out = M.load_games(gt.games, good)
    new = {r.game_id: (r.game_date, r.game_slug) for r in out.where(F.col("game_id") > 110).collect()}
    assert new == {111: (dt.date(2016, 12, 2), "2016-12-02_3_4"), 112: (dt.date(2016, 12, 3), "2016-12-03_4_1"),
                   113: (dt.date(2016, 12, 1), "2016-12-01_1_2")}


def test_assign_keys_dense_across_partitions(spark):
    batch = spark.range(0, 5000, numPartitions=7).select((F.col("id") * 3 % 5000).alias("batch_seq"))
    base = spark.createDataFrame([(41,)], "k long")
    got = assign_keys(batch, base, "k", "batch_seq")
    ks = sorted((r.batch_seq, r.k) for r in got.collect())
    assert [k for _, k in ks] == list(range(42, 5042))


def test_ingest_splits_bad_rows_and_keeps_quotes(spark):
    recs = spark.createDataFrame([
        {"playerName": "D'Angelo O'Neal", "birthdate": "1990-01-05", "team": "3", "isStarting": "true"},
        {"playerName": "Bad Date", "birthdate": "1990-13-45", "team": "x", "isStarting": "maybe"},
        {"playerName": "Missing", "birthdate": None, "team": None, "isStarting": None},
    ], schema=raw_schema([f for f in PLAYER_FIELDS if f.key in ("playerName", "birthdate", "team", "isStarting")]))
    fields = [f for f in PLAYER_FIELDS if f.key in ("playerName", "birthdate", "team", "isStarting")]
    good, bad = ingest(recs, fields)
    g = {r.player_name: r for r in good.collect()}
    assert set(g) == {"D'Angelo O'Neal", "Missing"}                 # both apostrophes kept (N11)
    assert g["D'Angelo O'Neal"].dob == dt.date(1990, 1, 5) and g["D'Angelo O'Neal"].current_team == 3
    assert g["Missing"].dob is None                                  # absent values are null, not errors
    b = bad.collect()
    assert len(b) == 1 and sorted(b[0].failed_keys) == ["birthdate", "isStarting", "team"]


def test_postgame_json_batch_roundtrip(spark, tmp_path):
    p = tmp_path / "post.json"
    p.write_text('{"gameId": 7, "awayPoints": 99, "homePoints": 101, "awayTeamInactive": [1, 2], '
                 '"homeTeamInactive": [], "attendance": 15000}\n')
    from rosterframe.sources.ingest import read_json_batch
    good, bad = read_json_batch(spark, str(p), POSTGAME_FIELDS)
    r = good.first()
    assert (r.game_id, r.home_team_pts, r.away_team_injured, r.home_team_injured) == (7, 101, [1, 2], [])
    assert bad.count() == 0


def test_not_on_roster(spark, gt):
    ids = spark.createDataFrame([(10,), (10,), (999,)], "player_id long")
    out = {r.player_id: r for r in M.mark_not_on_roster(gt.players, ids).collect()}
    assert len(out) == gt.players.count()
    p = out[10]
    assert (p.status, p.current_team, p.usual_depth_pos, p.is_starter, p.inactive) == ("NOT_ON_ROSTER", None, None, False, True)
    assert out[11].status == "ACTIVE"


def test_bio_sets_pending(spark, gt):
    b = spark.createDataFrame([(11, "new11", 80, 220, dt.date(1991, 1, 1), dt.date(2012, 1, 1), 5, 7, 1000, "F")],
                              "player_id long, bref_id string, height int, weight int, dob date, debut_date date, "
                              "draft_pick int, games_played int, current_salary int, player_position string")
    out = {r.player_id: r for r in M.update_bio(gt.players, b, order_col=None).collect()}
    assert (out[11].status, out[11].bref_id, out[11].player_position) == ("PENDING", "new11", "F")
    assert out[10].status == "ACTIVE"


def test_resolve_then_no_matching_pending_rows(spark, gt):
    batch = spark.createDataFrame([(10, "n10", "", "zz", "", "")],
                                  "player_id long, nf_id string, rw_id string, bm_id string, fp_id string, fc_id string")
    players2, ids2 = M.resolve_source_ids(gt.players, gt.new_ids, batch, order_col=None)
    p = players2.where("player_id = 10").first()
    assert (p.nf_id, p.rw_id, p.bm_id, p.fp_id) == ("n10", None, "zz", None)      # blanks become null
    left = {r.id for r in ids2.collect()}
    assert left == {"2_b10", "3_zz", "5_c99", "1_n77"}                             # nf n10 matched source 1
    # deleting again removes nothing more (idempotent), and null ids never match
    again = M.delete_source_ids(ids2, players2, batch.select("player_id"))
    assert {r.id for r in again.collect()} == left


def test_insert_ignore_first_wins_and_is_idempotent(spark, gt):
    batch = spark.createDataFrame([(1, 2, "b10", "Other", "2_b10"), (2, 4, "f1", "A", "4_f1"),
                                   (3, 4, "f1", "B", "4_f1")],
                                  "batch_seq long, source_id int, new_id string, player_name string, id string")
    once = M.insert_new_ids(gt.new_ids, batch)
    got = {r.id: r.player_name for r in once.collect()}
    assert got["2_b10"] == "Ten" and got["4_f1"] == "A" and len(got) == 6
    assert rows(M.insert_new_ids(once, batch)) == rows(once)


def test_fill_projection_roster_only_that_date(spark, gt):
    players = gt.players.withColumn("current_depth_pos", F.lit(4))
    out = M.fill_projection_roster(gt.projections, players, gt.games, AS_OF)
    got = {(r.player_id, r.source_id, r.pts): (r.team_id, r.depth_pos) for r in out.collect()}
    assert got[(10, 1, 21.0)] == (1, 4)
    assert got[(12, 2, 10.0)] == (None, 4)            # player 12 has no team: team stays null, depth set
    assert out.count() == gt.projections.count()
    none = M.fill_projection_roster(gt.projections, players, gt.games, "2016-11-16")
    assert rows(none) == rows(gt.projections)


def test_predictions_request(spark, gt):
    recs = spark.createDataFrame([(12.5, "p10")], "`Scored Label` double, bref_id string")
    enriched = enrich_literals(recs, predictionSrc="x", gameDate=AS_OF, statType="reb")
    assert enriched.first().predictionSrc == "x"
    out = M.insert_predictions(gt.predictions, recs, "x", AS_OF, "reb", "2018-01-01 00:00:00")
    r = out.where("source = 'x'").first()
    assert (r.stat_type, r.prediction, r.player_bref_id) == ("reb", 12.5, "p10")
    with pytest.raises(ValueError):
        M.insert_predictions(gt.predictions, recs, "x", AS_OF, "bad", "2018-01-01 00:00:00")


def test_jdbc_typing_matches_declared_schema(spark):
    from rosterframe import schema as S
    from rosterframe.sources.jdbc import typed
    raw = spark.createDataFrame([(1, "2016-11-01", 3, "7", True)],
                                "player_id int, changed_on string, new_team long, new_salary string, new_starting boolean")
    with pytest.raises(ValueError, match="tie_break"):
        typed(raw, "player_changelog")
    out = typed(raw.withColumn("seq", F.lit(5)), "player_changelog", tie_break="seq")
    assert out.schema.simpleString() == S.PLAYER_CHANGELOG.simpleString()
    r = out.first()
    assert (r.player_id, str(r.changed_on), r.new_team, r.new_salary, r.change_id) == (1, "2016-11-01 00:00:00", 3, 7, 5)


def test_jdbc_fact_tables_need_read_bounds(spark):
    from rosterframe.sources.jdbc import read_jdbc_tables
    with pytest.raises(ValueError, match="read bounds.*stats"):
        read_jdbc_tables(spark, "jdbc:none", {}, {"games": ("game_id", 1, 10, 2)})


UPDATES = {
    "update_player": ("player_id long, current_depth_pos int, usual_depth_pos int, current_team int, is_starter boolean, "
                      "inactive boolean, status string", (1, 1, 3, True, False, "A"), (2, 2, 4, False, True, "B"), "current_team", 4),
    "update_position": ("player_id long, player_position string", ("G",), ("C",), "player_position", "C"),
    "update_source_ids": ("player_id long, nf_id string, rw_id string, bm_id string, fp_id string, fc_id string",
                          ("a",) * 5, ("b",) * 5, "bm_id", "b"),
    "update_bio": ("player_id long, bref_id string, height int, weight int, dob date, debut_date date, draft_pick int, "
                   "games_played int, current_salary int, player_position string",
                   ("x", 1, 1, None, None, 1, 1, 1, "G"), ("y", 2, 2, None, None, 2, 2, 2, "F"), "bref_id", "y"),
}


@pytest.mark.parametrize("name", UPDATES)
def test_repeated_keys_never_multiply_players(spark, gt, name):
    """With an order the last record counts; without one a repeated key fails the job."""
    schema, first, last, column, want = UPDATES[name]
    batch = spark.createDataFrame([(2, 10, *last), (1, 10, *first)], "batch_seq long, " + schema)
    out = getattr(M, name)(gt.players, batch).collect()
    assert len(out) == gt.players.count()
    assert {r.player_id: r[column] for r in out}[10] == want
    with pytest.raises(Exception, match="repeated key"):
        getattr(M, name)(gt.players, batch.drop("batch_seq"), order_col=None).collect()


def test_resolve_with_repeated_keys(spark, gt):
    batch = spark.createDataFrame([(2, 10, "n10", "", "", "", ""), (1, 10, "", "", "", "", "")],
                                  "batch_seq long, player_id long, nf_id string, rw_id string, bm_id string, fp_id string, fc_id string")
    players2, ids2 = M.resolve_source_ids(gt.players, gt.new_ids, batch)
    assert players2.count() == gt.players.count()
    assert "1_n10" not in {r.id for r in ids2.collect()}


def test_fill_roster_refuses_a_repeated_player(gt):
    twice = gt.players.union(gt.players)
    with pytest.raises(Exception, match="repeated key"):
        M.fill_projection_roster(gt.projections, twice, gt.games, AS_OF).collect()


def test_a_bad_prediction_is_split_off(spark, gt):
    recs = spark.createDataFrame([("12.5", "p10"), ("n/a", "p11")], "`Scored Label` string, bref_id string")
    good, bad = M.prediction_rows(recs, "x", AS_OF, "reb")
    assert [(r.prediction, r.stat_type) for r in good.collect()] == [(12.5, "reb")]
    assert [r.failed_keys for r in bad.collect()] == [["Scored Label"]]
    assert M.insert_predictions(gt.predictions, recs, "x", AS_OF, "reb").where("source = 'x'").count() == 1


def test_malformed_json_and_bad_array_elements_are_rejected(spark, tmp_path):
    from rosterframe.sources.ingest import read_json_batch
    (tmp_path / "b.json").write_text('{"gameId": 7, "awayPoints": 90, "homePoints": 99, "awayTeamInactive": [1, 2], "homeTeamInactive": null}\n'
                                     '{"gameId": 8, "awayTeamInactive": [1, "x"]}\n{"gameId": 9, \nnot json\n'
                                     '{"gameId": 10, "awayTeamInactive": [1, null]}\n')
    good, bad = read_json_batch(spark, str(tmp_path / "b.json"), POSTGAME_FIELDS)
    assert sorted((r.game_id, r.away_team_injured) for r in good.collect()) == [(7, [1, 2]), (10, [1, None])]
    assert sorted((r.failed_keys, r.record[:12]) for r in bad.collect()) == [
        (["_corrupt_record"], "not json"), (["_corrupt_record"], '{"gameId": 9'), (["awayTeamInactive"], '{"gameId":"8')]


def test_generated_keys_are_stable_under_rerun(spark):
    batch = spark.range(0, 3000, numPartitions=5).select(((F.col("id") * 7919) % 3000).alias("batch_seq"))
    base = spark.createDataFrame([(100,)], "k long")
    a = sorted((r.batch_seq, r.k) for r in assign_keys(batch, base, "k", "batch_seq").collect())
    b = sorted((r.batch_seq, r.k) for r in assign_keys(batch.repartition(3), base, "k", "batch_seq").collect())
    assert a == b and a[0] == (0, 101)


def test_prediction_created_defaults_to_now(spark, gt):
    recs = spark.createDataFrame([(1.5, "p10")], "`Scored Label` double, bref_id string")
    out = M.insert_predictions(gt.predictions, recs, "now", AS_OF, "pts")
    assert out.where("source = 'now'").first().created is not None
