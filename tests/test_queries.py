"""Listing and report queries on golden rows."""

from __future__ import annotations

import pytest
from golden import AS_OF, tables

from rosterframe.plans import queries as Q


@pytest.fixture(scope="module")
def gt(spark):
    return tables(spark)


def test_games_filters(gt):
    assert [r.game_id for r in Q.games(gt, AS_OF).collect()] == [7]
    ids = [r.game_id for r in Q.games(gt, "2016-11-01", "2016-11-15").collect()]
    assert ids == [7, 5, 6, 4]                 # latest first, same date by game id
    assert Q.games(gt).columns == ["game_id", "away_team_id", "home_team_id", "bref_slug"]


def test_players_limit_and_status(gt):
    assert Q.players(gt, limit=2).count() == 2
    assert {r.player_id for r in Q.players(gt, status="NOT_ON_ROSTER").collect()} == {12}


def test_new_ids_wide(gt):
    got = {r.player_name: r for r in Q.new_ids(gt).collect()}
    assert (got["Ten"].nf_id, got["Ten"].bm_id, got["Ten"].rw_id) == ("n10", "b10", "zz")
    assert got[None].fc_id == "c99"                                  # a null name is its own group
    assert Q.pending_source_ids(gt).columns == ["player_name", "nf", "bm", "rw", "fp", "fc"]


def test_pending_counts(gt):
    r = Q.pending_counts(gt).first()
    assert (r.new_source_id_players, r.incomplete_players) == (3, 0)


def test_prediction_scores_sites_and_tpt(gt):
    """Two salary sites give two rows; N16: a missing tpt does not drop a player."""
    out = Q.prediction_scores(gt, AS_OF, "m").collect()
    by = {}
    for r in out:
        by.setdefault(r.player_bref_id, []).append(r)
    assert len(by["p10"]) == 2 and len(by["p11"]) == 1 and "p12" not in by
    r = sorted(by["p10"], key=lambda x: x.salary)[0]
    assert r.pred_pts == pytest.approx(10 + 12 + 15 + 20 + 20 - 10)
    assert r.value == pytest.approx(r.pred_pts / 8)
    assert r.actual_pts == pytest.approx(31 + 1.2 * 9 + 1.5 * 8 + 2 + 2 - 2)
    one = Q.prediction_scores(gt, AS_OF, "m", site="FAN_DUEL").collect()
    assert len([x for x in one if x.player_bref_id == "p10"]) == 1
