"""Hand-made league tables (FIXTURES.md part A) for the golden tests."""

from __future__ import annotations

import datetime as dt

from rosterframe import schema as S
from rosterframe.sources.tables import Tables

D = dt.date.fromisoformat
AS_OF, SEASON = "2016-11-15", "2016-10-01"


def _game(gid, date, home, away, hp=None, ap=None, att=None, total=None, home_inj=None, away_inj=None,
          slug=None, spread=0.0):
    won = None if hp is None else hp > ap
    ou = None if hp is None else ("O" if total is not None and hp + ap > total else "U")
    return (gid, D(date), "19:30", "Tuesday", away, home, f"b{gid}", slug, ap, hp, away_inj, home_inj, att, won, ou,
            spread, total, 100.0 + gid, 101.0 + gid)


def games_rows():
    return [
        _game(1, "2016-10-01", 1, 2, 100, 90, 15000, 180.0),        # season start: outside every window
        _game(2, "2016-10-20", 1, 2, 100, 90, 16000, 180.0, [5], [], spread=-3.0),
        _game(3, "2016-10-25", 2, 1, 95, 95, 12000, 190.0),         # tie: home not won (N1)
        _game(4, "2016-11-01", 1, 3),                                # unplayed past game, null result (N2)
        _game(5, "2016-11-05", 3, 1, 80, 99, 9000, None),           # away win, null total
        _game(6, "2016-11-05", 2, 3, 88, 70, None, 158.0),          # same date as 5: tie-break by id (N12)
        _game(7, "2016-11-15", 1, 3, None, None, None, 200.0, [1, 2, 3], None, spread=4.5),  # the as-of date
        _game(8, "2016-11-20", 1, 2, 120, 80, 99999, 150.0),        # after the date: must not leak (N8)
    ]


def teams_rows():
    return [(1, "AAA", -5, 40.7, 74.0, 18000), (2, "BBB", -6, 41.8, 87.6, 20000),
            (3, "CCC", -8, 34.0, 118.2, 15000), (4, "DDD", -7, 33.4, 112.0, 17000)]


def players_rows():
    base = dict(player_name="x", player_position="G", current_team=1, is_starter=True, inactive=False,
                usual_depth_pos=1, current_depth_pos=1, status="ACTIVE", dob=D("1990-06-20"),
                debut_date=D("2010-11-02"), draft_pick=3, current_salary=123456, height=78, weight=210,
                games_played=100, nf_id="n10", rw_id="r10", bm_id="b10", fp_id="f10", fc_id=None)
    out = []
    for pid, extra in ((10, {}), (11, {"player_name": "D'Angelo O'Neal", "current_team": 3, "inactive": True}),
                       (12, {"status": "NOT_ON_ROSTER", "current_team": None, "inactive": True}),
                       (13, {"status": None, "current_team": 1, "inactive": True})):
        r = {**base, **extra}
        r["bref_id"] = f"p{pid}"
        out.append(tuple([pid] + [r[f.name] for f in S.PLAYERS.fields[1:]]))
    return out


def T(day: str) -> dt.datetime:
    return dt.datetime.fromisoformat(day)


def changelog_rows():
    r = lambda pid, day, cid, team, start=True: (pid, T(day), cid, 2, 1, "G", team, start, 5000, 10, "ACTIVE", False)
    return [r(10, "2016-10-10", 1, 2), r(10, "2016-11-16", 2, 1),            # date + 1 counts (N8)
            r(10, "2016-11-17", 3, 3),                                        # date + 2 does not
            r(10, "2016-11-16 06:00:00", 6, 3),                               # after that midnight does not
            r(11, "2016-11-01", 4, 3, None), r(11, "2016-11-01", 5, 3, False)]  # same time: larger id wins
    # player 12 has no changelog row


def stats_rows():
    out = []
    # player 10 on team 1: games 2, 3, 4(not), 5 and eleven extra games below
    out.append((10, 2, 1, 30.0, 20, 5, 4, 1, 0, 2, 3))
    out.append((10, 3, 1, 0.0, 0, 0, 0, 0, 0, 0, 0))          # zero minutes: not a recent game
    out.append((10, 5, 1, 25.456, None, 7, 3, 2, 1, 1, 2))    # null stat inside the arrays (N13)
    out.append((10, 7, 1, 33.0, 31, 9, 8, 1, 1, 3, 2))        # the target game (label)
    out.append((10, 8, 1, 35.0, 40, 9, 8, 1, 1, 3, 2))        # later game: no leak
    out.append((11, 5, 3, 20.0, 10, 2, 2, 0, 0, 1, 1))
    out.append((11, 6, 3, 21.0, 12, 2, 2, 0, 0, 1, 1))
    out.append((11, 7, 3, 22.0, 14, 2, 2, 0, 0, 1, 1))
    return out


def projections_rows():
    out = []
    for pid in (10, 11):
        for src in (1, 2, 3, 4):
            out.append((pid, 7, src, 30.0, 20.0 + src, 5.0, 4.0, 1.0, 0.0, 2.0, 3.0, None, None, None))
    out.append((10, 7, 2, 30.0, 99.0, 5.0, 4.0, 1.0, 0.0, None, 3.0, None, None, None))  # repeat: MAX wins (N5)
    out.append((12, 7, 2, 30.0, 10.0, 5.0, 4.0, 1.0, 0.0, None, 3.0, None, None, None))  # incomplete
    return out


def predictions_rows():
    created = dt.datetime(2017, 6, 1)
    out = []
    for stat in S.STAT_TYPES:
        out.append(("m", D("2016-11-15"), stat, 10.0, "p10", created))
        if stat != "tpt":                                     # no tpt for p11 (N16)
            out.append(("m", D("2016-11-15"), stat, 5.0, "p11", created))
    out.append(("m", D("2016-11-15"), "pts", 50.0, "p12", dt.datetime(2016, 1, 1)))  # too old
    return out


def salaries_rows():
    return [(10, D("2016-11-15"), 9000, "FAN_DUEL"), (10, D("2016-11-15"), 8000, "DRAFT_KINGS"),
            (11, D("2016-11-15"), 4500, "FAN_DUEL")]


def new_ids_rows():
    return [(1, "n10", "Ten", "1_n10"), (2, "b10", "Ten", "2_b10"), (3, "zz", "Ten", "3_zz"),
            (5, "c99", None, "5_c99"), (1, "n77", "Seven", "1_n77")]


def tables(spark) -> Tables:
    mk = lambda rows, sch: spark.createDataFrame(rows, sch)
    extra = [(10, 100 + i, 1, 10.0 + i, i, 1, 1, 1, 1, 1, 1) for i in range(11)]
    extra_games = [_game(100 + i, f"2016-10-{2 + i:02d}", 4, 1, 90, 80, 10000, 170.0) for i in range(11)]
    return Tables(
        games=mk(games_rows() + extra_games, S.GAMES), teams=mk(teams_rows(), S.TEAMS),
        players=mk(players_rows(), S.PLAYERS), player_changelog=mk(changelog_rows(), S.PLAYER_CHANGELOG),
        projections=mk(projections_rows(), S.PROJECTIONS), stats=mk(stats_rows() + extra, S.STATS),
        predictions=mk(predictions_rows(), S.PREDICTIONS), salaries=mk(salaries_rows(), S.SALARIES),
        new_ids=mk(new_ids_rows(), S.NEW_IDS))
