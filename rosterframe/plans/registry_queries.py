"""Registered listing/report queries (Q1-Q8) with their oracle SQL."""

from __future__ import annotations

from .. import schema as S
from . import queries as Q
from .registry import AS_OF, register, safe

D = f"DATE '{AS_OF}'"


@register("q_games", "SELECT game_id, away_team_id, home_team_id, bref_slug FROM games ORDER BY game_date DESC")
def _q_games(t):
    return Q.games(t)


@register("q_games_on_date", f"""SELECT game_id, away_team_id, home_team_id, bref_slug FROM games
  WHERE game_date = strptime('{AS_OF}', '%Y-%m-%d')::DATE ORDER BY game_date DESC""")
def _q_games_on_date(t):
    return Q.games(t, AS_OF)


@register("q_games_between", """SELECT game_id, away_team_id, home_team_id, bref_slug FROM games
  WHERE game_date BETWEEN DATE '1998-11-01' AND DATE '1998-11-30' ORDER BY game_date DESC""")
def _q_games_between(t):
    return Q.games(t, "1998-11-01", "1998-11-30")


@register("q_players", f"SELECT {safe('players')} FROM players")
def _q_players(t):
    return Q.players(t)


@register("q_players_by_status",
          f"SELECT {safe('players')} FROM players WHERE status = 'ACTIVE'")
def _q_players_by_status(t):
    return Q.players(t, status="ACTIVE")


@register("q_projections", f"SELECT {safe('projections')} FROM projections")
def _q_projections(t):
    return Q.projections(t)


@register("q_players_page", f"SELECT {safe('players')} FROM players ORDER BY player_id LIMIT 100")
def _q_players_page(t):
    """The limit is the feature: a page of the size asked for."""
    return Q.players(t, limit=100)


@register("q_stats", f"SELECT {safe('stats')} FROM stats")
def _q_stats(t):
    return Q.stats(t)


def _wide_ids_sql(suffix: str) -> str:
    cols = ",\n".join(f"MAX(CASE WHEN source_id = {c} THEN new_id END) AS {n}{suffix}"
                      for n, c in S.SOURCE_CODES.items())
    return f"SELECT player_name, {cols} FROM new_ids GROUP BY player_name ORDER BY 1"


@register("q_new_ids", _wide_ids_sql("_id"))
def _q_new_ids(t):
    return Q.new_ids(t)


@register("q_pending_source_ids", _wide_ids_sql(""))
def _q_pending_source_ids(t):
    return Q.pending_source_ids(t)


@register("q_pending_counts", """SELECT a.n + b.n AS new_source_id_players, c.n AS incomplete_players
FROM (SELECT count(DISTINCT player_name) AS n FROM new_ids) a, (SELECT count(*) FILTER (player_name IS NULL) > 0 AS some FROM new_ids) e,
     LATERAL (SELECT CAST(e.some AS INTEGER) AS n) b, (SELECT count(*) FILTER (status = 'INCOMPLETE') AS n FROM players) c""")
def _q_pending_counts(t):
    return Q.pending_counts(t)


def _scores_sql(only_date: str = "") -> str:
    """A day's predictions as one map from stat to value; points as a sum over the weights."""
    def points(stat: str) -> str:
        return " ".join(f"{'-' if w < 0 else '+'} {abs(w):g} * {stat.format(s)}" for s, w in S.FANDUEL_WEIGHTS.items())

    needed = list(S.FANDUEL_WEIGHTS)
    return f"""words AS (
  SELECT player_bref_id AS who, game_date AS day, map(list(stat_type), list(v)) AS said
  FROM (SELECT player_bref_id, game_date, source, stat_type, max(prediction) AS v FROM predictions
        WHERE source = 'model_a' AND created > TIMESTAMP '2017-03-01'{only_date} GROUP BY ALL) one
  WHERE v IS NOT NULL GROUP BY player_bref_id, game_date, source),
done AS (SELECT player_id, game_date AS day, s.* EXCLUDE (player_id) FROM stats s JOIN games USING (game_id))
SELECT who AS player_bref_id, strftime(m.day, '%Y-%m-%d') AS game_date, b.player_position, done.mins,
       0 {points("said['{}']")} AS pred_pts, (0 {points("said['{}']")}) / (pay.salary // 1000) AS value,
       CAST(0 {points("done.{}")} AS DOUBLE) AS actual_pts, pay.salary
FROM words m JOIN players b ON b.bref_id = m.who
JOIN done ON done.player_id = b.player_id AND done.day = m.day
JOIN salaries pay ON pay.player_id = b.player_id AND pay.game_date = m.day
WHERE list_has_all(map_keys(said), {needed})"""


@register("q_prediction_scores", ", " + _scores_sql(f" AND game_date = {D}"))
def _q_prediction_scores(t):
    return Q.prediction_scores(t, AS_OF, "model_a")


@register("q_prediction_scores_all_dates", ", " + _scores_sql())
def _q_prediction_scores_all(t):
    return Q.prediction_scores(t, None, "model_a")
