"""Posted batches derived from the driver tables, for the mutation queries.

Each batch is what a client would post, built by Spark from the given tables
so that its size grows with them.  Stored tables and batches are split by
date where the API posts by date (``CUTOFF``: the table as stored on that day,
and what arrives after).  The rules mirror ``rosterframe.oracle``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ingest import (GAME_FIELDS, INCOMPLETE_PLAYER_FIELDS, NEW_ID_FIELDS, PLAYER_BIO_FIELDS, PLAYER_FIELDS,
                     PLAYER_POSITION_FIELDS, PLAYER_SOURCE_ID_FIELDS, PLAYER_UPDATE_FIELDS, POSTGAME_FIELDS,
                     SPREAD_FIELDS, ingest)
from .tables import Tables

CUTOFF = "1998-08-01"
RELEASE_DAY = "2001-06-01"


def _before(df: DataFrame, col: str = "game_date") -> DataFrame:
    return df.where(F.col(col) < F.lit(CUTOFF).cast("date"))


def _after(df: DataFrame, col: str = "game_date") -> DataFrame:
    return df.where(F.col(col) >= F.lit(CUTOFF).cast("date"))


def _text(c) -> F.Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def game_records(t: Tables) -> DataFrame:
    """Games from the cutoff on, posted with the five insert fields (text values)."""
    g = _after(t.games)
    return g.select(F.col("game_id").alias("batch_seq"),
                    F.date_format("game_date", "yyyy-MM-dd").alias("gameDate"),
                    F.col("game_time_24_et").alias("gameTime"), F.col("day_of_week").alias("dayOfWeek"),
                    _text("away_team_id").alias("awayTeamId"), _text("home_team_id").alias("homeTeamId"))


def game_batch(t: Tables) -> DataFrame:
    return ingest(game_records(t), GAME_FIELDS, keep=["batch_seq"])[0]


def postgame_records(t: Tables, lineitem: DataFrame) -> DataFrame:
    """One result record per line item of a game not yet played; later line
    numbers correct earlier ones (a repeated key, N14)."""
    pending = t.games.where(F.col("home_team_won").isNull()).select(F.col("game_id").alias("l_orderkey"))
    li = lineitem.join(pending, "l_orderkey", "left_semi")
    # Batch order: line number, then part and ship date ((order, line) alone repeats).
    return li.select(
        F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate").alias("batch_seq"),
        _text("l_orderkey").alias("gameId"),
        _text(85 + F.col("l_partkey") % 40).alias("awayPoints"),
        _text(85 + F.col("l_suppkey") % 40).alias("homePoints"),
        F.slice(F.array(*[F.lit(str(v)) for v in (31, 32, 33)]), 1, (F.col("l_linenumber") % 4).cast("int"))
         .alias("awayTeamInactive"),
        F.when(F.col("l_linenumber") % 3 != 0, F.array(_text("l_partkey"))).alias("homeTeamInactive"),
        _text(11000 + F.col("l_partkey") % 8000).alias("attendance"))


def postgame_batch(t: Tables, lineitem: DataFrame) -> DataFrame:
    return ingest(postgame_records(t, lineitem), POSTGAME_FIELDS, keep=["batch_seq"])[0]


def spread_batch(orders: DataFrame) -> DataFrame:
    k = F.col("o_orderkey")
    recs = orders.select(k.alias("batch_seq"), _text(k).alias("gameId"),
                         _text(k % 15 - 7).alias("homeSpread"), _text(170 + k % 50).alias("total"),
                         _text(95 + k % 20).alias("awayPredPts"), _text(95 + k % 15).alias("homePredPts"))
    return ingest(recs, SPREAD_FIELDS, keep=["batch_seq"])[0]


def player_records(customer: DataFrame) -> DataFrame:
    """Customers posted as new players, all values as text; some dates are bad."""
    c = F.col("c_custkey")
    day = lambda base, n: F.date_format(F.date_add(F.lit(base).cast("date"), (c % n).cast("int")), "yyyy-MM-dd")
    return customer.select(
        c.alias("batch_seq"),
        F.col("c_name").alias("playerName"), F.col("c_mktsegment").alias("playerPosition"),
        _text("c_nationkey").alias("team"), F.concat(F.lit("r"), _text(c)).alias("rw_id"),
        F.when(F.col("c_acctbal") > 0, "true").otherwise("false").alias("isStarting"),
        F.when(F.col("c_acctbal") < 1000, "true").otherwise("false").alias("inactive"),
        _text(c % 5 + 1).alias("depthPos"), _text(c % 4 + 1).alias("currentDepth"),
        F.lit("ACTIVE").alias("status"), F.concat(F.lit("c"), _text(c)).alias("bref_id"),
        F.when(c % 97 == 0, F.lit("not-a-date")).otherwise(day("1975-01-01", 5000)).alias("birthdate"),
        day("1995-01-01", 3000).alias("debutDate"),
        _text(c % 60 + 1).alias("drafted"), _text(F.floor(F.abs(F.col("c_acctbal")))).alias("salary"),
        _text(72 + c % 12).alias("height"), _text(170 + c % 80).alias("weight"),
        _text(c % 82).alias("gamesPlayed"))


def player_batch(customer: DataFrame) -> tuple[DataFrame, DataFrame]:
    return ingest(player_records(customer), PLAYER_FIELDS, keep=["batch_seq"])


def incomplete_player_batch(supplier: DataFrame) -> DataFrame:
    s = F.col("s_suppkey")
    recs = supplier.select(
        s.alias("batch_seq"), F.col("s_name").alias("playerName"), _text("s_nationkey").alias("team"),
        F.concat(F.lit("s"), _text(s)).alias("rw_id"),
        F.when(F.col("s_acctbal") > 5000, "true").otherwise("false").alias("isStarting"),
        F.lit("false").alias("inactive"), _text(s % 5 + 1).alias("depthPos"),
        F.lit(None).cast("string").alias("currentDepth"), F.lit("INCOMPLETE").alias("status"))
    return ingest(recs, INCOMPLETE_PLAYER_FIELDS, keep=["batch_seq"])[0]


def posted(df: DataFrame, fields, order=None) -> DataFrame:
    """Typed rows as posted text records, typed again; ``order`` is their place in the batch."""
    if order is None:
        return ingest(text_records(df, fields), fields)[0]
    return ingest(text_records(df.withColumn("batch_seq", order), fields, ["batch_seq"]), fields, keep=["batch_seq"])[0]


def player_update_batch(t: Tables) -> DataFrame:
    """Every change ever logged, in order: most players come many times, the last one counts."""
    rows = t.player_changelog.select(
        "player_id", "changed_on", "change_id", F.col("new_current_depth").alias("current_depth_pos"),
        F.col("new_usual_depth").alias("usual_depth_pos"), F.col("new_team").alias("current_team"),
        F.col("new_starting").alias("is_starter"), F.col("new_inactive").alias("inactive"), F.col("new_status").alias("status"))
    return posted(rows, PLAYER_UPDATE_FIELDS, F.struct("changed_on", "change_id"))


def position_batch(t: Tables) -> DataFrame:
    rows = t.player_changelog.select("player_id", "changed_on", "change_id", F.col("new_position").alias("player_position"))
    return posted(rows, PLAYER_POSITION_FIELDS, F.struct("changed_on", "change_id"))


def released_player_ids(lineitem: DataFrame) -> DataFrame:
    """Players whose last line items ship after the release day (a list of everyone would
    leave no player to stay on the roster)."""
    return (lineitem.where(F.col("l_shipdate") >= F.lit(RELEASE_DAY).cast("timestamp_ntz"))
            .select(F.col("l_partkey").alias("player_id")).distinct())


def bio_batch(t: Tables) -> DataFrame:
    """Biographies for the incomplete players, posted twice: the second post corrects the first."""
    p = t.players.where(F.col("status") == "INCOMPLETE").withColumn("post", F.explode(F.array(F.lit(1), F.lit(2))))
    first = (F.col("post") == 1).cast("int") * 50
    rows = p.select("player_id", "post", F.concat(F.lit("b"), _text("player_id")).alias("bref_id"),
                    (F.col("height") + 1 + first).alias("height"), (F.col("weight") + 2 + first).alias("weight"),
                    F.date_add("dob", 1).alias("dob"), F.date_add("debut_date", 2).alias("debut_date"),
                    (F.col("draft_pick") + 3 + first).alias("draft_pick"), (F.col("games_played") + 4).alias("games_played"),
                    (F.col("current_salary") + 5).alias("current_salary"),
                    F.concat(F.col("player_position"), F.lit(" II")).alias("player_position"))
    return posted(rows, PLAYER_BIO_FIELDS, F.col("post"))


def source_id_batch(t: Tables, events: DataFrame) -> DataFrame:
    """Pending ids of each purchasing user assigned to the player with that id, after an
    earlier post without any.  A source without a pending id is an empty string, and so are
    two of the sources for every other player, whose pending ids stay pending."""
    from ..plans.queries import new_ids as wide_ids
    w = wide_ids(t)
    uid = F.regexp_extract("player_name", r"^user_(\d+)$", 1)
    buyers = purchase_player_ids(events)
    open_ = F.col("player_id") % 2 == 1
    ids = (w.where(uid != "")
           .select(uid.cast("bigint").alias("player_id"),
                   *[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("nf_id", "rw_id", "bm_id", "fp_id", "fc_id")])
           .join(buyers, "player_id", "left_semi")
           .withColumns({c: F.when(open_, F.lit("")).otherwise(F.col(c)) for c in ("fp_id", "fc_id")})
           .withColumn("post", F.explode(F.array(F.lit(1), F.lit(2)))))
    ids = ids.withColumns({c: F.when(F.col("post") == 1, F.lit("")).otherwise(F.col(c))
                           for c in ("nf_id", "rw_id", "bm_id", "fp_id", "fc_id")})
    return posted(ids, PLAYER_SOURCE_ID_FIELDS, F.col("post"))


def new_id_batch(orders: DataFrame) -> DataFrame:
    """An id per order, posted as text: some are stored already, many come again in the batch."""
    source = (F.col("o_orderkey") % 5 + 1).cast("int")
    new_id = F.concat(F.lit("x"), _text(F.col("o_custkey") * 7 + source))
    rows = orders.select(F.col("o_orderkey").alias("post"), source.alias("source_id"), new_id.alias("new_id"),
                         F.concat(F.lit("User "), _text("o_custkey")).alias("player_name"),
                         F.concat(_text(source), F.lit("_"), new_id).alias("id"))
    return posted(rows, NEW_ID_FIELDS, F.col("post"))


def purchase_player_ids(events: DataFrame) -> DataFrame:
    return (events.where(F.col("event_type") == "purchase")
            .select(F.col("user_id").alias("player_id")).distinct())


def projection_split(t: Tables, date) -> tuple[DataFrame, DataFrame]:
    """Projections stored before ``date``'s posting, and the posted ones for
    that date (without roster fields)."""
    from ..functions.dates import as_date
    on = t.games.where(F.col("game_date") == as_date(date)).select("game_id")
    stored = t.projections.join(on, "game_id", "left_anti")
    posted = t.projections.join(on, "game_id", "left_semi").drop("team_id", "depth_pos", "is_starter")
    return stored, posted


def prediction_records(t: Tables, date) -> DataFrame:
    """One request's records: model output for the players who played on ``date``."""
    from ..functions.dates import as_date
    on = t.games.where(F.col("game_date") == as_date(date)).select("game_id")
    s = t.stats.join(on, "game_id", "left_semi")
    return s.select((F.col("pts") + 0.75).alias("Scored Label"),
                    F.concat(F.lit("p"), _text("player_id")).alias("bref_id"))


def text_records(df: DataFrame, fields, keep=()) -> DataFrame:
    """Typed rows rendered as posted JSON records: every value as text."""
    cols = [F.col(k) for k in keep]
    for f in fields:
        c = F.col(f.column)
        if f.type == "date":
            c = F.date_format(c, "yyyy-MM-dd")
        elif f.type == "int_array":
            c = F.transform(c, lambda x: x.cast("string"))
        else:
            c = c.cast("string")
        cols.append(c.alias(f.key))
    return df.select(*cols)


def posted_after_cutoff(df: DataFrame, fields, date_col: str | None = "game_date",
                        games: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Split a table into the part stored before ``CUTOFF`` and the part
    posted after it, the latter as typed rows re-read from text records."""
    if date_col not in df.columns:
        df = df.join(games.select("game_id", "game_date"), "game_id")
        stored, posted = _before(df).drop("game_date"), _after(df).drop("game_date")
    else:
        stored, posted = _before(df), _after(df)
    good, _ = ingest(text_records(posted, fields), fields)
    return stored, good
