"""Batches typed, split, written and counted in one pass."""

from __future__ import annotations

import json

import pytest
from conftest import SF001, rows

from rosterframe.sources import batches as B
from rosterframe.sources import ingest as I

POSTED = [
    {"playerId": "1", "gameDate": "1998-11-18", "salary": "5000", "site": "a"},
    {"playerId": "x", "gameDate": "1998-13-18", "salary": "5000", "site": "a"},        # two keys fail
    {"playerId": "3", "gameDate": None, "salary": None, "site": None},                # nothing there is nothing wrong
    {"playerId": "4", "gameDate": "1998-11-18", "salary": "much", "site": "a"},
    {"playerId": "4", "gameDate": "1998-11-18", "salary": "much", "site": "a"},        # repeated
    {}]


def post(path, lines):
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def text(df):
    return sorted(map(str, df.collect()))


def test_as_ingest_and_counted(spark, tmp_path):
    posted = post(tmp_path / "batch.json", [*map(json.dumps, POSTED), "{no json", "7"])
    landed = I.land_json_batch(spark, posted, I.SALARY_FIELDS, str(tmp_path / "landed"))
    good, bad = I.read_json_batch(spark, posted, I.SALARY_FIELDS)
    assert text(landed.good) == text(good) and landed.good.schema.simpleString() == good.schema.simpleString()
    assert text(landed.bad) == text(bad) and landed.bad.schema.simpleString() == bad.schema.simpleString()
    assert (landed.records, landed.rejected) == (8, 5) == (good.count() + bad.count(), bad.count())
    assert landed.failures == {"playerId": 1, "gameDate": 1, "salary": 2, "site": 0, I.CORRUPT: 2}


def test_landed_again_after_the_posted_files_are_gone(spark, tmp_path):
    posted, out = tmp_path / "batch.json", str(tmp_path / "landed")
    for n in (3, 6):  # a batch that comes again replaces what was landed before
        landed = I.land_json_batch(spark, post(posted, map(json.dumps, POSTED[:n])), I.SALARY_FIELDS, out)
    posted.unlink()
    assert landed.good.count() == 3 and landed.bad.count() == 3 and landed.records == 6


def test_one_side_is_read_alone(spark, tmp_path):
    """Neither side parses the text, and each reads its own folder."""
    landed = I.land(B.player_records(spark.read.parquet(f"{SF001}/customer.parquet")), I.PLAYER_FIELDS, str(tmp_path / "landed"), keep=["batch_seq"])
    for df, flag in ((landed.good, "false"), (landed.bad, "true")):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan parquet") == 1 and "customer" not in plan
        assert "PartitionFilters: [isnotnull(rejected" in plan
    assert landed.good.count() + landed.rejected == landed.records and landed.rejected == landed.failures["birthdate"] > 0


@pytest.mark.parametrize("lines", [[], [json.dumps(POSTED[0])], [json.dumps(POSTED[1])]])
def test_empty_sides(spark, tmp_path, lines):
    landed = I.land_json_batch(spark, post(tmp_path / "batch.json", lines), I.SALARY_FIELDS, str(tmp_path / "landed"))
    good, bad = I.ingest(spark.createDataFrame([], I.raw_schema(I.SALARY_FIELDS)), I.SALARY_FIELDS)
    assert landed.good.columns == good.columns and landed.bad.columns == bad.columns
    assert rows(landed.good.selectExpr("count(*)")) == [(landed.records - landed.rejected,)]
    assert rows(landed.bad.selectExpr("count(*)")) == [(landed.rejected,)] and landed.records == len(lines)


def test_names_of_the_landed_form(spark, tmp_path):
    df = spark.createDataFrame([("1", "x")], "playerId string, record string")
    with pytest.raises(ValueError):
        I.land(df, [I.Field("playerId", "player_id", "long")], str(tmp_path / "landed"), keep=["record"])
