"""Tables stored by buckets of their key: only a batch's buckets change; keys under concurrent loads."""

from __future__ import annotations

import pytest
from conftest import rows

from rosterframe import schema as S
from rosterframe.plans import bucketed as BU
from rosterframe.plans import mutations as M
from rosterframe.sources.ledger import Ledger

PLAYER = "batch_seq long, player_name string, status string"


def files(root, name):
    """Folder of each bucket -> its files."""
    from pathlib import Path
    out = {}
    for f in Path(root, name).glob(f"{BU.BUCKET}=*/*.parquet"):
        out.setdefault(f.parent.name, set()).add(f.name)
    return out


@pytest.fixture()
def root(spark, tmp_path, small_tables):
    out = str(tmp_path / "league")
    for name in ("players", "new_ids"):
        BU.write_bucketed(getattr(small_tables, name), out, name, buckets=16)
    return out


def same(a, b):
    return sorted(map(str, a.collect())) == sorted(map(str, b.select(*a.columns).collect()))


def test_an_update_rewrites_its_buckets_only(spark, root, small_tables):
    before = files(root, "players")
    assert len(before) == 16
    batch = spark.createDataFrame([(1, 3, "PG"), (2, 3, "C"), (3, 999_999, "SF")], "batch_seq int, player_id long, player_position string")
    touched = {f"{BU.BUCKET}={r[0]}" for r in batch.select(BU.bucket_of(batch.player_id, 16)).distinct().collect()}
    assert BU.update_players(spark, root, batch, M.update_position, batch_id="b")
    after = files(root, "players")
    assert {k for k in before if before[k] != after.get(k)} <= touched and any(before[k] != after[k] for k in touched)
    assert same(BU.table(spark, root, "players"), M.update_position(small_tables.players, batch))
    again = spark.createDataFrame([(1, 3, "never")], batch.schema)
    assert not BU.update_players(spark, root, again, M.update_position, batch_id="b") and files(root, "players") == after
    assert not BU.update_players(spark, root, batch.limit(0), M.update_position)


def test_inserting_ids_adds_files_and_reads_its_buckets(spark, root, small_tables):
    stored = small_tables.new_ids.limit(1).first()
    batch = spark.createDataFrame([(1, stored.source_id, "other", "x", stored.id), (2, 1, "n1", "first", "fresh"), (3, 1, "n2", "second", "fresh")],
                                  "batch_seq int, source_id int, new_id string, player_name string, id string")
    before = files(root, "new_ids")
    assert BU.insert_new_ids(spark, root, batch, batch_id="i")
    after = files(root, "new_ids")
    assert all(before[k] <= after[k] for k in before) and sum(map(len, after.values())) == sum(map(len, before.values())) + 1
    assert same(BU.table(spark, root, "new_ids"), M.insert_new_ids(small_tables.new_ids, batch))
    assert not BU.insert_new_ids(spark, root, batch, batch_id="i")
    BU.insert_new_ids(spark, root, batch, batch_id="under another id")
    assert same(BU.table(spark, root, "new_ids"), M.insert_new_ids(small_tables.new_ids, batch))


def test_deleting_rewrites_buckets_that_lose_a_row(spark, root, small_tables):
    one = small_tables.new_ids.where("source_id = 1").limit(1).first()
    player = spark.createDataFrame([(5, one.new_id, "", "", "", "")], "player_id long, nf_id string, rw_id string, bm_id string, fp_id string, fc_id string")
    before = files(root, "new_ids")
    BU.resolve_source_ids(spark, root, player, order_col=None, batch_id="r")
    after = files(root, "new_ids")
    players, left = M.resolve_source_ids(small_tables.players, small_tables.new_ids, player, None)
    assert same(BU.table(spark, root, "new_ids"), left) and same(BU.table(spark, root, "players"), players)
    lost = small_tables.new_ids.where(f"source_id = 1 and new_id = '{one.new_id}'").select(BU.bucket_of(small_tables.new_ids.id, 16)).distinct()
    assert {k for k in before if before[k] != after.get(k)} == {f"{BU.BUCKET}={r[0]}" for r in lost.collect()}


def test_a_rewrite_that_dies_loses_nothing(spark, root, small_tables, monkeypatch):
    batch = spark.createDataFrame([(i, i, "PG") for i in range(1, 40)], "batch_seq int, player_id long, player_position string")
    want = M.update_position(small_tables.players, batch)
    real = Ledger._move
    for step in (1, 2, 9):
        seen = [0]

        def move(self, src, dst):
            seen[0] += 1
            if seen[0] == step:
                raise RuntimeError("killed")
            real(self, src, dst)

        with monkeypatch.context() as m:
            m.setattr(Ledger, "_move", move)
            with pytest.raises(RuntimeError):
                BU.update_players(spark, root, batch, M.update_position, batch_id=f"k{step}")
        BU.update_players(spark, root, batch, M.update_position, batch_id=f"k{step}")
        assert same(BU.table(spark, root, "players"), want)


def test_loads_at_the_same_time_get_different_keys(spark, root, monkeypatch):
    """A second load runs whole while the first has numbered its rows but not yet stored them."""
    last = BU.table(spark, root, "players").agg({"player_id": "max"}).first()[0]
    new = lambda *names: spark.createDataFrame([(k, n, "ACTIVE") for k, n in enumerate(names)], PLAYER)
    real, inner = Ledger._write, []

    def write(self, path, entry):
        if not inner:
            inner.append(True)
            BU.insert_players(spark, root, new("c", "d"), batch_id="second")
        real(self, path, entry)

    with monkeypatch.context() as m:
        m.setattr(Ledger, "_write", write)
        BU.insert_players(spark, root, new("a", "b", "e"), batch_id="first")
    got = BU.table(spark, root, "players").where(f"player_id > {last}").select("player_id", "player_name")
    assert rows(got) == [(last + 1, "a"), (last + 2, "b"), (last + 3, "e"), (last + 4, "c"), (last + 5, "d")]
    BU.insert_players(spark, root, new("f"), batch_id="third")
    assert BU.table(spark, root, "players").where("player_name = 'f'").first().player_id == last + 6


def test_reservations_follow_each_other(spark, root):
    ledger = Ledger(spark, root)
    assert [ledger.reserve("t", n, last) for n, last in ((3, 10), (2, 10), (0, 10), (4, 500), (1, 12))] == [10, 13, 15, 500, 504]


def test_empty_tables(spark, tmp_path):
    root = str(tmp_path / "empty")
    for name in ("players", "new_ids"):
        BU.write_bucketed(spark.createDataFrame([], S.TABLE_SCHEMAS[name]), root, name, buckets=4)
    assert BU.table(spark, root, "players").count() == 0
    BU.insert_players(spark, root, spark.createDataFrame([(1, "a", "ACTIVE")], PLAYER))
    assert [r.player_id for r in BU.table(spark, root, "players").collect()] == [1]
    assert not BU.delete_source_ids(spark, root)
