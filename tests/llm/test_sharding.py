"""Rendezvous sharding against a plain version, and its properties."""

from __future__ import annotations

import hashlib
import math
import zlib
from collections import Counter, defaultdict

import pytest
from llm_fixtures import docs_of  # noqa: F401
from pyspark.sql import functions as F

from rosterframe.llm import sharding as S


def slow(key, weights, seed="shard"):
    key = "null" if key is None else f"={key}"

    def score(i):
        u = (int(hashlib.md5(f"{seed}|{i}|{key}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52
        return -math.log(u) / weights[i]

    return min((i for i, w in enumerate(weights) if w), key=score)


def test_plain_version_and_weights(spark):
    ids = spark.range(3000).select(F.col("id").alias("doc_id"))
    for weights in ([1.0] * 7, [1, 2, 0, 5.5], [3]):
        got = S.assign(ids, weights, added=[2.0], seed="s").collect()
        for r in got:
            assert r.shard == slow(r.doc_id, weights, "s") and r.grown_shard == slow(r.doc_id, [*weights, 2.0], "s")
            assert r.grown_shard in (r.shard, len(weights))  # rows move into the new shard only
        share = Counter(r.shard for r in got)
        for i, w in enumerate(weights):
            p = w / sum(weights)
            assert abs(share[i] - 3000 * p) <= 5 * math.sqrt(3000 * p * (1 - p)) + 1e-9
        moved = sum(r.grown_shard != r.shard for r in got)
        p = 2 / (sum(weights) + 2)
        assert abs(moved - 3000 * p) <= 5 * math.sqrt(3000 * p * (1 - p))
        slots = defaultdict(list)
        for r in got:
            slots[r.shard].append(r.slot)
        assert all(sorted(v) == list(range(len(v))) for v in slots.values())


def test_a_shard_less_moves_its_own_rows_only(spark):
    ids = spark.range(2000).select(F.col("id").alias("doc_id"))
    a, b = ({r.doc_id: r.shard for r in S.assign(ids, [1.0] * n).collect()} for n in (9, 8))
    assert all(b[i] == a[i] for i in a if a[i] < 8)


@pytest.mark.parametrize("weights", [[], [0, 0], [1, -1]])
def test_bad_weights(weights):
    with pytest.raises(ValueError):
        S.shard_of(F.lit("k"), weights)


def test_edge_cases(docs_of):
    long = "word " * 300_000
    hot = [(7, "copy", None, None)] * 400  # a third of the rows share key and text
    rows = hot + [(None, None), (None, "x"), (8, ""), (9, long), *((i, f"t{i}") for i in range(10, 800))]
    df = docs_of(rows).withColumns({"Shard": F.lit("old"), "key": F.lit(1), "row": F.lit(2), "place": F.lit(3), "tie0": F.lit(4)}).repartition(5)
    out = S.assign(df, [1.0] * 4)
    assert out.columns == [*(c for c in df.columns if c != "Shard"), "shard", "slot", "grown_shard"]
    got = out.collect()
    assert Counter((r.doc_id, zlib.crc32((r.text or "").encode())) for r in got) == Counter((r[0], zlib.crc32((r[1] or "").encode())) for r in rows)
    assert len({r.shard for r in got if r.doc_id is None}) == 1
    for s in range(4):
        mine = sorted((r.slot, r.doc_id) for r in got if r.shard == s)
        assert [x for x, _ in mine] == list(range(len(mine)))
    assert S.assign(df.limit(0), [1.0] * 4).collect() == []


def test_native(spark, docs_of):
    plan = S.assign(docs_of([(1, "a")]), [1.0] * 40)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_files_in_slot_order(spark, docs_of, tmp_path):
    df = docs_of([(i, f"text {i}") for i in range(500)])
    out = S.assign(df, [1.0, 2.0, 3.0])
    S.write_shards(out, f"{tmp_path}/out")
    back = spark.read.parquet(f"{tmp_path}/out")
    assert sorted(map(str, back.select(*out.columns).collect())) == sorted(map(str, out.collect()))
    for part in (tmp_path / "out").glob("shard=*/*.parquet"):
        slots = [r.slot for r in spark.read.parquet(str(part)).collect()]
        assert slots == sorted(slots)
