"""Embedding classes against all pairs in double precision."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from rosterframe.llm import embedding_dedup as E

SF = "/root/testdata/sf0.01"


def brute(rows, cosine):
    ok = [(k, np.array(v, np.float64)) for k, (i, v) in enumerate(rows)
          if v is not None and None not in v and np.isfinite(np.array(v, np.float64)).all() and any(v)]
    links, up = [0] * len(rows), list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    if ok:
        x = np.stack([v / np.linalg.norm(v) for _, v in ok])
        near = x @ x.T >= cosine
        for a in range(len(ok)):
            for b in np.flatnonzero(near[a]):
                if a != b:
                    links[ok[a][0]] += 1
                    p, q = find(ok[a][0]), find(ok[b][0])
                    up[max(p, q)] = min(p, q)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(least.get(find(k), i), i)
    return sorted(((i, links[k], least.get(find(k)), i == least.get(find(k))) for k, (i, _) in enumerate(rows)), key=str)


def found(df, **k):
    return sorted(map(tuple, E.embedding_classes(df, **k).collect()), key=str)


def table(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumns({"code": F.lit(1), "unit": F.lit("u"), "label": F.lit(0)}).repartition(3)


def clusters(seed, n, dim, groups, spread):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(groups, dim))
    x = centers[rng.integers(0, groups, n)] + spread * rng.normal(size=(n, dim))
    return [(int(i), [float(v) for v in np.float32(r)]) for i, r in zip(rng.permutation(n * 3)[:n], x)]


def test_whole_table(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = [(r.vec_id, list(r.embedding)) for r in df.collect()]
    assert found(df) == brute(rows, 0.9)


@pytest.mark.parametrize(("dim", "groups", "spread"), [(64, 40, 0.3), (5, 12, 0.25), (2, 30, 0.5), (100, 3, 0.25)])
def test_clusters_in_many_blocks(spark, dim, groups, spread):
    rows = clusters(dim, 900, dim, groups, spread)
    got = found(table(spark, rows), block_rows=64, sample=200)
    want = brute(rows, 0.9)
    assert got == want and any(r[1] for r in want)


def test_copies_and_edge_cases(spark):
    rows = clusters(3, 150, 8, 5, 0.4)
    rows += [(1000 + k, rows[0][1]) for k in range(400)]  # a hot vector
    rows += [(1000, rows[0][1]), (1000, rows[9][1])]  # a repeated row, an id with two vectors
    nan, inf = float("nan"), float("inf")
    odd = [None, [], [0.0] * 8, [nan] * 8, [1.0] * 7 + [inf], [1.0, 2.0], [1.0] * 7 + [None]]
    rows += [(2000 + k, v) for k, v in enumerate(odd)] + [(None, rows[0][1]), (None, None)]
    rows += [(3000, [2 * x for x in rows[3][1]]), (3001, [1e-30 * x for x in rows[3][1]]), (3002, [-x for x in rows[3][1]])]
    want = brute([(i, v if v is not None and len(v) == 8 else None) for i, v in rows], 0.9)
    assert found(table(spark, rows), block_rows=32) == want


def test_vectors_without_an_id_count_and_bridge(spark):
    """1 and 3 are linked over a vector that has no id; two more of those are linked with each other only."""
    at = lambda deg, dim=0: [float(np.cos(np.radians(deg))) if k == dim else float(np.sin(np.radians(deg))) if k == dim + 1 else 0.0 for k in range(8)]
    rows = [(3, at(0)), (None, at(20)), (1, at(40)), (None, at(0, 4)), (None, at(5, 4)), (7, at(90, 4))]
    assert found(table(spark, rows)) == sorted(
        [(3, 1, 1, False), (None, 2, 1, False), (1, 1, 1, True), (None, 1, None, True), (None, 1, None, True), (7, 0, 7, True)], key=str)


def test_every_length_is_joined(spark):
    parts, rows, want = [(64, 500), (8, 300), (3, 120), (1, 6), (30, 2)], [], []
    for k, (dim, n) in enumerate(parts):
        own = [(10_000 * k + i, v) for i, v in clusters(dim, n, dim, 6, 0.3)]
        own.append((10_000 * k + 9999, own[0][1]))  # an identical vector of the same length
        rows += own
        want += brute(own, 0.9)
    got = found(table(spark, rows), block_rows=32, sample=400)
    assert got == sorted(want, key=str) and all(any(i // 10_000 == k and n for i, n, *_ in got) for k in range(len(parts)))


def test_blocks_are_dealt_out_by_groups(spark, monkeypatch):
    """One cluster, so that every block meets every other: a block goes to a task for each group, not for each block."""
    kept, write = {}, E.materialize
    monkeypatch.setattr(E, "materialize", lambda df, name: kept.setdefault(name, write(df, name)))
    rows = clusters(11, 1200, 16, 1, 0.3)
    assert found(table(spark, rows), block_rows=16, sample=200) == brute(rows, 0.9)
    blocks, pairs, dealt = (kept[n].count() for n in ("grid_blocks", "block_pairs", "tile_blocks"))
    assert blocks > 30 and pairs * 4 > blocks * blocks and dealt * 3 < 2 * pairs


def test_empty_tables(spark):
    df = table(spark, [(1, None), (2, [])])
    assert found(df) == [(1, 0, 1, True), (2, 0, 2, True)]
    assert found(df.limit(0)) == []


def test_distant_intervals_are_skipped():
    """In grid order a sequence of separate clusters joins far fewer leaves than all pairs."""
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal(size=32) + 0.01 * rng.normal(size=(512, 32)) for _ in range(16)])
    x /= np.linalg.norm(x, axis=1)[:, None]
    axes = np.linalg.eigh(np.cov(x.T))[1].T[::-1]
    eps = np.sqrt(0.2)
    y = x @ axes.T
    order = np.lexsort(np.floor(y[:, :8] / eps).T[::-1])
    y = y[order]
    rest = np.sqrt(np.maximum(0, 1 - (y[:, :24] ** 2).sum(1)))
    seq = E.Sequence(np.ascontiguousarray(x[order]).tobytes(), np.hstack([y[:, :24], rest[:, None]]).astype(np.float32).tobytes(),
                     np.ones(len(x), np.int64).tobytes(), len(x))
    n = sum(1 for _ in E.leaf_pairs(seq, seq, eps))
    leaves = len(x) // E.LEAF
    assert n < leaves * (leaves + 1) / 2 / 3
