"""Classifier: its parts against plain versions, and held-out accuracy."""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import functions as F
from llm_fixtures import docs_of  # noqa: F401

from rosterframe.llm import classifier as Q


def auc(score, y):
    order = np.argsort(score, kind="stable")
    rank = np.empty(len(y))
    rank[order] = np.arange(1, len(y) + 1)
    for v in np.unique(score):
        rank[score == v] = rank[score == v].mean()
    pos = y == 1
    return (rank[pos].sum() - pos.sum() * (pos.sum() + 1) / 2) / (pos.sum() * (~pos).sum())


def test_held_out_accuracy_on_the_table(spark):
    d = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    got = {r.doc_id: r for r in Q.quality_scores(docs, labels).collect()}
    assert len(got) == docs.count()
    for r in got.values():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7)
    seen = [(got[r.doc_id].score, r.quality) for r in labels.collect() if got[r.doc_id].held_out]
    score, y = map(np.array, zip(*seen))
    assert len(y) > 800 and auc(score, y) > 0.97
    assert ((score >= 0.7) == (y == 1)).mean() > 0.97 and (score[y == 1] >= 0.7).mean() > 0.98


def test_held_out_labels_teach_nothing(spark):
    d = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    flipped = labels.withColumn("quality", F.when(Q.fold(F.col("doc_id")) == 2, 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = ({r.doc_id: r.score for r in Q.quality_scores(docs, x).collect()} for x in (labels, flipped))
    assert max(abs(a[k] - b[k]) for k in a) < 1e-6


def test_normal_equations_equal_the_plain_fit(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, Q.N_STATS)) * rng.uniform(0.5, 9, Q.N_STATS) + 3
    y = (x[:, 0] > 3).astype(float)
    f = np.arange(300) % 4
    rows = [(r.tolist(), float(v), int(k)) for r, v, k in zip(x, y, f) if k != 2]
    m = Q.train(spark.createDataFrame(rows, "x array<double>, y double, fold long").repartition(5), 40, 1e-3, 3)
    fit = (f == 0) | (f == 1)
    z = m.features(x[fit])
    assert np.allclose(m.features.mean, x[fit].mean(0)) and np.allclose(m.features.scale, x[fit].std(0))
    p = 1e-3 * fit.sum() / 41 * np.eye(41)
    p[-1, -1] = 1e-9 * fit.sum()
    assert np.allclose(m.beta, np.linalg.solve(z.T @ z + p, z.T @ y[fit]), atol=1e-6)
    assert (np.diff(m.levels) >= 0).all() and auc(m.score(x[f == 2]), y[f == 2]) > 0.85


def test_fourier_features_approximate_the_kernel():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(40, 6))
    z = Q.Features(np.zeros(6), np.ones(6), 20_000, 1)(x)[:, :-1]
    kernel = np.exp(-((x[:, None] - x[None]) ** 2).sum(-1) / (2 * 6))
    assert abs(z @ z.T - kernel).max() < 0.05


def test_isotonic_equals_brute_force():
    rng = np.random.default_rng(9)
    for _ in range(30):
        v, w = rng.random(8), rng.integers(1, 5, 8).astype(float)
        # max over starts of min over ends of the weighted mean
        mean = lambda i, j: (v[i:j + 1] * w[i:j + 1]).sum() / w[i:j + 1].sum()
        want = [max(min(mean(i, j) for j in range(k, 8)) for i in range(k + 1)) for k in range(8)]
        assert np.allclose(Q.isotonic(v, w), want)


def test_edge_cases(spark, docs_of):
    long = " ".join(f"w{k}" for k in range(300_000))
    rows = [(1, None), (2, ""), (3, " \n"), (4, long), (4, long), (None, "some words"), (5, "THE! BAD! ONE!")]
    docs = docs_of(rows).withColumns({"x": F.lit(1), "score": F.lit(2), "fold": F.lit(3)})
    labels = spark.createDataFrame([(4, 1, 0), (5, 0, 0), (5, 1, 0), (1, None, 0), (None, 0, 0), (77, 0, 0)], "doc_id long, quality int, toxic int")
    got = Q.quality_scores(docs, labels).collect()
    assert len(got) == 7 and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.doc_id in (1, 2, 3)}) == 1 and [r.held_out for r in got if r.doc_id is None] == [False]
    assert {r.score for r in Q.quality_scores(docs, labels.limit(0)).collect()} == {0.5}
    assert Q.quality_scores(docs.limit(0), labels).collect() == []
    one_class = Q.quality_scores(docs_of([(k, f"text {k}") for k in range(40)]), spark.createDataFrame([(k, 1, 0) for k in range(40)], labels.schema))
    assert {r.predicted for r in one_class.collect()} == {1}
