"""Quality classifier on document statistics.

Random Fourier features (Rahimi and Recht, 2007) approximate a Gaussian kernel over
standardised statistics of the text; ridge regression on them needs only the sums Z'Z and
Z'y, which every partition adds up by itself.  Isotonic regression on labelled rows that
the ridge has not seen turns its output into a score from 0 to 1.

What travels is bounded by the number of features, not of documents: one matrix per
partition, summed in two steps, and the calibration counts of at most ``BINS`` bins.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterframe.llm.common import materialize, shuffle_partitions
from rosterframe.llm.quality_rules import text_stats

#: Byte classes whose share of the characters is a feature.
_SHARES = [b"0123456789", b"#*$%&<>@^~\\{}[]=+_", b"|", b"!?", b".,;:", b"\"'()-"]
N_STATS = 12 + len(_SHARES)
BINS, LOW, HIGH = 2048, -0.5, 1.5


def statistics(text: bytes) -> list[float]:
    """Features of a whole text; an empty one gives zeros."""
    n, chars, symbols, dup, repeat, *_ = text_stats(text)
    words, lines = text.split(), [x for x in text.split(b"\n") if x.strip()]
    found = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    upper, lower, other = found[65:91].sum(), found[97:123].sum(), found[192:].sum()
    kinds = len(set(words))
    lengths = np.fromiter(map(len, words), np.int64, n)
    c, w = max(1, chars), max(1, n)
    return [float(x) for x in (
        math.log1p(n), chars / w, lengths.std() if n else 0.0, math.log1p(lengths.max(initial=0)), symbols / c,
        upper / max(1, upper + lower), other / c, repeat / w, dup / max(1, len(lines)), kinds / w,
        math.log1p(n) - math.log1p(kinds), math.log1p(n / max(1, len(lines))),
        *(found[np.frombuffer(s, np.uint8)].sum() / c for s in _SHARES))]


def with_statistics(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = pa.array([statistics(t.as_py() or b"") for t in b.column(1)], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([b.column(0), x], ["doc_id", "x"])

    src = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("binary").alias("text"))
    return src.mapInArrow(run, "doc_id long, x array<double>")


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 4; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 4


HELD_OUT, CALIBRATION = 2, 3


# --------------------------------------------------------------------- fit

class Features:
    """Standardising and the random Fourier map, the same wherever it is built."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, n_features: int, seed: int):
        rng = np.random.default_rng(seed)
        d = len(mean)
        self.mean, self.scale = mean, scale
        self.w = rng.normal(size=(d, n_features)) / math.sqrt(d)  # kernel width: the square root of d
        self.b = rng.uniform(0, 2 * math.pi, n_features)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        z = np.cos(z @ self.w + self.b) * math.sqrt(2 / len(self.b))
        return np.concatenate([z, np.ones((len(z), 1))], axis=1)


def _rows(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _summed(parts: DataFrame, size: int) -> np.ndarray:
    """Sum of the vectors of doubles in ``s``, in two steps, each task holding one vector."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for b in batches:
            for v in b.column(0):
                total += np.frombuffer(v.as_py(), np.float64)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["s"])

    width = max(1, round(math.sqrt(shuffle_partitions(parts.sparkSession))))
    row = parts.repartition(width).mapInArrow(add, "s binary").repartition(1).mapInArrow(add, "s binary").first()
    return np.frombuffer(row["s"], np.float64)


def _partition_sums(rows: DataFrame, columns: list[str], size: int, term) -> np.ndarray:
    """Sum over all rows of what ``term`` gives for arrays of ``columns``; one vector per partition travels."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = np.zeros(size), False
        for b in batches:
            if b.num_rows:
                total, seen = total + term(*(_rows(c) if pa.types.is_list(c.type) else c.to_numpy(zero_copy_only=False) for c in b.columns)), True
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["s"])

    return _summed(rows.select(*columns).mapInArrow(run, "s binary"), size)


def isotonic(value: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weighted non-decreasing least squares by pooling adjacent violators."""
    pools: list[list[float]] = []
    for v, w in zip(value.tolist(), weight.tolist()):
        pools.append([v, w, 1])
        while len(pools) > 1 and pools[-2][0] >= pools[-1][0]:
            v2, w2, n2 = pools.pop()
            v1, w1, n1 = pools[-1]
            pools[-1] = [(v1 * w1 + v2 * w2) / (w1 + w2), w1 + w2, n1 + n2]
    return np.repeat([p[0] for p in pools], [p[2] for p in pools])


class Model:
    """Scores rows of statistics; a few hundred kilobytes, sent with the tasks."""

    def __init__(self, features: Features, beta: np.ndarray, knots: np.ndarray, levels: np.ndarray):
        self.features, self.beta, self.knots, self.levels = features, beta, knots, levels

    def raw(self, x: np.ndarray) -> np.ndarray:
        return np.clip(self.features(x) @ self.beta, LOW, HIGH)

    def score(self, x: np.ndarray) -> np.ndarray:
        raw = self.raw(x)
        s = np.interp(raw, self.knots, self.levels) if len(self.knots) else raw
        return np.round(np.clip(s, 0.0, 1.0), 9)


def train(labelled: DataFrame, n_features: int, ridge: float, seed: int) -> Model | None:
    """From stored rows (x, y, fold), held-out rows already gone; None without rows to fit."""
    fitted = labelled.where(F.col("fold") != CALIBRATION)
    moments = _partition_sums(fitted, ["x"], 1 + 2 * N_STATS, lambda x: np.concatenate([[len(x)], x.sum(axis=0), (x * x).sum(axis=0)]))
    n = moments[0]
    if not n:
        return None
    mean = moments[1: 1 + N_STATS] / n
    spread = np.sqrt(np.maximum(moments[1 + N_STATS:] / n - mean ** 2, 0))
    features = Features(mean, np.where(spread > 1e-9, spread, 1.0), n_features, seed)
    d = n_features + 1

    def normal(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        z = features(x)
        return np.concatenate([(z.T @ z).ravel(), z.T @ y])

    sums = _partition_sums(fitted, ["x", "y"], d * d + d, normal)
    penalty = ridge * n / d * np.eye(d)
    penalty[-1, -1] = 1e-9 * n  # the intercept is free
    beta = np.linalg.solve(sums[: d * d].reshape(d, d) + penalty, sums[d * d:])
    model = Model(features, beta, np.zeros(0), np.zeros(0))

    def binned(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        raw = model.raw(x)
        at = np.minimum(((raw - LOW) / (HIGH - LOW) * BINS).astype(np.int64), BINS - 1)
        return np.concatenate([np.bincount(at, w, BINS) for w in (np.ones_like(raw), y, raw)])

    count, good, place = _partition_sums(labelled.where(F.col("fold") == CALIBRATION), ["x", "y"], 3 * BINS, binned).reshape(3, BINS)
    some = count > 0
    count, good, place = count[some], good[some], place[some]
    return Model(features, beta, place / count, isotonic(good / count, count) if some.any() else np.zeros(0))


# ---------------------------------------------------------------- operator

def quality_scores(docs: DataFrame, labels: DataFrame, n_features: int = 256, ridge: float = 1e-3, seed: int = 7,
                   threshold: float = 0.7, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: (doc_id, held_out, score, predicted).

    ``labels`` has doc_id and quality (1 or 0).  Rows whose id falls in the held-out fold are
    never learned from; another fold calibrates.  Only the text is an input of a score.

    - Null, empty and blank texts are scored like any other, by the statistics of an empty text.
    - Null id: scored, never held out, never labelled.  Repeated rows get the same score.
    - Null qualities, and documents labelled both ways, teach nothing; without any label all
      scores are 0.5.  Empty table: no rows.
    - Other columns are neither read nor returned, so their names can't clash.
    """
    stats = materialize(with_statistics(docs, id_col, text_col), "statistics")
    known = (labels.where("quality is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
             .agg(F.min("quality").alias("quality"), F.max("quality").alias("most")).where("quality = most")
             .select("doc_id", F.col("quality").cast("double").alias("y"), fold(F.col("doc_id")).alias("fold"))
             .where(F.col("fold") != HELD_OUT))
    model = train(materialize(stats.join(known, "doc_id").select("x", "y", "fold"), "labelled"), n_features, ridge, seed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            score = model.score(_rows(b.column(1))) if model and b.num_rows else np.full(b.num_rows, 0.5)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(score)], ["doc_id", "score"])

    return stats.mapInArrow(run, "doc_id long, score double").select(
        "doc_id", F.coalesce(fold(F.col("doc_id")) == HELD_OUT, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"))
