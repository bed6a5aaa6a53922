"""Connected components of a link table, on Spark.

Alternating large-star / small-star (Kiveris et al., "Connected Components in
MapReduce and Beyond", 2014).  Every step is an aggregate and an equi-join on the
node, so a hub with a third of the links is combined map-side in the aggregate and
split by AQE in the join; no link list is ever gathered in one task.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterframe.llm.common import materialize


def _star(edges: DataFrame) -> DataFrame:
    """Directed (u, v) rows -> the rows with m, the least of u and its v."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    return edges.join(least, "u").select("u", "v", F.least("u", "m").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return (_star(both).where("v > u and v <> m")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    s = _star(down)
    up = s.select("u", F.col("m").alias("v"))
    side = s.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return up.unionByName(side).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """Links (u long, v long) -> (node, root): every linked node with the smallest node
    of its component.  Self links, null ends and repeated links are ignored; a node
    without links is absent.  Each round is written to the shared folder."""
    e = materialize(edges.where("u is not null and v is not null and u <> v")
                    .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                    .distinct(), "links")
    before = _state(e)
    while before[0]:
        e = materialize(_small_star(_large_star(e)), "links")
        after = _state(e)
        if after == before:
            break
        before = after
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)


class Labels:
    """Components among n items, merged in batches of pairs."""

    def __init__(self, label: np.ndarray):
        self.of = label

    def merge(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Unite the pairs; returns the indexes of those that joined two components."""
        la, lb = self.of[a], self.of[b]
        open_ = np.flatnonzero(la != lb)
        if not open_.size:
            return open_
        _, first = np.unique(np.stack([np.minimum(la, lb), np.maximum(la, lb)])[:, open_], axis=1, return_index=True)
        root: dict[int, int] = {}

        def find(x: int) -> int:
            while root.get(x, x) != x:
                root[x] = root.get(root[x], root[x])
                x = root[x]
            return x

        used = []
        for k in open_[first].tolist():
            x, y = find(int(la[k])), find(int(lb[k]))
            if x != y:
                root[max(x, y)] = min(x, y)
                used.append(k)
        to = np.arange(self.of.max() + 1)
        for x in root:
            to[x] = find(x)
        self.of = to[self.of]
        return np.array(used, np.int64)
