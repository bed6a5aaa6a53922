"""Embedding near-duplicates by epsilon grid order (Boehm, Braunmueller, Krebs and Kriegel,
"Epsilon Grid Order", SIGMOD 2001).

On unit vectors a cosine of at least c is a distance of at most eps = sqrt(2 - 2c).  The
vectors are turned to their principal axes and sorted by the cells of a grid of width
eps on the leading ones.  The sorted sequence is stored in blocks of bounded size; pairs
of blocks are joined, except those whose boxes are provably farther apart than eps.  The
join of two intervals of the sequence halves the longer one and drops pairs whose boxes
are too far apart, down to leaves.  A leaf compares leading coordinates first:
p.q + |rest of p||rest of q| is an upper bound of the cosine, and only pairs that
reach c by it are computed in double precision from the unturned vectors.

Vectors of different lengths are never compared: the length leads the sort order, each length
has axes of its own, and a block holds one length.

Equal vectors are merged before, with their number.  Neighbouring blocks go to a task together, in
two groups; it returns how many vectors each one is linked with and a spanning forest of
the links; pairs of vectors are never listed.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rosterframe.llm.common import materialize, shuffle_partitions
from rosterframe.llm.graph import Labels, components

#: Leading axes that the grid, the boxes and the leaves' bound use.
GRID_AXES, BOX_AXES, BOUND_AXES = 8, 16, 24
LEAF = 256
#: Most blocks on either side of a tile, so that a task holds twice as many.
TILE = 8
#: Lengths, the most frequent ones, that get principal axes; others keep their first coordinates.
AXES_OF = 100
#: Stands for the id of vectors that have none, behind every other.
NO_ID = (1 << 63) - 1
#: Slack of the pruning bounds, above the rounding of the turned single-precision values.
SLACK = 1e-4


# ------------------------------------------------------------ unit vectors

def unit_vectors(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, code, unit): unit vector in double precision and a digest of it; both are null for
    vectors that link with nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column(1)
            dims = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
            codes, units = [None] * b.num_rows, [None] * b.num_rows
            for dim in np.unique(dims[dims > 0]):
                at = np.flatnonzero(dims == dim)
                x = lists.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
                top = np.abs(x).max(axis=1, initial=0.0)
                good = np.isfinite(x).all(axis=1) & (top > 0)
                x, at = x[good], at[good]
                x = x / top[good][:, None]
                x = x / np.sqrt((x * x).sum(axis=1))[:, None] + 0.0  # no negative zeros
                for i, row in zip(at.tolist(), x):
                    units[i] = row.tobytes()
                    codes[i] = hashlib.blake2b(units[i], digest_size=16).digest()
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(codes, pa.binary()), pa.array(units, pa.binary())], ["vec_id", "code", "unit"])

    src = vectors.select(vectors[id_col].cast("long").alias("vec_id"), vectors[vector_col].cast("array<double>").alias("v"))
    return src.mapInArrow(run, "vec_id long, code binary, unit binary")


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(x.as_py() for x in column), np.float64).reshape(-1, dim)


def principal_axes(distinct: DataFrame, n: int, sample: int) -> dict[int, np.ndarray]:
    """For each length the leading orthonormal axes (rows), widest first, of a hash sample of about ``sample``
    vectors of all lengths.  They decide how much is pruned, never what is found."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[bytes]] = {}
        for b in batches:
            for u in b.column(0).to_pylist():
                held.setdefault(len(u) // 8, []).append(u)
        for dim in sorted(held, key=lambda d: (-len(held[d]), d))[:AXES_OF]:
            x = np.frombuffer(b"".join(held[dim]), np.float64).reshape(-1, dim)
            axes = np.linalg.eigh(np.cov(x, rowvar=False, bias=True).reshape(dim, dim))[1].T[::-1][:BOUND_AXES]
            yield pa.RecordBatch.from_arrays([pa.array([dim], pa.int32()), pa.array([np.ascontiguousarray(axes).tobytes()], pa.binary())], ["dim", "axes"])

    share = int(min(1.0, sample / max(1, n)) * (1 << 31))
    rows = (distinct.where(F.pmod(F.xxhash64("code"), F.lit(1 << 31)) < share).select("unit")
            .repartition(1).mapInArrow(run, "dim int, axes binary").collect())
    return {r["dim"]: np.frombuffer(r["axes"], np.float64).reshape(-1, r["dim"]) for r in rows}


# ------------------------------------------------------------------ blocks

def sorted_blocks(distinct: DataFrame, axes: dict[int, np.ndarray], eps: float, block_rows: int) -> DataFrame:
    """The vectors by length and in grid order, up to ``block_rows`` of one length to a row: (block, rows, codes,
    ids, copies, units, turned, lo, hi, dim).  Ties of the grid order are split by the coordinates and the id."""
    names = [f"c{k}" for k in range(GRID_AXES)]

    def axes_of(dim: int) -> np.ndarray:
        return axes[dim] if dim in axes else np.eye(min(BOUND_AXES, dim), dim)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            dims = b.column(4).to_numpy()
            for dim in np.unique(dims).tolist():
                own = b.take(pa.array(np.flatnonzero(dims == dim)))
                lead = _matrix(own.column(3), dim) @ axes_of(dim)[:GRID_AXES].T
                cells = np.zeros((GRID_AXES, len(lead)), np.int32)
                cells[: lead.shape[1]] = np.floor(lead / eps).astype(np.int32).T
                yield pa.RecordBatch.from_arrays([*own.columns, *(pa.array(c) for c in cells), pa.array(lead[:, 0])],
                                                 [*own.schema.names, *names, "along"])

    fields = "code binary, vec_id long, copies long, unit binary, dim int"
    placed = distinct.select("code", "vec_id", "copies", "unit", (F.length("unit") / 8).cast("int").alias("dim")).mapInArrow(
        place, f"{fields}, {', '.join(f'{n} int' for n in names)}, along double")
    order = ["dim", *names, "along", "vec_id", "code"]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, block, held, n = TaskContext.get().partitionId(), 0, [], 0

        def rows(group: list[pa.RecordBatch]) -> pa.RecordBatch:
            t = pa.Table.from_batches(group).combine_chunks()
            dim = t.column("dim")[0].as_py()
            units = _matrix(t.column("unit").combine_chunks(), dim)
            turned = units @ axes_of(dim).T
            box = turned[:, : min(BOX_AXES, dim)]
            rest = np.sqrt(np.maximum(0.0, 1 - (turned[:, :BOUND_AXES] ** 2).sum(axis=1)))
            lead = np.concatenate([turned[:, :BOUND_AXES], rest[:, None]], axis=1).astype(np.float32)
            one = [(part << 32) + block, len(units), b"".join(t.column("code").to_pylist()),
                   t.column("vec_id").to_numpy().tobytes(), t.column("copies").to_numpy().tobytes(),
                   units.tobytes(), lead.tobytes(), box.min(axis=0).tolist(), box.max(axis=0).tolist(), dim]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(one, BLOCK_KINDS)], BLOCK_NAMES)

        for b in batches:
            b = b.select(["code", "vec_id", "copies", "unit", "dim"])
            while b.num_rows:
                dims = b.column(4).to_numpy()
                if held and held[0].column(4)[0].as_py() != dims[0]:
                    yield rows(held)
                    block, held, n = block + 1, [], 0
                take = b.slice(0, min(block_rows - n, int(np.searchsorted(dims, dims[0], "right"))))
                held.append(take)
                n += take.num_rows
                b = b.slice(take.num_rows)
                if n == block_rows:
                    yield rows(held)
                    block, held, n = block + 1, [], 0
        if held:
            yield rows(held)

    packed = (placed.repartitionByRange(shuffle_partitions(distinct.sparkSession), *order)
              .sortWithinPartitions(*order).mapInArrow(pack, BLOCK_SCHEMA))
    return materialize(_merged(materialize(packed, "grid_parts"), block_rows), "grid_blocks")


def _merged(parts: DataFrame, block_rows: int) -> DataFrame:
    """Neighbouring small blocks of one length put together, so that how many partitions the sort had does
    not matter: every block but the last of a length gets between one and two times ``block_rows``
    vectors.  The running sum and the numbers are over one row per stored block."""
    before = F.coalesce(F.sum("rows").over(Window.partitionBy("dim").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    groups = (parts.select("dim", F.col("block").alias("part"), F.floor(before / block_rows).cast("long").alias("w"))
              .select("part", (F.dense_rank().over(Window.orderBy("dim", "w")) - 1).cast("long").alias("whole")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []

        def one() -> pa.RecordBatch:
            values = [held[0]["whole"], sum(r["rows"] for r in held), *(b"".join(r[c] for r in held) for c in BLOCK_NAMES[2:7]),
                      np.min([r["lo"] for r in held], axis=0).tolist(), np.max([r["hi"] for r in held], axis=0).tolist(), held[0]["dim"]]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, BLOCK_KINDS)], BLOCK_NAMES)

        for b in batches:
            for k in range(b.num_rows):
                row = {n: b.column(i)[k].as_py() for i, n in enumerate(b.schema.names)}
                if held and held[0]["whole"] != row["whole"]:
                    yield one()
                    held = []
                held.append(row)
        if held:
            yield one()

    return (parts.join(groups, F.col("block") == F.col("part")).select("whole", *BLOCK_NAMES)
            .repartition(shuffle_partitions(parts.sparkSession), "whole").sortWithinPartitions("whole", "block")
            .mapInArrow(run, BLOCK_SCHEMA))


BLOCK_KINDS = [pa.int64(), pa.int32(), *[pa.binary()] * 5, *[pa.list_(pa.float64())] * 2, pa.int32()]
BLOCK_NAMES = ["block", "rows", "codes", "ids", "copies", "units", "lead", "lo", "hi", "dim"]
BLOCK_SCHEMA = ("block long, rows int, codes binary, ids binary, copies binary, units binary, lead binary, "
                "lo array<double>, hi array<double>, dim int")


def block_pairs(blocks: DataFrame, eps: float) -> DataFrame:
    """(a, b), a <= b: the pairs of blocks of one length whose boxes are within eps of each other.  Blocks meet over
    the cells that they reach into on the first axis; the other axes then add up."""
    cells = F.sequence(F.floor(F.col("lo")[0] / eps), F.floor(F.col("hi")[0] / eps))
    own = blocks.select("dim", "block", "lo", "hi", F.explode(cells).alias("cell"))
    other = (blocks.select("dim", F.col("block").alias("b"), F.col("lo").alias("lo2"), F.col("hi").alias("hi2"),
                           F.explode(cells).alias("at")).withColumn("cell", F.explode(F.array(F.col("at") - 1, F.col("at"), F.col("at") + 1))))
    gap = F.zip_with(F.zip_with("lo", "hi2", lambda x, y: F.greatest(x - y, F.lit(0.0))),
                     F.zip_with("lo2", "hi", lambda x, y: F.greatest(x - y, F.lit(0.0))), lambda x, y: F.greatest(x, y))
    far = F.aggregate(gap, F.lit(0.0), lambda total, x: total + x * x)
    return (own.join(other, ["dim", "cell"]).where("block <= b").where(far <= (eps + SLACK) ** 2)
            .select(F.col("block").alias("a"), "b").distinct())


# -------------------------------------------------------------- join of two

class Sequence:
    """One block in grid order, with boxes of its halves, quarters and so on."""

    def __init__(self, units: bytes, lead: bytes, copies: bytes, rows: int):
        self.units = np.frombuffer(units, np.float64).reshape(rows, -1)
        self.lead = np.frombuffer(lead, np.float32).reshape(rows, -1)
        self.copies = np.frombuffer(copies, np.int64)
        self.boxes: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}

    def box(self, s: int, e: int) -> tuple[np.ndarray, np.ndarray]:
        if (s, e) not in self.boxes:
            x = self.lead[s:e, : min(BOX_AXES, self.lead.shape[1] - 1)]
            self.boxes[s, e] = x.min(axis=0), x.max(axis=0)
        return self.boxes[s, e]


def leaf_pairs(a: Sequence, b: Sequence, eps: float) -> Iterator[tuple[int, int, int, int]]:
    """Pairs of intervals of at most LEAF vectors that may hold a link."""
    todo = [(0, len(a.units), 0, len(b.units))]
    while todo:
        s, e, t, f = todo.pop()
        if a is b and f <= s:
            continue  # the mirror image
        (lo, hi), (lo2, hi2) = a.box(s, e), b.box(t, f)
        gap = np.maximum(0, np.maximum(lo - hi2, lo2 - hi))
        if float(gap @ gap) > (eps + SLACK) ** 2:
            continue
        if e - s <= LEAF and f - t <= LEAF:
            yield s, e, t, f
        elif e - s >= f - t:
            m = (s + e) // 2
            todo += [(s, m, t, f), (m, e, t, f)]
        else:
            m = (t + f) // 2
            todo += [(s, e, t, m), (s, e, m, f)]


def join_blocks(a: Sequence, b: Sequence, cosine: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Linked copies of each vector of a and of b (the other's share, itself excluded), and a
    spanning forest as indexes, those of b counted on from a's."""
    eps = math.sqrt(2 - 2 * cosine)
    na, shift = len(a.units), 0 if a is b else len(a.units)
    degree = np.zeros(na + (0 if a is b else len(b.units)), np.int64)
    labels = Labels(np.arange(len(degree)))
    left, right = [], []
    for s, e, t, f in leaf_pairs(a, b, eps):
        i, j = np.nonzero(a.lead[s:e] @ b.lead[t:f].T >= cosine - SLACK)
        if a is b:
            own = i + s < j + t
            i, j = i[own], j[own]
        if not i.size:
            continue
        i, j = i + s, j + t
        ok = np.einsum("ij,ij->i", a.units[i], b.units[j]) >= cosine
        i, j = i[ok], j[ok]
        np.add.at(degree, i, b.copies[j])
        np.add.at(degree, j + shift, a.copies[i])
        used = labels.merge(i, j + shift)
        left.append(i[used])
        right.append(j[used] + shift)
    empty = np.zeros(0, np.int64)
    return degree[:na], degree[na:] if shift else empty, np.concatenate([empty, *left]), np.concatenate([empty, *right])


def _node(block: int, rows: int) -> np.ndarray:
    """Node numbers of a block's vectors."""
    return (block << 21) + np.arange(rows)


def tile_blocks(pairs: DataFrame, side: int) -> DataFrame:
    """(tile, block): the pairs of blocks, gathered into pairs of groups of ``side`` neighbouring blocks.  Tiles are
    numbered from 0; the numbering is over one row per tile."""
    near = pairs.select("a", "b", F.expr(f"a div {side}").alias("ga"), F.expr(f"b div {side}").alias("gb"))
    numbers = near.select("ga", "gb").distinct().select("ga", "gb", (F.row_number().over(Window.orderBy("ga", "gb")) - 1).alias("tile"))
    return near.join(numbers, ["ga", "gb"]).select("tile", "ga", "gb", F.explode(F.array("a", "b")).alias("at")).distinct()


def join_tile(rows: list[dict], side: int, cosine: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The links between the two groups of a tile, as (nodes, linked copies of each, and a spanning forest's ends)."""
    rows = sorted(rows, key=lambda r: r["block"])
    sequences = [Sequence(r["units"], r["lead"], r["copies"], r["rows"]) for r in rows]
    at = np.cumsum([0, *(r["rows"] for r in rows)])
    node = np.concatenate([_node(r["block"], r["rows"]) for r in rows])
    degree, labels = np.zeros(at[-1], np.int64), Labels(np.arange(at[-1]))
    left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for x, p in enumerate(rows):
        for y in range(x, len(rows)):
            q = rows[y]
            if p["dim"] != q["dim"] or p["block"] // side != p["ga"] or q["block"] // side != p["gb"]:
                continue
            da, db, i, j = join_blocks(sequences[x], sequences[y], cosine)
            degree[at[x]:at[x + 1]] += da
            if x != y:
                degree[at[y]:at[y + 1]] += db
                j = j + at[y] - p["rows"]  # counted on from x's
            else:
                j = j + at[x]
            i = i + at[x]
            if i.size:
                used = labels.merge(i, j)
                left.append(i[used])
                right.append(j[used])
    return node, degree, node[np.concatenate(left)], node[np.concatenate(right)]


def join_links(blocks: DataFrame, cosine: float) -> DataFrame:
    """(u, v, n): a forest's link where v is given, else n linked vectors of u.

    A task gets two groups of blocks and joins each block of one with each of the other, so a block is
    dealt out once for every group it meets, not once for every block."""
    spark = blocks.sparkSession
    pairs = materialize(block_pairs(blocks, math.sqrt(2 - 2 * cosine)), "block_pairs")
    side = min(TILE, max(1, math.isqrt(pairs.count() // shuffle_partitions(spark))))
    tiles = materialize(tile_blocks(pairs, side), "tile_blocks")
    n_tiles = tiles.agg(F.coalesce(F.max("tile"), F.lit(0))).first()[0] + 1
    data = ["block", "rows", "copies", "units", "lead", "dim"]
    dealt = (tiles.join(blocks.select(*data), F.col("at") == F.col("block")).select("tile", "ga", "gb", *data)
             .repartitionById(n_tiles, F.col("tile").cast("int")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[dict]] = {}
        for batch in batches:
            for k in range(batch.num_rows):
                r = {n: batch.column(i)[k].as_py() for i, n in enumerate(batch.schema.names)}
                held.setdefault(r["tile"], []).append(r)
        for rows in held.values():
            node, degree, i, j = join_tile(rows, side, cosine)
            some = np.flatnonzero(degree)
            u, v = np.concatenate([i, node[some]]), np.concatenate([j, np.zeros(len(some), np.int64)])
            n = np.concatenate([np.zeros(len(i), np.int64), degree[some]])
            is_link = np.arange(len(u)) < len(i)
            yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v, mask=~is_link), pa.array(n, mask=is_link)], ["u", "v", "n"])

    return materialize(dealt.mapInArrow(run, "u long, v long, n long"), "vector_links")


# ---------------------------------------------------------------- operator

def embedding_classes(vectors: DataFrame, cosine: float = 0.9, block_rows: int = 4096, sample: int = 10_000,
                      id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row per input row: (vec_id, n_links, component_id, kept).

    Two vectors are linked if their cosine in double precision is at least ``cosine`` (0.5 or more).
    ``n_links`` counts the other rows that a row is linked with, ``component_id`` is the
    smallest vec_id reachable, ``kept`` says that it is the row's own.

    - Vectors link within their length only; every length is joined.
    - Null, empty and zero vectors and null or non-finite components link with nothing.
    - A row with a null vec_id is linked like any other and never names a component; it is kept
      only where its component has no vec_id at all (component_id null).
    - Repeated rows are vectors of their own and linked with each other.
    - Empty table: no rows.  Other columns aren't read, so their names can't clash.
    """
    units = materialize(unit_vectors(vectors, id_col, vector_col), "unit_vectors")
    distinct = materialize(units.where("code is not null").groupBy("code").agg(
        F.coalesce(F.min("vec_id"), F.lit(NO_ID)).alias("vec_id"), F.count("*").alias("copies"), F.min("unit").alias("unit")), "distinct_vectors")
    axes = principal_axes(distinct, distinct.count(), sample)
    blocks = sorted_blocks(distinct, axes, math.sqrt(2 - 2 * cosine), min(block_rows, 1 << 20))  # two of them fit a node number
    found = join_links(blocks, cosine)
    roots = components(found.select("u", "v"))

    def nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for block, rows, codes, ids, copies in zip(*(c.to_pylist() for c in b.columns)):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(_node(block, rows)), pa.array([codes[k:k + 16] for k in range(0, 16 * rows, 16)], pa.binary()),
                     pa.array(np.frombuffer(ids, np.int64)), pa.array(np.frombuffer(copies, np.int64))], ["node", "code", "least", "copies"])

    own = materialize(blocks.select("block", "rows", "codes", "ids", "copies")
                      .mapInArrow(nodes, "node long, code binary, least long, copies long"), "nodes")
    degree = found.where("v is null").groupBy(F.col("u").alias("node")).agg(F.sum("n").alias("n"))
    member = own.join(roots, "node", "left").join(degree, "node", "left").select(
        "code", "least", F.coalesce("root", "node").alias("root"), (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    named = member.groupBy("root").agg(F.min(F.when(F.col("least") != NO_ID, F.col("least"))).alias("component_id"))
    classes = member.join(named, "root").select("code", "n_links", "component_id")
    return units.select("vec_id", "code").join(classes, "code", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
        F.col("vec_id").eqNullSafe(F.coalesce("component_id", "vec_id")).alias("kept"))
