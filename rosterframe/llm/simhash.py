"""SimHash near-duplicates through a Gray-order hierarchical index.

1. Every text becomes a 64-bit SimHash of its word shingles.
2. Equal fingerprints are merged; from here on only distinct ones are handled.
3. Upper nodes: the 64 bits are cut into ``max_distance + 1`` masks.  Two
   fingerprints within the distance agree on at least one whole mask, so each is
   placed under its masked pattern for every mask and only fingerprints below a
   common pattern are compared.
4. A pattern with more than ``block_rows`` fingerprints is cut into blocks that are
   contiguous in Gray rank.  A block's shared bits (AND equal to OR) are its node;
   pairs of blocks whose shared bits already differ too often are pruned.
5. Inside a task the fingerprints are sorted by Gray rank and a tree of nodes
   is built on them; a pair of nodes is dropped as soon as the differences
   accumulated in their shared bits exceed the distance, or when both already lie
   in one component.  A task returns a spanning forest of the links it found, so
   a large group of near copies never yields all its pairs.
6. Connected components of the forests give the classes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterframe.llm.common import materialize, row_parts, shuffle_partitions
from rosterframe.llm.graph import Labels, components

LEAF, FAN = 32, 8


# ------------------------------------------------------------- fingerprints

def shingle_hashes(text: bytes, shingle: int, seed: int) -> list[int]:
    """XXH64 of every word shingle, repeats included.  ``bytes.lower`` and
    ``bytes.split`` know ASCII letters and ASCII white space only, as the contract asks."""
    words = text.lower().split()
    if not words:
        return []
    joined = b" ".join(words)
    if len(words) <= shingle:
        return [xxhash.xxh64_intdigest(joined, seed)]
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    digest = xxhash.xxh64_intdigest
    return [digest(joined[a:b], seed)
            for a, b in zip(starts[: len(words) - shingle + 1].tolist(), ends[shingle - 1:].tolist())]


def majority_bits(hashes: list[int]) -> int:
    """The bits set in over half of the hashes; 0 for none."""
    n = len(hashes)
    if not n:
        return 0
    counts = np.zeros(64, np.int64)
    values = np.array(hashes, dtype="<u8")
    for at in range(0, n, 1 << 16):
        part = values[at:at + (1 << 16)]
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return int((np.uint64(1) << np.flatnonzero(2 * counts > n).astype(np.uint64)).sum(dtype=np.uint64))


def row_digest(docs: DataFrame) -> list[Column]:
    """128 bits that stand for a whole row, as two longs."""
    cols = row_parts(docs)
    return [F.xxhash64(*cols).alias("w1"), F.xxhash64(F.lit("other half"), *cols).alias("w2")]


def fingerprints(docs: DataFrame, shingle: int = 4, seed: int = 42, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """(doc_id, w1, w2, fp): the SimHash of every row, as a signed long, and a digest of
    the whole row.  Null or blank text: 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.fromiter((majority_bits(shingle_hashes(t, shingle, seed)) if t else 0
                               for t in (x.as_py() for x in b.column(3))), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(fps.view(np.int64))], ["doc_id", "w1", "w2", "fp"])

    src = docs.select(docs[id_col].cast("long").alias("doc_id"), *row_digest(docs), docs[text_col].cast("binary").alias("text"))
    return src.mapInArrow(run, "doc_id long, w1 long, w2 long, fp long")


# ------------------------------------------------------------------- index

def gray_rank(x: np.ndarray) -> np.ndarray:
    """Position of each code word in the reflected Gray sequence."""
    r = x.copy()
    for s in (1, 2, 4, 8, 16, 32):
        r ^= r >> np.uint64(s)
    return r


def gray_links(fps: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links (at most ``distance`` differing bits) among
    distinct uint64 fingerprints, found through a Gray-ordered tree of shared bits."""
    x = fps[np.argsort(gray_rank(fps), kind="stable")]
    n = len(x)
    near = np.bitwise_count(x[1:] ^ x[:-1]) <= distance
    at = np.flatnonzero(near)
    left, right = [at], [at + 1]
    labels = Labels(np.concatenate(([0], np.cumsum(~near))))
    # the tree, leaves first: (AND, OR) of every node
    starts = np.arange(0, n, LEAF)
    levels = [(np.bitwise_and.reduceat(x, starts), np.bitwise_or.reduceat(x, starts))]
    while len(levels[-1][0]) > 1:
        lo, hi = levels[-1]
        cut = np.arange(0, len(lo), FAN)
        levels.append((np.bitwise_and.reduceat(lo, cut), np.bitwise_or.reduceat(hi, cut)))

    def uniform() -> tuple[np.ndarray, np.ndarray]:
        return np.minimum.reduceat(labels.of, starts), np.maximum.reduceat(labels.of, starts)

    def alive(level: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        lo, hi = levels[level]
        shared = ~(lo[a] ^ hi[a]) & ~(lo[b] ^ hi[b])
        return np.bitwise_count((lo[a] ^ lo[b]) & shared) <= distance

    a = b = np.zeros(1, np.int64)
    for level in range(len(levels) - 1, 0, -1):
        below = len(levels[level - 1][0])
        da, db = np.divmod(np.arange(FAN * FAN), FAN)
        ca, cb = (a[:, None] * FAN + da).ravel(), (b[:, None] * FAN + db).ravel()
        ok = (ca <= cb) & (cb < below)
        a, b = ca[ok], cb[ok]
        ok = alive(level - 1, a, b)
        a, b = a[ok], b[ok]
    padded = np.concatenate([x, np.zeros(-n % LEAF, np.uint64)]).reshape(-1, LEAF)
    lowest, highest = uniform()
    for at in range(0, len(a), 2048):
        pa_, pb = a[at:at + 2048], b[at:at + 2048]
        ok = ~((lowest[pa_] == highest[pa_]) & (lowest[pb] == highest[pb]) & (lowest[pa_] == lowest[pb]))
        pa_, pb = pa_[ok], pb[ok]
        if not pa_.size:
            continue
        k, i, j = np.nonzero(np.bitwise_count(padded[pa_][:, :, None] ^ padded[pb][:, None, :]) <= distance)
        i, j = pa_[k] * LEAF + i, pb[k] * LEAF + j
        ok = (i < j) & (j < n)
        i, j = i[ok], j[ok]
        used = labels.merge(i, j)
        if used.size:
            left.append(i[used])
            right.append(j[used])
            lowest, highest = uniform()
    i, j = np.concatenate(left), np.concatenate(right)
    return x[i], x[j]


def _groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[np.ndarray]:
    """The last column of every run of rows with equal leading ``keys`` columns; a run may
    cross batches."""
    held, held_key = [], None
    for b in batches:
        if not b.num_rows:
            continue
        cols = [c.to_numpy(zero_copy_only=False) for c in b.columns]
        change = np.zeros(b.num_rows - 1, bool)
        for c in cols[:keys]:
            change |= c[1:] != c[:-1]
        bounds = np.concatenate(([0], np.flatnonzero(change) + 1, [b.num_rows]))
        for s, e in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            key = tuple(c[s] for c in cols[:keys])
            if held and key != held_key:
                yield np.concatenate(held)
                held = []
            held.append(cols[-1][s:e])
            held_key = key
    if held:
        yield np.concatenate(held)


def _gray_rank_column(fp):
    r = fp
    for s in (1, 2, 4, 8, 16, 32):
        r = r.bitwiseXOR(F.shiftrightunsigned(r, s))
    return r.bitwiseXOR(F.lit(-(1 << 63)))  # signed order equals the unsigned one


def links(fps: DataFrame, max_distance: int = 4, block_rows: int = 8192) -> DataFrame:
    """Distinct fingerprints (fp) -> spanning forests (u, v) of the links at
    ``max_distance`` bits or fewer: no component is split, no pair is farther."""
    spark = fps.sparkSession
    n_masks = max_distance + 1
    cuts = [64 * k // n_masks for k in range(n_masks + 1)]
    nodes = [F.struct(F.lit(k).cast("byte").alias("mask"),
                      F.shiftrightunsigned("fp", lo).bitwiseAND(F.lit((1 << (hi - lo)) - 1)).alias("pattern"))
             for k, (lo, hi) in enumerate(zip(cuts[:-1], cuts[1:]))]
    placed = (fps.select("fp", F.explode(F.array(*nodes)).alias("n"))
              .select("n.mask", "n.pattern", F.lit(0).alias("bi"), F.lit(0).alias("bj"), "fp"))
    sizes = placed.groupBy("mask", "pattern").agg(F.count("*").alias("size")).where(F.col("size") > block_rows)
    hot = materialize(sizes, "hot_nodes")
    largest = hot.agg(F.max("size")).first()[0]
    if largest:
        placed = _split(placed, hot, -(-largest // block_rows), max_distance, block_rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for values in _groups(batches, 4):
            if len(values) < 2:
                continue
            u, v = gray_links(values.view(np.uint64), max_distance)
            if len(u):
                yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], ["u", "v"])

    return (placed.repartition(shuffle_partitions(spark), "mask", "pattern", "bi", "bj")
            .sortWithinPartitions("mask", "pattern", "bi", "bj")
            .mapInArrow(run, "u long, v long"))


def _split(placed: DataFrame, hot: DataFrame, most: int, max_distance: int, block_rows: int) -> DataFrame:
    """Cut the nodes in ``hot`` into Gray-contiguous blocks of about ``block_rows`` and
    place their rows once for each pair of blocks that the shared bits don't rule out."""
    on = ["mask", "pattern"]
    rank = _gray_rank_column(F.col("fp"))
    own = placed.join(hot, on).withColumn("rank", rank)
    quantiles = (own.groupBy(*on).agg(
        F.percentile_approx("rank", [k / most for k in range(1, most)], max(10_000, 100 * most)).alias("cuts"),
        F.max("size").alias("size")))
    n_blocks = F.ceil(F.col("size") / block_rows)
    block = F.floor(F.size(F.filter("cuts", lambda c: c < F.col("rank"))) * n_blocks / F.lit(most)).cast("int")
    rows = materialize(own.drop("size").join(quantiles, on).select(*on, block.alias("block"), "fp"), "hot_rows")
    blocks = rows.groupBy(*on, "block").agg(F.expr("bit_and(fp)").alias("lo"), F.expr("bit_or(fp)").alias("hi"))
    b = blocks.select(*on, F.col("block").alias("bj"), F.col("lo").alias("lo2"), F.col("hi").alias("hi2"))
    shared = F.bitwise_not(F.col("lo").bitwiseXOR(F.col("hi"))).bitwiseAND(F.bitwise_not(F.col("lo2").bitwiseXOR(F.col("hi2"))))
    pairs = (blocks.withColumnRenamed("block", "bi").join(b, on).where("bi <= bj")
             .where(F.bit_count(F.col("lo").bitwiseXOR(F.col("lo2")).bitwiseAND(shared)) <= max_distance)
             .select(*on, "bi", "bj"))
    sides = pairs.select(*on, "bi", "bj", F.explode(F.array_distinct(F.array("bi", "bj"))).alias("block"))
    dealt = rows.join(sides, [*on, "block"]).select(*on, "bi", "bj", "fp")
    return placed.join(hot, on, "left_anti").unionByName(dealt)


# --------------------------------------------------------------- operators

def _classes(docs: DataFrame, shingle: int, max_distance: int, seed: int, block_rows: int, id_col: str,
             text_col: str) -> DataFrame:
    """(doc_id, w1, w2, fp, root, component_id) for every row."""
    marked = materialize(fingerprints(docs, shingle, seed, id_col, text_col), "fingerprints")
    distinct = materialize(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct_fps")
    roots = components(links(distinct.select("fp"), max_distance, block_rows))
    member = (distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
              .select("fp", "least", F.coalesce("root", "fp").alias("root")))
    named = member.groupBy("root").agg(F.min("least").alias("component_id"))
    return marked.join(member.join(named, "root").select("fp", "root", "component_id"), "fp")


def simhash_classes(docs: DataFrame, shingle: int = 4, max_distance: int = 4, seed: int = 42,
                    block_rows: int = 8192, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: (doc_id, fingerprint, component_id).

    ``fingerprint`` has 16 lowercase hex digits; ``component_id`` is the smallest
    doc_id that is reached over links of at most ``max_distance`` differing bits.

    - Null, empty or blank text: fingerprint zero, linked like any other.
    - Null doc_id: the row takes part and is returned; it never names a component
      (a component with no other id has a null component_id).
    - Repeated rows are returned as often as they come.  Empty table: no rows.
    - Other columns are not returned, so their names can't clash.
    """
    return (_classes(docs, shingle, max_distance, seed, block_rows, id_col, text_col)
            .select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"))


def one_per_class(docs: DataFrame, shingle: int = 4, max_distance: int = 4, seed: int = 42,
                  block_rows: int = 8192, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each class of near-duplicates: the one with the smallest
    doc_id (a null id only where there is no other); among rows that share it, one and
    always the same.  Nulls, empty texts and empty tables as in ``simhash_classes``."""
    stays = (_classes(docs, shingle, max_distance, seed, block_rows, id_col, text_col)
             .groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "w1", "w2")).alias("m"))
             .select("m.w1", "m.w2"))
    rows = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("row"), *row_digest(docs))
    # the rows travel once: what is left of repeated rows is dropped where the join put them
    return rows.join(stays, ["w1", "w2"], "left_semi").dropDuplicates(["w1", "w2"]).select("row.*")
