"""Sequence packing by minimum bin slack.

Documents are tokenised, ended by ``end_id`` and cut into pieces of at most
``capacity`` tokens.  What has to be planned is only how many pieces there are of each
length: a histogram of at most ``capacity`` rows, whatever the corpus.  Minimum bin
slack (Gupta and Ho, 1999) on the histogram: each bin takes the longest piece left, and
a bitset subset-sum over the lengths still available finds the fullest completion; the
combination is then removed.  As long as the counts allow, the same search would return
the same combination, so it is removed as many times as they allow; every such step
uses up a length, hence there are few more steps than lengths.

Every piece then gets its rank among the pieces of its length and looks up its bin and
place.  Ranks are numbered within salted parts of a length, plus the counts of the parts
before, so that a length shared by a third of all pieces is no single task.
"""

from __future__ import annotations

import json
import random
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rosterframe.llm.common import materialize

CAPACITY, END_ID = 1024, 2


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


# ------------------------------------------------------------------- ids

def _byte_alphabet() -> dict[str, int]:
    """The printable stand-in of each byte in byte-level vocabularies: printable Latin-1
    characters stand for themselves, the rest for the code points from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


def encoder(path: str) -> Callable[[str], np.ndarray]:
    """Text -> ids, as ``tokenizers`` gives them for this file without adding special tokens.

    For a plain byte-level BPE file whose merges are in the order of the ids, the file's
    vocabulary is run by ``tiktoken``, which gives the same ids about four times as fast;
    any other file is run by ``tokenizers`` itself."""
    import tiktoken
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    pre, model = spec["pre_tokenizer"] or {}, spec["model"]
    vocab, added = model["vocab"], {t["content"]: t["id"] for t in spec["added_tokens"]}
    merged = [vocab["".join(m.split(" ") if isinstance(m, str) else m)] for m in model.get("merges", [])]
    plain = (model["type"] == "BPE" and not spec["normalizer"] and pre.get("type") == "ByteLevel"
             and not pre.get("add_prefix_space") and pre.get("use_regex", True) and merged == sorted(merged)
             and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix",
                                                "byte_fallback", "ignore_merges"))
             and all(t["special"] and not any(t[k] for k in ("lstrip", "rstrip", "single_word", "normalized"))
                     for t in spec["added_tokens"]))
    if not plain:
        tok = Tokenizer.from_file(path)
        return lambda text: np.array(tok.encode(text, add_special_tokens=False).ids, np.uint32)
    byte = _byte_alphabet()
    ranks = {bytes(byte[c] for c in t): i for t, i in vocab.items() if t not in added}
    enc = tiktoken.Encoding("file", pat_str=BYTE_LEVEL_SPLIT, mergeable_ranks=ranks, special_tokens=added)
    return lambda text: enc.encode_to_numpy(text, allowed_special="all")


#: Fixed value: how byte-level BPE vocabularies of this kind split a text.
BYTE_LEVEL_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


# ----------------------------------------------------------------- pieces

def piece_bounds(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n tokens: only the first may be shorter."""
    first = n - (n - 1) // capacity * capacity
    return [(0, first), *((s, capacity) for s in range(first, n, capacity))]


def pieces(docs: DataFrame, capacity: int = CAPACITY, tokenizer_path: str | None = None, end_id: int = END_ID,
           id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]) of every row; a null text is empty
    and gives the single token ``end_id``."""
    path = tokenizer_path or default_tokenizer()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        for b in batches:
            out: list[tuple] = []
            for i, text in zip(b.column(0).to_pylist(), b.column(1)):
                ids = np.append(encode(text.as_py() or ""), end_id).astype("<u4")
                out += [(i, k, s, n, zlib.crc32(ids[s:s + n]), ids[s:s + n] if with_ids else None)
                        for k, (s, n) in enumerate(piece_bounds(len(ids), capacity))]
            cols = list(zip(*out)) if out else [()] * 6
            arrays = [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int32()),
                      *(pa.array(c, pa.int64()) for c in cols[2:5])]
            if with_ids:
                arrays.append(pa.array(cols[5], pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(arrays, [*NAMES, *(["ids"] if with_ids else [])])

    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return src.mapInArrow(run, SCHEMA + (", ids array<int>" if with_ids else ""))


NAMES = ["doc_id", "piece", "start", "length", "ids_crc32"]
SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long"


# ------------------------------------------------------------------- plan

def fullest(counts: dict[int, int], order: list[int], capacity: int) -> dict[int, int]:
    """Length -> how often it is in the fullest bin that holds the longest piece.
    ``order`` lists the lengths as the subset-sum tries them: it decides between
    equally full bins."""
    longest = max(counts)
    room = capacity - longest
    mask = (1 << (room + 1)) - 1
    reach, steps = 1, []
    for length in order:
        left = min(counts.get(length, 0) - (length == longest), room // length)
        times = 1
        while left > 0 and not reach >> room & 1:
            times = min(times, left)
            steps.append((length, times, reach))
            reach |= reach << length * times & mask
            left -= times
            times *= 2
        if reach >> room & 1:
            break
    filled = reach.bit_length() - 1
    used = {longest: 1}
    for length, times, before in reversed(steps):
        if not before >> filled & 1:
            used[length] = used.get(length, 0) + times
            filled -= length * times
    return used


def _plan(histogram: dict[int, int], order: list[int], capacity: int) -> list[tuple[int, dict[int, int]]]:
    counts = {n: c for n, c in histogram.items() if c}
    plan = []
    while counts:
        used = fullest(counts, order, capacity)
        times = min(counts[n] // k for n, k in used.items())
        plan.append((times, used))
        for n, k in used.items():
            counts[n] -= times * k
            if not counts[n]:
                del counts[n]
    return plan


def bin_plan(histogram: dict[int, int], capacity: int, shuffles: int = 5) -> list[tuple[int, dict[int, int]]]:
    """(times, length -> count in each bin), using up the histogram: the plan with the
    fewest bins over a few fixed orders of breaking ties."""
    up = sorted(histogram)
    orders = [up, up[::-1], sorted(up, key=lambda n: -n * histogram[n])]
    orders += [random.Random(k).sample(up, len(up)) for k in range(shuffles)]
    return min((_plan(histogram, o, capacity) for o in orders), key=lambda plan: sum(t for t, _ in plan))


def slots(plan: list[tuple[int, dict[int, int]]]) -> dict[int, np.ndarray]:
    """Length -> rows (first rank, first bin, pieces a bin, first offset), ranks ascending."""
    out: dict[int, list] = {}
    rank: dict[int, int] = {}
    bins = 0
    for times, used in plan:
        offset = 0
        for n, k in sorted(used.items(), reverse=True):
            out.setdefault(n, []).append((rank.get(n, 0), bins, k, offset))
            rank[n] = rank.get(n, 0) + times * k
            offset += n * k
        bins += times
    return {n: np.array(rows, np.int64) for n, rows in out.items()}


# --------------------------------------------------------------- operator

def place(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add (sequence_id, offset) to rows with doc_id, piece, length and ids_crc32.
    ``cut`` is read twice, so it should be stored."""
    per_length = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}  # at most capacity rows
    if not per_length:
        return cut.withColumns({"sequence_id": F.lit(0).cast("long"), "offset": F.lit(0).cast("long")})
    where = slots(bin_plan(per_length, capacity))
    n_salts = max(16, -(-max(per_length.values()) // 2000))
    salted = cut.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(n_salts)))
    before = (salted.groupBy("length", "salt").count()
              .withColumn("before", F.sum("count").over(Window.partitionBy("length").orderBy("salt")) - F.col("count"))
              .drop("count"))
    order = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")
    ranked = (salted.withColumn("rank", F.row_number().over(order).cast("long")).join(before, ["length", "salt"])
              .select(*cut.columns, (F.col("rank") - 1 + F.col("before")).alias("sequence_id"),
                      F.lit(0).cast("long").alias("offset")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = {n: i for i, n in enumerate(b.schema.names)}
            length, rank = (b.column(at[c]).to_numpy() for c in ("length", "sequence_id"))
            bins, offset = np.zeros_like(rank), np.zeros_like(rank)
            for n in np.unique(length).tolist():
                mine = np.flatnonzero(length == n)
                s = where[n][np.searchsorted(where[n][:, 0], rank[mine], "right") - 1]
                bin_, place_ = np.divmod(rank[mine] - s[:, 0], s[:, 2])
                bins[mine], offset[mine] = s[:, 1] + bin_, s[:, 3] + place_ * n
            cols = list(b.columns)
            cols[at["sequence_id"]], cols[at["offset"]] = pa.array(bins), pa.array(offset)
            yield pa.RecordBatch.from_arrays(cols, b.schema.names)

    return ranked.mapInArrow(run, ranked.schema)


def pack(docs: DataFrame, capacity: int = CAPACITY, tokenizer_path: str | None = None, end_id: int = END_ID,
         id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """One row per piece: (doc_id, piece, start, length, ids_crc32[, ids], sequence_id, offset).

    Sequences hold at most ``capacity`` tokens; offsets run without gaps from 0.

    - Null or empty text: one piece of one token (``end_id``).  Null doc_id: kept as null.
    - Repeated rows and ties are pieces of their own.  Empty table: no rows.
    - Other columns are neither read nor returned, so their names can't clash.
    """
    return place(materialize(pieces(docs, capacity, tokenizer_path, end_id, id_col, text_col, with_ids), "pieces"), capacity)
