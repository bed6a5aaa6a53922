"""Phrase collocations by direct-address tiling.

Texts become chunks: streams of small integer codes with a gap between pieces, and the
chunk's dictionary.  One level of the mining counts adjacent pairs in the streams:

1. The items of a level (words at first) are counted over the corpus, and every chunk's
   stream is recoded: the frequent items of the chunk are ranked by their frequency in the
   corpus, rarer ones become gaps.
2. In each chunk the matrix of adjacent ranks is cut into square tiles.  Since ranks
   follow frequency, the tiles of the first ranks are dense: those are counted by one
   ``bincount`` over their cells.  Entries of sparse tiles are sorted as coordinates
   and counted by runs.
3. A pair's counts are summed over the chunks.

Frequent pairs are the items of the next level: a stream of overlapping pairs whose neighbours
are phrases of three words, and so on.  A phrase's parts are at least as frequent as it is, so
dropping rare items loses no frequent phrase.

Chunks have a bounded number of tokens, so what a task holds is bounded; counts are shuffled as
rows, by the item they count.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rosterframe.llm.common import materialize

#: Ends of pieces all become "."; a tab is a blank like any other.
_MARKS = bytes.maketrans(b",;:!?\n\x0b\x0c\r\t", b"." * 9 + b" ")
_MARK, _CUT = re.compile(rb"\."), re.compile(rb"[ .]")
_SLICE = 1 << 20
#: A tile has TILE x TILE cells; with at least DENSE entries its cells are counted directly.
TILE, DENSE, TILES_AT_ONCE = 512, 1 << 14, 16

CHUNK = "chunk long, words array<struct<lang:string,word:string,n:long>>, codes binary"
STREAM = "chunk long, ids array<long>, codes binary"


# ------------------------------------------------------------------ chunks

def token_lists(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text in order, b"." between pieces, in lists of bounded length."""
    text = text.lower().translate(_MARKS)  # bytes.lower knows A-Z only
    at = 0
    while at < len(text):
        near = min(len(text), at + _SLICE)
        cut = _MARK.search(text, near, near + _SLICE) or _CUT.search(text, near)
        end = cut.end() if cut else len(text)
        yield text[at:end].replace(b".", b" . ").split()
        at = end


class _Chunk:
    """Codes of (language, word) in order of their first use, from 1; 0 is the gap."""

    def __init__(self):
        self.size, self.codes = 0, []
        fresh = count(1).__next__
        self.of = defaultdict(lambda: defaultdict(fresh, {b".": 0}))

    def add(self, lang: str, words: list[bytes]) -> None:
        known = self.of[lang]
        self.codes.append(np.fromiter(map(known.__getitem__, words), np.int32, len(words)))
        self.size += len(words)

    def end(self) -> None:
        self.codes.append(np.zeros(1, np.int32))

    def at_gap(self) -> bool:
        return bool(self.codes) and self.codes[-1].size > 0 and self.codes[-1][-1] == 0

    def batch(self, number: int) -> pa.RecordBatch:
        codes = without_runs(np.concatenate(self.codes), 0)
        found = sorted((c, lang, w) for lang, known in self.of.items() for w, c in known.items() if c)
        n = np.bincount(codes, minlength=len(found) + 1)[1:]
        words = pa.StructArray.from_arrays([pa.array([x[1] for x in found], pa.string()), pa.array([x[2] for x in found], pa.binary()).cast(pa.string()),
                                            pa.array(n, pa.int64())], ["lang", "word", "n"])
        return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.ListArray.from_arrays(pa.array([0, len(found)], pa.int32()), words),
                                           pa.array([codes.tobytes()], pa.binary())], ["chunk", "words", "codes"])


def without_runs(codes: np.ndarray, gap: int) -> np.ndarray:
    """One gap in place of several."""
    empty = codes == gap
    return codes[~(empty & np.concatenate(([True], empty[:-1])))] if codes.size else codes


def chunks(docs: DataFrame, lang: Column, text_col: str, chunk_tokens: int) -> DataFrame:
    """Chunks of about ``chunk_tokens`` words.  A chunk ends between pieces, so only a piece
    longer than that makes a larger one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, made, chunk = TaskContext.get().partitionId() << 32, 0, _Chunk()
        for b in batches:
            for name, text in zip(b.column(0), b.column(1)):
                name = name.as_py()
                for words in token_lists(text.as_py() or b""):
                    chunk.add(name, words)
                    if chunk.size >= chunk_tokens and chunk.at_gap():
                        yield chunk.batch(first + made)
                        made, chunk = made + 1, _Chunk()
                chunk.end()
                if chunk.size >= chunk_tokens:
                    yield chunk.batch(first + made)
                    made, chunk = made + 1, _Chunk()
        if chunk.size:
            yield chunk.batch(first + made)

    return docs.select(lang, docs[text_col].cast("binary")).mapInArrow(run, CHUNK)


# ------------------------------------------------------------------- tiles

def count_adjacent(codes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of adjacent codes (below ``size``; -1 is a gap) with their counts."""
    a, b = codes[:-1].astype(np.int64), codes[1:].astype(np.int64)
    ok = (a >= 0) & (b >= 0)
    a, b = a[ok], b[ok]
    side = -(-size // TILE)
    tile = a // TILE * side + b // TILE
    tiles, tile, entries = np.unique(tile, return_inverse=True, return_counts=True)
    dense = np.flatnonzero(entries >= DENSE)
    place = np.full(len(tiles), -1)
    place[dense] = np.arange(len(dense))
    place = place[tile]
    cell = a % TILE * TILE + b % TILE
    out = []
    for lo in range(0, len(dense), TILES_AT_ONCE):
        some = dense[lo:lo + TILES_AT_ONCE]
        mine = (place >= lo) & (place < lo + len(some))
        n = np.bincount((place[mine] - lo) * TILE * TILE + cell[mine], minlength=len(some) * TILE * TILE)
        hit = np.flatnonzero(n)
        at, inside = tiles[some][hit // (TILE * TILE)], hit % (TILE * TILE)
        out.append((at // side * TILE + inside // TILE, at % side * TILE + inside % TILE, n[hit]))
    rest = place < 0
    pairs, n = np.unique(a[rest] * size + b[rest], return_counts=True)
    out.append((pairs // max(1, size), pairs % max(1, size), n))
    return tuple(np.concatenate(x) for x in zip(*out))


def pair_counts(streams: DataFrame) -> DataFrame:
    """(chunk, a, b, n): how often b follows a in a chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for chunk, ids, codes in zip(b.column(0), b.column(1), b.column(2)):
                ids = ids.values.to_numpy()
                first, second, n = count_adjacent(np.frombuffer(codes.as_buffer(), np.int32), len(ids))
                for lo in range(0, len(n), 1 << 17):
                    part = slice(lo, lo + (1 << 17))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(n[part]), chunk.as_py())), *(pa.array(x) for x in (ids[first[part]], ids[second[part]], n[part]))],
                        ["chunk", "a", "b", "n"])

    return streams.select("chunk", "ids", "codes").mapInArrow(run, "chunk long, a long, b long, n long")


# ---------------------------------------------------------------- recoding

def _stream(chunk: int, known: pa.Table, order: np.ndarray, codes: np.ndarray) -> pa.Table:
    """``order``: the rows of ``known`` from the most to the least frequent; codes are places in it."""
    ids = known["id"].to_numpy()[order]
    return pa.table({"chunk": pa.array([chunk], pa.int64()), "ids": pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), pa.array(ids, pa.int64())),
                     "codes": pa.array([without_runs(codes, -1).astype(np.int32).tobytes()], pa.binary())})


def _by_frequency(known: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """(rows from the most to the least frequent, each row's rank)."""
    order = np.lexsort((known["id"].to_numpy(), -known["f"].to_numpy()))
    rank = np.empty(len(order), np.int32)
    rank[order] = np.arange(len(order), dtype=np.int32)
    return order, rank


_NOTHING = pa.table({"chunk": pa.array([], pa.int64()), "ids": pa.array([], pa.list_(pa.int64())), "codes": pa.array([], pa.binary())})


def _recode_words(stream: pa.Table, known: pa.Table) -> pa.Table:
    """``known``: (chunk, code, id, f) of the chunk's frequent words."""
    if not stream.num_rows or not known.num_rows:
        return _NOTHING
    codes, code = np.frombuffer(stream["codes"][0].as_buffer(), np.int32), known["code"].to_numpy()
    order, rank = _by_frequency(known)
    new = np.full(max(int(codes.max(initial=0)), int(code.max())) + 1, -1, np.int32)
    new[code] = rank
    return _stream(stream["chunk"][0].as_py(), known, order, new[codes])


def _recode_pairs(stream: pa.Table, known: pa.Table) -> pa.Table:
    """``known``: (chunk, a, b, id, f) of the chunk's frequent pairs."""
    if not stream.num_rows or not known.num_rows:
        return _NOTHING
    codes = np.frombuffer(stream["codes"][0].as_buffer(), np.int32).astype(np.int64)
    old = stream["ids"][0].values.to_numpy()
    place = np.argsort(old)
    a, b = (place[np.searchsorted(old, known[c].to_numpy(), sorter=place)] for c in ("a", "b"))
    order, rank = _by_frequency(known)
    by_pair = np.argsort(a * len(old) + b)
    pairs, rank = (a * len(old) + b)[by_pair], rank[by_pair]
    here = np.where((codes[:-1] >= 0) & (codes[1:] >= 0), codes[:-1] * len(old) + codes[1:], -1)
    at = np.minimum(np.searchsorted(pairs, here), len(pairs) - 1)
    return _stream(stream["chunk"][0].as_py(), known, order, np.where(pairs[at] == here, rank[at], -1))


def _frequent(rows: DataFrame, item: list[str], min_count: int, name: str) -> DataFrame:
    """Rows (chunk, item..., n) -> those of frequent items, with the total ``f``, a number ``id`` of
    the item and ``first``, true for one of its rows.  The rows are counts of whole chunks
    already, so an item has one row a chunk at most and one shuffle does it all: the
    item's number is the least of the numbers of its rows."""
    same_item = Window.partitionBy(*item)
    found = (rows.withColumn("row", F.monotonically_increasing_id())
             .withColumns({"f": F.sum("n").over(same_item), "id": F.min("row").over(same_item)}).where(F.col("f") >= min_count))
    return materialize(found.select("chunk", *(c for c in rows.columns if c not in ("chunk", "n")), "f", "id",
                                    (F.col("row") == F.col("id")).alias("first")), name)


def _recoded(streams: DataFrame, frequent: DataFrame, keep: list[str], how, name: str) -> DataFrame:
    known = frequent.select("chunk", *keep, "id", "f")
    return materialize(streams.groupBy("chunk").cogroup(known.groupBy("chunk")).applyInArrow(how, STREAM), name)


# ---------------------------------------------------------------- operator

def collocations(docs: DataFrame, max_words: int = 3, min_count: int = 10, covered_pct: int = 50, top: int = 2000,
                 lang_col: str = "lang", text_col: str = "text", chunk_tokens: int = 1 << 20) -> DataFrame:
    """The best phrases of 2 to ``max_words`` words of each language: lang, rank (from 1),
    phrase, a, l, r, n, score.

    A is lower-cased to a, and so on to Z; pieces end at ``. , ; : ! ?`` and line ends, words at
    blanks and tabs.  n: words of the language; a: occurrences of the phrase inside pieces,
    overlaps included; l, r: those of its two parts at the cut that scores lowest (ties:
    after the fewest words); score: floor(1000000 a^2 / (l r)).  Phrases found less than
    ``min_count`` times are not considered, nor those whose words stand in a longer considered
    phrase that has ``covered_pct`` percent of their occurrences or more.  At most ``top`` a
    language, by score, a (both falling) and phrase (order of UTF-8 bytes).

    - Null or empty text: no words.  Null language: ``und``.
    - Very long texts are cut into slices between words; no phrase is lost at a cut.
    - Repeated rows count every time.  Empty table: no rows.
    - Other columns are not read, so no name can clash.
    """
    lang = F.coalesce(docs[lang_col].cast("string"), F.lit("und"))
    stored = materialize(chunks(docs, lang, text_col, chunk_tokens), "chunks")
    words = stored.select("chunk", F.posexplode("words").alias("at", "x")).select("chunk", (F.col("at") + 1).alias("code"), "x.*")
    n = words.groupBy("lang").agg(F.sum("n").alias("n"))
    frequent = _frequent(words, ["lang", "word"], min_count, "words")
    streams = _recoded(stored.select("chunk", "codes"), frequent, ["code"], _recode_words, "stream1")
    # what a phrase carries: its text, its last word, the counts of its first j and its last j words
    level = materialize(frequent.where("first").select("id", "lang", F.col("word").alias("phrase"), F.col("word").alias("last"), "f",
                                     F.array("f").alias("pre"), F.array("f").alias("post")), "phrases1")
    found = None
    for k in range(2, max_words + 1):
        counts = pair_counts(streams)
        if k < max_words:
            frequent = _frequent(counts, ["a", "b"], min_count, f"pairs{k}")
            streams = _recoded(streams, frequent, ["a", "b"], _recode_pairs, f"stream{k}")
            items = frequent.where("first").select("a", "b", "f", "id")
        else:
            items = materialize(counts.groupBy("a", "b").agg(F.sum("n").alias("f")).where(F.col("f") >= min_count)
                                .withColumn("id", F.lit(None).cast("long")), f"items{k}")
        if found is not None:  # phrases of k - 1 words that a longer one covers
            inside = items.select(F.explode(F.array("a", "b")).alias("id"), "f").groupBy("id").agg(F.max("f").alias("longer"))
            level = level.join(inside, "id", "left").where((F.col("longer").isNull()) | (100 * F.col("longer") < covered_pct * F.col("f")))
            found.append(level.drop("longer"))
        below = level if found is None else whole
        whole = materialize(
            items.join(below.select(F.col("id").alias("a"), "lang", "phrase", "pre"), "a")
            .join(below.select(F.col("id").alias("b"), "last", "post"), "b")
            .select("id", "lang", F.concat_ws(" ", "phrase", "last").alias("phrase"), "last", "f",
                    F.concat("pre", F.array("f")).alias("pre"), F.concat("post", F.array("f")).alias("post")), f"phrases{k}")
        level, found = whole, found or []
    candidates = level
    for other in found or []:
        candidates = candidates.unionByName(other)
    best = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    scored = candidates.select("lang", "phrase", F.col("f").alias("a"), _lowest_cut().alias("cut")).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    # the best of each part of a language first, so that what meets in one task doesn't follow the number of tasks
    parts = scored.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(16)))
    for of in (["lang", "part"], ["lang"]):
        parts = parts.withColumn("rank", F.row_number().over(Window.partitionBy(*of).orderBy(*best))).where(F.col("rank") <= top)
    first = parts
    return first.join(n, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def _lowest_cut() -> Column:
    """Struct (score, k, l, r) of the lowest-scoring cut; the last entries of pre and post
    are the phrase's own count.  Products have up to 38 digits."""

    def cut(k: Column) -> Column:
        left, right = F.get("pre", k - 1), F.get("post", F.size("pre") - k - 1)
        f, lft, rgt = (c.cast("decimal(15,0)") for c in (F.col("f"), left, right))
        score = F.call_function("div", (f * f * F.lit(1_000_000).cast("decimal(7,0)")).cast("decimal(38,0)"), (lft * rgt).cast("decimal(38,0)"))
        return F.struct(score.alias("score"), k.alias("k"), left.alias("l"), right.alias("r"))

    return F.array_min(F.transform(F.sequence(F.lit(1), F.size("pre") - 1), cut))


def oracle(min_count: int = 10, covered_pct: int = 50, top: int = 2000) -> str:
    """DuckDB SQL for phrases of two and three words over ``documents``."""
    return f"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                   '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents),
split AS (SELECT row_number() OVER () AS p, lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS ws FROM pieces),
sizes AS (SELECT lang, CAST(sum(len(ws)) AS BIGINT) AS n FROM split GROUP BY lang),
words AS (SELECT lang, p, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM split),
runs AS (
  SELECT lang, w AS w1, lead(w) OVER one AS w2, lead(w, 2) OVER one AS w3 FROM words WINDOW one AS (PARTITION BY p ORDER BY i)),
f AS (
  SELECT lang, 1 AS k, w1 AS phrase, NULL AS head, NULL AS tail, w1, NULL AS w3, count(*) AS a FROM runs GROUP BY ALL
  UNION ALL
  SELECT lang, 2, w1 || ' ' || w2, NULL, NULL, w1, w2, count(*) FROM runs WHERE w2 IS NOT NULL GROUP BY ALL
  UNION ALL
  SELECT lang, 3, w1 || ' ' || w2 || ' ' || w3, w1 || ' ' || w2, w2 || ' ' || w3, w1, w3, count(*) FROM runs
  WHERE w3 IS NOT NULL GROUP BY ALL HAVING count(*) >= {min_count}),
candidate AS (SELECT * FROM f WHERE k > 1 AND a >= {min_count}),
cuts AS (
  SELECT c.lang, c.phrase, c.a, 1 AS j, l.a AS l, r.a AS r
  FROM candidate c JOIN f l ON l.lang = c.lang AND l.phrase = c.w1 JOIN f r ON r.lang = c.lang AND r.phrase = coalesce(c.tail, c.w3)
  UNION ALL
  SELECT c.lang, c.phrase, c.a, 2, l.a, r.a
  FROM candidate c JOIN f l ON l.lang = c.lang AND l.phrase = c.head JOIN f r ON r.lang = c.lang AND r.phrase = c.w3),
lowest AS (
  SELECT *, CAST((1000000::HUGEINT * a * a) // (l::HUGEINT * r) AS BIGINT) AS score FROM cuts
  QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY (1000000::HUGEINT * a * a) // (l::HUGEINT * r), j) = 1),
covered AS (
  SELECT DISTINCT p.lang, p.phrase FROM candidate p
  JOIN (SELECT lang, unnest([head, tail]) AS phrase, a FROM candidate WHERE k = 3) t ON t.lang = p.lang AND t.phrase = p.phrase
  WHERE 100 * t.a >= {covered_pct} * p.a),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank
  FROM lowest l WHERE NOT EXISTS (SELECT 1 FROM covered c WHERE c.lang = l.lang AND c.phrase = l.phrase))
SELECT r.lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, n, score
FROM ranked r JOIN sizes USING (lang) WHERE rank <= {top}"""
