"""Filter interaction audit by failing-id relations.

One table of row ids is stored for each filter: the rows that fail it.  Whatever is asked of
an order of the filters follows from joins of those tables.  What a step removes depends
on the set of filters before it only, not on their order, so k filters have 2^k prefixes:

- survivors of a prefix: the ids left-anti the tables of its filters;
- removed by the next filter: the survivors left-semi its table;
- redundant: the next filter's table left-semi the tables of the prefix;
- labelled documents lost: the same, from the ids that are left-semi the label's table.

The prefix is a column of the relations.  The ids are dealt out by row id once; prefixes are
exploded behind that shuffle, and every join is on the row id with the test of the prefix as
its condition, so nothing but ids is moved and no id is moved twice.  The row id is the
library's own and differs from row to row, hence no partition is hot.
"""

from __future__ import annotations

import math
from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterframe.llm.common import WORD, materialize, shuffle_partitions

#: More filters would have more orders than a report can hold.
MOST_FILTERS = 7


def text_filters(text: Column, min_words: int = 100, distinct_pct: int = 80, upper_pct: int = 10,
                 symbols: str = "#$%&*|") -> dict[str, Column]:
    """Failure conditions by the text alone; ``text`` must not be null."""
    words = F.regexp_extract_all(text, F.lit(f"({WORD})"), F.lit(1))
    capitals = F.length(text) - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    return {
        "A": F.size(words) < min_words,
        "B": 100 * F.size(F.array_distinct(words)) < distinct_pct * F.size(words),
        "C": 100 * capitals.cast("long") > upper_pct * F.length(text).cast("long"),
        "D": F.length(F.translate(text, symbols, "")) < F.length(text),
    }


def row_table(docs: DataFrame, conditions: dict[str, Column], part: Column, copies: str | None = None, id_col: str = "doc_id",
              text_col: str = "text") -> tuple[DataFrame, dict[str, DataFrame]]:
    """(rows, failing): the stored rows (rid, id, part), and for each filter its stored id
    table (rid, part) of the rows that fail it.

    ``conditions``: filter -> failure condition over ``docs`` (null: passes).  ``copies``: name
    of one more filter, which fails a row whose text equals that of a row with a smaller id,
    anywhere in the table; texts are compared by their SHA-256.

    - Null text: empty.  Null part: the empty string.
    - Null id: no id is smaller and it is smaller than none, so it is no copy and makes none.
    - Repeated ids are rows of their own; equal ids make no copies.
    - Empty table: empty tables.  Other columns are neither read nor returned.
    """
    digest = F.unhex(F.sha2(F.coalesce(docs[text_col], F.lit("")), 256)) if copies else F.lit(None).cast("binary")
    base = materialize(docs.select(
        F.monotonically_increasing_id().alias("rid"), docs[id_col].alias("id"), F.coalesce(part.cast("string"), F.lit("")).alias("part"),
        F.struct(*(F.coalesce(c, F.lit(False)).alias(n) for n, c in conditions.items())).alias("fails"), digest.alias("digest")), "audit_rows")
    failing = {n: materialize(base.where(F.col("fails")[n]).select("rid", "part"), f"failing_{n}") for n in conditions}
    if copies:
        # stored, so that the join below deals both sides out anew and a hot text can be split
        firsts = materialize(base.groupBy(F.col("digest").alias("text")).agg(F.min("id").alias("first"), F.max("id").alias("last"))
                             .where("first < last").select("text", "first"), "first_ids")
        same_text = base.join(firsts, (F.col("digest") == F.col("text")) & (F.col("id") > F.col("first")))
        failing[copies] = materialize(same_text.select("rid", "part"), f"failing_{copies}")
    return base.select("rid", "id", "part"), failing


def label_ids(rows: DataFrame, labelled: DataFrame, name: str) -> DataFrame:
    """The stored id table (rid, part) of the rows whose id is in the one column of ``labelled``."""
    ids = materialize(labelled.toDF("id").where("id is not null").distinct(), f"ids_{name}")
    return materialize(rows.join(ids, "id", "left_semi").select("rid", "part"), f"labelled_{name}")


def audit(rows: DataFrame, failing: dict[str, DataFrame], labelled: dict[str, DataFrame]) -> DataFrame:
    """One row per part, order of the filters and step: part, filter_order, step (from 1), kept,
    removed, redundant, unique_fails, one ``<name>_lost`` per entry of ``labelled``, shapley.

    ``rows``: (rid, part) with rid unique.  ``failing``, ``labelled``: id tables (rid, part) of
    some of them, one per filter and label.  Filters are named by one letter each.

    - kept: rows left after the step; removed: rows that the step takes away.
    - redundant: rows that fail the step's filter and were removed before.
    - unique_fails: rows that fail the step's filter and no other.
    - shapley: the filter's ``removed``, summed over all orders.
    - A part without rows has no rows here; every part has all orders and steps, zeros too.
    """
    k = len(failing)
    if not 1 <= k <= MOST_FILTERS or any(len(n) != 1 for n in failing):
        raise ValueError(f"1 to {MOST_FILTERS} filters, each named by one letter")
    spark = rows.sparkSession
    bit = {n: 1 << i for i, n in enumerate(failing)}
    everything = (1 << k) - 1
    parts = shuffle_partitions(spark)

    def tagged(tables: dict, column: str) -> DataFrame:
        out = None
        for name, t in tables.items():
            t = t.select("rid", "part", F.lit(name).alias(column))
            out = t if out is None else out.unionByName(t)
        return out.repartition(parts, "rid")

    def within(mask: str) -> Column:
        return F.col(mask).bitwiseAND(F.col("bit")) != 0

    fails = tagged({bit[n]: t for n, t in failing.items()}, "filter")
    # the side that a join looks rows up in: a few rows a row id, so its partitions follow the ids
    lookup = fails.select(F.col("rid").alias("fail_rid"), F.col("filter").alias("bit")).hint("shuffle_hash")
    met = F.col("rid") == F.col("fail_rid")

    def prefixed(df: DataFrame, masks: range) -> DataFrame:
        return df.withColumn("prefix", F.explode(F.array(*map(F.lit, masks))))

    def survivors(df: DataFrame) -> DataFrame:
        return prefixed(df, range(everything + 1)).join(lookup, met & within("prefix"), "left_anti")

    def following(df: DataFrame) -> DataFrame:
        after = F.filter(F.array(*map(F.lit, bit.values())), lambda b: F.col("prefix").bitwiseAND(b) == 0)
        return df.withColumn("filter", F.explode(after))

    kept = (survivors(rows.select("rid", "part").repartition(parts, "rid")).groupBy("part", F.col("prefix").alias("after"))
            .agg(F.count("*").alias("kept")))
    kinds = tagged({"": rows, **labelled}, "kind")
    removed = (following(survivors(kinds)).join(lookup, met & (F.col("filter") == F.col("bit")), "left_semi")
               .groupBy("part", "prefix", "filter")
               .agg(F.count_if(F.col("kind") == "").alias("removed"),
                    *(F.count_if(F.col("kind") == n).alias(f"{n}_lost") for n in labelled)))
    redundant = (prefixed(fails, range(1, everything + 1)).where(F.col("prefix").bitwiseAND(F.col("filter")) == 0)
                 .join(lookup, met & within("prefix"), "left_semi")
                 .groupBy("part", "prefix", "filter").agg(F.count("*").alias("redundant")))
    # from here on a few rows for each part
    kept, removed = materialize(kept, "kept"), materialize(removed, "removed")
    redundant = materialize(redundant, "redundant")
    orders_of = {(m, b): math.factorial(bin(m).count("1")) * math.factorial(k - 1 - bin(m).count("1"))
                 for m in range(everything + 1) for b in bit.values() if not m & b}
    steps = F.array(*(F.struct(F.lit(m).alias("prefix"), F.lit(b).alias("filter"), F.lit(n).cast("long").alias("orders"))
                      for (m, b), n in orders_of.items()))
    frame = rows.select("part").distinct().select("part", F.explode(steps).alias("s")).select("part", "s.*")
    counted = (frame.join(removed, ["part", "prefix", "filter"], "left").join(redundant, ["part", "prefix", "filter"], "left")
               .withColumn("after", F.col("prefix").bitwiseOR(F.col("filter"))).join(kept, ["part", "after"], "left")
               .na.fill(0))
    whole = counted.groupBy("part", "filter").agg(
        F.sum(F.col("orders") * F.col("removed")).alias("shapley"),
        F.max(F.when(F.col("after") == everything, F.col("removed"))).alias("unique_fails"))
    places = []
    for order in permutations(failing):
        before = 0
        for step, n in enumerate(order, 1):
            places.append((before, bit[n], "".join(order), step))
            before |= bit[n]
    places = spark.createDataFrame(places, "prefix int, filter int, filter_order string, step int")
    return (counted.join(whole, ["part", "filter"]).join(places, ["prefix", "filter"])
            .select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails",
                    *(f"{n}_lost" for n in labelled), "shapley"))


def oracle() -> str:
    """DuckDB SQL for the registered query, from the set of filters that each document fails."""
    letters = "['A', 'B', 'C', 'D', 'E']"
    return f"""
WITH RECURSIVE words AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws
  FROM documents),
judged AS (
  SELECT doc_id, part, list_filter([
           CASE WHEN len(ws) < 100 THEN 'A' END,
           CASE WHEN 100 * len(list_distinct(ws)) < 80 * len(ws) THEN 'B' END,
           CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text) THEN 'C' END,
           CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' END,
           CASE WHEN min(doc_id) OVER (PARTITION BY text) < doc_id THEN 'E' END], lambda x: x IS NOT NULL) AS failed
  FROM words),
marked AS (
  SELECT j.*, EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = j.doc_id AND l.quality = 1) AS good,
         EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = j.doc_id AND l.toxic = 1) AS toxic
  FROM judged j),
patterns AS (
  SELECT part, list_sort(failed) AS failed, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
  FROM marked GROUP BY ALL),
orders(o) AS (
  SELECT [x] FROM (SELECT unnest({letters}) AS x)
  UNION ALL
  SELECT list_append(o, x) FROM orders, (SELECT unnest({letters}) AS x) WHERE NOT list_contains(o, x)),
steps AS (
  SELECT array_to_string(o, '') AS filter_order, s AS step, o[s] AS f, o[1:s - 1] AS before
  FROM orders, (SELECT unnest(range(1, 6)) AS s) WHERE len(o) = 5),
counted AS (
  SELECT p.part, filter_order, step, f,
         sum(n) FILTER (NOT list_has_any(failed, list_append(before, f))) AS kept,
         sum(n) FILTER (list_contains(failed, f) AND NOT list_has_any(failed, before)) AS removed,
         sum(n) FILTER (list_contains(failed, f) AND list_has_any(failed, before)) AS redundant,
         sum(n) FILTER (failed = [f]) AS unique_fails,
         sum(good) FILTER (list_contains(failed, f) AND NOT list_has_any(failed, before)) AS good_lost,
         sum(toxic) FILTER (list_contains(failed, f) AND NOT list_has_any(failed, before)) AS toxic_lost
  FROM patterns p, steps GROUP BY ALL)
SELECT part, filter_order, CAST(step AS INTEGER) AS step,
       {", ".join(f"CAST(coalesce({c}, 0) AS BIGINT) AS {c}" for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"))},
       CAST(sum(coalesce(removed, 0)) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM counted"""
