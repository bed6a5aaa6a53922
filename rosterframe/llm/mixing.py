"""Mixing sources to target weights by temperature.

Shares of the sources' tokens are raised to an exponent t in [0, 1] and normalised: 1
keeps the natural mix, 0 weighs all sources alike.  A bisection finds the smallest
exponent whose weights stay within a target entropy and within a repetition limit.

The weights are realised as budgeted block permutations.  Each pass over a source (an
epoch) is a keyed permutation of its documents; the passes laid end to end are the
source's stream.  A source gets its quota of tokens from the front of its stream, and
block b of the output takes the b-th of ``n_blocks`` equal parts of every quota, so each
block has the target weights.  The order inside a block is the permutation key.

A position in a stream is exact: tokens of all key buckets before (a small aggregate)
plus a running sum inside the bucket.  The number of buckets follows the largest source,
so a source with a third of all rows is no single task.  DataFrame functions only.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rosterframe.llm.common import WORD, materialize, row_parts

#: Halvings of [0, 1] in all, and those that one Spark job evaluates together.
HALVINGS, AT_ONCE = 24, 6


def token_count(text: Column) -> Column:
    """Words plus one for the end mark: every document weighs something."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long") + 1


def exponent(sources: DataFrame, target_entropy: float | None, max_repetition: float | None) -> float:
    """Smallest t in [0, 1] with entropy(weights) <= target_entropy * ln(sources) and
    max / min passes over a source <= max_repetition; 1 if there is none.
    ``sources`` has one row per source with its share p > 0."""

    def allowed(ts: list[float]) -> list[bool]:
        grid = sources.select("p", F.explode(F.array(*map(F.lit, ts))).alias("t")).withColumn("w", F.pow("p", "t"))
        rows = grid.groupBy("t").agg(
            F.count("*").alias("n"), F.sum("w").alias("z"), F.sum(F.col("w") * F.log("w")).alias("a"),
            F.max(F.col("w") / F.col("p")).alias("most"), F.min(F.col("w") / F.col("p")).alias("least")).collect()
        ok = {}
        for r in rows:  # one row for each exponent tried
            entropy = math.log(r.z) - r.a / r.z
            ok[r.t] = ((target_entropy is None or entropy <= target_entropy * math.log(r.n))
                       and (max_repetition is None or r.most / r.least <= max_repetition))
        return [ok[t] for t in ts]

    if allowed([0.0])[0]:
        return 0.0
    low, step = 0, 1 << HALVINGS  # in units of 2 ** -HALVINGS; `low` is not allowed, `low + step` is (or is 1)
    for _ in range(0, HALVINGS, AT_ONCE):
        step >>= AT_ONCE
        inner = [low + k * step for k in range(1, 1 << AT_ONCE)]
        ok = dict(zip(inner, allowed([t / (1 << HALVINGS) for t in inner])))
        width = step << AT_ONCE
        while width > step:  # six halvings, looked up
            width //= 2
            low = low if ok[low + width] else low + width
    return (low + step) / (1 << HALVINGS)


def mix(docs: DataFrame, target_entropy: float | None = None, max_repetition: float | None = None,
        block_tokens: int = 1_000_000, seed: str = "mix", source_col: str = "source", id_col: str = "doc_id",
        text_col: str = "text", bucket_rows: int = 256) -> DataFrame:
    """The columns of ``docs`` plus n_tokens, epoch, block and order_key: each document as
    often as its source's quota takes it.  Training order: block, order_key.

    The budget is the smallest one at which no source falls short of one full pass, so
    no document is lost; flatter weights repeat the smaller sources, at most
    ``max_repetition`` times as often as the largest.

    - Null text: one token.  Null source: a source of its own.  Null id: an id like any other.
    - Repeated rows are documents of their own; ties of the key are broken by the whole row.
    - Empty table: no rows.  An input column with the name of a new one is replaced.
    """
    new = ["n_tokens", "epoch", "block", "order_key"]
    kept = [c for c in docs.columns if c.lower() not in new]
    # sources by a name that is never null, so that joins and windows deal the rows out alike
    name = F.coalesce(F.concat(F.lit("="), docs[source_col].cast("string")), F.lit("null"))
    rows = docs.select(F.struct(*(docs[c] for c in kept)).alias("row"), name.alias("source"), docs[id_col].cast("string").alias("id"),
                       token_count(docs[text_col]).alias("n"), F.xxhash64(*row_parts(docs.select(*(docs[c] for c in kept)))).alias("whole"))
    slim = materialize(rows.select("source", "id", "n"), "token_counts")
    totals = slim.groupBy("source").agg(F.sum("n").alias("tokens"), F.count("*").alias("docs"))
    everything = totals.agg(F.sum("tokens").cast("double").alias("all"), F.max("docs").alias("most")).first()
    if everything["all"] is None:
        return rows.select("row.*", *(F.lit(None).cast(t).alias(n) for n, t in zip(new, ("long", "int", "long", "string"))))
    shares = materialize(totals.withColumn("p", F.col("tokens") / F.lit(everything["all"])), "shares")
    t = exponent(shares, target_entropy, max_repetition)
    natural = shares.agg(F.max("p")).first()[0]
    # quota: passes are (p / largest p) ** (t - 1), so the largest source is passed exactly once
    quotas = shares.withColumn("quota", F.round(F.col("tokens") * F.pow(F.col("p") / F.lit(natural), F.lit(t - 1.0))).cast("long"))
    budget = quotas.agg(F.sum("quota")).first()[0]
    n_blocks = max(1, round(budget / block_tokens))
    digits = max(1, math.ceil(math.log(max(1, everything["most"] / bucket_rows), 16)))

    def copies(df: DataFrame, quotas: DataFrame) -> DataFrame:
        key = F.md5(F.concat_ws("|", F.lit(seed), "epoch", F.coalesce("id", F.lit("")), "n"))
        return (df.join(quotas, "source")
                .withColumn("epoch", F.explode(F.sequence(F.lit(0), (F.ceil(F.col("quota") / F.col("tokens")) - 1).cast("int"))))
                .withColumn("order_key", key).withColumn("bucket", F.substring("order_key", 1, digits)))

    whole_pass = F.col("epoch") * F.col("tokens")
    buckets = (copies(slim, quotas.select("source", "tokens", "quota"))
               .groupBy("source", "epoch", "bucket", "tokens", "quota").agg(F.sum("n").alias("in_bucket"))
               .withColumn("before", whole_pass - F.col("in_bucket")
                           + F.sum("in_bucket").over(Window.partitionBy("source", "epoch").orderBy("bucket")))
               .where(F.col("before") < F.col("quota")))
    buckets = materialize(buckets.select("source", "epoch", "bucket", "before"), "buckets")
    last = buckets.groupBy("source", "epoch").agg(F.max("bucket").alias("last")).groupBy("source").agg(
        F.max_by("last", "epoch").alias("last"))  # buckets of the last pass beyond it are not needed
    quotas = materialize(quotas.join(last, "source").select("source", "tokens", "quota", "last"), "quotas")
    used = copies(rows, quotas).where((F.col("bucket") <= F.col("last")) | (whole_pass + F.col("tokens") < F.col("quota")))
    inside = (Window.partitionBy("source", "epoch", "bucket").orderBy("order_key", "id", "whole")
              .rowsBetween(Window.unboundedPreceding, -1))
    start = F.col("before") + F.coalesce(F.sum("n").over(inside), F.lit(0))
    return (used.join(buckets, ["source", "epoch", "bucket"]).withColumn("start", start).where("start < quota")
            .select("row.*", F.col("n").alias("n_tokens"), "epoch",
                    F.floor(F.col("start").cast("double") / F.col("quota") * n_blocks).cast("long").alias("block"), "order_key"))


def oracle(target_entropy: float | None, max_repetition: float | None, block_tokens: int, seed: str = "mix",
           table: str = "documents", columns: str = "doc_id, source, n_tokens, epoch, block, order_key", head: str = "WITH RECURSIVE") -> str:
    """DuckDB SQL for ``mix``; streams are cumulated by one window, without buckets."""
    bad = []
    if target_entropy is not None:
        bad.append(f"ln(list_sum(list_transform(ps, lambda p: pow(p, {{t}})))) - list_sum(list_transform(ps, lambda p: pow(p, {{t}}) * ln(pow(p, {{t}}))))"
                   f" / list_sum(list_transform(ps, lambda p: pow(p, {{t}}))) > CAST({target_entropy} AS DOUBLE) * ln(len(ps))")
    if max_repetition is not None:
        bad.append(f"list_max(list_transform(ps, lambda p: pow(p, {{t}}) / p)) / list_min(list_transform(ps, lambda p: pow(p, {{t}}) / p)) > CAST({max_repetition} AS DOUBLE)")
    refuse = " OR ".join(f"({b})" for b in bad) or "false"
    mid = "((low + high) / 2)"
    return f"""
{head} counted AS (
  SELECT *, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) + 1 AS n FROM {table}),
totals AS (SELECT source, CAST(sum(n) AS BIGINT) AS tokens FROM counted GROUP BY source),
shares AS (SELECT *, tokens / (SELECT CAST(sum(tokens) AS DOUBLE) FROM totals) AS p FROM totals),
listed AS (SELECT list(p) AS ps FROM shares),
halved(i, low, high, ps) AS (
  SELECT 0, CAST(0 AS DOUBLE), CASE WHEN {refuse.format(t="CAST(0 AS DOUBLE)")} THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END, ps FROM listed
  UNION ALL
  SELECT i + 1, CASE WHEN {refuse.format(t=mid)} THEN {mid} ELSE low END, CASE WHEN {refuse.format(t=mid)} THEN high ELSE {mid} END, ps
  FROM halved WHERE i < {HALVINGS}),
quotas AS (
  SELECT source, tokens, CAST(round(tokens * pow(p / (SELECT max(p) FROM shares),
         (SELECT high FROM halved WHERE i = {HALVINGS}) - 1.0)) AS BIGINT) AS quota FROM shares),
copies AS (
  SELECT c.*, q.tokens, q.quota, e.epoch,
         md5('{seed}|' || e.epoch || '|' || c.doc_id || '|' || c.n) AS order_key
  FROM counted c JOIN quotas q ON q.source IS NOT DISTINCT FROM c.source,
       LATERAL (SELECT CAST(unnest(range(CAST(ceil(q.quota / q.tokens) AS BIGINT))) AS INTEGER) AS epoch) e),
placed AS (
  SELECT *, epoch * tokens + sum(n) OVER (PARTITION BY source, epoch ORDER BY order_key, doc_id) - n AS start FROM copies),
mixed AS (
  SELECT *, CAST(n AS BIGINT) AS n_tokens,
         CAST(floor(CAST(start AS DOUBLE) / quota
              * greatest(1, round((SELECT sum(quota) FROM quotas) / {block_tokens}))) AS BIGINT) AS block
  FROM placed WHERE start < quota)
SELECT {columns} FROM mixed"""
