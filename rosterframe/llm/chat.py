"""Preference formatting: one prompt, two masked completions.

The longest common prefix of turns of a chosen and a rejected conversation is rendered
once as the prompt; what differs is rendered as two completions.  A completion's mask
lists its runs of characters with a flag: the loss covers what the assistant wrote
and its end mark, not the headers and the other roles.  DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

END = "<|end|>\n"
ASSISTANT = "assistant"


def turn_lists(turns: DataFrame, key: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
               text_col: str = "text") -> DataFrame:
    """(key, turns): every conversation as a list of (role, text) in the order of turn, role
    and text.  A null role or text is empty, null turns come first, a null key is a key."""
    text = lambda c: F.coalesce(turns[c].cast("string"), F.lit(""))
    turn = F.struct(turns[turn_col].alias("turn"), text(role_col).alias("role"), text(text_col).alias("text"))
    listed = turns.select(turns[key].alias("key"), turn.alias("t")).groupBy("key").agg(F.sort_array(F.collect_list("t")).alias("t"))
    return listed.select(F.col("key").alias(key), F.transform("t", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns"))


def common_turns(a: Column, b: Column) -> Column:
    """Number of leading turns that two lists share."""
    first_odd = F.array_position(F.zip_with(a, b, lambda x, y: x.eqNullSafe(y)), F.lit(False))
    return F.when(first_odd > 0, first_odd - 1).otherwise(F.size(a)).cast("int")


def _header(t: Column) -> Column:
    return F.concat(F.lit("<|"), t["role"], F.lit("|>\n"))


def render(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(_header(t), t["text"], F.lit(END))), "")


def mask(turns: Column) -> Column:
    """Runs (chars, loss) that cover ``render(turns)`` from its start."""
    def runs(t: Column) -> Column:
        return F.array(F.struct(F.length(_header(t)).alias("chars"), F.lit(False).alias("loss")),
                       F.struct((F.length(t["text"]) + len(END)).alias("chars"), (t["role"] == ASSISTANT).alias("loss")))

    return F.flatten(F.transform(turns, runs))


def _after(turns: Column, k: Column) -> Column:
    return F.slice(turns, k + 1, F.greatest(F.size(turns) - k, F.lit(0)))


def format_preferences(pairs: DataFrame, key: str, chosen: str = "chosen", rejected: str = "rejected", after: str | None = None) -> DataFrame:
    """(key, n_prompt_turns, prompt, chosen, rejected, chosen_mask, rejected_mask) for rows
    with two turn lists, as ``turn_lists`` makes them; ``after``: a third list, of turns that belong to
    neither completion, rendered as a column ``after``.

    - A null list is an empty conversation: the prompt is empty, the other one all completion.
    - Equal conversations are all prompt, with two empty completions and empty masks; if one
      is a prefix of the other, its completion is empty.
    - Null and repeated keys are kept row by row.  Empty table: no rows.
    - Other columns are not returned, so their names can't clash.
    """
    kind = "array<struct<role:string,text:string>>"
    c, r = (F.coalesce(pairs[x].cast(kind), F.array().cast(kind)) for x in (chosen, rejected))
    later = F.coalesce(pairs[after].cast(kind), F.array().cast(kind)) if after else F.array().cast(kind)
    both = pairs.select(pairs[key].alias("key"), c.alias("c"), r.alias("r"), later.alias("later"))
    both = both.select("key", "c", "r", "later", common_turns(F.col("c"), F.col("r")).alias("k"))
    rest = {"chosen": _after(F.col("c"), F.col("k")), "rejected": _after(F.col("r"), F.col("k"))}
    return both.select(F.col("key").alias(key), F.col("k").alias("n_prompt_turns"),
                       render(F.slice("c", F.lit(1), F.col("k"))).alias("prompt"),
                       *(render(t).alias(n) for n, t in rest.items()),
                       *(mask(t).alias(f"{n}_mask") for n, t in rest.items()),
                       *([render(F.col("later")).alias("after")] if after else []))


def pair_by_id(chosen: DataFrame, rejected: DataFrame, key: str = "pair_id") -> DataFrame:
    """Turn rows of chosen and of rejected conversations -> rows for ``format_preferences``.
    A pair with one side only has an empty conversation on the other."""
    c = turn_lists(chosen, key).withColumnRenamed("turns", "chosen")
    r = turn_lists(rejected, key).select(F.col(key).alias("other"), F.col("turns").alias("rejected"))
    return (c.join(r, c[key].eqNullSafe(r["other"]), "full")
            .select(F.coalesce(key, "other").alias(key), "chosen", "rejected"))


def mismatched_replies(conversations: DataFrame, key: str = "conv_id") -> DataFrame:
    """Pairs out of plain conversations.  Chosen: the turns up to the last one of the assistant.
    Rejected: the same with that reply replaced by the last reply of the conversation
    whose id differs in the lowest bit (empty if it has none).  A conversation without a
    reply is both chosen and rejected, whole.  After: the turns behind the last reply."""
    lists = turn_lists(conversations, key)
    back = F.array_position(F.reverse(F.transform("turns", lambda t: t["role"])), F.lit(ASSISTANT))
    lists = lists.withColumn("last", F.when(back > 0, F.size("turns") - back + 1).cast("int"))
    reply = F.get("turns", F.col("last") - 1)
    replies = lists.select(F.col(key).bitwiseXOR(F.lit(1).cast("long")).alias("for"), reply["text"].alias("reply"))
    odd = F.array(F.struct(F.lit(ASSISTANT).alias("role"), F.coalesce("reply", F.lit("")).alias("text")))
    return lists.join(replies, lists[key] == replies["for"], "left").select(
        key,
        F.when(F.col("last").isNull(), F.col("turns")).otherwise(F.slice("turns", F.lit(1), F.col("last"))).alias("chosen"),
        F.when(F.col("last").isNull(), F.col("turns"))
        .otherwise(F.concat(F.slice("turns", F.lit(1), F.col("last") - 1), odd)).alias("rejected"),
        _after(F.col("turns"), F.coalesce("last", F.size("turns"))).alias("after"))


def mask_text(runs: Column) -> Column:
    """A mask as text, such as ``14-,230+``: 14 characters without loss, 230 with."""
    return F.array_join(F.transform(runs, lambda m: F.concat(m["chars"].cast("string"), F.when(m["loss"], "+").otherwise("-"))), ",")


def oracle() -> str:
    """DuckDB SQL for the formatted ``mismatched_replies`` of ``conversations``."""
    body = "'<|' || t.role || '|>' || chr(10) || t.text || '<|end|>' || chr(10)"
    runs = (f"(length(t.role) + 5) || '-,' || (length(t.text) + {len(END)}) || CASE WHEN t.role = 'assistant' THEN '+' ELSE '-' END")

    def joined(xs: str, what: str, by: str = "''") -> str:
        return f"coalesce(list_aggregate(list_transform({xs}, lambda t: {what}), 'string_agg', {by}), '')"

    return f"""
WITH lists AS (
  SELECT conv_id, list(struct_pack(role := coalesce(role, ''), text := coalesce(text, ''))
                       ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS turns
  FROM conversations GROUP BY conv_id),
lasts AS (SELECT *, list_max(list_filter(range(1, len(turns) + 1), lambda i: turns[i].role = 'assistant')) AS last FROM lists),
pairs AS (
  SELECT a.conv_id, CASE WHEN a.last IS NULL THEN a.turns ELSE a.turns[1:a.last] END AS c,
         CASE WHEN a.last IS NULL THEN a.turns ELSE list_concat(list_slice(a.turns, 1, a.last - 1),
           [struct_pack(role := 'assistant', text := coalesce(b.turns[b.last].text, ''))]) END AS r,
         CASE WHEN a.last IS NULL THEN [] ELSE a.turns[a.last + 1:] END AS behind
  FROM lasts a LEFT JOIN lasts b ON b.conv_id = xor(a.conv_id, 1)),
cut AS (
  SELECT *, coalesce(list_min(list_filter(range(1, greatest(len(c), len(r)) + 1), lambda i: c[i] IS DISTINCT FROM r[i])) - 1, len(c)) AS k FROM pairs),
parts AS (SELECT conv_id, k, list_slice(c, 1, k) AS p, list_slice(c, k + 1, len(c)) AS c, list_slice(r, k + 1, len(r)) AS r, behind FROM cut)
SELECT conv_id, CAST(k AS INTEGER) AS n_prompt_turns, {joined('p', body)} AS prompt,
       {joined('c', body)} AS chosen, {joined('r', body)} AS rejected,
       {joined('c', runs, "','")} AS chosen_mask, {joined('r', runs, "','")} AS rejected_mask, {joined('behind', body)} AS after
FROM parts"""
