"""Quality rules whose cutoffs are risk-controlled.

Each rule rejects a document whose metric is above a cutoff.  Cutoffs come from
labelled documents, per stratum (language): for every rule, cutoffs are tested from the
most lenient to the strictest, each with the exact binomial test of "this cutoff
rejects more than its share of the risk of clean documents".  The sequence stops at its
first failure (fixed-sequence testing, which needs no correction inside the sequence);
over strata and rules the level is Bonferroni-corrected, and the tolerated risk of a
stratum is shared equally among its rules.  So with confidence ``1 - delta``, in no
stratum do the rules together reject more than ``max_false_rejection`` of the
clean documents.  Among the certified cutoffs the one with the best gain is used: the
share of labelled bad documents it catches, less the share of clean ones it loses in
units of the tolerated risk.  A rule that gains nothing, or that too few labels certify,
rejects nothing.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterframe.llm.common import materialize

#: Rule -> its cutoffs, ascending.  A document is rejected above the cutoff.
RULES: dict[str, list[float]] = {
    "symbols_per_char": [k / 200 for k in range(1, 200)],
    "upper_share": [k / 100 for k in range(1, 100)],
    "repeat_share": [k / 100 for k in range(1, 100)],
    "dup_line_share": [k / 100 for k in range(1, 100)],
}

STATS = T.StructType(
    [T.StructField(n, T.LongType(), False) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    + [T.StructField(n, T.DoubleType(), False) for n in RULES])

_SYMBOLS = np.frombuffer(b"#*$%&|<>", np.uint8)
_BLANKS = np.frombuffer(b" \t\n\x0b\x0c\r", np.uint8)


def repeated_words(words: list[bytes], width: int = 3) -> int:
    """Words that lie in a window of ``width`` words found twice or more."""
    n = len(words)
    if n <= width:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)
    if len(number) == n:
        return 0
    window = ids[: n - width + 1]
    for k in range(1, width):  # renumbering keeps the codes far from overflow
        if k > 1:
            window = np.unique(window, return_inverse=True)[1]
        window = window * len(number) + ids[k: n - width + 1 + k]
    _, at, times = np.unique(window, return_inverse=True, return_counts=True)
    edge = np.zeros(n + 1, np.int32)
    starts = np.flatnonzero(times[at] > 1)
    edge[starts] += 1
    edge[starts + width] -= 1
    return int((np.cumsum(edge) > 0).sum())


def text_stats(text: bytes) -> tuple:
    """The values of ``STATS`` for a whole text.  ``bytes.split`` and ``bytes.strip`` know
    ASCII white space only."""
    words = text.split()
    found = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    n, chars = len(words), len(text) - int(found[128:192].sum()) - int(found[_BLANKS].sum())
    symbols, upper, lower = int(found[_SYMBOLS].sum()), int(found[65:91].sum()), int(found[97:123].sum())
    lines = [x for x in text.split(b"\n") if x.strip()]
    dup, repeat = len(lines) - len(set(lines)), repeated_words(words)
    return (n, chars, symbols, dup, repeat, symbols / max(1, chars), upper / max(1, upper + lower), repeat / max(1, n),
            dup / max(1, len(lines)))


def with_stats(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (default: all) as a struct ``row``, with a struct ``stats`` of the whole text."""
    keep = docs.columns if keep is None else keep
    src = docs.select(F.struct(*(docs[c] for c in keep)).alias("row"), docs[text_col].cast("binary").alias("text"))
    if text_col in keep:  # the text travels once
        src = docs.select(F.struct(*(docs[c] for c in keep)).alias("row"))
    at = keep.index(text_col) if text_col in keep else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(1) if at is None else b.column(0).field(at).cast(pa.binary())
            values = list(zip(*(text_stats(t.as_py() or b"") for t in texts))) or [()] * len(STATS)
            kinds = [pa.int64()] * 5 + [pa.float64()] * len(RULES)
            stats = pa.StructArray.from_arrays([pa.array(v, k) for v, k in zip(values, kinds)], STATS.names)
            yield pa.RecordBatch.from_arrays([b.column(0), stats], ["row", "stats"])

    return src.mapInArrow(run, T.StructType([src.schema["row"], T.StructField("stats", STATS)]))


def base_failed(stats: Column) -> Column:
    """Too short, or mostly repeated windows."""
    return (stats["n_words"] < 50) | (100 * stats["n_repeat_words"] > 50 * stats["n_words"])


# ----------------------------------------------------------------- cutoffs

def binomial_tail(n: int, k: int, p: float) -> float:
    """P(X <= k) for X binomial (n, p), 0 < p < 1: the exact p-value of "the rate exceeds p"."""
    if k >= n:
        return 1.0
    i = np.arange(k + 1)
    rise = np.concatenate(([0.0], np.cumsum(np.log((n - i[1:] + 1) / i[1:]))))
    log = rise + i * math.log(p) + (n - i) * math.log1p(-p)
    top = log.max()
    return float(min(1.0, math.exp(top) * np.exp(log - top).sum()))


def _exceeded(metric: Column, cutoffs: list[float]) -> Column:
    """How many of the cutoffs lie below the metric."""
    return F.size(F.filter(F.array(*map(F.lit, cutoffs)), lambda c: c < metric))


def cutoffs(stats: DataFrame, labels: DataFrame, stratum: Column, max_false_rejection: float, delta: float,
            id_col: str = "doc_id") -> DataFrame:
    """(stratum, <rule>...): the certified cutoff of each rule, null where it rejects nothing."""
    known = (labels.where("quality is not null").groupBy(F.col("doc_id").cast("long").alias("label_id"))
             .agg(F.min("quality").alias("quality"), F.max("quality").alias("most")).where("quality = most").drop("most"))
    # rank of the metric among the cutoffs: a document is rejected by the first `above` of them
    above = F.array(*(F.struct(F.lit(r).alias("rule"), _exceeded(F.col("stats")[r], cs).alias("above")) for r, cs in RULES.items()))
    seen = (stats.where(~base_failed(F.col("stats")))
            .select(stratum.alias("stratum"), F.col("row")[id_col].cast("long").alias("label_id"), "stats")
            # a document counts once, however often it is repeated: the bound is one on independent trials
            .groupBy("label_id").agg(F.min(F.struct("stratum", "stats")).alias("one")).select("label_id", "one.*").join(known, "label_id")
            .select("stratum", "quality", F.explode(above).alias("m")).select("stratum", "m.*", "quality")
            .groupBy("stratum", "rule", "above")
            .agg(F.sum((F.col("quality") == 1).cast("long")).alias("good"), F.sum((F.col("quality") == 0).cast("long")).alias("bad")))
    seen = materialize(seen, "label_counts")  # at most one row per stratum, rule and cutoff
    level = delta / max(1, seen.select("stratum", "rule").distinct().count())
    risk = max_false_rejection / len(RULES)

    def pick(t: pd.DataFrame) -> pd.DataFrame:
        cs = RULES[t["rule"].iloc[0]]
        good, bad = (np.bincount(t["above"], t[c], len(cs) + 1).astype(np.int64) for c in ("good", "bad"))
        # rejected by cutoff j: the metric is above more than j cutoffs
        lost, caught = (np.cumsum(x[::-1])[::-1][1:] for x in (good, bad))
        ok, j = [], len(cs) - 1
        n = int(good.sum())
        # at or above its expected count a rate is never certified: no need to sum
        while j >= 0 and lost[j] < risk * n and binomial_tail(n, int(lost[j]), risk) <= level:
            ok.append(j)
            j -= 1
        cutoff = None
        if ok and bad.sum():
            gain = {j: caught[j] / bad.sum() - lost[j] / n / risk for j in ok}
            best = [j for j in ok if gain[j] == max(gain.values())]
            cutoff = cs[best[len(best) // 2]] if max(gain.values()) > 0 else None
        return pd.DataFrame({"stratum": t["stratum"].iloc[:1], "rule": t["rule"].iloc[:1], "cutoff": [cutoff]})

    chosen = seen.groupBy("stratum", "rule").applyInPandas(pick, "stratum string, rule string, cutoff double")
    return materialize(chosen.groupBy("stratum").pivot("rule", list(RULES)).agg(F.max("cutoff")), "cutoffs")


# ---------------------------------------------------------------- operator

def judge(docs: DataFrame, labels: DataFrame, max_false_rejection: float = 0.05, delta: float = 0.05,
          stratum_col: str = "lang", id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """One row per input row: ``row`` (a struct of the columns ``keep``, default all), the
    counts n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, ``base_failed`` and ``kept``.

    ``labels`` has doc_id and quality (1 clean, 0 not); rows without a label's value, and
    documents labelled both ways, are no evidence.

    - Null text: no words, so the base rule fails it.  Null stratum: a stratum of its own.
    - Null id: judged, never labelled.  Repeated rows are judged alike, each on its own; as
      evidence an id counts once (with different texts under it, one and always the same).
    - No labels: only the base rule rejects.  Empty table: no rows.
    - The input's columns stay inside ``row``, so no name can clash.
    """
    keep = docs.columns if keep is None else keep
    light = list(dict.fromkeys([*(c for c in keep if c != text_col), id_col, stratum_col]))
    numbers = materialize(with_stats(docs, text_col, light), "stats")
    stratum = F.coalesce(F.concat(F.lit("="), F.col("row")[stratum_col].cast("string")), F.lit("null"))
    limit = cutoffs(numbers, labels, stratum, max_false_rejection, delta, id_col)
    # with the texts, the counts are taken again on the way: cheaper than storing every text
    stats = numbers if text_col not in keep else with_stats(docs, text_col, list(dict.fromkeys([*keep, stratum_col])))
    over = [F.coalesce(F.col("stats")[r] > F.col(r), F.lit(False)) for r in RULES]
    rejected = over[0]
    for o in over[1:]:
        rejected = rejected | o
    failed = base_failed(F.col("stats"))
    return (stats.join(limit, stratum == F.col("stratum"), "left")
            .select(F.struct(*(F.col("row")[c].alias(c) for c in keep)).alias("row"),
                    *(F.col("stats")[n].alias(n) for n in STATS.names[:5]),
                    failed.alias("base_failed"), (~failed & ~rejected).alias("kept")))
