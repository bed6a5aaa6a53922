"""Row-level changes as pure functions ``new_base = f(base, batch)``.

Parquet tables take no UPDATE/DELETE, so each change builds the next version
of a table; a sink writes it as a new snapshot.  Batches are deduplicated on
their key before they meet the base, so a repeated key can never multiply
base rows (N14).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.tables import DATE_COLUMNS, UNASSIGNED, month_of, partition_column, public


def _dedupe(batch: DataFrame, keys: Sequence[str], order_col: str, pick) -> DataFrame:
    others = [c for c in batch.columns if c not in keys]
    if not others:
        return batch.select(*keys).distinct()
    # max_by/min_by combine map-side, so a hot key is merged before the shuffle.
    return (batch.groupBy(*keys)
            .agg(pick(F.struct(*others), F.col(order_col)).alias("_row"))
            .select(*keys, "_row.*"))


def cast_to(e: Column, dtype) -> Column:
    """Cast to the column's type; arrays are left as they are, since a cast
    cannot drop element nullability and the ``CASE`` branches coerce anyway."""
    from pyspark.sql import types as T
    return e if isinstance(dtype, T.ArrayType) else e.cast(dtype)


def dedupe_first(batch: DataFrame, keys: Sequence[str], order_col: str) -> DataFrame:
    """First record per key in batch order."""
    return _dedupe(batch, keys, order_col, F.min_by)


def dedupe_last(batch: DataFrame, keys: Sequence[str], order_col: str) -> DataFrame:
    """Last record per key in batch order (a later post overrides an earlier one)."""
    return _dedupe(batch, keys, order_col, F.max_by)


def only_record(batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The batch as it is; the job fails if it repeats a key."""
    others = [c for c in batch.columns if c not in keys]
    message = F.concat(F.lit(f"repeated key in a batch without an order ({', '.join(keys)}): "),
                       F.concat_ws(", ", *[F.col(k).cast("string") for k in keys]))
    return (batch.groupBy(*keys).agg(F.first(F.struct(*others, F.lit(0).alias("_"))).alias("_row"), F.count(F.lit(1)).alias("_n"))
            .withColumn("_row", F.when(F.col("_n") == 1, F.col("_row")).otherwise(F.raise_error(message)))
            .select(*keys, *[F.col("_row")[c].alias(c) for c in others]))


def append(base: DataFrame, batch: DataFrame) -> DataFrame:
    """``INSERT INTO base (cols) VALUES ...``: columns the batch lacks become null.

    A stored base carries the month its rows are stored under; new rows get theirs
    from their date, or UNASSIGNED if they have none, so no pruned read loses them."""
    part = partition_column(base)
    if part is not None:
        batch = public(batch)
        date = DATE_COLUMNS[part]
        batch = batch.withColumn(part, month_of(F.col(date)) if date in batch.columns else F.lit(UNASSIGNED))
    extra = [c for c in batch.columns if c not in base.columns]
    if extra:
        raise ValueError(f"batch columns not in the table: {extra}")
    return base.unionByName(batch.select(*[
        F.col(c).cast(base.schema[c].dataType) for c in batch.columns]), allowMissingColumns=True)


def insert_ignore(base: DataFrame, batch: DataFrame, keys: Sequence[str],
                  order_col: str) -> DataFrame:
    """``INSERT ... ON CONFLICT (keys) DO NOTHING``.

    A key already stored keeps its stored row; a key repeated inside the batch
    keeps its first record, as a row-by-row insert would.
    """
    fresh = dedupe_first(batch, keys, order_col).join(base.select(*keys), list(keys), "left_anti")
    return append(base, fresh.drop(order_col) if order_col in fresh.columns else fresh)


def apply_update(base: DataFrame, batch: DataFrame, keys: Sequence[str],
                 assignments: Mapping[str, Column | str], order_col: str | None = None,
                 where: Column | None = None) -> DataFrame:
    """``UPDATE base SET col = expr FROM batch u WHERE keys match [AND where]``.

    ``assignments`` maps base columns to expressions over batch columns (named
    ``u_<col>`` after the join) and base columns.  Unmatched rows keep their
    values.  The batch is left-joined after it has been brought to one record a
    key: the last one in ``order_col``; without an order a repeated key is an error.
    Either way base rows never multiply.
    """
    batch = only_record(batch, keys) if order_col is None else dedupe_last(batch, keys, order_col).drop(order_col)
    renamed = batch.select(*keys, *[F.col(c).alias(f"u_{c}") for c in batch.columns if c not in keys],
                           F.lit(True).alias("_matched"))
    joined = base.join(renamed, list(keys), "left")
    hit = F.coalesce(F.col("_matched"), F.lit(False))
    if where is not None:
        hit = hit & F.coalesce(where, F.lit(False))
    out = []
    for c in base.columns:
        if c in assignments:
            e = assignments[c]
            e = F.col(e) if isinstance(e, str) else e
            out.append(F.when(hit, cast_to(e, base.schema[c].dataType)).otherwise(F.col(c)).alias(c))
        else:
            out.append(F.col(c))
    return joined.select(*out)


def set_where(base: DataFrame, cond: Column, assignments: Mapping[str, Column]) -> DataFrame:
    """``UPDATE base SET ... WHERE cond`` with no second table."""
    hit = F.coalesce(cond, F.lit(False))
    return base.select(*[
        F.when(hit, cast_to(assignments[c], base.schema[c].dataType)).otherwise(F.col(c)).alias(c)
        if c in assignments else F.col(c) for c in base.columns])


def delete_matching(base: DataFrame, doomed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``DELETE FROM base WHERE (keys) IN (doomed)``: an anti-join."""
    return base.join(doomed.select(*keys).distinct(), list(keys), "left_anti").select(*base.columns)
