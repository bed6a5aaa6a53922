"""Long-to-wide pivots by code (``MAX(CASE WHEN code = c THEN v END)``)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pivot_codes(df: DataFrame, keys: Sequence[str], code_col: str, value_col: str,
                codes: Mapping[str, object]) -> DataFrame:
    """One column per code holding the largest value of that code (N5: MAX, not newest).

    Written as conditional maxima rather than ``pivot`` so that the code list is
    fixed at plan time and the aggregate combines map-side before the shuffle.
    """
    return df.groupBy(*keys).agg(*[
        F.max(F.when(F.col(code_col) == F.lit(code), F.col(value_col))).alias(name)
        for name, code in codes.items()])


def unpivot_codes(df: DataFrame, keys: Sequence[str], codes: Mapping[str, object],
                  code_col: str, value_col: str) -> DataFrame:
    """Inverse of ``pivot_codes``: one row per non-null wide column."""
    pairs = F.array(*[F.struct(F.lit(code).alias(code_col), F.col(name).alias(value_col))
                      for name, code in codes.items()])
    return (df.select(*keys, F.inline(pairs))
              .where(F.col(value_col).isNotNull()))


def complete_rows(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Keep rows where every listed column is present (``c IS NOT NULL AND ...``)."""
    return df.dropna(how="any", subset=list(cols))
