from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def blank_to_null(x) -> Column:
    """Empty string becomes null; other values pass."""
    return F.nullif(_c(x), F.lit(""))


def bool_text(x) -> Column:
    """``CAST(bool AS text)``: 'true' / 'false' / null."""
    return _c(x).cast("string")


def flag_text(cond: Column) -> Column:
    """``CASE WHEN cond THEN 'true' ELSE 'false' END``: null counts as false."""
    return F.when(cond, F.lit("true")).otherwise(F.lit("false"))
