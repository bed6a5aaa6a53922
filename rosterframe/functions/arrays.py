from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def array_len0(a) -> Column:
    """Array length with null counted as 0 (``COALESCE(ARRAY_LENGTH(a, 1), 0)``).

    ``array_size`` already gives 0 for an empty array; only null needs the default.
    """
    return F.coalesce(F.array_size(_c(a)), F.lit(0)).cast("int")


def lat_lng(lat, lng) -> Column:
    """``ARRAY[lat, lng]::REAL[]``."""
    return F.array(_c(lat).cast("float"), _c(lng).cast("float"))
