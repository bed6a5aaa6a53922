from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import FANDUEL_WEIGHTS


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def int_div(a, b) -> Column:
    """Integer division truncating toward zero (SQL ``int / int``, Spark ``div``).

    ``div`` on bigint is exact over the whole range.  A zero divisor raises under
    ANSI mode, as the SQL original does.
    """
    return F.call_function("div", _c(a).cast("bigint"), _c(b).cast("bigint"))


def least_one(x) -> Column:
    """``LEAST(x, 1)`` on a REAL value; nulls are skipped as in SQL LEAST."""
    return F.least(_c(x), F.lit(1.0).cast("float"))


def fantasy_score(prefix: str = "", weights: dict[str, float] | None = None,
                  exact: bool = False) -> Column:
    """``pts + 1.2 reb + 1.5 ast + 2 stl + 2 blk - tov`` over columns ``prefix+stat``.

    Terms are added left to right in the order of ``weights``.  With
    ``exact=True`` (integer box scores) the sum is taken in DECIMAL, as SQL
    does with ``1.2 * int``, and only the total becomes a double.
    """
    from decimal import Decimal

    w = weights or FANDUEL_WEIGHTS
    total = None
    for stat, weight in w.items():
        c = F.col(prefix + stat)
        if exact:
            c = c.cast("decimal(20,0)")
            lit = F.lit(Decimal(str(abs(weight))))
        else:
            lit = F.lit(abs(weight))
        term = c if abs(weight) == 1.0 else lit * c
        if total is None:
            total = term if weight > 0 else -term
        elif weight > 0:
            total = total + term
        else:
            total = total - term
    return total.cast("double") if exact else total


def round_ratio(num, den, scale: int) -> Column:
    """``round(num / den, scale)`` half up, exact for non-negative integers.

    Computed as ``floor((2 * num * 10^scale + den) / (2 * den)) / 10^scale`` in
    integer arithmetic, so a quotient that sits exactly on a rounding boundary
    rounds the way exact NUMERIC division does, in every engine.
    """
    m = 10 ** scale
    n, d = _c(num).cast("bigint"), _c(den).cast("bigint")
    return int_div(n * (2 * m) + d, d * 2).cast("double") / F.lit(float(m))
