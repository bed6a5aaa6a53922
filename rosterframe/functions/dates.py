from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import LEAGUE_TIME_ZONE


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def as_date(x) -> Column:
    """A date argument: a ``Column``, or an ISO ``yyyy-MM-dd`` string."""
    if isinstance(x, Column):
        return x.cast("date")
    return F.lit(str(x)).cast("date")


def parse_date(text, strict: bool = True) -> Column:
    """``to_date(text, 'YYYY-MM-DD')``; ``strict=False`` gives null on bad input."""
    c = _c(text)
    return F.to_date(c, "yyyy-MM-dd") if strict else F.try_to_date(c, "yyyy-MM-dd")


def month_diff(later, earlier) -> Column:
    """Whole calendar months between two dates, day of month ignored:
    ``(year(a) - year(b)) * 12 + (month(a) - month(b))``."""
    a, b = _c(later), _c(earlier)
    return ((F.year(a) - F.year(b)) * 12 + (F.month(a) - F.month(b))).cast("int")


def month_name(d) -> Column:
    """``to_char(d, 'MON')``: upper-case three-letter month."""
    return F.upper(F.date_format(_c(d), "MMM"))


def game_slug(game_date, away, home) -> Column:
    """``to_char(date, 'YYYY-MM-DD') || '_' || away || '_' || home``; null if any part is."""
    return F.concat(F.date_format(_c(game_date), "yyyy-MM-dd"), F.lit("_"),
                    _c(away).cast("string"), F.lit("_"), _c(home).cast("string"))


def date_in_zone(instant: Column, zone: str = LEAGUE_TIME_ZONE) -> Column:
    """Calendar date of a timestamp in ``zone``, whatever the session time zone is."""
    return F.to_date(F.convert_timezone(None, F.lit(zone), instant.cast("timestamp_ntz")))


def today_in_zone(zone: str = LEAGUE_TIME_ZONE) -> Column:
    """Today's date in ``zone``."""
    return date_in_zone(F.current_timestamp(), zone)
