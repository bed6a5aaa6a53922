"""Column-level helpers: every one returns a built-in Spark ``Column``."""

from .arith import fantasy_score, int_div, least_one  # noqa: F401
from .arrays import array_len0, lat_lng  # noqa: F401
from .dates import game_slug, month_diff, month_name, parse_date, today_in_zone  # noqa: F401
from .text import blank_to_null, bool_text, flag_text  # noqa: F401
