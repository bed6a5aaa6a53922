"""DataFrame operators the league queries are built from.

All are lazy: they take DataFrames and return a DataFrame without an action,
except ``assign_keys``, which checkpoints the ordered batch so that generated
keys stay stable if an executor is lost.
"""

from .history import history_rows, recent_arrays, recent_n  # noqa: F401
from .latest import latest_per_key  # noqa: F401
from .pivot import complete_rows, pivot_codes, unpivot_codes  # noqa: F401
from .team import avg_attendance, last_team_game, team_games, team_records  # noqa: F401
