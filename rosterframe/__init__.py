"""rosterframe: league data pipelines (games, rosters, box scores, projections,
predictions, salaries) and point-in-time ML features as Spark DataFrame plans."""

__version__ = "0.1.0"
