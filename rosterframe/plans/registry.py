"""Registered queries: one entry per inventory key, each with its oracle SQL.

Every entry binds the driver tables at ``sf_dir`` to the league model, runs
one library function on the whole tables and returns the CSV-safe export form.
The parameters below are the fixture's (FIXTURES.md, "Parameters that give rows").
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .. import oracle as O
from .. import schema as S
from ..sources.binding import bind, read_driver
from ..sources.sinks import csv_safe
from . import features as FE

AS_OF = "1998-11-18"
SEASON_START = "1998-01-01"
STAT = "pts"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


class Raw:
    """Lazy access to the driver tables that batches are built from."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __call__(self, name: str) -> DataFrame:
        return read_driver(self.spark, self.sf_dir, name)


def register(key: str, sql: str | None):
    """Register ``fn(tables[, raw])`` under ``key`` with its oracle SQL body
    (the binding CTEs are prefixed here)."""
    import inspect

    def deco(fn):
        wants_raw = len(inspect.signature(fn).parameters) > 1

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            t = bind(spark, sf_dir)
            out = fn(t, Raw(spark, sf_dir)) if wants_raw else fn(t)
            return csv_safe(out)
        run.__name__ = key
        QUERIES[key] = run
        if sql is not None:
            ORACLE[key] = sql if sql.lstrip().upper().startswith("WITH") else O.with_binding(sql)
        return fn
    return deco


@register("p_ml_features", O.ml_features_sql(AS_OF, STAT, SEASON_START))
def _p_ml_features(t):
    return FE.ml_features(t, AS_OF, STAT, SEASON_START)


@register("p_ml_features_training", O.ml_features_sql(AS_OF, "reb", SEASON_START, training=True))
def _p_ml_features_training(t):
    return FE.ml_features(t, AS_OF, "reb", SEASON_START, training=True)


@register("p_ml_features_tpt", O.ml_features_sql(AS_OF, "tpt", SEASON_START, training=True, n_recent=5))
def _p_ml_features_tpt(t):
    return FE.ml_features(t, AS_OF, "tpt", SEASON_START, training=True, n_recent=5)


def safe(table: str, alias: str = "") -> str:
    """SQL select list of a league table in the CSV-safe export form."""
    a = f"{alias}." if alias else ""
    out = []
    for f in S.TABLE_SCHEMAS[table].fields:
        c, n = f"{a}{f.name}", f.dataType.typeName()
        if n == "boolean":
            out.append(f"CAST({c} AS VARCHAR) AS {f.name}")
        elif n == "date":
            out.append(f"strftime({c}, '%Y-%m-%d') AS {f.name}")
        elif n == "timestamp":
            out.append(f"strftime({c}, '%Y-%m-%d %H:%M:%S') AS {f.name}")
        elif n == "array":
            out.append(f"CAST(to_json({c}) AS VARCHAR) AS {f.name}")
        else:
            out.append(f"{c} AS {f.name}" if alias else f.name)
    return ", ".join(out)


from . import registry_queries  # noqa: E402,F401  (registers Q1-Q8)
from . import registry_mutations  # noqa: E402,F401  (registers S5-S12, M1-M15)
from . import registry_operators  # noqa: E402,F401  (registers op_* and the live query)
from . import registry_stored  # noqa: E402,F401  (registers st_*: changes to stored tables)
