"""Every registered query: runs, matches its DuckDB oracle at sf0.001, and has
a plan without cartesian products."""

from __future__ import annotations

import pytest
from conftest import SF001
from oracle_check import canon, duck

import __spark_entry__ as E
from rosterframe.plans.registry import ORACLE, QUERIES

KEYS = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


def test_every_key_has_an_oracle():
    assert set(ORACLE) == set(QUERIES)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "bref_id" in df.columns


SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "float": "FLOAT", "string": "VARCHAR",
                 "boolean": "BOOLEAN", "date": "DATE"}


@pytest.mark.parametrize("key", KEYS)
def test_against_oracle(spark, con, key):
    """Column names, column types and the multiset of rows."""
    df = QUERIES[key](spark, SF001)
    srows = [tuple(r) for r in df.collect()]
    rel = con.sql(ORACLE[key])
    sc, sm = canon(df.columns, srows)
    dc, dm = canon(rel.columns, rel.fetchall())
    assert sc == dc
    assert sm == dm
    duck_types = dict(zip(rel.columns, map(str, rel.types)))
    for f in df.schema.fields:
        assert SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString()) == duck_types[f.name], f.name


@pytest.mark.parametrize("key", ["p_ml_features", "p_ml_features_live", "p_ml_features_backfill",
                                 "q_prediction_scores_all_dates", "m_delete_source_ids", "q_pending_counts"])
def test_plans_have_no_cartesian_product(spark, key):
    plan = QUERIES[key](spark, SF001)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_flagship_plan_shape(spark):
    qe = QUERIES["p_ml_features"](spark, SF001)._jdf.queryExecution()
    plan = qe.executedPlan().toString()
    assert "WindowGroupLimit" in plan                     # top-N before the shuffle
    assert "broadcast)" not in qe.logical().toString()    # no forced broadcast: Spark decides by size
