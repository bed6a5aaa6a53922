"""The entry module without the optional operators."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]


@pytest.mark.parametrize("hide", ["rosterframe.llm", "rosterframe.llm.registry", "xxhash"])
def test_the_league_queries_stay_when_the_operators_cannot_be_imported(hide):
    code = f"import sys; sys.path.insert(0, {str(ROOT)!r}); sys.modules[{hide!r}] = None\nimport __spark_entry__ as e\nprint(len(e.queries()), len(e.oracle_sql()))"
    n, m = map(int, subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True).stdout.split())
    assert n == m >= 93
