from __future__ import annotations

import pytest


@pytest.fixture()
def docs_of(spark):
    """Rows (doc_id, text[, lang, source]) -> a documents table, with an extra column."""

    def make(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s",
                 len(r[1]) if r[1] is not None else None, "x") for r in rows]
        return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long, fp string")

    return make
