from __future__ import annotations

import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def documents(spark):
    """Builds a documents table from (doc_id, text) pairs, with an extra column whose name clashes with internal ones."""
    def build(rows, parts=3):
        full = [(i, t, "en", "s", len(t or ""), "x") for i, t in rows]
        return spark.createDataFrame(full, SCHEMA + ", block string").repartition(parts)
    return build

