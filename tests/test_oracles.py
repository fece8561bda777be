"""Every registered query with an oracle, at the smallest scale, against DuckDB."""

from __future__ import annotations

import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))

from check_oracle import TABLES, compare  # noqa: E402

from caseloom.plans import registry  # noqa: E402

PER_ROW_PYTHON = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas", "PythonMapInArrow")


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES.split():
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_equals_oracle(spark, sf, duck, name):
    verdict = compare(registry.QUERIES[name](spark, sf), duck, registry.ORACLES[name])
    assert verdict.startswith(("ok", "EMPTY")), verdict


@pytest.mark.parametrize("name", ["ol12_item_rates", "ol18_rollup_topk", "val5_nulls", "txt13_diabetes_records", "txt15_stroke_notes", "st2_mannwhitney", "ev3_roc_points",
                                  "xa5_rules", "fs4_rank_agg", "cln13b_surrogate_cells"])
def test_plan_stays_in_the_jvm(spark, sf, name):
    plan = registry.QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert not any(p in plan for p in PER_ROW_PYTHON)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_top_k_needs_no_full_sort(spark, sf):
    for name in ("ol18_rollup_topk", "ol19_slice_registry", "srt2_top_k"):
        assert "TakeOrderedAndProject" in registry.QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()


def test_scan_reads_only_what_the_query_needs(spark, sf):
    plan = registry.QUERIES["jn4_scalar_subquery"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "o_orderkey:bigint,o_totalprice:double>" in plan and "PushedFilters: [IsNotNull(o_totalprice)" in plan


