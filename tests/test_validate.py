from __future__ import annotations

import pytest

from caseloom.operators import validate
from caseloom.operators.validate import Constraint, DataQualityError


def test_missing_and_binary_gates_name_the_columns(spark):
    df = spark.createDataFrame([(1, None), (2, 0)], "a int, b int")
    with pytest.raises(DataQualityError, match="b"):
        validate.assert_no_missing(df, "t")
    with pytest.raises(DataQualityError, match="a"):
        validate.assert_binary(df, ["a", "b"], "t")
    validate.assert_binary(df, ["b"], "t")


def test_null_is_no_domain_violation(spark):
    df = spark.createDataFrame([("x",), (None,), ("z",)], "c string")
    rows = validate.domain_violations({"t": (df, {"c": ["x", "y"]})}).collect()
    assert [(r["check_target"], r["violations"]) for r in rows] == [("t.c", 1)]


def test_orphans_include_clean_facts(spark):
    dim = spark.createDataFrame([(1,), (2,)], "k int")
    facts = {"f": spark.createDataFrame([(1,), (3,), (3,)], "k int"), "g": spark.createDataFrame([(2,)], "k int")}
    got = {r["fact_table"]: r["orphaned_rows"] for r in validate.orphan_counts(facts, dim, "k").collect()}
    assert got == {"f": 2, "g": 0}


def test_checked_write_refuses_bad_rows(spark, tmp_path):
    df = spark.createDataFrame([(5,), (11,), (None,)], "score int")
    rules = [Constraint.between("score", 0, 10)]
    with pytest.raises(DataQualityError):
        validate.write_checked(df, rules, str(tmp_path / "x"))
    good, bad = validate.split_by_constraints(df, rules)
    assert good.count() == 2 and bad.collect()[0]["violated"] == ["score between 0 and 10"]
    validate.write_checked(good, rules, str(tmp_path / "x"))
    assert spark.read.parquet(str(tmp_path / "x")).count() == 2


def test_cascade(spark):
    dim = spark.createDataFrame([(1,), (2,)], "k int")
    new_dim, facts = validate.cascade_delete(dim, {"f": spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")}, dim.where("k = 1"), "k")
    assert new_dim.count() == 1 and [r["v"] for r in facts["f"].collect()] == ["b"]
