from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from caseloom.operators import clean
from caseloom.operators.clean import MedianImputer


def test_null_tokens_and_casts(spark):
    df = spark.createDataFrame([("?", " x "), ("N/A", "None"), ("1.5", "NA"), ("abc", "nan")], "a string, b string")
    rows = clean.cast_columns(clean.trim_strings(clean.null_tokens(df)), {"a": "double"}).collect()
    assert [r["a"] for r in rows] == [None, None, 1.5, None]
    assert [r["b"] for r in rows] == ["x", None, None, "nan"]


def test_value_map_ignores_case_and_keeps_what_fits(spark):
    df = spark.createDataFrame([("YES",), ("no",), ("1",), ("maybe",), (None,)], "v string")
    assert [r["v"] for r in clean.map_columns(df, ["v"], {"yes": 1, "no": 0}).collect()] == [1, 0, 1, None, None]
    text = clean.map_columns(spark.createDataFrame([("M",), ("x",)], "v string"), ["v"], {"m": "Male"}).collect()
    assert [r["v"] for r in text] == ["Male", "x"]


def test_brackets_are_right_closed(spark):
    ages = [0.0, 0.08, 18.0, 18.5, 40.0, 60.0, 80.0, 80.1]
    df = spark.createDataFrame([(a,) for a in ages], "age double").select(clean.age_bracket("age").alias("b"))
    assert [r["b"] for r in df.collect()] == [None, "0-18", "0-18", "19-40", "19-40", "41-60", "61-80", "81+"]


def test_grouped_median_with_fallback(spark):
    rows = [("a", 10.0), ("a", 20.0), ("a", None), ("b", 30.0), ("b", 50.0), ("c", None), (None, 99.0), (None, None)]
    df = spark.createDataFrame(rows, "g string, v double")
    imputer = MedianImputer("v", "g").fit(df)
    got = sorted((r["g"] or "", r["v"]) for r in imputer.transform(df).collect())
    # medians a=15, b=40; after filling: 10 15 20 30 50 99 -> overall median 25; the existing value without a group stays
    assert imputer.medians == {"a": 15.0, "b": 40.0} and imputer.fallback == 25.0
    assert got == [("", 25.0), ("", 99.0), ("a", 10.0), ("a", 15.0), ("a", 20.0), ("b", 30.0), ("b", 50.0), ("c", 25.0)]
    table = {r["g"]: (r["median"], r["missing"]) for r in imputer.bracket_table(df).collect()}
    assert table["a"] == (15.0, 1) and table["c"] == (None, 1)


def test_many_groups_are_joined_instead(spark, monkeypatch):
    monkeypatch.setattr(clean, "FEW_GROUPS", 1)
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("b", 3.0), ("b", None), (None, 5.0)], "g string, v double")
    got = MedianImputer("v", "g").fit(df).transform(df)
    assert got.columns == ["g", "v"] and sorted(r["v"] for r in got.collect()) == [1.0, 1.0, 3.0, 3.0, 5.0]


def test_sentinels_keep_nulls(spark):
    df = spark.createDataFrame([("Male",), ("OTHER",), (None,)], "s string")
    assert [r["s"] for r in clean.drop_sentinels(df, "s", ["Other"]).collect()] == ["Male", None]


@pytest.mark.parametrize("months,years", [(18, 2), (30, 2), (42, 4), (12, 1), (17, 1)])
def test_months_round_half_to_even(spark, months, years):
    assert spark.range(1).select(clean.months_to_years(F.lit(months)).alias("y")).first()["y"] == years


def test_slang(spark):
    assert spark.range(1).select(clean.expand_slang(F.lit("bc u and w/ u there")).alias("t")).first()["t"] == "because you and with you there"
