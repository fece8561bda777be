from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from caseloom.functions.scalar import chi2_upper, erfc, kolmogorov_upper
from caseloom.operators import stats


def cell(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize("x", [0.0, 0.3, 1.0, 2.5, 5.0, 10.0])
def test_erfc(spark, x):
    assert cell(spark, erfc(F.lit(x))) == pytest.approx(math.erfc(x), rel=2e-7)


@pytest.mark.parametrize("x,dof,p", [(3.841459, 1, 0.05), (5.991465, 2, 0.05), (7.814728, 3, 0.05), (9.487729, 4, 0.05), (11.0705, 5, 0.05),
                                     (18.30704, 10, 0.05), (30.57791, 15, 0.01)])
def test_chi2_tail(spark, x, dof, p):
    assert cell(spark, chi2_upper(F.lit(x), F.lit(dof))) == pytest.approx(p, rel=1e-4)


def test_kolmogorov_tail(spark):
    assert cell(spark, kolmogorov_upper(F.lit(1.3581))) == pytest.approx(0.05, abs=1e-4)


def test_chi2_with_continuity_correction(spark):
    rows = [("f", 0)] * 10 + [("f", 1)] * 20 + [("g", 0)] * 30 + [("g", 1)] * 40
    out = stats.chi2_independence(spark.createDataFrame(rows, "x string, label int"), ["x"]).first()
    n, ad_bc = 100, abs(10 * 40 - 20 * 30)
    assert out["chi2"] == pytest.approx(n * (ad_bc - n / 2) ** 2 / (30 * 70 * 40 * 60))
    assert out["dof"] == 1 and out["p_value"] == pytest.approx(math.erfc(math.sqrt(out["chi2"] / 2)), rel=1e-6)


def test_chi2_counts_pairs_that_never_occur(spark):
    rows = [("a", 0)] * 5 + [("b", 1)] * 5 + [("c", 0)] * 5
    out = stats.chi2_independence(spark.createDataFrame(rows, "x string, label int"), ["x"]).first()
    assert (out["chi2"], out["dof"]) == (pytest.approx(15.0), 2)


@pytest.mark.parametrize("cells", [1, 4])
def test_mann_whitney_with_ties(spark, cells):
    zero, one = [1, 2, 2, 3, 5], [2, 4, 4, 6]
    df = spark.createDataFrame([(float(v), 0) for v in zero] + [(float(v), 1) for v in one], "v double, label int")
    out = stats.mann_whitney(df, ["v"], cells=cells).first()
    u = sum((a > b) + 0.5 * (a == b) for a in zero for b in one)
    ties = (3 ** 3 - 3) + (2 ** 3 - 2)
    sd = math.sqrt(5 * 4 / 12 * (10 - ties / (9 * 8)))
    z = (abs(u - 10) - 0.5) / sd
    assert out["u"] == u and out["effect_r"] == pytest.approx(1 - 2 * u / 20)
    assert out["z"] == pytest.approx(z) and out["p_value"] == pytest.approx(math.erfc(z / math.sqrt(2)), rel=1e-6)


def test_ks(spark):
    df = spark.createDataFrame([(float(v), "train") for v in (1, 2, 3, 4)] + [(float(v), "test") for v in (3, 4, 5, 6)], "v double, split string")
    assert stats.kolmogorov_smirnov(df, ["v"], "split", "train", "test").first()["ks"] == pytest.approx(0.5)


def test_constant_feature_has_no_effect(spark):
    df = spark.createDataFrame([(1.0, 0), (1.0, 1), (1.0, 1)], "v double, label int")
    out = stats.mann_whitney(df, ["v"]).first()
    assert out["u"] == 1.0 and out["z"] is None and out["effect_r"] == 0.0
