from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from caseloom.operators import evaluate

SCHEMA = "model string, label int, probability double, prediction int"


def frame(spark, rows):
    return spark.createDataFrame([("m", y, p, int(p >= 0.5)) for y, p in rows], SCHEMA)


@pytest.mark.parametrize("cells", [1, 8])
def test_areas_with_ties(spark, cells):
    rows = [(1, 0.9), (0, 0.9), (1, 0.4), (0, 0.4), (0, 0.1), (1, 0.8)]
    out = evaluate.ranking_scores(frame(spark, rows), ["model"], cells).first()
    pos, neg = [p for y, p in rows if y], [p for y, p in rows if not y]
    auc = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / 9
    # thresholds 0.9: P 1/2 R 1/3; 0.8: P 2/3 R 2/3; 0.4: P 3/5 R 1
    assert out["roc_auc"] == pytest.approx(auc)
    assert out["pr_auc"] == pytest.approx((0.5 + 2 / 3 + 3 / 5) / 3)


def test_reversed_scores_mirror_the_area(spark):
    rng = random.Random(3)
    df = frame(spark, [(rng.randint(0, 1), rng.randint(0, 20) / 20) for _ in range(400)])
    a = evaluate.ranking_scores(df, ["model"]).first()["roc_auc"]
    b = evaluate.ranking_scores(df.withColumn("probability", 1 - F.col("probability")), ["model"]).first()["roc_auc"]
    assert a + b == pytest.approx(1.0)


def test_zero_margins_give_zero(spark):
    out = evaluate.metrics(frame(spark, [(0, 0.1), (1, 0.2), (0, 0.3)]), ["model"]).first()
    assert (out["precision"], out["recall"], out["f1"], out["mcc"]) == (0.0, 0.0, 0.0, 0.0) and out["accuracy"] == pytest.approx(2 / 3)


def test_mcc(spark):
    out = evaluate.metrics(frame(spark, [(1, 0.9)] * 3 + [(1, 0.1)] + [(0, 0.1)] * 4 + [(0, 0.9)] * 2), ["model"]).first()
    assert out["mcc"] == pytest.approx((3 * 4 - 2 * 1) / math.sqrt(5 * 4 * 6 * 5))


def test_sweep_counts_scores_on_the_threshold(spark):
    rows = [(i % 2, t) for i, t in enumerate(evaluate.SWEEP)] + [(1, 0.0), (0, 1.0), (1, 0.0499999), (0, 0.95)]
    got = {r["threshold"]: r for r in evaluate.threshold_sweep(frame(spark, rows), ["model"]).collect()}
    assert len(got) == 91
    for t in evaluate.SWEEP:
        tp, fp = sum(1 for y, p in rows if y and p >= t), sum(1 for y, p in rows if not y and p >= t)
        assert got[t]["precision"] == pytest.approx(tp / (tp + fp) if tp + fp else 0.0, abs=6e-5)
        assert got[t]["recall"] == pytest.approx(tp / sum(y for y, _ in rows), abs=6e-5)


def test_uneven_thresholds(spark):
    got = [r["n"] for r in spark.createDataFrame([(0.05,), (0.3,), (0.31,), (0.9,)], "p double").select(
        evaluate.thresholds_reached(F.col("p"), [0.1, 0.3, 0.9]).alias("n")).collect()]
    assert got == [0, 2, 2, 3]


def test_first_best_threshold_and_clinical_default(spark):
    sweep = spark.createDataFrame([("m", 0.1, 0.1, 0.9, 0.5), ("m", 0.2, 0.15, 0.8, 0.5), ("m", 0.3, 0.1, 0.2, 0.4)],
                                  "model string, threshold double, precision double, recall double, f1 double")
    out = evaluate.best_thresholds(sweep, ["model"]).first()
    assert (out["f1_threshold"], out["clinical_threshold"], out["clinical_recall"]) == (0.1, 0.5, 0.0)


def test_best_model_ties_go_to_the_first_name(spark):
    rows = [("d", "b", 0.5, 0.1), ("d", "a", 0.5, 0.2), ("s", "a", 0.9, 0.1), ("s", "b", 0.1, 0.8)]
    df = spark.createDataFrame(rows, "dataset string, model string, f1 double, pr_auc double")
    got = {r["dataset"]: r["best_model"] for r in evaluate.best_models(df, {"s": "pr_auc"}, shown=["f1", "pr_auc"]).collect()}
    assert got == {"d": "a", "s": "b"}
