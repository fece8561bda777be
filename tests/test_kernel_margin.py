"""The kernel margin on two rings, against a linear one and against a kernel machine over all pairs of rows."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from caseloom.operators import models


def rings(n, seed):
    r = random.Random(seed)
    out = []
    for i in range(n):
        y = i % 2
        a, d = r.uniform(0, 2 * math.pi), r.gauss(1.0 + 1.5 * y, 0.2)
        out.append((i, d * math.cos(a), d * math.sin(a), y))
    return out


@pytest.fixture(scope="module")
def prepared(spark):
    def build(rows):
        return models.prepare(spark.createDataFrame(rows, "id int, x double, y double, label int").coalesce(2), ["x", "y"], keep=["id"])
    return build


def dual(x, y, gamma, steps=400):
    """Dual ascent over the kernel matrix (C = 1, the bias inside the kernel)."""
    k = np.exp(-gamma * ((x[:, None] - x[None]) ** 2).sum(-1)) + 1.0
    s, a = 2 * y - 1, np.zeros(len(x))
    for _ in range(steps):
        for i in range(len(x)):
            a[i] = np.clip(a[i] + (1 - s[i] * (k[i] @ (a * s))) / k[i, i], 0, 1)
    return lambda z: (np.exp(-gamma * ((z[:, None] - x[None]) ** 2).sum(-1)) + 1.0) @ (a * s)


def test_random_features_approach_the_kernel(prepared):
    kernel = models.GaussianFeatures.of(prepared(rings(50, 1)), 4096, gamma=0.7)
    x = np.array([r[1:3] for r in rings(40, 2)])
    z = kernel.map(x)
    assert np.abs(z @ z.T - np.exp(-0.7 * ((x[:, None] - x[None]) ** 2).sum(-1))).max() < 0.08


def test_rings(prepared):
    train, test = rings(200, 3), rings(200, 4)
    held = prepared(test)
    recipe = models.base_recipes()["svm"]
    fitted = models.fit(recipe, prepared(train))
    got = {r["id"]: r for r in fitted.transform(held).collect()}
    accuracy = np.mean([got[r[0]]["prediction"] == r[3] for r in test])
    linear = models.fit(models.Recipe("svm", recipe.build), prepared(train))
    plain = {r["id"]: r["prediction"] for r in linear.transform(held).collect()}
    assert accuracy > 0.95 > 0.75 > np.mean([plain[r[0]] == r[3] for r in test])
    x, y = np.array([r[1:3] for r in train]), np.array([r[3] for r in train])
    gamma = 1 / (2 * x.var())
    margin = dual(x, y, gamma)(np.array([r[1:3] for r in test]))
    assert np.mean([(m > 0) == got[r[0]]["prediction"] for m, r in zip(margin, test)]) > 0.95
    p = np.array([got[r[0]]["probability"] for r in test])
    assert ((p > 0) & (p < 1)).all() and p[[r[3] == 1 for r in test]].mean() > 0.8 > 0.2 > p[[r[3] == 0 for r in test]].mean()
    assert np.corrcoef(np.argsort(np.argsort(margin)), np.argsort(np.argsort(p)))[0, 1] > 0.9


def test_probabilities_come_from_rows_that_a_model_has_not_seen(prepared):
    r = random.Random(5)  # labels without any pattern: a margin of its own training rows would look certain
    rows = [(i, r.gauss(0, 1), r.gauss(0, 1), r.randrange(2)) for i in range(300)]
    fitted = models.fit_kernel(models.Recipe("svm", models.base_recipes()["svm"].build, kernel=256), prepared(rows), gamma=30.0)
    p = [x["probability"] for x in fitted.transform(prepared(rows)).collect()]
    assert max(p) < 0.75 and min(p) > 0.25


def test_platt_equals_a_direct_minimum(spark):
    r = random.Random(6)
    rows = [(y, r.choice([0.5, 2.0]), r.gauss(2 * y - 1, 1)) for y in [0, 1] * 60]
    model = models._platt(spark.createDataFrame(rows, f"label int, {models.WEIGHT} double, _m double"), "label")
    y, w, m = (np.array(c, float) for c in zip(*rows))
    t = np.where(y == 1, 61 / 62, 1 / 62)
    a = b = 0.0
    for _ in range(200):
        p = 1 / (1 + np.exp(-(a * m + b)))
        g = np.array([(w * (p - t) * m).sum(), (w * (p - t)).sum()])
        h = w * p * (1 - p)
        a, b = np.array([a, b]) - np.linalg.solve([[(h * m * m).sum(), (h * m).sum()], [(h * m).sum(), h.sum()]], g)
    assert float(model.coefficients[0]) == pytest.approx(a, abs=1e-4) and model.intercept == pytest.approx(b, abs=1e-4)


def test_all_columns_stay(prepared):
    rows = prepared(rings(40, 7)).withColumn("extra", F.lit("x"))
    out = models.fit(models.base_recipes()["svm"], rows).transform(rows)
    assert out.columns == [*rows.columns, "probability", "prediction"] and out.select(models.FEATURES).first()[0].size == 2


def short():
    recipe = models.base_recipes()["svm"]
    return models.Recipe("svm", lambda n: recipe.build(n).setMaxIter(5), kernel=16)


def test_scores_need_no_row_of_random_features(prepared):
    held = prepared(rings(50, 10))
    fitted = models.fit(short(), prepared(rings(100, 11)))
    wide = fitted.kernel.transform(held, "_f").collect()
    z = np.array([r["_f"].toArray() for r in wide]) @ fitted.model.coefficients.toArray() + fitted.model.intercept
    found = held.withColumn("m", fitted.kernel.margin(fitted.model.coefficients.toArray(), fitted.model.intercept))
    assert dict(found.schema["m"].jsonValue())["type"] == "double"
    assert [r["m"] for r in found.collect()] == pytest.approx(z.tolist(), abs=1e-12)


def test_stacking_fits_one_kernel_margin_at_a_time(prepared, monkeypatch):
    from threading import Lock

    running, most, lock, fit_kernel = [0], [0], Lock(), models.fit_kernel

    def counted(*args, **named):
        with lock:
            running[0] += 1
            most[0] = max(most[0], running[0])
        try:
            return fit_kernel(*args, **named)
        finally:
            with lock:
                running[0] -= 1
    monkeypatch.setattr(models, "fit_kernel", counted)
    rows = prepared(rings(60, 12)).withColumn("fold", F.expr("int(id div 2 % 2)"))
    models.fit_stacking(rows, {"svm": short()}, folds=2)
    assert most[0] == 1
