from __future__ import annotations

import random

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.sql import functions as F

from caseloom.operators import evaluate, explain, features, models, rules, serve
from caseloom.operators.features import Scaler
from caseloom.operators.rules import Rule

NAMES = [f"x{i}" for i in range(5)]


@pytest.fixture(scope="module")
def data(spark):
    """100 rows, 5 numeric features, two of them informative; 80/20 split."""
    rng = random.Random(42)
    rows = []
    for i in range(100):
        y = i % 2
        rows.append((i, y, rng.gauss(2.0 * y, 1), rng.gauss(-1.5 * y, 1), *[rng.gauss(0, 1) for _ in range(3)]))
    df = spark.createDataFrame(rows, "id bigint, label int, " + ", ".join(f"{n} double" for n in NAMES)).coalesce(1)
    split = features.stratified_split(df, "id")
    train = features.stratified_folds(split.where("split='train'"), "id", k=3).coalesce(1)
    return train.cache(), split.where("split='test'").cache()


@pytest.fixture(scope="module")
def report(data):
    train, test = data
    chosen = {n: r for n, r in models.recipes().items() if n in ("Logistic Regression", "Decision Tree")}
    return models.train_and_evaluate(train, test, NAMES, chosen, folds=3)


def test_results_have_one_row_per_model(report):
    assert {r["model"] for r in report.results.collect()} == {"Logistic Regression", "Decision Tree"}
    assert report.predictions.count() == 2 * 20
    assert {r["class"] for r in evaluate.class_report(report.predictions, ["model"]).collect()} == {"0", "1", "macro avg", "weighted avg"}


def test_metrics_stay_in_range(report):
    for r in report.results.collect():
        for m in ("accuracy", "f1", "recall", "precision", "roc_auc", "pr_auc", "cv_f1", "weighted_f1"):
            assert 0.0 <= r[m] <= 1.0
        assert -1.0 <= r["mcc"] <= 1.0
        assert r["accuracy"] >= 0.6  # the two informative features carry the label


def test_feature_count_is_logged(report):
    assert {r["n_features"] for r in report.results.collect()} == {5}


def test_voting_and_stacking(data):
    train, test = data
    prepared = models.prepare(train, NAMES, keep=["fold"])
    held = models.prepare(test, NAMES, train=train)
    fitted = models.fit_members(prepared, models.base_recipes())
    soft = models.predictions_of(models.Voting(fitted), held)
    hard = models.predictions_of(models.Voting(fitted, soft=False), held)
    assert soft.where("probability < 0 OR probability > 1").count() == 0 and hard.where("probability IS NOT NULL").count() == 0
    stacked = models.predictions_of(models.fit_stacking(prepared, models.base_recipes(), folds=3), held)
    table = {r["model"]: r for r in evaluate.full_evaluation(soft.unionByName(hard).unionByName(stacked), ["model"]).collect()}
    assert table["Voting (Hard)"]["roc_auc"] == 0.0 and table["Voting (Soft)"]["roc_auc"] > 0.7 and table["Stacking (LR Meta)"]["accuracy"] > 0.6


@pytest.fixture(scope="module")
def forest(data):
    train, _ = data
    prepared = models.prepare(train, NAMES)
    return RandomForestClassifier(numTrees=7, maxDepth=4, labelCol="label", featuresCol=models.FEATURES, weightCol=models.WEIGHT, seed=1).fit(prepared)


@pytest.mark.parametrize("cells", [explain._CELLS, 100])
def test_shapley_values_add_up_to_the_prediction(data, forest, monkeypatch, cells):
    monkeypatch.setattr(explain, "_CELLS", cells)
    _, test = data
    values = explain.shap_values(forest, test, NAMES, ["id"]).collect()
    fitted = models.Fitted("forest", forest)
    p = {r["id"]: r["probability"] for r in fitted.transform(models.prepare(test, NAMES, keep=["id"])).collect()}
    assert len(values) == 20
    for r in values:
        assert r["base"] + sum(r[n] for n in NAMES) == pytest.approx(p[r["id"]], abs=1e-9)
    ranked = [r["feature"] for r in explain.mean_abs_shap(explain.shap_values(forest, test, NAMES), NAMES).collect()]
    assert set(ranked[:2]) == {"x0", "x1"}


def test_leaf_values_equal_the_definition():
    import itertools
    import math

    import numpy as np
    for m in (1, 2, 3, 6):
        share, value = np.array([[0.3, 0.6, 0.5, 0.0, 1.0, 0.25][:m]]), np.array([2.0])
        patterns = np.array(list(itertools.product([False, True], repeat=m)))
        phi = explain.leaf_values(value, share, patterns[:, None, :])
        for met, got in zip(patterns, phi[:, 0]):

            def game(s):
                return 2.0 * math.prod(met[j] if j in s else share[0][j] for j in range(m))
            for i in range(m):
                others = [j for j in range(m) if j != i]
                want = sum(math.factorial(len(s)) * math.factorial(m - 1 - len(s)) / math.factorial(m) * (game({*s, i}) - game(set(s)))
                           for r in range(m) for s in itertools.combinations(others, r))
                assert got[i] == pytest.approx(want, abs=1e-12)


def test_deep_forests_have_shapley_values(spark):
    rng = random.Random(8)
    rows = [(i, *[rng.random() for _ in range(25)]) for i in range(600)]
    rows = [(*r, int(sum(r[1:]) + rng.random() > 13)) for r in rows]
    names = [f"x{i}" for i in range(25)]
    df = spark.createDataFrame(rows, "id int, " + ", ".join(f"{n} double" for n in names) + ", label int").coalesce(1)
    prepared = models.prepare(df, names, keep=["id"])
    model = RandomForestClassifier(numTrees=3, maxDepth=20, labelCol="label", featuresCol=models.FEATURES, featureSubsetStrategy="2", seed=1).fit(prepared)
    tables, _ = explain.forest_leaves(model, df)
    assert max(t.features.shape[1] for t in tables) >= 10
    p = {r["id"]: r["probability"] for r in models.Fitted("forest", model).transform(prepared).collect()}
    for r in explain.shap_values(model, df.limit(40), names, ["id"]).collect():
        assert r["base"] + sum(r[n] for n in names) == pytest.approx(p[r["id"]], abs=1e-9)


def test_tree_importance_flags_the_top_quarter(data, forest):
    rows = explain.tree_importance(forest, NAMES, data[0]).collect()
    assert sum(r["importance"] for r in rows) == pytest.approx(1.0) and [r["top"] for r in rows][:2] == [True, True]


def test_permuting_an_unused_feature_changes_nothing(data):
    train, _ = data

    def predict(df):
        return df.withColumn("prediction", F.when(F.col("x0") > 1.0, 1).otherwise(0))
    out = {r["feature"]: r["importance_mean"] for r in explain.permutation_importance(train, "id", NAMES, predict, repeats=5).collect()}
    assert out["x0"] > 0.1 and all(out[n] == 0.0 for n in NAMES[1:])


def test_local_surrogate_follows_a_linear_model(data):
    train, test = data
    scaler = Scaler(NAMES).fit(train)

    def predict(df):
        return df.withColumn("probability", 1 / (1 + F.exp(-(0.8 * F.col("x0") - 0.4 * F.col("x1")))))
    rows = explain.local_surrogates(test, NAMES, scaler.mean, scaler.std, predict, ["id"], samples=500).collect()
    assert len(rows) == 20 * 5
    for r in rows:
        if r["feature"] in ("x0", "x1"):
            assert (r["weight"] > 0) == (r["feature"] == "x0")
        else:
            assert abs(r["weight"]) < 0.02


def test_rules_fire_in_order_and_nulls_do_not(spark):
    made = [Rule("R1", "a >= 1", "HIGH RISK — x", 0.9, "e1", F.col("a") >= 1, True), Rule("R2", "b = 0", "MONITOR", 0.5, "e2", F.col("b") == 0, False)]
    df = spark.createDataFrame([(1, 2, 0, 1, 0.8), (2, 0, 0, 1, 0.6), (3, None, 5, 0, 0.1), (4, 1, 1, 0, 0.2)], "id int, a int, b int, prediction int, probability double")
    judged = rules.with_agreement(df, made)
    got = {r["id"]: ([f["rule_id"] for f in r["fired"]], r["agrees"]) for r in judged.collect()}
    assert got == {1: (["R1", "R2"], True), 2: (["R2"], False), 3: ([], True), 4: (["R1"], False)}
    text = {r["id"]: r["t"] for r in judged.select("id", rules.explanation(judged, "Stroke").alias("t")).collect()}
    assert "ML Model Prediction: HIGH RISK" in text[1] and "[R1] IF a >= 1" in text[1] and "Confidence: 90%" in text[1]
    assert "DISAGREE" in text[2] and "No clinical rules triggered." in text[3] and "80.0%" in text[1]
    assert rules.rule_table(df, made).count() == 2


def test_saved_model_scores_in_the_saved_order(spark, data, tmp_path):
    train, test = data
    scaler = Scaler(["x0", "x1"]).fit(train)
    stages = [models.scaling_stage(scaler), models.assembler(["x0__scaled", "x1__scaled", "x2"]), LogisticRegression(labelCol="label", featuresCol=models.FEATURES)]
    path = str(tmp_path / "model")
    models.save_model(Pipeline(stages=stages).fit(train.select("label", *NAMES)), path)
    store = serve.ModelStore()
    out = serve.score(test.drop("x2").withColumn("noise", F.lit(1)), store.get(path), ["x0", "x1", "x2"], ["id"])
    assert out.columns == ["id", "prediction", "probability", "risk_level"] and out.count() == 20
    assert out.where("(prediction = 1) != (risk_level = 'High')").count() == 0
    store.reload(path)
    assert store.get(path) is not None


def test_registry_and_rollback(spark):
    registry = serve.registered(serve.registered(serve.empty_registry(spark), "stroke", "v1", "/m/1"), "stroke", "v2", "/m/2")
    assert serve.active_versions(registry).first()["version"] == "v2"
    back = serve.rolled_back(registry, "stroke", "v1")
    row = serve.active_versions(back).first()
    assert (row["version"], row["path"], row["seq"]) == ("v1", "/m/1", 3) and back.count() == 3
    with pytest.raises(ValueError, match="v9"):
        serve.rolled_back(registry, "stroke", "v9")
