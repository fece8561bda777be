from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from caseloom.operators import features, select
from caseloom.operators.features import OneHot, Scaler
from caseloom.operators.neighbours import nearest_points
from caseloom.operators.select import GeneticSearch


def brute(points, k):
    out = {}
    for i, x in points.items():
        d = sorted((float(np.sqrt(sum((a - b) ** 2 for a, b in zip(x, y)))), j) for j, y in points.items() if j != i)
        out[i] = d[:k]
    return out


@pytest.mark.parametrize("cells", [1, 5, 40])
def test_neighbours_equal_brute_force(spark, cells):
    rng = random.Random(4)
    points = {i: [round(rng.gauss(0, 1) + (20 if i % 3 == 0 else 0), 2), float(rng.randint(0, 3))] for i in range(250)}
    points = {i: x for i, x in points.items() if x not in [points[j] for j in range(i)]}
    df = spark.createDataFrame([(i, x, 1) for i, x in points.items()], "id bigint, x array<double>, m bigint")
    got = {r["id"]: [(n["d"], n["nid"]) for n in r["near"]] for r in nearest_points(df, 2, 5, cells=cells).collect()}
    want = brute(points, 5)
    for i in points:
        assert [j for _, j in got[i]] == [j for _, j in want[i]]


def test_dense_regions_get_pivots_of_their_own(spark, monkeypatch):
    from caseloom.operators import neighbours
    monkeypatch.setattr(neighbours, "POINTS_PER_CELL", 10)
    monkeypatch.setattr(neighbours, "PIVOTS_PER_CELL", 4)  # several levels, most of them in the dense region
    monkeypatch.setattr(neighbours, "ROWS_PER_GROUP", 25)
    points = {i: [i / 1000 if i % 10 else float(i)] for i in range(1, 300)}
    df = spark.createDataFrame([(i, x, 1) for i, x in points.items()], "id bigint, x array<double>, m bigint")
    got = {r["id"]: [n["nid"] for n in r["near"]] for r in nearest_points(df, 1, 3).collect()}
    want = brute(points, 3)
    assert all(got[i] == [j for _, j in want[i]] for i in points)
    leaves, levels = neighbours._cells(df, 1, 10, 42)
    assert len(levels) >= 3 and leaves.groupBy("cell").count().agg(F.max("count")).first()[0] <= 10 and leaves.count() == len(points)


def imbalanced(spark, twins: int = 0):
    rng = random.Random(9)
    rows = [(i, 0, rng.uniform(0, 10), float(rng.randint(0, 1))) for i in range(300)]
    rows += [(1000 + i, 1, rng.uniform(20, 30), float(rng.randint(0, 1))) for i in range(37)]
    rows += [(5000 + i, 1, 25.0, 1.0) for i in range(twins)]
    return spark.createDataFrame(rows, "id bigint, label int, a double, b double"), rows


@pytest.mark.parametrize("twins,cells", [(0, 1), (60, 1), (60, 6)])
def test_smote_balances_and_interpolates(spark, twins, cells):
    df, rows = imbalanced(spark, twins)
    out = features.smote(df, "id", ["a", "b"], k=5, cells=cells)
    sizes = {r["label"]: r["count"] for r in out.groupBy("label").count().collect()}
    assert sizes == {0: 300, 1: 300}
    assert out.where("copy = 0").count() == len(rows)
    minority = [(r[2], r[3]) for r in rows if r[1] == 1]
    for r in out.where("copy > 0").collect():
        # on the segment between its start and some minority point
        base = next((x[2], x[3]) for x in rows if x[0] == r["base"])
        assert any(abs((q[0] - base[0]) * (r["b"] - base[1]) - (q[1] - base[1]) * (r["a"] - base[0])) < 1e-9
                   and min(base[0], q[0]) - 1e-9 <= r["a"] <= max(base[0], q[0]) + 1e-9 for q in minority)


def test_smote_does_not_depend_on_partitioning(spark):
    df, _ = imbalanced(spark, 20)
    a = features.smote(df, "id", ["a", "b"]).orderBy("base", "copy").collect()
    b = features.smote(df.repartition(11), "id", ["a", "b"], cells=4).orderBy("base", "copy").collect()
    assert a == b


def test_smote_folds_never_touch_the_held_out_rows(spark):
    df, _ = imbalanced(spark)
    folded = features.stratified_folds(df, "id", k=3)
    made = features.smote_folds(folded, "id", ["a", "b"], folds=range(3))
    for f in range(3):
        held = {r["id"] for r in folded.where(F.col("fold") == f).collect()}
        train = made.where((F.col("cv_fold") == f) & (F.col("part") == "train"))
        assert not held & {r["base"] for r in train.collect()}
        assert len({r["count"] for r in train.groupBy("label").count().collect()}) == 1


def test_one_hot_drops_the_first_value(spark):
    df = spark.createDataFrame([("b", 1), ("a", 2), ("c", 3), (None, 4)], "w string, x int")
    hot = OneHot(["w"]).fit(df)
    assert hot.names == ["w_b", "w_c"]
    assert [(r["w_b"], r["w_c"]) for r in hot.transform(df).orderBy("x").collect()] == [(1, 0), (0, 0), (0, 1), (0, 0)]


def test_scaler_uses_the_population_deviation(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    out = Scaler(["a", "b"]).fit(df).transform(df).collect()
    assert [(r["a"], r["b"]) for r in out] == [(-1.0, 0.0), (1.0, 0.0)]


def test_contract(spark):
    df = spark.createDataFrame([(1, None, 9)], "b int, a double, extra int")
    row = features.feature_contract(df, ["a", "b", "c"]).first()
    assert row.asDict() == {"a": 0.0, "b": 1.0, "c": 0.0}


@pytest.fixture(scope="module")
def informative(spark):
    rng = random.Random(5)
    rows = []
    for i in range(600):
        y = rng.randint(0, 1)
        rows.append((i, y, i % 3, float(y if rng.random() < 0.95 else 1 - y), float(y if rng.random() < 0.8 else 1 - y), *[rng.random() for _ in range(4)]))
    return spark.createDataFrame(rows, "id bigint, label int, fold int, s1 double, s2 double, n1 double, n2 double, n3 double, n4 double").cache()


NAMES = ["s1", "s2", "n1", "n2", "n3", "n4"]


def test_scores_rank_the_informative_features_first(spark, informative):
    scores = select.feature_scores(informative, NAMES, discrete=["s1", "s2"])
    ranked = [r["feature"] for r in select.aggregate_ranks(scores).collect()]
    assert ranked[:2] == ["s1", "s2"]
    assert [r["feature"] for r in select.aggregate_ranks(scores, select.default_top(6)).collect()] == ranked[:3]


def test_genetic_search_finds_the_signal(spark, informative):
    search = GeneticSearch(NAMES, population=10, generations=6)
    chosen, fitness = search.run(informative)
    assert "s1" in chosen and fitness > 0.9
    best = [h["best_fitness"] for h in search.history]
    assert best == sorted(best) and len(best) == 6  # the elite survives
    assert search.history_table(informative).count() == 6


def test_smote_with_missing_features_and_text_keys(spark):
    rows = [(f"k{i}", int(i % 4 == 0), float(i), None if i == 8 else float(i % 3)) for i in range(40)]
    df = spark.createDataFrame(rows, "id string, label int, a double, b double")
    out = features.smote(df, "id", ["a", "b"]).collect()
    assert sum(r.label == 1 for r in out) == sum(r.label == 0 for r in out) == 30
    assert all(r.b is not None for r in out if r["copy"] > 0) and len({r.base for r in out}) == 40
    none = spark.createDataFrame([("a", 1, None), ("b", 0, 1.0), ("c", 0, 2.0)], "id string, label int, a double")
    assert len(features.smote(none, "id", ["a"]).collect()) == 3


def test_genetic_scans_read_distinct_rows(spark):
    """Equal rows are one counted row in few partitions, whatever the partitions of the input, and the fitness is that of all rows."""
    rows = [(i % 2, (i // 2) % 2, 1 if i % 7 == 0 else i % 2, i % 3) for i in range(600)]
    df = spark.createDataFrame(rows, "x0 int, x1 int, label int, fold int").repartition(40)
    search = GeneticSearch(["x0", "x1"], generations=1, population=4)
    collapsed = search._collapsed(df)
    assert collapsed.count() == len(set(rows)) and collapsed.agg(F.sum("_n")).first()[0] == len(rows)
    assert collapsed.rdd.getNumPartitions() == 1
    grams = search._grams(df)
    search._evaluate(collapsed, grams, [(1, 1)])
    scores = []
    for f in range(3):
        w, held = search._scorer(grams, f, (1, 1)), [r for r in rows if r[3] == f]
        hits = [(bool(w[0] + w[1] * a + w[2] * b > 0), y == 1) for a, b, y, _ in held]
        scores.append(select._weighted_f1(*(sum(h == (g, t) for h in hits) for g, t in ((False, False), (True, False), (False, True), (True, True)))))
    assert search.cache[(1, 1)] == pytest.approx(sum(scores) / 3 * 0.99)
