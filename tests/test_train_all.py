"""Training and evaluation of all recipes, with all prepared features and oversampling inside the folds."""

from __future__ import annotations

from pyspark.sql import functions as F

from caseloom.plans import learning_queries as lq


def test_all_recipes_on_prepared_features(spark):
    got = lq._all_models(spark, "/root/testdata/sf0.01", ["stroke"], rounds=2, trees=3).collect()
    assert {r.model for r in got} == set(lq.models.recipes()) and len(got) == 5
    train, test, names = lq._classified(spark, "/root/testdata/sf0.01", "stroke")
    assert {r.n_features for r in got} == {len(names)} and "bmi" in names and any(n.startswith("work_type_") for n in names)
    assert any(n.startswith("smoking_status_") for n in names) and len(names) > len(lq.STROKE_FEATURES) + 1
    assert train.where("bmi IS NULL").count() == test.where("bmi IS NULL").count() == 0


def test_all_tables_are_trained():
    assert set(lq._CLASSIFIED) == {"autism", "diabetes", "stroke"}


def test_a_fit_reads_no_empty_partitions(spark, monkeypatch):
    """The raised rows of each fold lie in partitions of their own, so that the small jobs of a fit have no idle tasks."""
    seen, fit = [], lq.models.fit
    monkeypatch.setattr("caseloom.session.LEAST_ROWS", 64)

    def spied(recipe, rows, *args):
        seen.append((rows.rdd.getNumPartitions(), rows.select(F.spark_partition_id()).distinct().count(), rows.count()))
        return fit(recipe, rows, *args)
    monkeypatch.setattr(lq.models, "fit", spied)
    rows = [(i, i % 3 // 2, float(i % 7), float(i % 11), i % 5) for i in range(600)]
    table = spark.createDataFrame(rows, "id bigint, label int, a double, b double, fold int").repartition(6)
    got = lq.models.train_and_evaluate(table, table, ["a", "b"], {"Decision Tree": lq.models.recipes()["Decision Tree"]}, oversample="id")
    assert got.results.count() == 1 and len(seen) == 6
    assert all(parts == filled for parts, filled, _ in seen)
    assert sorted(n for *_, n in seen) == [640] * 5 + [800]
