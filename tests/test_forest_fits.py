"""Forests over all folds: the star is joined once, rows keep their nodes, and fits side by side are bounded by the cores."""

from __future__ import annotations

import random

from caseloom.operators import models
from caseloom.plans import learning_queries as lq
from caseloom.session import MOST_ROWS


def test_the_star_is_joined_once(spark, tmp_path, monkeypatch):
    customers = [(i, f"c{i}", i % 5, 37.5 * i, "MACHINERY") for i in range(60)]
    orders = [(100 * i + j, i, "OP"[j % 2], 900.0 + 7 * i + j, "2-HIGH" if i % 3 else "5-LOW") for i in range(60) for j in range(16 if i % 4 else 9)]
    spark.createDataFrame(customers, "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string").write.parquet(f"{tmp_path}/customer.parquet")
    spark.createDataFrame(orders, "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderpriority string").write.parquet(f"{tmp_path}/orders.parquet")
    seen, split = [], lq.features.stratified_split

    def spied(df, *args, **kw):
        seen.append(df.inputFiles())
        return split(df, *args, **kw)
    monkeypatch.setattr(lq.features, "stratified_split", spied)
    train, test, _ = lq._classified(spark, str(tmp_path), "stroke")
    assert seen == [[]]  # what splits, fills and folds the rows does not read the orders again
    assert train.count() + test.count() == 60


def test_a_forest_with_kept_nodes_is_the_same(spark):
    rng = random.Random(3)
    rows = [(i % 2, rng.gauss(i % 2, 1), rng.gauss(0, 1), float(rng.randrange(3))) for i in range(400)]
    prepared = models.prepare(spark.createDataFrame(rows, "label int, x0 double, x1 double, x2 double").coalesce(2), ["x0", "x1", "x2"])
    estimator = models.recipes(trees=5)["Random Forest"].build(400).setParams(featuresCol=models.FEATURES, labelCol="label", weightCol=models.WEIGHT)
    assert estimator.getCacheNodeIds()
    trees = [e.fit(prepared).toDebugString.split("\n", 1)[1] for e in (estimator, estimator.copy({estimator.cacheNodeIds: False}))]
    assert trees[0] == trees[1] and "Tree 4" in trees[0]


def test_fits_side_by_side_follow_the_cores(spark):
    cores = spark.sparkContext.defaultParallelism
    assert models.fits_at_once(spark, 0) == models.fits_at_once(spark, MOST_ROWS) == min(6, max(2, 3 * cores))
    assert models.fits_at_once(spark, MOST_ROWS * cores) == 3
    assert models.fits_at_once(spark, MOST_ROWS * cores * 50) == 2
