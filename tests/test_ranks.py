from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from caseloom.operators import features
from caseloom.operators.ranks import hash_parts, number_rows, prefix_sums, quantiles, settle


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows carry one value, a third belong to one group, one group is NULL."""
    rng = random.Random(1)
    rows = []
    for i in range(3000):
        group = "hot" if i % 3 == 0 else rng.choice(["a", "b", None])
        value = 7.0 if i % 3 == 1 else round(rng.uniform(-50, 50), 1)
        rows.append((i, group, value, rng.randint(0, 1)))
    return spark.createDataFrame(rows, "id bigint, g string, v double, y int").cache(), rows


@pytest.mark.parametrize("cells", [1, 4, 64])
def test_prefix_sums_equal_brute_force(skewed, cells):
    df, rows = skewed
    counts = df.groupBy("g", "v").agg(F.count(F.lit(1)).alias("n"))
    got = {(r["g"], r["v"]): (r["below_n"], r["total_n"]) for r in prefix_sums(counts, "v", ["n"], ["g"], cells).collect()}
    for group in ("hot", "a", "b", None):
        mine = [v for _, g, v, _ in rows if g == group]
        for v in set(mine):
            assert got[(group, v)] == (sum(1 for x in mine if x < v), len(mine))


@pytest.mark.parametrize("cells", [1, 16])
def test_quantiles_interpolate_like_numpy(skewed, cells):
    df, rows = skewed
    out = quantiles(df, "v", {"q1": 0.25, "q2": 0.5, "q9": 0.9}, ["g"], cells=cells).collect()
    for r in out:
        mine = [v for _, g, v, _ in rows if g == r["g"]]
        assert [r["q1"], r["q2"], r["q9"]] == pytest.approx(list(np.quantile(mine, [0.25, 0.5, 0.9])))


def test_lower_median(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,), (None,)], "v double")
    assert quantiles(df, "v", {"m": 0.5}, method="lower").first()["m"] == 2.0


def test_cells_respect_order(spark):
    df = spark.range(1000).select((F.col("id") % 97).cast("double").alias("v"), (F.col("id") % 3).alias("g"))
    rows = settle(df, "v", ["g"], 8).collect()
    assert len({r["_cell"] for r in rows}) > 4
    assert [r["_cell"] for r in sorted(rows, key=lambda r: (r["g"], r["v"], r["_cell"]))] == sorted(r["_cell"] for r in rows)
    assert len({(r["g"], r["v"], r["_cell"]) for r in rows}) == 3 * 97


def test_many_classes_are_split_too(spark):
    df = spark.range(22_002).select("id", (F.col("id") % 11_001).alias("y"))
    sizes = features.stratified_split(df, "id", "y", 0.5).groupBy("split").count().collect()
    assert {r["split"]: r["count"] for r in sizes} == {"test": 11_001, "train": 11_001}


def test_no_estimate_decides_the_path(spark):
    many = spark.range(300).select(F.explode(F.sequence(F.lit(0), F.lit(999))).alias("i"), "id").select((F.col("id") * 1000 + F.col("i")).alias("k"))
    got = number_rows(many, "k", "n", cells=16).where(F.col("n") != F.col("k") + 1).count()
    assert got == 0


@pytest.mark.parametrize("cells", [1, 8])
def test_row_numbers_run_through_the_blocks(spark, cells):
    df = spark.range(100).select("id", F.when(F.col("id") % 4 == 0, "first").otherwise("second").alias("b"))
    rows = number_rows(df, "id", "n", "b", ["first", "second"], cells).orderBy("n").collect()
    assert [r["n"] for r in rows] == list(range(1, 101))
    assert [r["id"] for r in rows] == [i for i in range(100) if i % 4 == 0] + [i for i in range(100) if i % 4]


def test_hash_parts_have_exact_sizes_and_repeat(skewed):
    df, _ = skewed
    sizes = {r["y"]: r["count"] for r in df.groupBy("y").count().collect()}
    split = features.stratified_split(df, "id", "y", 0.2)
    got = {(r["y"], r["split"]): r["count"] for r in split.groupBy("y", "split").count().collect()}
    for y, n in sizes.items():
        assert got[(y, "test")] == int(n * 0.2 + 0.5) and got[(y, "test")] + got[(y, "train")] == n
    again = features.stratified_split(df.repartition(13), "id", "y", 0.2)
    assert {r["id"] for r in split.where("split='test'").collect()} == {r["id"] for r in again.where("split='test'").collect()}


def test_folds_are_balanced_and_disjoint(skewed):
    df, rows = skewed
    folded = features.stratified_folds(df, "id", "y", 7)
    assert folded.count() == len(rows) and folded.where("fold IS NULL").count() == 0
    per = folded.groupBy("y", "fold").count().collect()
    for y in (0, 1):
        counts = [r["count"] for r in per if r["y"] == y]
        assert len(counts) == 7 and max(counts) - min(counts) <= 1


def test_copies_of_a_key_stay_together(spark):
    df = spark.range(200).select((F.col("id") % 50).alias("k"), F.lit(1).alias("y"))
    parts = hash_parts(df, "k", "y", [F.ceil(F.col("n") / 2)]).transform(df, "p")
    assert parts.groupBy("k").agg(F.countDistinct("p").alias("n")).where("n > 1").count() == 0
