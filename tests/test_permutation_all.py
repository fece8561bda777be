"""Permutation importance over all features, against plain Python."""

from __future__ import annotations

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from caseloom.operators import explain
from caseloom.plans import fixtures as fx
from caseloom.plans import registry


def permutation(n, repeat, seed=42):
    """The keyed permutation of 0 .. n - 1, one number at a time."""
    a = 1
    while a * a < n:
        a += 1
    b = -(-n // a)

    def mixed(x, round_):
        once = ((x + 1) * 2654435761 + repeat * 131 + seed * 7919 + round_ * 104729) % 2**32
        return once // 128 * 48271 % 2147483647

    def step(v):
        left, right = v % a, v // a
        for round_ in (0, 2):
            left = (left + mixed(right, round_)) % a
            right = (right + mixed(left, round_ + 1)) % b
        return right * a + left
    out = []
    for i in range(n):
        v = step(i)
        while v >= n:
            v = step(v)
        out.append(v)
    return np.array(out)


@pytest.mark.parametrize("n", [1, 2, 3, 5, 10, 24, 100, 101, 1000, 4097])
def test_every_number_is_hit_once(n):
    a, b = explain._sides(n)
    assert a * b >= n and a * b - n < a
    for r in (1, 2):
        assert sorted(permutation(n, r).tolist()) == list(range(n))
    if n > 50:
        p = permutation(n, 1)
        assert (p != permutation(n, 2)).mean() > 0.9 and (p == np.arange(n)).mean() < 0.1
        assert abs(np.corrcoef(np.arange(n), p)[0, 1]) < 0.25


def test_all_features_are_permuted(spark, sf):
    names = [*fx.OBS_FLAGS, *fx.OBS_MEASURES]
    rows = fx.obs(spark, sf).selectExpr(*[f"cast({k} AS string) AS k{i}" for i, k in enumerate(fx.OBS_KEY)], "label", *[f"cast({n} AS double) AS {n}" for n in names]).collect()
    keyed = [(int(hashlib.md5("|".join([*r[:4], "42"]).encode()).hexdigest()[:15], 16), r) for r in rows]
    keyed.sort(key=lambda x: x[0])
    x, y = np.array([[r[n] for n in names] for _, r in keyed]), np.array([r["label"] for _, r in keyed])
    above = np.array([0.0, 0.0, 0.0, 0.0, 25.0, 38000.0])
    accuracy = lambda m: (((m > above).sum(axis=1) >= 3) == y).mean()
    want = {n: [] for n in names}
    for r in range(1, 11):
        p = permutation(len(x), r)
        for i, n in enumerate(names):
            moved = x.copy()
            moved[:, i] = x[p, i]
            want[n].append(accuracy(x) - accuracy(moved))
    got = {r.feature: (r.importance_mean, r.importance_std) for r in registry.QUERIES["xa2b_permutation_all"](spark, sf).collect()}
    assert set(got) == set(names)
    for n in names:
        assert np.allclose(got[n], (np.mean(want[n]), np.std(want[n])), atol=2e-8), n


def test_few_rows_and_one_key(spark):
    predict = lambda df: df.withColumn("prediction", F.col("x").cast("int"))
    for rows in ([(1, 1, 1.0)], [(1, 1, 1.0), (1, 0, 0.0), (1, 1, 1.0)]):
        df = spark.createDataFrame(rows, "id int, label int, x double")
        got = explain.permutation_importance(df, "id", ["x"], predict, repeats=3).collect()
        assert len(got) == 1 and 0.0 <= got[0].importance_mean <= 1.0


def test_borrowed_rows_are_looked_up_without_a_sort(spark):
    """Donors are hashed, not sorted, and only a number beyond the last row is walked on."""
    df = spark.range(50).selectExpr("id", "CAST(id % 2 AS INT) AS label", "CAST(id % 3 AS DOUBLE) AS x")
    out = explain.permutation_importance(df, "id", ["x"], lambda d: d.withColumn("prediction", (d["x"] > 1).cast("int")), repeats=2)
    plan = out._jdf.queryExecution().toString()
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan.split("== Physical Plan ==")[1].split("Subquery")[0]
    assert "if ((_to" in plan


def test_packed_rows_come_back_to_the_last_bit():
    """Whole numbers, cents, any doubles, negative zeros, NaN and nulls, for keys in any order and more bits than one word has."""
    draw = np.random.default_rng(5)
    keys = draw.permutation(np.r_[np.arange(700), draw.choice(np.arange(700, 3000), 500, replace=False)])
    n = len(keys)
    odd = draw.normal(size=n)
    odd[:4] = [-0.0, np.nan, np.inf, 1e300]
    columns = [draw.integers(0, 2, n).astype(float), draw.integers(-500, 10_000_000, n) / 100, odd, np.full(n, -3.0), draw.normal(size=n)]
    columns = [(c, draw.random(n) < 0.1 if i % 2 else None) for i, c in enumerate(columns)]
    order = np.argsort(keys, kind="stable")
    batch = explain._bundled(keys, columns, 256).to_pylist()
    assert [r["_at"] for r in batch] == sorted({int(k) // 256 for k in keys})
    back = [explain._unbundled(r["_n"], r["_first"], r["_layout"], r["_blob"]) for r in batch]
    assert np.array_equal(np.concatenate([k for k, _ in back]), keys[order])
    for i, (values, nulls) in enumerate(columns):
        assert np.array_equal(np.concatenate([c[i][0] for _, c in back]).view(np.int64), values[order].view(np.int64))
        assert np.array_equal(np.concatenate([c[i][1] for _, c in back]), np.zeros(n, bool) if nulls is None else nulls[order])


def test_asking_rows_travel_in_few_bytes():
    """Flags, a quantity and a price in cents: six bytes and a half, not a row of seven words."""
    draw = np.random.default_rng(6)
    n = 1 << 16
    keys = draw.integers(0, 200 * n, n)
    values = [draw.integers(0, 10, n), *[draw.integers(0, 2, n) for _ in range(5)], draw.integers(1, 51, n), draw.integers(90_000, 10_000_000, n) / 100]
    batch = explain._bundled(keys, [(v.astype(float), np.zeros(n, bool)) for v in values], 1 << 20)
    assert sum(len(b) for b in batch["_blob"].to_pylist()) < 7 * n


def test_untouched_rows_borrow_nothing(spark):
    """The rows that the variants are compared with are scored without the join."""
    df = spark.range(50).selectExpr("id", "CAST(id % 2 AS INT) AS label", "CAST(id % 3 AS DOUBLE) AS x")
    out = explain.permutation_importance(df, "id", ["x"], lambda d: d.withColumn("prediction", (d["x"] > 1).cast("int")), repeats=2)
    assert out._jdf.queryExecution().toString().split("== Physical Plan ==")[1].count("ShuffledHashJoin") == 1
