"""The neighbour estimate of mutual information against a count over all pairs of rows."""

from __future__ import annotations

import math
import random

import numpy as np
import pandas as pd
import pytest

from caseloom.operators import select


def psi(n):
    return -0.57721566490153286 + sum(1 / i for i in range(1, int(n)))


def plain(x, y, k=3):
    x, y = np.array(x), np.array(y)
    keep = np.array([(y == c).sum() > 1 for c in y])
    x, y = x[keep], y[keep]
    total = 0.0
    for i in range(len(x)):
        others = np.delete(np.abs(x - x[i])[y == y[i]], np.flatnonzero(np.flatnonzero(y == y[i]) == i))
        want = min(k, len(others))
        d = np.sort(others)[want - 1]
        if d == 0:
            want, m = (others == 0).sum(), (x == x[i]).sum() - 1
        else:
            m = (np.abs(x - x[i]) < d).sum()
        total += psi(want) - psi((y == y[i]).sum()) - psi(m)
    return max(0.0, psi(len(x)) + total / len(x))


def made(seed, n):
    r = random.Random(seed)
    y = [int(r.random() < 0.3) for _ in range(n)]
    return [(i, c, float(round(r.gauss(c, 1) * 64)) / 64, float(r.randrange(4) + c), float(r.random() < 0.2 + 0.5 * c), float(r.randrange(10**6)), 1.0) for i, c in enumerate(y)]


@pytest.mark.parametrize("seed, n, cells, k", [(1, 300, None, 3), (2, 200, 40, 3), (3, 120, 60, 5), (4, 5, 3, 3)])
def test_equals_a_count_over_pairs(spark, seed, n, cells, k):
    rows = made(seed, n)
    df = spark.createDataFrame(rows, "id int, label int, a double, b double, c double, d double, e double").repartition(3)
    got = {r.feature: r.score for r in select.neighbour_information(df, list("abcde"), k=k, cells=cells).collect()}
    y = [r[1] for r in rows]
    for i, f in enumerate("abcde"):
        assert got[f] == pytest.approx(plain([r[i + 2] for r in rows], y, k), abs=1e-9), f


def test_digamma(spark):
    got = spark.range(1, 2000).selectExpr("id", f"{select.digamma('id')} AS p").collect()
    assert all(math.isclose(r.p, psi(r.id), abs_tol=1e-10) for r in got)


def test_missing_values_and_a_class_of_one_row(spark):
    rows = [(0, 1.0), (0, 2.0), (0, 2.5), (0, None), (1, 9.0)]
    df = spark.createDataFrame(rows, "label int, a double")
    assert select.neighbour_information(df, ["a"]).collect()[0].score == pytest.approx(plain([1.0, 2.0, 2.5], [0, 0, 0]))


def test_few_rows_leave_their_cell():
    r = np.random.default_rng(5)
    value = np.unique(r.normal(size=20_000).round(4))
    counts = r.integers(0, 3, (2, len(value)))
    found = pd.concat(select._inside(value, counts, counts.sum(1).tolist(), 3))
    away = found[found["kind"] != "done"].groupby(["class", "kind"]).size()
    assert away.to_dict() == {(0.0, "edge"): 6, (1.0, "edge"): 6, (0.0, "near"): 6, (1.0, "near"): 6}
    done = found[found["kind"] == "done"]
    assert done["c"].sum() == counts.sum() - found.loc[found["kind"] == "edge", "c"].sum() and len(done) < 200


def test_values_apart_by_less_than_the_sums_are_rounded_by(spark):
    r = random.Random(9)
    rows = [(r.randrange(2), 2.0**52 + r.randrange(400) + r.choice([0.0, 1e-3]), r.uniform(0.1, 0.1 + 3e-15)) for _ in range(300)]
    df = spark.createDataFrame(rows, "label int, a double, b double")
    for cells in (1, 30):
        got = {g.feature: g.score for g in select.neighbour_information(df, ["a", "b"], cells=cells).collect()}
        for i, f in enumerate("ab"):
            assert got[f] == pytest.approx(plain([x[i + 1] for x in rows], [x[0] for x in rows]), abs=1e-9), f
