"""Exact probabilities of the rank tests against all arrangements."""

from __future__ import annotations

import itertools
import math
import random
from collections import Counter

import pytest

from caseloom.operators import stats

SIZES = [(1, 1), (1, 7), (2, 3), (3, 5), (4, 4), (5, 8), (8, 8)]


def arrangements(m, n):
    for chosen in itertools.combinations(range(m + n), m):
        yield set(chosen)


@pytest.mark.parametrize("m, n", SIZES)
def test_rank_sums(m, n):
    seen = Counter(sum(c) - m * (m - 1) // 2 for c in arrangements(m, n))
    total = math.comb(m + n, m)
    for u in seen:
        want = min(1.0, 2 * sum(c for v, c in seen.items() if v <= min(u, m * n - u)) / total)
        assert stats.rank_sum_tail(u, m, n) == pytest.approx(want, abs=1e-12) == stats.rank_sum_tail(u, n, m)


@pytest.mark.parametrize("m, n", SIZES)
def test_distances(m, n):
    seen = Counter()
    for c in arrangements(m, n):
        i = far = 0
        for t in range(m + n):
            i += t in c
            far = max(far, abs(i * n - (t + 1 - i) * m))
        seen[far] += 1
    for d in seen:
        want = sum(c for v, c in seen.items() if v >= d) / math.comb(m + n, m)
        assert stats.two_sample_tail(d / (m * n), m, n) == pytest.approx(want, abs=1e-12)


def test_large_samples_come_near_the_limit():
    assert stats.two_sample_tail(0.1, 400, 500) == pytest.approx(2 * sum((-1) ** (j - 1) * math.exp(-2 * j * j * 0.01 * 400 * 500 / 900) for j in range(1, 20)), abs=0.01)
    assert stats.rank_sum_tail(100_000, 1, 200_000) == pytest.approx(1.0, abs=1e-4) and stats.rank_sum_tail(0, 8, 50_000) < 1e-30


def test_reports(spark):
    r = random.Random(1)
    rows = [(int(i < 6), r.random(), float(r.randrange(3))) for i in range(40)]
    df = spark.createDataFrame(rows, "label int, a double, tied double")
    exact, plain = ({x.feature: x for x in stats.mann_whitney(df, ["a", "tied"], exact=e).collect()} for e in (True, False))
    assert exact["a"].p_value == pytest.approx(stats.rank_sum_tail(exact["a"].u, 34, 6)) != plain["a"].p_value
    assert exact["tied"].p_value == plain["tied"].p_value
    ks = {x.feature: x for x in stats.kolmogorov_smirnov(df, ["a"], "label", 0, 1, exact=True).collect()}["a"]
    assert ks.p_value == pytest.approx(stats.two_sample_tail(ks.ks, 34, 6))
