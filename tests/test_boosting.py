"""Boosting of many members at once against a plain version with loops over rows."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest

from caseloom.operators import boosting
from caseloom.operators.boosting import Growth


def made(n, seed=1):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        x = [r.randrange(4), round(r.gauss(0, 1), 2), r.choice([0, 1]), r.choice([None, 1.0, 2.5])]
        rows.append((i, *x, int(x[0] + x[1] + 2 * x[2] * (x[0] > 1) + r.gauss(0, 0.7) > 2), i % 3))
    return rows


def plain(rows, edges, g, keep):
    """Trees as nested tuples, one row at a time."""
    data = [([sum(e < (float("-inf") if v is None else v) for e in es) for v, es in zip(x[1:5], edges)], x[5], key) for x, key in rows if keep(x)]
    count = [sum(y == c for _, y, _ in data) for c in (0, 1)]
    weight = [len(data) / (2 * c) for c in count]
    margin = [0.0] * len(data)
    trees = []
    for round_ in range(g.rounds):
        n = max(1, round(g.columns * 4))
        allowed = sorted(np.random.default_rng([g.seed, round_]).choice(4, n, replace=False).tolist())
        seen = [bool(boosting.drawn(np.array([key]), g.rows, g.seed, round_)[0]) for _, _, key in data]
        grad = []
        for (_, y, _), m in zip(data, margin):
            p = 1 / (1 + math.exp(-m))
            grad.append((weight[y] * (p - y), weight[y] * p * (1 - p)))

        def value(part):
            return -g.rate * sum(grad[i][0] for i in part) / (sum(grad[i][1] for i in part) + g.l2)

        def best(part):
            score = lambda s: sum(grad[i][0] for i in s) ** 2 / max(sum(grad[i][1] for i in s) + g.l2, 1e-12)
            found = None
            for f in allowed:
                for c in range(len(edges[f])):
                    a, b = [i for i in part if data[i][0][f] <= c], [i for i in part if data[i][0][f] > c]
                    if min(len(a), len(b)) < g.least_rows or min(sum(grad[i][1] for i in s) for s in (a, b)) < g.least_hessian:
                        continue
                    gain = round(0.5 * (score(a) + score(b) - score(part)), 9)
                    if gain > 1e-9 and (found is None or gain > found[0]):
                        found = (gain, f, c, a, b)
            return found

        nodes = {0: [i for i in range(len(data)) if seen[i]]}
        split, known, open_, level = {}, {}, [0], 0
        while open_:
            known.update({n: s for n in open_ if (s := best(nodes[n]))})
            chosen = sorted(known, key=lambda n: (-known[n][0], n))
            room = len(chosen)
            if g.leaves:
                room = g.leaves - 1 - len(split)
                chosen = chosen[:-(-3 * room // 4)] if room else []
            open_, level = [], level + 1
            for n in chosen:
                _, f, c, a, b = known.pop(n)
                k = len(nodes)
                split[n] = (f, c, k)
                nodes[k], nodes[k + 1] = a, b
                open_ += [k, k + 1]
            if (g.depth and level >= g.depth) or (g.leaves and room <= len(chosen)):
                break
        trees.append(({n: s for n, s in split.items()}, {n: value(p) for n, p in nodes.items()}))
        for i, (bins, _, _) in enumerate(data):
            n = 0
            while n in split:
                f, c, k = split[n]
                n = k + (bins[f] > c)
            margin[i] += trees[-1][1][n]
    return trees


GROWTHS = [Growth("level", 4, 0.3, depth=3, rows=0.8, columns=0.8), Growth("leaf", 3, 0.2, leaves=9, l2=0.0, least_hessian=1e-3, least_rows=5)]


@pytest.fixture()
def table(spark):
    return lambda rows, parts: spark.createDataFrame(rows, "id int, a double, b double, c double, d double, label int, fold int").repartition(parts)


def test_every_member_equals_the_plain_version(spark, table, monkeypatch):
    from pyspark.sql import functions as F

    monkeypatch.setattr(boosting, "TREES_BETWEEN", 2)
    monkeypatch.setattr(boosting, "ROWS_IN_PART", 80)
    rows = [(i, float(a), b, float(c), d, y, f) for i, a, b, c, d, y, f in made(300)]
    df = table(rows, 3)
    keys = {r[0]: r[1] for r in df.select("id", F.xxhash64("id")).collect()}
    names = ["a", "b", "c", "d"]
    edges = boosting.feature_edges(df, names, 16)
    mask = F.lit(7) - F.pow(F.lit(2), F.col("fold")).cast("bigint") + 8  # folds 0 to 2 left out, and all rows
    got = boosting.boost(df, names, GROWTHS, "id", training=mask, trainings=4, bins=16, edges=edges)
    assert set(got) == {(g.name, t) for g in GROWTHS for t in range(4)}
    for g in GROWTHS:
        for t in range(4):
            want = plain([(x, keys[x[0]]) for x in rows], edges, g, lambda x, t=t: x[6] != t)
            trees = got[g.name, t].trees
            assert len(trees) == len(want) == g.rounds
            for tree, (split, value) in zip(trees, want):
                assert {n: (f, c, k) for n, (f, c, k) in enumerate(zip(tree.feature, tree.cut, tree.left)) if f >= 0} == split
                assert np.allclose(tree.value, [value[n] for n in range(len(tree.value))], atol=1e-9)
    same = boosting.boost(table(rows[::-1], 5), names, GROWTHS[:1], "id", bins=16, edges=edges)["level", 0]
    for a, b in zip(same.trees, got["level", 3].trees):
        assert a.feature == b.feature and a.cut == b.cut and np.allclose(a.value, b.value)


def test_scores_and_the_two_ways_differ(table):
    rows = [(i, float(a), b, float(c), d, y, f) for i, a, b, c, d, y, f in made(600, 2)]
    df, names = table(rows, 4), ["a", "b", "c", "d"]
    got = boosting.boost(df, names, [boosting.level_wise(rounds=15), boosting.leaf_wise(rounds=15)], "id")
    first, second = (got[n, 0] for n in ("Boosted Trees", "Boosted Trees (leaf-wise)"))
    assert max(len(t.feature) for t in second.trees) <= 61 and max(len(t.feature) for t in first.trees) <= 63
    assert [t.feature for t in first.trees] != [t.feature for t in second.trees]
    for b in (first, second):
        out = b.transform(df, names).collect()
        assert sum(r.prediction == r.label for r in out) / len(out) > 0.85
        values = np.array([[np.nan if v is None else v for v in r[1:5]] for r in out], float)
        assert np.allclose(boosting.sigmoid(b.margin(values)), [r.probability for r in out])


def test_one_class_and_no_rows(table):
    one = boosting.boost(table([(1, 1.0, 1.0, 1.0, None, 1, 0)] * 5, 2), ["a", "b", "c", "d"], GROWTHS[:1], "id", edges=[np.array([0.5])] * 4)["level", 0]
    assert one.trees == [] and one.margin(np.ones((2, 4))).min() > 10
    none = boosting.boost(table([], 1), ["a"], GROWTHS[:1], "id", edges=[np.array([0.5])])["level", 0]
    assert none.margin(np.ones((2, 1))).tolist() == [0.0, 0.0]


def test_a_scan_looks_at_own_rows_only(monkeypatch):
    """A member walks its tree for the rows of its training set, not for those of the other sets, and ships no finished trees."""
    n, seen = 60, []
    member = boosting.Member(boosting.leaf_wise(), 0, 1, (1.0, 1.0), 0.0, 2)
    member.trees = [boosting.Tree()] * 5
    walk = boosting.Tree.leaf_of
    monkeypatch.setattr(boosting.Tree, "leaf_of", lambda self, bins: seen.append(len(bins)) or walk(self, bins))
    block = (np.arange(n), np.arange(n, dtype=np.uint8) % 2, 1 << (np.arange(n) % 3), np.zeros((n, 2), np.uint8), np.zeros((n, 1)))
    sums = boosting._sums(block, member, 4)
    assert seen == [n // 3] and sums[0, 0, :, 2].sum() == n // 3
    assert member.view().trees == [] and len(member.trees) == 5


def test_small_training_sets_grow_in_tasks(spark, table, monkeypatch):
    """Sets that a task can hold need one job for all their trees, and these are the trees of the scans."""
    from pyspark.sql import functions as F

    rows = [(i, float(a), b, float(c), d, y, f) for i, a, b, c, d, y, f in made(500, 4)]
    df, names = table(rows, 3), ["a", "b", "c", "d"]
    edges = boosting.feature_edges(df, names, 16)
    growths = [*GROWTHS, boosting.leaf_wise("wide", rounds=6), boosting.level_wise("deep", rounds=6)]
    args = dict(training=F.lit(7) - F.pow(F.lit(2), F.col("fold")).cast("bigint") + 8, trainings=4, bins=16, edges=edges)
    scans = []
    monkeypatch.setattr(boosting, "_scan", lambda *a, f=boosting._scan: scans.append(a) or f(*a))
    got = boosting.boost(df, names, growths, "id", **args)
    assert not scans
    monkeypatch.setattr(boosting, "ROWS_IN_PART", 80)
    want = boosting.boost(df, names, growths, "id", **args)
    assert scans and set(got) == set(want)
    for member, booster in want.items():
        assert len(got[member].trees) == len(booster.trees) == next(g.rounds for g in growths if g.name == member[0])
        for a, b in zip(got[member].trees, booster.trees):
            assert a.feature == b.feature and a.cut == b.cut and a.left == b.left and np.allclose(a.value, b.value)
