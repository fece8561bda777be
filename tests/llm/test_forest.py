"""Near duplicates against all pairs."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_cases import ODD

from caseloom.llm import forest
from caseloom.llm.components import components


def shingles(t, size=5):
    w = (t or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    for c in "\t\n\x0b\x0c\r":
        w = w.replace(c, " ")
    w = [x for x in w.split(" ") if x]
    return frozenset(tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1))) if w else frozenset()


def brute(rows, threshold=0.8):
    """Expected (id, class_id, class_size, n_links, n_near, group_id) of rows whose classes are word sequences."""
    classes = defaultdict(list)
    for i, t in rows:
        classes[shingles(t)].append(i)
    keys = list(classes)
    least = lambda ids: min((i for i in ids if i is not None), default=None)
    near = {k: [q for q in keys if q is not k and k and q and len(k & q) >= threshold * len(k | q)] for k in keys}
    out = []
    for k in keys:
        seen, todo = {k}, [k]
        while todo:
            for q in near[todo.pop()]:
                if q not in seen:
                    seen.add(q)
                    todo.append(q)
        group = least([i for q in seen for i in classes[q]])
        n = sum(len(classes[q]) for q in near[k]) + len(classes[k]) - 1
        out += [(str(i), str(least(classes[k])), len(classes[k]), len(near[k]), n, str(group)) for i in classes[k]]
    return sorted(out)


def case(seed, groups=25):
    r = random.Random(seed)
    v = ["w%d" % i for i in range(400)]
    passage = r.choices(v, k=25)
    rows = []
    for _ in range(groups):
        base = r.choices(v, k=r.choice([5, 8, 30, 80, 200]))
        if r.random() < 0.4:
            base = passage + base
        for _ in range(r.choice([1, 1, 2, 3, 12])):
            t = list(base)
            for _ in range(r.choice([0, 0, 1, 1, 2, 4])):
                t[r.randrange(len(t))] = r.choice(v)
            rows.append(r.choice([" ", "\n", "  "]).join(t))
    rows += [rows[0], rows[0].upper(), rows[3]]
    r.shuffle(rows)
    return list(enumerate(rows)) + [(1000 + i, t) for i, t in enumerate(ODD)] + [(None, rows[1]), (None, "a b c d e f"), (None, None), (2, rows[2])]


def table(df):
    return sorted((str(r.doc_id), str(r.class_id), r.class_size, r.n_links, r.n_near, str(r.group_id)) for r in df.collect())


@pytest.mark.parametrize("seed,block,bucket", [(1, 512, 5000), (2, 4, 3)])
def test_all_links_are_found(documents, monkeypatch, seed, block, bucket):
    monkeypatch.setattr(forest, "BLOCK_ROWS", block)
    monkeypatch.setattr(forest, "BUCKET_ROWS", bucket)
    rows = case(seed)
    assert table(forest.near_duplicates(documents(rows))) == brute(rows)


def test_one_row_of_each_group_stays(documents):
    rows = case(3)
    want = brute(rows)
    left = forest.one_per_group(documents(rows))
    assert left.columns == documents(rows).columns
    ids = [r.doc_id for r in left.collect()]
    groups = Counter(w[5] for w in want)
    assert sorted(str(i) for i in ids if i is not None) == sorted(g for g in groups if g != "None")


def test_nothing_from_nothing(documents):
    none = documents([(1, "a")]).where("doc_id < 0")
    assert forest.near_duplicates(none).collect() == [] and forest.one_per_group(none).collect() == []


def test_prefix_is_shortened_until_the_recall_is_reached():
    for trees in (8, 48, 200):
        d = forest.prefix_length(0.8, trees, 0.99)
        assert 1 - (1 - 0.8 ** d) ** trees >= 0.99 or d == 1
        assert d == forest.LONGEST or 1 - (1 - 0.8 ** (d + 1)) ** trees < 0.99


def test_intersections():
    r = np.random.default_rng(1)
    sets = [np.unique(r.integers(0, 60, 30).astype(np.uint64)) for _ in range(9)]
    want = [[len(np.intersect1d(a, b)) for b in sets] for a in sets]
    assert (forest.intersections(sets, width=7) == want).all()


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, 200), (200, 300), (300, 100), (-5, 400), (7, 7), (900, 900)]
    got = dict(tuple(r) for r in components(spark.createDataFrame(edges, "a bigint, b bigint"), "a", "b").collect())
    want = {**{i: 1 for i in range(1, 41)}, 100: 100, 200: 100, 300: 100, -5: -5, 400: -5}
    assert got == want


def missed(similarity, pairs, trees=48, recall=0.9999):
    """Share of pairs at a similarity whose prefixes agree nowhere: sets of one element stand for independent minima."""
    depth = forest.prefix_length(0.8, trees, recall)
    r = np.random.default_rng(3)
    lost = 0
    for _ in range(pairs // 20_000):
        a = r.integers(0, 2**32, (20_000, trees * depth), dtype=np.uint32)
        b = np.where(r.random(a.shape) < similarity, a, a ^ np.uint32(1))
        lost += (forest.prefix_nodes(a, trees, depth) != forest.prefix_nodes(b, trees, depth)).all(axis=1).sum()
    return lost / pairs


def test_labels_agree_independently():
    """The recall that is promised at the threshold is the one of the labels that are used."""
    assert missed(0.8, 200_000) < 1e-4


def test_label_values_have_own_hash_functions():
    n = 48 * forest.prefix_length(0.8, 48, 0.9999)
    assert len(set(forest.hash_factors(n).tolist())) == n
    r = np.random.default_rng(5)
    common, a, b = (r.integers(0, 2**63, n, dtype=np.uint64) for n in (160, 20, 20))  # similarity 0.8
    sig = forest.signatures(np.concatenate([common, a, common, b]), np.array([0, 180, 360]), n)
    assert abs((sig[0] == sig[1]).mean() - 0.8) < 0.1


def test_low_thresholds_keep_links_through_a_leader():
    """Two members of one bucket that are as near as the threshold, the first close to the leader, the second far from it."""
    import pyarrow as pa

    leader = np.zeros(forest.VALUES, np.uint8)
    close, far = leader.copy(), leader.copy()
    close[:22] = 1  # 0.83 of the leader's values
    far[:22], far[22:86] = 1, 2  # half of the values of the close member, a third of the leader's
    far[86:106] = 3  # below the limit that holds for 0.8
    far[:22] = 1
    assert (far == leader).mean() < 0.27 < 0.3 < (far == close).mean()
    batch = pa.RecordBatch.from_arrays([pa.array([5] * 3, pa.int64()), pa.array([0] * 3, pa.int64()), pa.array([1, 2, 3], pa.int64()),
                                        pa.array([x.tobytes() for x in (leader, close, far)], pa.binary())], names=["bucket", "salt", "class_key", "signature"])
    links = lambda t: {(k, l) for b in forest._lead(t)([batch]) for k, l in zip(b["class_key"].to_pylist(), b["leader"].to_pylist())}  # noqa: E731, E741
    assert {(2, 1), (3, 1)} <= links(0.5) and (3, 1) not in links(0.8)
    assert abs(forest.link_limit(0.8) - 0.27) < 1e-9 and forest.link_limit(0.5) == 0
