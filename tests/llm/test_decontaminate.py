"""Benchmark hits against brute force."""

from __future__ import annotations

import random
import re

import pytest
from llm_cases import ODD

from caseloom.llm import decontaminate

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(t):
    return WORD.findall((t or "").translate(AZ))


def brute(docs, items, window=10):
    out = []
    for i, t in docs:
        w = words(t)
        hit, found = set(), set()
        for item, text in items:
            v = words(text)
            k = min(window, len(v))
            for s in range(len(v) - k + 1 if k else 0):
                for p in range(len(w) - k + 1):
                    if w[p:p + k] == v[s:s + k]:
                        hit.update(range(p, p + k))
                        if item is not None:
                            found.add(str(item))
        out.append((str(i), len(w), len(hit), ",".join(sorted(found)), len(found), bool(hit)))
    return sorted(out)


def case(seed, vocabulary):
    r = random.Random(seed)
    v = ["w%d" % i for i in range(vocabulary)] + ["É", "THE"]
    items = [(i, r.choice([" ", ", ", "\n"]).join(r.choices(v, k=r.choice([1, 2, 3, 5, 9, 10, 11, 14, 25])))) for i in range(25)]
    items += [(100, None), (101, ""), (102, "!!"), (3, items[3][1]), (None, "nobody owns this short item"), (104, "a a a a a a a a a a a a")]
    texts = [t for _, t in items if t]
    docs = []
    for i in range(80):
        parts = []
        for _ in range(r.randint(0, 4)):
            p = words(r.choice(texts))
            a = r.randint(0, max(0, len(p) - 3))
            parts.append(" ".join(r.choice([p, p[a:], r.choices(v, k=12)])).upper())
        docs.append((i, r.choice([" ", "-"]).join(parts)))
    docs += [(1000 + i, t) for i, t in enumerate(ODD)] + [(None, texts[5]), (None, None), (7, texts[6]), (7, texts[6]), (8, "a " * 30)]
    return docs, items


@pytest.mark.parametrize("seed,vocabulary,window", [(1, 30, 10), (2, 4, 10), (3, 30, 3)])
def test_contamination(spark, documents, seed, vocabulary, window):
    docs, items = case(seed, vocabulary)
    table = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id bigint, text string, size int")
    got = decontaminate.contamination(documents(docs), table, window=window)
    rows = sorted((str(r.doc_id), r.n_words, r.n_hit, ",".join(r["items"]), r.n_items, r.contaminated) for r in got.collect())
    want = brute(docs, items, window)
    assert rows == want
    clean = decontaminate.uncontaminated(documents(docs), table, window=window)
    assert clean.columns == documents(docs).columns
    assert sorted((str(r.doc_id), len(words(r.text))) for r in clean.collect()) == sorted((w[0], w[1]) for w in want if not w[5])


def test_empty_tables(spark, documents):
    none = spark.createDataFrame([], "item_id bigint, text string")
    got = decontaminate.contamination(documents([(1, "a b"), (2, None)]), none).collect()
    assert sorted((r.doc_id, r.n_words, r.n_hit, r.contaminated) for r in got) == [(1, 2, 0, False), (2, 0, 0, False)]
    assert decontaminate.contamination(documents([(1, "a")]).where("doc_id < 0"), spark.createDataFrame([(1, "a b")], "item_id bigint, text string")).collect() == []
