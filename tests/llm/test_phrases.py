"""Collocations against a plain count of all phrases."""

from __future__ import annotations

import random
import re
from collections import Counter

import pytest
from llm_cases import ODD

from caseloom.llm import phrases


def plain(rows, longest=4, least=30, inside=80, top=2000):
    n, f = Counter(), {}
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", lower):
            words = [w for w in re.split(r"[ \t]+", piece) if w]
            n[lang] += len(words)
            for k in range(1, longest + 1):
                f.setdefault(lang, Counter()).update(tuple(words[i:i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, count in f.items():
        candidates = {p: a for p, a in count.items() if len(p) > 1 and a >= least}
        dropped = set()
        for p, a in candidates.items():
            for size in range(2, len(p)):
                for i in range(len(p) - size + 1):
                    if 100 * a >= inside * candidates[p[i:i + size]]:
                        dropped.add(p[i:i + size])
        scored = []
        for p, a in candidates.items():
            if p not in dropped:
                score, k = min((2000000 * a // (count[p[:k]] + count[p[k:]]), k) for k in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), count[p[:k]], count[p[k:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def made(r, size):
    words = ["the", "The", "of", "a", "é", "x y", "new", "york", "city", "b\x00b"]
    tie = [" ", "  ", "\t", ", ", ". ", "\n", " "]
    return "".join(r.choice(words) + r.choice(tie) for _ in range(size)) + "new york city. "


@pytest.fixture()
def table(spark):
    def build(rows, parts=3):
        return spark.createDataFrame([(i, t, g, "x", 1) for i, (t, g) in enumerate(rows)], "doc_id bigint, text string, lang string, phrase string, n int").repartition(parts)
    return build


@pytest.mark.parametrize("least, inside, top, block", [(3, 80, 2000, 1 << 20), (5, 30, 7, 64), (1, 100, 2000, 200)])
def test_equals_a_plain_count(table, least, inside, top, block):
    r = random.Random(least)
    rows = [(made(r, r.randrange(1, 60)), r.choice(["en", "fr", None, "und"])) for _ in range(60)] + [(t, "en") for t in ODD] + [("only here", "zz"), (None, None)]
    got = phrases.collocations(table(rows), least=least, inside=inside, top=top, block_bytes=block)
    assert sorted(map(tuple, got.collect())) == plain(rows, least=least, inside=inside, top=top)


def test_overlapping_phrases_and_one_hot_phrase(table):
    rows = [("ha " * 40, "en")] * 2 + [("ha ha. ha", "en")]
    assert sorted(map(tuple, phrases.collocations(table(rows), least=2).collect())) == plain(rows, least=2)


def test_given_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    want = plain([(x.text, x.lang) for x in docs.select("text", "lang").collect()], least=10)
    assert want and sorted(map(tuple, phrases.collocations(docs, least=10).collect())) == want


def test_keys_that_meet_do_not_change_counts(table, monkeypatch):
    monkeypatch.setattr(phrases, "mix", lambda h: h & phrases.np.uint64(3 << 16))
    rows = [("a b c d. b c", "en"), ("a b c. q r", "en")] * 3
    assert sorted(map(tuple, phrases.collocations(table(rows), least=4).collect())) == plain(rows, least=4)


def test_empty_table(table, spark):
    assert phrases.collocations(table([("a", "b")]).where("doc_id < 0")).collect() == []
    assert phrases.collocations(table([("a a", "b")])).collect() == []


def test_a_long_text(table):
    r = random.Random(5)
    rows = [(made(r, 200_000), "en"), ("a", None)]
    assert sorted(map(tuple, phrases.collocations(table(rows), top=50).collect())) == plain(rows, top=50)


def test_counts_leave_a_block_in_the_order_of_short_keys():
    import pyarrow as pa

    from caseloom.llm import phrases

    relation, _ = phrases.Relation.of(pa.table({"text": [" ".join(f"w{i * 7 % 50}" for i in range(300))], "lang": ["en"]}))
    batch = pa.RecordBatch.from_pydict({"block": pa.array([3], pa.int64()), "state": pa.array([relation.packed()], pa.binary())})
    rows = pa.Table.from_batches(list(phrases._group_counts(True)([batch])))
    keys = rows["key"].to_pylist()
    assert keys == sorted(set(keys)) and 0 <= keys[0] and keys[-1] < 1 << 40 and sum(rows["f"].to_pylist()) == 299
