"""Packing: pieces against the tokenizers library, places against the law of the bins, the search against best possible packings."""

from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import ODD

tokenizers = pytest.importorskip("tokenizers")
public_tokenizers = pytest.importorskip("public_tokenizers")
from caseloom.llm import packing  # noqa: E402

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = tokenizers.Tokenizer.from_file(PATH)
SPECIAL = ["<|endoftext|>x<|startoftext|> <|ENDOFTEXT|>", "İstanbul ΣΑΣ J̌ é 12٣ it's", "日本語 текст 👩‍👩‍👧", "x" * 9000]


def wanted(rows, sequence):
    out = []
    for i, t in rows:
        ids = np.array([*LIBRARY.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        out += [(i, n, at, len(ids[at:at + sequence]), zlib.crc32(ids[at:at + sequence].tobytes())) for n, at in enumerate(range(0, len(ids), sequence))]
    return sorted(out, key=str)


def lawful(rows, sequence):
    """Number of sequences, after a check of all places."""
    held = defaultdict(list)
    for x in rows:
        held[x.sequence_id].append((x.offset, x.length))
    for places in held.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= sequence
    return len(held)


def test_tables(spark, documents):
    r = random.Random(3)
    rows = list(enumerate([*ODD, *SPECIAL, *[" ".join(r.choices(["lower", "case", "naïve", "don't"], k=r.randrange(200))) for _ in range(150)]])) + [(None, "id"), (3, "twice"), (3, "twice")]
    got = packing.packed_sequences(documents(rows), PATH, sequence=256).collect()
    assert sorted(((x.doc_id, x.piece, x.start, x.length, x.ids_crc32) for x in got), key=str) == wanted(rows, 256)
    total = sum(x.length for x in got)
    assert lawful(got, 256) <= total // 256 + 3
    many = packing.packed_sequences(documents(rows), PATH, sequence=256, group_pieces=20).collect()
    assert len(many) == len(got) and lawful(many, 256) <= total // 256 + 20


def test_empty_table(documents):
    assert packing.packed_sequences(documents([(1, "a")]).where("doc_id < 0"), PATH).collect() == []


def test_given_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = packing.packed_sequences(docs, PATH).collect()
    rows = [(x.doc_id, x.text) for x in docs.select("doc_id", "text").collect()]
    assert sorted(((x.doc_id, x.piece, x.start, x.length, x.ids_crc32) for x in got), key=str) == wanted(rows, 4096)
    assert lawful(got, 4096) == -(-sum(x.length for x in got) // 4096)


def test_words_turn_over(monkeypatch):
    monkeypatch.setattr(packing, "WORDS_KEPT", 30)
    coder = packing.WordIds(open(PATH, "rb").read())
    r = random.Random(1)
    for _ in range(30):
        texts = [" ".join(r.choice("abcde") + r.choice("xyz") * r.randrange(5) for _ in range(12)) for _ in range(3)]
        assert [np.frombuffer(x, "<u4").tolist() for x in coder.encode(texts)] == [LIBRARY.encode(t, add_special_tokens=False).ids for t in texts]
        assert len(coder.now) <= 60


def test_new_words_reach_the_library_together(monkeypatch):
    monkeypatch.setattr(packing, "WORDS_KEPT", 900)
    coder = packing.WordIds(open(PATH, "rb").read())
    given_, library = [], coder.library

    class Counted:
        @staticmethod
        def encode_batch_fast(texts, **options):
            given_.extend(texts)
            return library.encode_batch_fast(texts, **options)
    coder.library = Counted
    r = random.Random(2)
    words = ["".join(r.choices("abcdeéß", k=r.randrange(1, 9))) for _ in range(1500)] + ["!!", "'s", "7", "\x1c\x1d", "<|endoftext|>"]
    for n, at in enumerate([0, 500, 250, 1005, 0]):
        texts = [" ".join(words[at:at + 500]), "", *SPECIAL, "of<|endoftext|><|startoftext|>words " + words[at]]
        assert [np.frombuffer(x, "<u4").tolist() for x in coder.encode(texts)] == [LIBRARY.encode(t, add_special_tokens=False).ids for t in texts]
        assert len(given_) <= n + 1


def best(sizes, capacity):
    """Fewest bins, by trying all ways."""
    for n in range(1, len(sizes) + 1):
        def fill(i, free, n=n):
            if i == len(sizes):
                return True
            return any(sizes[i] <= f and fill(i + 1, tuple(sorted((*free[:j], f - sizes[i], *free[j + 1:]))), n) for j, f in enumerate(free) if f not in free[:j])
        if fill(0, (capacity,) * n):
            return n
    return 0


def squares(bins):
    return int(((bins.capacity - bins.free) ** 2).sum())


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 20), min_size=1, max_size=9))
def test_no_better_than_possible_and_rarely_worse(sizes):
    sizes = np.array(sorted(sizes, reverse=True))
    bins = packing.Bins(sizes, 20)
    start, count = squares(bins), bins.count
    bins.search()
    assert squares(bins) >= start and bins.count <= count and bins.count == len({b for b in bins.where})
    assert best(sizes.tolist(), 20) <= bins.count <= best(sizes.tolist(), 20) + 1
    held = np.bincount(bins.where, sizes, minlength=len(bins.free))
    assert (bins.capacity - held == bins.free).all() and (bins.free >= 0).all()


def next_fit(sizes, capacity):
    where, used, b = [], 0, 0
    for x in sizes:
        if used + x > capacity:
            used, b = 0, b + 1
        used += x
        where.append(b)
    return where


@pytest.mark.parametrize("high", [25, 45, 70])
def test_steps_alone_empty_bins(high):
    r = random.Random(high)
    for _ in range(20):
        sizes = np.array([r.randint(1, high) for _ in range(150)])
        start = packing.Bins(sizes, 100, next_fit(sizes, 100))
        count, before = start.count, squares(start)
        start.search()
        by_best_fit = packing.Bins(np.sort(sizes)[::-1], 100).count
        assert start.count < count and squares(start) > before
        assert start.count <= 1.1 * by_best_fit + 1
        assert (np.bincount(start.where, sizes, minlength=len(start.free)) + start.free == 100).all()


def test_two_for_one():
    bins = packing.Bins(np.array([6, 6, 5, 5, 4, 4]), 10)  # already perfect
    assert bins.count == bins.least == 3
    bins = packing.Bins(np.array([7, 3, 2, 2, 2]), 10)
    bins.search()
    assert bins.count == 2


def test_bins_that_cannot_be_emptied_end_the_search():
    bins = packing.Bins(np.full(3000, 1500), 4096)
    bins.search()
    assert bins.count == 1500
