"""The two passage deduplicators against brute force."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest

from caseloom.llm import suffix
from caseloom.llm.suffix import remove_repeated_bytes
from caseloom.llm.superkmer import remove_repeated_windows

from llm_cases import ODD


def sha(b):
    return hashlib.sha256(b).hexdigest()


def corpus(seed, words=12, rows=60):
    r = random.Random(seed)
    vocabulary = ["w%d" % i for i in range(words)] + ["é", "the"]
    passages = [" ".join(r.choices(vocabulary, k=r.randint(5, 40))) for _ in range(6)]
    out = []
    for i in range(rows):
        t = r.choice([" ", "\n", "  "]).join(r.choice(passages) if r.random() < 0.5 else " ".join(r.choices(vocabulary, k=r.randint(0, 30)))
                                               for _ in range(r.randint(0, 4)))
        out.append((i, t))
    out += [(1000 + i, t) for i, t in enumerate(ODD)] + [(None, passages[0]), (None, passages[1]), (7, out[7][1]), (8, passages[0])]
    return out


def brute_words(rows, window=13):
    big = 2**63 - 1
    least = {}
    split = [(big if i is None else i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    for i, w in split:
        for s in range(len(w) - window + 1):
            k = tuple(w[s:s + window])
            least[k] = min(least.get(k, big), i)
    out = []
    for (raw, _), (i, w) in zip(rows, split):
        gone = set()
        for s in range(len(w) - window + 1):
            if least[tuple(w[s:s + window])] < i:
                gone.update(range(s, s + window))
        out.append((raw, len(w), len(gone), sha(" ".join(x for j, x in enumerate(w) if j not in gone).encode())))
    return out


def ordered(rows):
    return sorted(map(tuple, rows), key=lambda r: (r[0] is None, *map(str, r)))


@pytest.mark.parametrize("seed,window", [(1, 13), (2, 13), (3, 4), (4, 1)])
def test_word_windows(documents, seed, window):
    rows = corpus(seed)
    got = remove_repeated_windows(documents(rows), window=window, block_bytes=2000, bucket_bytes=3000)
    assert got.columns == ["doc_id", "n_words", "n_removed", "kept_sha256"]
    assert ordered(got.collect()) == ordered(brute_words(rows, window))


def test_word_windows_of_an_empty_table(documents):
    assert remove_repeated_windows(documents([(1, "a")]).where("doc_id < 0")).collect() == []


def brute_bytes(rows, length=100):
    big = 2**63 - 1
    least = {}
    flat = [(big if i is None else i, (t or "").encode()) for i, t in rows]
    for i, b in flat:
        for s in range(len(b) - length + 1):
            k = b[s:s + length]
            least[k] = min(least.get(k, (big, big)), (i, s))
    out = []
    for (raw, _), (i, b) in zip(rows, flat):
        gone = [False] * (len(b) + 1)
        for s in range(len(b) - length + 1):
            if least[b[s:s + length]] < (i, s):
                gone[s:s + length] = [True] * length
        runs = sum(g and not (j and gone[j - 1]) for j, g in enumerate(gone))
        out.append((raw, len(b), sum(gone), runs, sha(bytes(x for x, g in zip(b, gone) if not g))))
    return out


@pytest.mark.parametrize("seed,length,gram", [(1, 100, 32), (2, 100, 32), (5, 20, 8), (6, 3, 2)])
def test_byte_strings(documents, seed, length, gram):
    rows = corpus(seed, words=6, rows=50)
    got = remove_repeated_bytes(documents(rows), length=length, gram=gram, block_bytes=3000, bucket_bytes=9000)
    assert got.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert ordered(got.collect()) == ordered(brute_bytes(rows, length))


def test_byte_strings_of_an_empty_table(documents):
    assert remove_repeated_bytes(documents([(1, "a")]).where("doc_id < 0")).collect() == []


@pytest.mark.parametrize("narrow", [True, False])
def test_bucket_pointers_name_equal_strings(monkeypatch, narrow):
    if not narrow:
        monkeypatch.setattr(suffix, "_NARROW", 3)
    r = np.random.default_rng(1)
    data = r.integers(97, 99, 600, dtype=np.uint8)
    data[300:450] = data[10:160]
    for length in (1, 4, 5, 13, 100):
        pointer = suffix.bucket_pointers(data, length)
        text = bytes(data) + bytes(length)
        strings = [text[i:i + length] for i in range(len(data))]
        # behind the end there are zeros, so the order of pointers is the order of the strings
        rank = {s: i for i, s in enumerate(sorted(set(strings)))}
        assert (np.unique(pointer, return_inverse=True)[1] == [rank[s] for s in strings]).all()
