"""Encoding and decoding against the tokenizers library."""

from __future__ import annotations

import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import ODD

tokenizers = pytest.importorskip("tokenizers")
public_tokenizers = pytest.importorskip("public_tokenizers")
from caseloom.llm import bpe  # noqa: E402

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = tokenizers.Tokenizer.from_file(PATH)
CODER = bpe.codec(open(PATH, "rb").read())
TEXTS = [*[t or "" for t in ODD], "It's we'll HE'D!'s don't", "ΣΑΣ ΟΔΟΣ Σ.", "ȺȾ İstanbul ǅ ﬁ ½ ²³ 12٣", "é Å", "a\x1cb\x1fc\x85d​e　f",
         "<|endoftext|>x<|startoftext|> <|ENDOFTEXT|> <|endoftext|", "aaaaaaaaaaaaaaaaaaaaaa", "lolololol" * 50, "日本語 текст 👩‍👩‍👧 🇩🇪", "\n\t a \r\n", "'", "''s''t", "x" * 3000]


def library(text):
    ids = LIBRARY.encode(text, add_special_tokens=False).ids
    return ids, LIBRARY.decode(ids, skip_special_tokens=False)


@pytest.mark.parametrize("text", TEXTS)
def test_odd_texts(text):
    ids = CODER.encode([text])[0]
    assert (ids, CODER.decode(ids)) == library(text)


@settings(max_examples=400, deadline=None)
@given(st.text(max_size=80))
def test_any_text(text):
    assert CODER.encode([text])[0] == library(text)[0]


def test_words_of_a_piece_are_independent(sf):
    import pyarrow.parquet as pq
    texts = pq.read_table(f"{sf}/documents.parquet")["text"].to_pylist()
    fresh = bpe.Codec(open(PATH, "rb").read())
    assert fresh.encode(texts) == [e.ids for e in LIBRARY.encode_batch(texts, add_special_tokens=False)]


def test_tables(spark, documents, monkeypatch):
    r = random.Random(2)
    rows = list(enumerate([*TEXTS, *[" ".join(r.choices(["Lower", "case", "123", "naïve", "don't"], k=20)) for _ in range(50)], None, None])) + [(None, "id"), (3, "twice"), (3, "twice")]
    want = []
    for i, t in rows:
        ids, text = library(t or "")
        want.append((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    got = bpe.round_trip_digests(documents(rows), PATH)
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))
    tokens = bpe.encode(documents(rows), PATH)
    back = bpe.decode(tokens, PATH)
    assert sorted((str(x.doc_id), x.text) for x in back.collect()) == sorted((str(i), library(t or "")[1]) for i, t in rows)
    assert bpe.round_trip_digests(documents(rows).where("doc_id < 0"), PATH).collect() == []


def test_kept_words_are_bounded(monkeypatch):
    monkeypatch.setattr(bpe, "WORDS_KEPT", 10)
    coder = bpe.Codec(open(PATH, "rb").read())
    for i in [*range(0, 40, 8), 8, 8, 0]:
        text = " ".join("w" + chr(97 + j % 26) * (j + 1) for j in range(i, i + 8))
        assert coder.encode([text])[0] == library(text)[0]
        assert len(coder.ids) <= 10 and len(coder.before[0]) <= 10


def test_a_text_longer_than_a_piece(documents):
    r = random.Random(6)
    text = " ".join(r.choices(["Lower", "case", "123", "naïve", "don't", "x" * 50], k=300_000)) + " tail"
    ids, back = library(text)
    got = bpe.round_trip_digests(documents([(1, text), (2, "a")]), PATH).where("doc_id = 1").first()
    assert (got.n_tokens, got.decoded_sha256) == (len(ids), hashlib.sha256(back.encode()).hexdigest())
