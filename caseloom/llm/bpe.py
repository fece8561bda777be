"""Byte-pair encoding with an index of pair occurrences, for tokenizer files with word ends.

The distinct new words of a piece of a partition lie behind each other in one symbol array. An index maps each mergeable
pair to all its positions; the ranks that occur wait in a heap. The lowest rank is applied at all its positions at once,
and the lists of the pairs that the merges make or break are updated. Words found before are looked up. Text is
normalised, split and decoded as the tokenizer file says (NFC, one blank for white space, lower case).
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import itertools
import json
import re
import sys
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from caseloom.llm.arrays import pieces

END = "</w>"
#: fixed value: the white space of the file's patterns
SPACE = "\\t\\n\\x0B\\x0C\\r \\x85\\xA0\\u1680\\u2000-\\u200A\\u2028\\u2029\\u202F\\u205F\\u3000"
#: fixed values: ranges without capitals that lower() misses, of letters (Latin) and of other signs (ASCII and punctuation)
LATIN, SIGNS = "A-Za-z\xC0-\xD6\xD8-\xF6\xF8-\u0239", "\x00-\x7F\u2010-\u2027\u2030-\u205E"
OTHER = re.compile(f"[^{LATIN}{SIGNS}]")
PLAIN = re.compile(f"'(?:[stmd]|re|ve|ll)|[{LATIN}]+|[0-9]|[^{SPACE}{LATIN}0-9]+")


#: fixed values: capitals of Unicode 16 and 17, which Python's own tables do not know, with the small letter of the first
NEW_CAPITALS = {range(0x1C89, 0x1C8A): 0x1C8A, range(0xA7CB, 0xA7CC): 0x264, range(0xA7CC, 0xA7CD): 0xA7CD, range(0xA7CE, 0xA7CF): 0xA7CF,
                range(0xA7D2, 0xA7D3): 0xA7D3, range(0xA7D4, 0xA7D5): 0xA7D5, range(0xA7DA, 0xA7DB): 0xA7DB, range(0xA7DC, 0xA7DD): 0x19B,
                range(0x10D50, 0x10D66): 0x10D70, range(0x16EA0, 0x16EB9): 0x16EBB}
LOWER = {c: small + i for capitals, small in NEW_CAPITALS.items() for i, c in enumerate(capitals)} | {ord("Σ"): ord("σ")}
#: fixed values: letters and numbers of Unicode 16 that Python's tables do not know (first and last of each range)
NEW = {"L": [(0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65), (0x10D6F, 0x10D85), (0x10EC2, 0x10EC4),
             (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5), (0x113B7, 0x113B7), (0x113D1, 0x113D1), (0x113D3, 0x113D3),
             (0x11BC0, 0x11BE0), (0x13460, 0x143FA), (0x16100, 0x1611D), (0x16D40, 0x16D6C), (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5F0)],
       "N": [(0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79), (0x1CCF0, 0x1CCF9), (0x1E5F1, 0x1E5FA)]}


@functools.cache
def splitter() -> re.Pattern[str]:
    """The file's split pattern, with letters and numbers as ranges of the Unicode categories L and N."""
    ranges = {k: list(v) for k, v in NEW.items()}
    at = 0
    for kind, run in itertools.groupby(unicodedata.category(chr(c))[0] for c in range(sys.maxunicode + 1)):
        size = sum(1 for _ in run)
        if kind in ranges:
            ranges[kind].append((at, at + size - 1))
        at += size
    letter, number = ("".join(f"{re.escape(chr(a))}-{re.escape(chr(b))}" for a, b in ranges[k]) for k in "LN")
    return re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{letter}]+|[{number}]|[^{SPACE}{letter}{number}]+")


#: words that a worker keeps at most in each of two generations: those used since the last turn, and those of the turn before
WORDS_KEPT = 150_000
#: text of a partition that is indexed at a time
PIECE_BYTES = 2 << 20
_OUT = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in the vocabulary: itself where printable, else one from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    shown = {b: chr(b) for b in own}
    for b in range(256):
        shown.setdefault(b, chr(256 + len(shown) - len(own)))
    return [shown[b] for b in range(256)]


class Codec:
    """Tables of one tokenizer file, and the words encoded so far: id string and token string of each."""

    def __init__(self, content: bytes):
        file = json.loads(content)
        vocabulary = file["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in file["added_tokens"]}
        self.symbols = [""] * (1 + max([*vocabulary.values(), *self.special.values()]))
        for s, i in [*vocabulary.items(), *self.special.items()]:
            self.symbols[i] = s
        self.digits = [str(i) for i in range(len(self.symbols))]
        shown = byte_symbols()
        #: symbol of a byte, and behind these 256 the symbol of a byte that ends a word
        self.start = np.array([vocabulary[c] for c in shown] + [vocabulary[c + END] for c in shown], np.int64)
        self.pairs: list[tuple[int, int, int]] = []  # by rank: left, right, merged
        self.as_left: dict[int, dict[int, int]] = {}  # symbol -> right neighbour -> rank
        self.as_right: dict[int, dict[int, int]] = {}
        for rank, pair in enumerate(file["model"]["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            x, y = vocabulary[a], vocabulary[b]
            self.pairs.append((x, y, vocabulary[a + b]))
            self.as_left.setdefault(x, {})[y] = rank
            self.as_right.setdefault(y, {})[x] = rank
        #: rank of two neighbouring bytes of a word, -1 where there is none
        self.first_rank = np.array([[self.as_left.get(x, {}).get(y, -1) for y in self.start.tolist()] for x in self.start.tolist()], np.int32)
        self.ids: dict[str, str] = {}
        self.tokens: dict[str, str] = {}
        self.before: tuple[dict[str, str], dict[str, str]] = ({}, {})

    def split(self, text: str) -> list[str]:
        """Words of a text; the file's special tokens are words of their own, found before anything is normalised."""
        if any(s in text for s in self.special):
            parts = re.split("(" + "|".join(re.escape(s) for s in sorted(self.special, key=len, reverse=True)) + ")", text)
            return [w for i, p in enumerate(parts) for w in ([p] if i % 2 else self._split(p))]
        return self._split(text)

    @staticmethod
    def _split(text: str) -> list[str]:
        # white space only separates words, so it need not become one blank first
        text = unicodedata.normalize("NFC", text)
        if not OTHER.search(text):
            return PLAIN.findall(text.lower())
        # lower-casing goes by single characters: a capital sigma at a word end is no final sigma
        return splitter().findall(text.translate(LOWER).lower())

    def learn(self, words: list[str]) -> list[list[int]]:
        """Ids of all words, encoded at once by their pair index."""
        flat = [w.encode() for w in words]
        if not flat:
            return []
        code = np.frombuffer(b"".join(flat), np.uint8).astype(np.int64)
        ends = np.cumsum(np.fromiter(map(len, flat), np.int64, len(flat)))
        code[ends - 1] += 256
        n = len(code)
        right = np.arange(1, n + 1)
        right[ends - 1] = -1
        left = np.arange(-1, n - 1)
        left[ends[:-1]] = -1
        rank = np.full(n, -1, np.int32)
        rank[:-1] = self.first_rank[code[:-1], code[1:]]
        rank[ends - 1] = -1
        at = np.flatnonzero(rank >= 0)
        at = at[np.argsort(rank[at], kind="stable")]
        kinds, first = np.unique(rank[at], return_index=True)
        listed, cuts = at.tolist(), [*first.tolist(), len(at)]
        where = {r: listed[i:j] for r, i, j in zip(kinds.tolist(), cuts, cuts[1:])}
        active = kinds.tolist()  # ascending, so a heap
        symbol, left, right = self.start[code].tolist(), left.tolist(), right.tolist()
        nothing: dict[int, int] = {}
        while active:
            rank = heapq.heappop(active)
            a, b, new = self.pairs[rank]
            ranks_before, ranks_behind = self.as_right.get(new, nothing), self.as_left.get(new, nothing)
            for i in sorted(where.pop(rank)):
                j = right[i]
                if j < 0 or symbol[i] != a or symbol[j] != b:
                    continue  # an earlier merge took one of the two
                symbol[i], symbol[j] = new, -1
                k = right[i] = right[j]
                if k >= 0:
                    left[k] = i
                    found = ranks_behind.get(symbol[k])
                    if found is not None:
                        if found in where:
                            where[found].append(i)
                        else:
                            where[found] = [i]
                            heapq.heappush(active, found)
                h = left[i]
                if h >= 0:
                    found = ranks_before.get(symbol[h])
                    if found is not None:
                        if found in where:
                            where[found].append(h)
                        else:
                            where[found] = [h]
                            heapq.heappush(active, found)
        out, at = [], 0
        for to in ends.tolist():
            out.append([s for s in symbol[at:to] if s >= 0])
            at = to
        return out

    def prepare(self, split: list[list[str]]) -> None:
        """Afterwards ``ids`` and ``tokens`` have every word of the split texts."""
        present = set().union(*split)
        fresh = present.difference(self.ids)
        if len(self.ids) + len(fresh) > WORDS_KEPT:
            self.before = self.ids, self.tokens
            self.ids, self.tokens, fresh = {}, {}, present
        old_ids, old_tokens = self.before
        ids, tokens, unknown = self.ids, self.tokens, []
        for w in fresh:
            if w in old_ids:
                ids[w], tokens[w] = old_ids[w], old_tokens[w]
            elif w in self.special:
                ids[w], tokens[w] = str(self.special[w]), w
            else:
                unknown.append(w)
        digits, symbols = self.digits, self.symbols
        for w, found in zip(unknown, self.learn(unknown)):
            ids[w] = " ".join([digits[i] for i in found])
            tokens[w] = " ".join([symbols[i] for i in found])

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [[int(i) for i in ids.split()] for ids, _ in self.strings(texts)]

    def strings(self, texts: list[str]) -> list[tuple[str, str]]:
        """Per text its decimal ids, and its tokens, each joined by blanks: the file has no decoder, so that is the decoded text."""
        split = [self.split(t) for t in texts]
        self.prepare(split)
        ids, tokens = self.ids.__getitem__, self.tokens.__getitem__
        return [(" ".join(map(ids, s)), " ".join(map(tokens, s))) for s in split]

    def decode(self, ids: list[int]) -> str:
        """The file has no decoder: tokens are joined by blanks."""
        return " ".join([self.symbols[i] for i in ids])


_codecs: dict[str, Codec] = {}


def codec(content: bytes) -> Codec:
    """The codec of a file's content, made once per worker."""
    key = hashlib.sha256(content).hexdigest()
    if key not in _codecs:
        _codecs.clear()
        _codecs[key] = Codec(content)
    return _codecs[key]


def _mapped(docs: DataFrame, doc_id: str, text: str, path: str, make, schema: str) -> DataFrame:
    with open(path, "rb") as file:  # a vocabulary: a fixed size, whatever the corpus
        shared = docs.sparkSession.sparkContext.broadcast(file.read())

    def run(batches):
        coder = codec(shared.value)
        for batch in batches:
            for piece in pieces(batch, "text", PIECE_BYTES):
                texts = [t or "" for t in piece["text"].to_pylist()]
                yield from make(coder, piece["doc_id"], texts).to_batches()
        coder.before = ({}, {})  # a worker waits for its next task with one generation of words
    return docs.selectExpr(f"cast(`{doc_id}` as bigint) AS doc_id", f"`{text}` AS text").mapInArrow(run, schema)


def encode(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id and the token ids of its whole text. Null and empty texts, and texts of blanks, have no tokens;
    other columns are ignored; no rows, no result rows."""
    def make(coder, ids, texts):
        return pa.table({"doc_id": ids, "ids": pa.array(coder.encode(texts), pa.list_(pa.int32()))})
    return _mapped(docs, doc_id, text, path, make, "doc_id bigint, ids array<int>")


def decode(tokens: DataFrame, path: str, doc_id: str = "doc_id", ids: str = "ids") -> DataFrame:
    """Per row: doc_id and the text of its token ids (null: empty)."""
    with open(path, "rb") as file:
        shared = tokens.sparkSession.sparkContext.broadcast(file.read())

    def run(batches):
        coder = codec(shared.value)
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0), "text": [coder.decode(x or []) for x in batch.column(1).to_pylist()]},
                                             schema=pa.schema([("doc_id", pa.int64()), ("text", pa.string())]))
    return tokens.selectExpr(f"cast(`{doc_id}` as bigint) AS doc_id", f"`{ids}` AS ids").mapInArrow(run, "doc_id bigint, text string")


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def round_trip_digests(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, number of tokens, SHA-256 of the decimal ids joined by blanks and of the decoded text, in one pass.
    Edge cases as in ``encode``; a text without tokens has the digests of the empty string."""
    def make(coder, ids, texts):
        done = coder.strings(texts)
        return pa.table({"doc_id": ids, "n_tokens": pa.array([a.count(" ") + 1 if a else 0 for a, _ in done], pa.int64()),
                         "ids_sha256": pa.array([_sha(a) for a, _ in done], pa.string()), "decoded_sha256": pa.array([_sha(b) for _, b in done], pa.string())})
    return _mapped(docs, doc_id, text, path, make, _OUT)


def tokenised(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, ids, n_tokens, decoded_sha256 (of the decoded text). Edge cases as in ``encode``."""
    def make(coder, ids, texts):
        done = coder.strings(texts)
        sizes = np.array([a.count(" ") + 1 if a else 0 for a, _ in done], np.int64)
        tokens = np.array(" ".join([a for a, _ in done if a]).split(), np.int32)
        ends = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
        return pa.table({"doc_id": ids, "ids": pa.ListArray.from_arrays(ends, pa.array(tokens)), "n_tokens": pa.array(sizes),
                         "decoded_sha256": pa.array([_sha(b) for _, b in done], pa.string())})
    return _mapped(docs, doc_id, text, path, make, "doc_id bigint, ids array<int>, n_tokens bigint, decoded_sha256 string")
