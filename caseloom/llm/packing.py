"""Documents packed into sequences of a fixed number of tokens: best fit first, then swaps that empty bins.

A bin is a sequence. Best fit decreasing fills the bins; then the emptiest bin gives its documents away: it moves one or two
of them into another bin's free space, or exchanges one or two for a smaller document there. Every step moves tokens from the
emptiest bin to a fuller one, so the sum of squared fills rises and the search ends. Pieces of the full length need no search.
"""

from __future__ import annotations

import itertools
import json
import os
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseloom.llm.arrays import pieces
from caseloom.llm.bpe import END, codec
from caseloom.session import shared_dir

SEQUENCE = 4096
END_ID = 1
GROUP_PIECES = 16_384
WORDS_KEPT, BYTES_KEPT, WORDS_AT_ONCE = 300_000, 32 << 20, 8192
#: so many emptiest bins in a row without a possible step end the search
PATIENCE = 32
_PIECES = "number bigint, doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def _runs(pool: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The runs of a pool that begin at ``start``, one behind the other."""
    ends = np.cumsum(size)
    return pool[np.arange(ends[-1] if len(ends) else 0) + np.repeat(start - ends + size, size)]


class WordIds:
    """Ids of words, which are known by running numbers. Words used since the last turn of the cache, or the turn before, stay in it."""

    def __init__(self, content: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        file = json.loads(content)
        # words are normalised and split already: the library gets many at once, with a blank between them
        steps = file["pre_tokenizer"]["pretokenizers"]
        file["normalizer"] = None
        file["pre_tokenizer"] = {"type": "Sequence", "pretokenizers": [{"type": "WhitespaceSplit"}, *[s for s in steps if s["type"] != "Split"]]}
        self.library = Tokenizer.from_str(json.dumps(file))
        coder = codec(content)
        self.split = coder.split
        #: by id: whether it ends a word
        self.last = np.array([s.endswith(END) or s in coder.special for s in coder.symbols])
        self.before = {}, _Ids()
        self._turn()

    def _turn(self) -> None:
        self.now: dict[str, int] = defaultdict(itertools.count().__next__)  # a word that is not there gets the next number
        self.ids = _Ids()
        self.bytes = 0

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text (little-endian, 32 bits each)."""
        split = [self.split(t) for t in texts]
        counts = np.fromiter(map(len, split), np.int64, len(split))
        numbers = self._numbers(split, int(counts.sum()))
        start, size = self.ids.start[numbers], self.ids.size[numbers]
        cuts = np.cumsum(np.concatenate([[0], size]))
        out = np.empty(cuts[-1], "<u4")
        for i in range(0, len(numbers), WORDS_AT_ONCE):
            to = min(i + WORDS_AT_ONCE, len(numbers))
            out[cuts[i]:cuts[to]] = _runs(self.ids.ids, start[i:to], size[i:to])
        cuts = cuts[np.cumsum(np.concatenate([[0], counts]))].tolist()
        return [out[i:j].tobytes() for i, j in zip(cuts, cuts[1:])]

    def _numbers(self, split: list[list[str]], size: int) -> np.ndarray:
        """Numbers of all words, one behind the other; the ids of each are there afterwards."""
        known = len(self.now)
        numbers = np.fromiter(map(self.now.__getitem__, itertools.chain.from_iterable(split)), np.int64, size)
        fresh = list(itertools.islice(self.now, known, None))
        self.bytes += sum(map(len, fresh))
        if known and (len(self.now) > WORDS_KEPT or self.bytes > BYTES_KEPT):
            used, numbers = np.unique(numbers, return_inverse=True)
            words = list(self.now)
            for w in fresh:
                del self.now[w]
            self.before = self.now, self.ids
            self._turn()
            fresh = [words[i] for i in used.tolist()]
            for w in fresh:
                self.now[w]
            self.bytes = sum(map(len, fresh))
        self._learn(fresh)
        return numbers

    def _learn(self, words: list[str]) -> None:
        """Ids of words that have the next numbers."""
        old, kept = self.before
        place = np.fromiter((old.get(w, -1) for w in words), np.int64, len(words))
        unknown = list(itertools.compress(words, place < 0))
        made = [np.zeros(0, np.uint32)]
        for i in range(0, len(unknown), WORDS_AT_ONCE):
            some = " ".join(unknown[i:i + WORDS_AT_ONCE])
            made.append(np.array(self.library.encode_batch_fast([some], add_special_tokens=False)[0].ids, np.uint32))
        ids = np.concatenate(made)
        ends = np.flatnonzero(self.last[ids]) + 1
        if len(ends) != len(unknown):
            raise ValueError("the words of a tokenizer file must end in one id that ends a word")
        place[place < 0] = np.arange(len(unknown)) + len(kept.size)
        size = np.concatenate([kept.size, np.diff(ends, prepend=0)])[place]
        start = np.concatenate([kept.start, ends - np.diff(ends, prepend=0) + len(kept.ids)])[place]
        self.ids.append(_runs(np.concatenate([kept.ids, ids]), start, size), size)


class _Ids:
    """Ids of numbered words, one behind the other."""

    def __init__(self):
        self.ids, self.start, self.size = np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def append(self, ids: np.ndarray, size: np.ndarray) -> None:
        self.start = np.concatenate([self.start, np.cumsum(size) - size + len(self.ids)])
        self.ids, self.size = np.concatenate([self.ids, ids]), np.concatenate([self.size, size])


_words: dict[int, WordIds] = {}


def _cut(shared, sequence: int, end_id: int):
    end = np.array([end_id], "<u4").tobytes()

    def run(batches):
        content = shared.value
        key = zlib.crc32(content)
        if key not in _words:
            _words.clear()
            _words[key] = WordIds(content)
        number = TaskContext.get().partitionId() << 36
        for batch in batches:
            for part in pieces(batch, "text", 2 << 20):
                rows = {"doc": [], "piece": [], "start": [], "length": [], "crc": []}
                for doc, ids in zip(part["doc_id"].to_pylist(), _words[key].encode([t or "" for t in part["text"].to_pylist()])):
                    ids = memoryview(ids + end)
                    for n, at in enumerate(range(0, len(ids) // 4, sequence)):
                        here = ids[4 * at:4 * (at + sequence)]
                        for c, v in zip(rows, (doc, n, at, len(here) // 4, zlib.crc32(here))):
                            rows[c].append(v)
                size = len(rows["doc"])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(number, number + size)), pa.array(rows["doc"], pa.int64()), pa.array(rows["piece"], pa.int32()),
                     pa.array(rows["start"], pa.int64()), pa.array(rows["length"], pa.int64()), pa.array(rows["crc"], pa.int64())],
                    ["number", "doc_id", "piece", "start", "length", "ids_crc32"])
                number += size
    return run


def best_fit(sizes: list[int], capacity: int) -> tuple[list[int], list[int]]:
    """Bin of each size and free space of each bin; every size goes where least space remains. Sizes come in falling order."""
    with_free: dict[int, list[int]] = {}
    some = 0  # bit f is set where a bin has f free
    bins, free = [], []
    for s in sizes:
        fits = some >> s
        if fits:
            f = s + (fits & -fits).bit_length() - 1
            b = with_free[f].pop()
            if not with_free[f]:
                some ^= 1 << f
        else:
            f, b = capacity, len(free)
            free.append(capacity)
        f -= s
        free[b] = f
        bins.append(b)
        if f:
            with_free.setdefault(f, []).append(b)
            some |= 1 << f
    return bins, free


class Bins:
    """Local search over the bins of one group, from a given bin of each size or (sizes falling) from best fit."""

    def __init__(self, sizes: np.ndarray, capacity: int, where: list[int] | None = None):
        self.sizes, self.capacity = sizes, capacity
        self.where = np.array(best_fit(sizes.tolist(), capacity)[0] if where is None else where, np.int64)
        self.held: list[list[int]] = [[] for _ in range(int(self.where.max()) + 1)]
        for i, b in enumerate(self.where.tolist()):
            self.held[b].append(i)
        self.free = capacity - np.bincount(self.where, sizes).astype(np.int64)
        self.count = len(self.held)
        self.least = max(-(-int(sizes.sum()) // capacity), int((2 * sizes > capacity).sum()))

    def search(self, patience: int = PATIENCE) -> None:
        stuck: set[int] = set()
        while self.count > self.least and len(stuck) < patience:
            free = np.where(self.free < self.capacity, self.free, -1)
            free[list(stuck)] = -1
            source = int(np.argmax(free))
            if free[source] <= 0:
                break
            before = self.free[source]
            self._empty(source)
            if self.free[source] == self.capacity:
                self.count -= 1
                stuck.clear()
            else:
                if self.free[source] > before:
                    stuck.clear()
                stuck.add(source)

    def _empty(self, source: int) -> None:
        """Steps from a bin to fuller ones, as long as there is one: squares of fills only rise that way."""
        partners = np.flatnonzero((self.free > 0) & (self.free <= self.free[source]))
        partners = partners[partners != source]
        while self.held[source]:
            step = self._step(source, partners)
            if step is None:
                return
            out, target, back = step
            self.held[source] = [i for i in self.held[source] if i not in out] + back
            self.held[target] = [i for i in self.held[target] if i not in back] + out
            self.where[out], self.where[back] = target, source
            moved = int(self.sizes[out].sum()) - int(self.sizes[back].sum())
            self.free[source] += moved
            self.free[target] -= moved
            if not self.free[target]:
                partners = partners[partners != target]

    def _step(self, source: int, partners: np.ndarray):
        """(documents that go, their bin, documents that come back): whole moves first, then the exchange that leaves least free,
        for one document and, where none helps, for two of neighbouring sizes."""
        if not len(partners):
            return None
        same: dict[int, list[int]] = {}
        for i in self.held[source]:
            same.setdefault(int(self.sizes[i]), []).append(i)
        two: dict[int, tuple[int, ...]] = {}
        kinds = sorted(same)
        for n, x in enumerate(kinds):
            if len(same[x]) > 1:
                two.setdefault(2 * x, (same[x][0], same[x][1]))
            for y in kinds[n + 1:]:
                if x + y > self.capacity:
                    break
                two.setdefault(x + y, (same[x][0], same[y][0]))
        sums = {**two, **{x: (i[0],) for x, i in same.items()}}
        offer = np.array(sorted(sums), np.int64)
        free = self.free[partners]
        most = offer[np.maximum(0, np.searchsorted(offer, free, "right") - 1)]
        fits = most <= free
        if fits.any():  # a move: the largest offer that finds room, where least remains
            j = int(np.argmin(np.where(fits, (self.capacity - most) * (self.capacity + 1) + free - most, np.iinfo(np.int64).max)))
            return list(sums[int(most[j])]), int(partners[j]), []
        open_bin = np.zeros(len(self.free), bool)
        open_bin[partners] = True
        docs = np.flatnonzero(open_bin[self.where])
        docs = docs[np.lexsort((self.sizes[docs], self.where[docs]))]
        beside = np.flatnonzero(self.where[docs[1:]] == self.where[docs[:-1]])
        for back in (docs[:, None], np.stack([docs[beside], docs[beside + 1]], 1)):
            own, target = self.sizes[back].sum(1), self.where[back[:, 0]]
            most = offer[np.maximum(0, np.searchsorted(offer, own + self.free[target], "right") - 1)]
            gain = most - own
            left = np.where((gain > 0) & (gain <= self.free[target]), self.free[target] - gain, self.capacity)
            if len(left) and left.min() < self.capacity:
                j = int(np.argmin(left))
                return list(sums[int(most[j])]), int(target[j]), back[j].tolist()
        return None


def _packed(sequence: int, patience: int):
    def run(key, table):
        length, number = table["length"].to_numpy(), table["number"].to_numpy()
        order = np.lexsort((number, -length))
        table, length = table.take(pa.array(order)), length[order]
        bins = Bins(length, sequence)
        bins.search(patience)
        by_bin = np.argsort(bins.where, kind="stable")
        size = length[by_bin]
        before = np.cumsum(size) - size
        head = np.concatenate([[True], np.diff(bins.where[by_bin]) != 0])
        offset = np.empty(len(size), np.int64)
        offset[by_bin] = before - before[np.flatnonzero(head)][np.cumsum(head) - 1]
        ids = (int(key[0].as_py()) << 32) + bins.where
        return table.drop_columns(["number", "part"]).append_column("sequence_id", pa.array(2 * ids + 1)).append_column("offset", pa.array(offset))
    return run


def packed_sequences(docs: DataFrame, path: str, sequence: int = SEQUENCE, end_id: int = END_ID, doc_id: str = "doc_id", text: str = "text",
                     group_pieces: int = GROUP_PIECES, patience: int = PATIENCE) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id and offset (its place there, without gaps).

    A document is its token ids and ``end_id``; only one that is longer than a sequence is cut. Null and empty texts are one end
    id. Equal and null ids, and repeated rows, are packed like any other row; other columns are ignored; an empty table gives no
    rows. Pieces are written once and dealt by their running number into groups of about ``group_pieces``, so that neither
    copies nor one hot source meet in a group; a group leaves a bin or two that more pieces could have filled. Which of the
    possible packings comes out depends on how the rows are dealt to tasks.
    """
    spark = docs.sparkSession
    with open(path, "rb") as file:  # a vocabulary: a fixed size, whatever the corpus
        shared = spark.sparkContext.broadcast(file.read())
    rows = docs.selectExpr(f"cast(`{doc_id}` as bigint) AS doc_id", f"`{text}` AS text")
    written = shared_dir(spark, "packing-pieces")
    rows.mapInArrow(_cut(shared, sequence, end_id), _PIECES).write.parquet(written)
    cut = spark.read.parquet(written)
    rest = cut.where(F.col("length") < sequence)
    groups = max(1, -(-rest.count() // group_pieces))
    rest = rest.withColumn("part", F.pmod(F.xxhash64("number"), F.lit(groups)))
    packed = rest.groupBy("part").applyInArrow(_packed(sequence, patience), "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint")
    whole = cut.where(F.col("length") == sequence)
    return packed.unionAll(whole.select("doc_id", "piece", "start", "length", "ids_crc32", (2 * F.col("number")).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset")))
