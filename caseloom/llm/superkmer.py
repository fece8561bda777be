"""Repeated word windows, found exactly by super-k-mer partitioning.

Windows of consecutive words that share a minimiser (the smallest hash among the word grams of the window) are
neighbours, so they travel as one packed string to the bucket of that minimiser. Equal windows have equal minimisers
and meet in one bucket, where sorting finds them; equal hashes are compared byte by byte. Per block a string is sent
once, so a passage that stands in a third of all documents reaches its bucket once per block, and the answer goes back
to the block, where it holds for all documents with the string.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from caseloom.llm.arrays import RangeHash, Words, byte_class, covered, equal_ranges, gather, mix, pack, sliding_min, spans_index, unpack
from caseloom.llm.blocks import BLOCK_BYTES, Block, dealt, representatives, text_bytes

WORD = byte_class([(0x20, 0x20), (0x09, 0x0D)], inside=False)
BUCKET_BYTES = 4 << 20
GRAM = 3
_OUT = "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string"


class _Kmers:
    """The super-k-mers of a block: words ``first .. first + windows + window - 2`` of the block."""

    def __init__(self, block: Block, window: int, gram: int):
        self.block, self.window = block, window
        words = Words(block.data, block.offsets, WORD)
        self.count, n = words.count, len(words.start)
        size = words.end - words.start
        self.text = np.full(int(size.sum()) + n, 32, np.uint8)  # all words, one space behind each
        self.at = np.cumsum(size + 1) - size - 1
        self.size = size
        self.text[spans_index(self.at, size)] = block.data[spans_index(words.start, size)]
        self.hash = RangeHash(self.text)
        doc = words.document()
        starts = max(0, n - window + 1)
        valid = doc[:starts] == doc[window - 1:window - 1 + starts]
        h = self.hash.of(self.at, self.at + size)
        gram = min(gram, window)
        g = np.zeros(max(0, n - gram + 1), np.uint64)
        for i in range(gram):
            g += h[i:i + len(g)] * np.uint64(2 * i * 0x9E3779B97F4A7C15 + 1 & (1 << 64) - 1)
        least = sliding_min(mix(g), window - gram + 1)[:starts] if starts else g[:0]
        new = valid.copy()
        if starts > 1:
            new[1:] &= ~valid[:-1] | (least[1:] != least[:-1]) | (doc[1:starts] != doc[:starts - 1])
        self.first = np.flatnonzero(new)
        run = np.cumsum(new)[valid] - 1
        self.windows = np.bincount(run, minlength=len(self.first)).astype(np.int64)
        self.minimiser = least[self.first]
        last = self.first + self.windows + window - 2
        self.begin = self.at[self.first]
        self.bytes = self.at[last] + size[last] + 1 - self.begin
        self.ids = block.ids[doc[self.first]]
        key = self.hash.of(self.begin, self.begin + self.bytes)
        self.rep = representatives(key, (self.ids,), lambda a, b: (self.bytes[a] == self.bytes[b]) & self._same(a, b))

    def _same(self, a, b):
        return equal_ranges(self.text, self.begin[a], self.begin[b], np.where(self.bytes[a] == self.bytes[b], self.bytes[a], 0))


def _send(window: int, gram: int, buckets: int):
    def send(key, table):
        k = _Kmers(Block(table), window, gram)
        sent = np.flatnonzero(k.rep == np.arange(len(k.rep)))
        bucket = (k.minimiser[sent] % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        sent, bucket = sent[order], bucket[order]
        cuts = np.concatenate([np.flatnonzero(np.diff(bucket, prepend=-1)), [len(sent)]])
        rows = {"bucket": [], "block": [], "strings": []}
        for i, j in zip(cuts[:-1], cuts[1:]):
            s = sent[i:j]
            rows["bucket"].append(int(bucket[i]))
            rows["block"].append(int(key[0].as_py()))
            rows["strings"].append(pack(s.astype(np.int32), k.ids[s], k.windows[s].astype(np.int32), gather(k.text, k.begin[s], k.bytes[s])))
        return pa.table(rows, schema=pa.schema([("bucket", pa.int32()), ("block", pa.int32()), ("strings", pa.binary())]))
    return send


def _settle(data, begin, size, ids, hit, against):
    """Decides hash collisions: ``hit`` windows whose bytes differ from the earlier one with the same hash."""
    same = (size[hit] == size[against])
    same &= equal_ranges(data, begin[hit], begin[against], np.where(same, size[hit], 0))
    return same


def _count(window: int):
    def count(key, table):
        parts = [unpack(b, np.int32, np.int64, np.int32, np.uint8) for b in table["strings"].to_pylist()]
        blocks = np.repeat(table["block"].to_numpy(), [len(p[0]) for p in parts])
        local, ids, windows, data = (np.concatenate([p[i] for p in parts]) for i in range(4))
        del parts
        end = np.flatnonzero(data == 32)
        start = np.concatenate([[0], end[:-1] + 1])
        words = windows + window - 1
        first = np.cumsum(words) - words
        at = spans_index(first, windows)  # first word of each window
        entry = np.repeat(np.arange(len(local)), windows)
        begin, stop = start[at], end[at + window - 1]
        del at, start, end
        h = RangeHash(data).of(begin, stop)
        order = np.lexsort((ids[entry], h))
        head = np.concatenate([[True], h[order][1:] != h[order][:-1]])
        earliest = np.empty(len(order), np.int64)
        earliest[order] = order[np.flatnonzero(head)][np.cumsum(head) - 1]
        flag = ids[entry[earliest]] < ids[entry]
        hit = np.flatnonzero(flag)
        differs = hit[~_settle(data, begin, stop - begin, ids, hit, earliest[hit])]
        for value in np.unique(h[differs]):  # two windows, one hash: compare the strings of the whole run
            run = order[np.searchsorted(h[order], value, "left"):np.searchsorted(h[order], value, "right")]
            text = [data[begin[i]:stop[i]].tobytes() for i in run]
            low = {}
            for i, t in zip(run, text):
                low[t] = min(low.get(t, ids[entry[i]]), ids[entry[i]])
            flag[run] = [low[t] < ids[entry[i]] for i, t in zip(run, text)]
        some = np.flatnonzero(np.bincount(entry[flag], minlength=len(local)))
        rows = {"block": [], "flags": []}
        base = np.cumsum(windows) - windows
        for b in np.unique(blocks[some]):
            s = some[blocks[some] == b]
            rows["block"].append(int(b))
            rows["flags"].append(pack(local[s], np.packbits(flag[spans_index(base[s], windows[s])])))
        return pa.table(rows, schema=pa.schema([("block", pa.int32()), ("flags", pa.binary())]))
    return count


def _remove(window: int, gram: int):
    def remove(key, table, answers):
        k = _Kmers(Block(table), window, gram)
        n = len(k.size)
        flag = np.zeros(n + 1, bool)
        for blob in answers["flags"].to_pylist():
            local, bits = unpack(blob, np.int32, np.uint8)
            at = spans_index(k.first[local], k.windows[local])
            flag[at] = np.unpackbits(bits, count=len(at)).astype(bool)
        copies = np.flatnonzero(k.rep != np.arange(len(k.rep)))
        later = copies[k.ids[copies] > k.ids[k.rep[copies]]]
        flag[spans_index(k.first[later], k.windows[later])] = True
        for c in copies[k.ids[copies] == k.ids[k.rep[copies]]]:
            r = k.rep[c]
            flag[k.first[c]:k.first[c] + k.windows[c]] = flag[k.first[r]:k.first[r] + k.windows[r]]
        gone = covered(np.flatnonzero(flag[:n]), window, n)
        per_doc = np.concatenate([[0], np.cumsum(k.count)])
        removed = np.concatenate([[0], np.cumsum(gone)])[per_doc]
        kept = k.text[np.repeat(~gone, k.size + 1)]
        ends = np.concatenate([[0], np.cumsum(np.where(gone, 0, k.size + 1))])[per_doc]
        kept = kept.tobytes()
        digest = [hashlib.sha256(kept[a:max(a, b - 1)]).hexdigest() for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
        return pa.table({"doc_id": k.block.doc_id, "n_words": pa.array(k.count, pa.int64()), "n_removed": pa.array(np.diff(removed), pa.int64()),
                         "kept_sha256": pa.array(digest, pa.string())})
    return remove


def remove_repeated_windows(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = 13, gram: int = GRAM,
                            block_bytes: int = BLOCK_BYTES, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Per row: its words, how many of them a window covers that also starts in a row with a smaller id, and the SHA-256 of
    the rest joined by single spaces.

    Words are maximal runs of other bytes than blank and tab to carriage return. Windows are judged on the input and lie in
    one document. Null and empty texts, and texts shorter than a window, lose nothing; a null id counts as larger than all
    others; rows with one id never remove words from each other, and repeated rows each give a row. Other columns of
    ``docs`` are ignored, so their names cannot clash. An empty table gives an empty result.
    """
    total = text_bytes(docs, text)
    buckets = max(1, math.ceil(3 * total / bucket_bytes))
    blocks = dealt(docs, doc_id, text, total, block_bytes)
    strings = blocks.groupBy("block").applyInArrow(_send(window, gram, buckets), "bucket int, block int, strings binary")
    answers = strings.groupBy("bucket").applyInArrow(_count(window), "block int, flags binary")
    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_remove(window, gram), _OUT)
