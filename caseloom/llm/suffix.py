"""Repeated byte strings, found exactly by sorting suffixes with bucket-pointer refinement.

Suffixes are cut at the wanted length. To sort them apart from each other, every window of ``length`` bytes is keyed by
its anchor, the smallest hash among its ``gram``-byte grams: equal windows have equal anchors at equal offsets. One pass
counts anchors. An anchor that stands once in the whole corpus cannot lie in a repeated window, so only the regions of
repeated anchors travel, each region once per block. A bucket sorts the suffixes of its regions: buckets of equal q-grams
are refined by sorting on the bucket pointers of later offsets, and every pass reads the pointers that the earlier ones
wrote. After the last pass equal pointers mean equal windows, and the earliest of each class stays.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from caseloom.llm.arrays import RangeHash, covered, equal_ranges, gather, mix, pack, sliding_min, spans_index, unpack
from caseloom.llm.blocks import BLOCK_BYTES, Block, dealt, representatives, text_bytes

GRAM = 32
BUCKET_BYTES = 8 << 20
_Q = 5  # bytes of the first buckets: 40 bits, which leaves room for a position in one sort key
_NARROW = 21  # positions of this many bits and two pointers fit one 64-bit sort key
_CHUNK = 1 << 15
_OUT = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"


def _anchor_positions(h: RangeHash, n: int, length: int, gram: int) -> np.ndarray:
    """Position of the leftmost smallest gram of each window of ``length`` bytes, in pieces that stay in the cache."""
    out = np.empty(max(0, n - length + 1), np.int64)
    low = np.uint64(0xFFFFFFFF)
    scale = np.uint64(0xD6E8FEB86659FD93)
    for a in range(0, len(out), _CHUNK):
        b = min(len(out), a + _CHUNK)
        to = b + length - gram  # grams that start in [a, to)
        g = (h.total[a + gram:to + gram] - h.total[a:to]) * h.inverse[a:to] * scale
        key = ((g >> np.uint64(32)) * np.uint64(0xFF51AFD7ED558CCD) & ~low) | np.arange(to - a, dtype=np.uint64)
        out[a:b] = (sliding_min(key, length - gram + 1) & low).astype(np.int64) + a
    return out


class _Regions:
    """The windows of a block in runs with one anchor: windows ``first .. first + windows`` of its bytes."""

    def __init__(self, block: Block, length: int, gram: int):
        self.block, self.length = block, length
        data, offsets = block.data, block.offsets
        n = len(data)
        self.hash = h = RangeHash(data)
        anchor = _anchor_positions(h, n, length, gram)
        valid = np.zeros(len(anchor) + 1, np.int8)  # windows that end in their own document
        size = np.diff(offsets)
        long = size >= length
        np.add.at(valid, offsets[:-1][long], 1)
        np.subtract.at(valid, offsets[1:][long] - length + 1, 1)
        valid = np.cumsum(valid[:-1], dtype=np.int8) > 0
        new = valid.copy()
        new[1:] &= ~valid[:-1] | (anchor[1:] != anchor[:-1])
        self.first = np.flatnonzero(new)
        run = np.cumsum(new)[valid] - 1
        self.windows = np.bincount(run, minlength=len(self.first)).astype(np.int64)
        at = anchor[self.first]
        self.lead = at - self.first
        self.key = h.of(at, at + gram)
        self.bytes = self.windows + length - 1
        doc = np.searchsorted(offsets, self.first, "right") - 1
        self.ids, self.start = block.ids[doc], self.first - offsets[doc]

    def repeated_strings(self) -> np.ndarray:
        """For each run the earliest run of the block with the same bytes."""
        key = self.hash.of(self.first, self.first + self.bytes) ^ mix(self.lead.astype(np.uint64))
        same = lambda a, b: (self.bytes[a] == self.bytes[b]) & (self.lead[a] == self.lead[b]) & equal_ranges(
            self.block.data, self.first[a], self.first[b], np.where(self.bytes[a] == self.bytes[b], self.bytes[a], 0))
        return representatives(key, (self.start, self.ids), same)


def _slices(bucket: np.ndarray):
    cuts = np.concatenate([np.flatnonzero(np.diff(bucket, prepend=-1)), [len(bucket)]])
    return zip(cuts[:-1], cuts[1:])


def _anchors(length: int, gram: int, buckets: int):
    def anchors(key, table):
        r = _Regions(Block(table), length, gram)
        values, times = np.unique(r.key, return_counts=True)
        rows = {"bucket": [], "block": [], "anchors": []}
        bucket = (values >> np.uint64(40)).astype(np.int64) * buckets >> 24
        for i, j in _slices(bucket):
            rows["bucket"].append(int(bucket[i]))
            rows["block"].append(int(key[0].as_py()))
            rows["anchors"].append(pack(values[i:j], np.packbits(times[i:j] > 1)))
        return pa.table(rows, schema=pa.schema([("bucket", pa.int32()), ("block", pa.int32()), ("anchors", pa.binary())]))
    return anchors


def _known(key, table):
    """Which anchors of each block stand at two places of the corpus or more."""
    parts = [unpack(b, np.uint64, np.uint8) for b in table["anchors"].to_pylist()]
    sizes = [len(p[0]) for p in parts]
    values = np.concatenate([p[0] for p in parts])
    more = np.concatenate([np.unpackbits(p[1], count=n).astype(bool) for p, n in zip(parts, sizes)])
    ranked = np.sort(values)
    again = np.unique(np.concatenate([ranked[1:][ranked[1:] == ranked[:-1]], values[more]]))
    at = np.minimum(np.searchsorted(again, values), max(0, len(again) - 1))
    hit = again[at] == values if len(again) else np.zeros(len(values), bool)
    ends = np.cumsum(sizes)
    kept = [values[e - n:e][hit[e - n:e]] for e, n in zip(ends, sizes)]
    return pa.table({"block": table["block"].to_pylist(), "anchors": [pack(k) for k in kept]},
                    schema=pa.schema([("block", pa.int32()), ("anchors", pa.binary())]))


def _send(length: int, gram: int, buckets: int):
    def send(key, table, known):
        r = _Regions(Block(table), length, gram)
        again = [unpack(b, np.uint64)[0] for b in known["anchors"].to_pylist()]
        again = np.sort(np.concatenate(again)) if again else np.zeros(0, np.uint64)
        at = np.minimum(np.searchsorted(again, r.key), max(0, len(again) - 1))
        hit = again[at] == r.key if len(again) else np.zeros(len(r.key), bool)
        sent = np.flatnonzero(hit & (r.repeated_strings() == np.arange(len(r.key))))
        bucket = ((r.key[sent] & np.uint64(0xFFFFFF)).astype(np.int64)) * buckets >> 24
        order = np.lexsort((sent, bucket))
        sent, bucket = sent[order], bucket[order]
        rows = {"bucket": [], "block": [], "regions": []}
        for i, j in _slices(bucket):
            s = sent[i:j]
            rows["bucket"].append(int(bucket[i]))
            rows["block"].append(int(key[0].as_py()))
            rows["regions"].append(pack(s.astype(np.int32), r.key[s], r.ids[s], r.start[s], r.windows[s].astype(np.int16), r.lead[s].astype(np.int16),
                                        gather(r.block.data, r.first[s], r.bytes[s])))
        return pa.table(rows, schema=pa.schema([("bucket", pa.int32()), ("block", pa.int32()), ("regions", pa.binary())]))
    return send


def bucket_pointers(data: np.ndarray, length: int) -> np.ndarray:
    """For each position of ``data`` a pointer that is equal for equal strings of ``length`` bytes (zeros follow the end).

    A pointer is the left end of the position's bucket in the sorted suffixes. Buckets start as groups of equal q-grams;
    a pass sorts the members of each bucket that has more than one by the pointer at a later offset, and so doubles the
    depth. Members of a bucket of one keep their pointer.
    """
    n = len(data)
    if not n:
        return np.zeros(0, np.int64)
    q = min(_Q, length)
    padded = np.concatenate([data, np.zeros(length, np.uint8)])
    grams = np.zeros(n, np.uint64)
    for i in range(q):
        grams = grams << np.uint64(8) | padded[i:i + n]
    narrow = n < 1 << _NARROW  # else up to 2**32 positions, sorted with a separate list of them
    where = np.uint64((1 << _NARROW) - 1)

    def sort(high: np.ndarray, positions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(positions in the order of ``high``, sorted ``high``)."""
        if narrow:
            packed = np.sort(high << np.uint64(_NARROW) | positions.astype(np.uint64))
            return (packed & where).astype(np.int64), packed >> np.uint64(_NARROW)
        order = np.argsort(high, kind="stable")
        return positions[order], high[order]

    def heads(ranked: np.ndarray) -> np.ndarray:
        return np.concatenate([[True], ranked[1:] != ranked[:-1]])

    order, ranked = sort(grams, np.arange(n))
    head = heads(ranked)
    left = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    pointer = np.zeros(n + length, np.int64)  # behind the end: one bucket below all
    pointer[order] = left + 1
    single = head & np.concatenate([head[1:], [True]])
    active = order[~single]
    depth = q
    while depth < length and len(active):
        step = min(depth, length - depth)
        bits = np.uint64(_NARROW if narrow else 32)
        own = pointer[active].astype(np.uint64)
        later = pointer[active + step].astype(np.uint64)
        order, ranked = sort(own << bits | later, active)
        old = (ranked >> bits).astype(np.int64)
        head = heads(ranked)
        begin = np.concatenate([[True], old[1:] != old[:-1]])
        index = np.arange(len(order))
        inside = np.maximum.accumulate(np.where(head, index, 0)) - np.maximum.accumulate(np.where(begin, index, 0))
        pointer[order] = old + inside
        single = head & np.concatenate([head[1:], [True]])
        active = order[~single]
        depth += step
    return pointer[:n]


def _refine(length: int):
    def refine(key, table):
        kinds = (np.int32, np.uint64, np.int64, np.int64, np.int16, np.int16, np.uint8)
        parts = [unpack(b, *kinds) for b in table["regions"].to_pylist()]
        blocks = np.repeat(table["block"].to_numpy(), [len(p[0]) for p in parts])
        local, anchor, ids, start, windows, lead, data = (np.concatenate([p[i] for p in parts]) for i in range(7))
        windows = windows.astype(np.int64)
        size = windows + length - 1
        at = np.cumsum(size) - size
        text = RangeHash(data).of(at, at + size) ^ mix(anchor) ^ lead.astype(np.uint64)
        same = lambda a, b: (anchor[a] == anchor[b]) & (lead[a] == lead[b]) & (size[a] == size[b]) & equal_ranges(
            data, at[a], at[b], np.where(size[a] == size[b], size[a], 0))
        rep = representatives(text, (start, ids), same)
        base = np.cumsum(windows) - windows
        flag = np.zeros(int(windows.sum()), bool)
        mine = np.flatnonzero(rep == np.arange(len(rep)))
        # anchors with several strings, in runs of whole anchors that one sort can take
        order = mine[np.argsort(anchor[mine], kind="stable")]
        run = np.cumsum(np.diff(anchor[order], prepend=anchor[order][:1]) != 0) if len(order) else order
        several = np.bincount(run)[run] > 1 if len(order) else np.zeros(0, bool)
        order, run = order[several], run[several]
        total = np.cumsum(size[order])
        i = 0
        while i < len(order):
            limit = (total[i - 1] if i else 0) + (1 << _NARROW) - 256
            j = int(np.searchsorted(total, limit, "right"))
            j = int(np.searchsorted(run, run[min(j, len(run) - 1)], "left")) if j < len(order) else j
            if j <= i:
                j = int(np.searchsorted(run, run[i], "right"))
            own = order[i:j]
            here = np.cumsum(size[own]) - size[own]
            pointer = bucket_pointers(gather(data, at[own], size[own]), length)
            pointer = pointer[spans_index(here, windows[own])]
            entry = np.repeat(own, windows[own])
            inner = spans_index(np.zeros(len(own), np.int64), windows[own])
            by = np.lexsort((start[entry] + inner, ids[entry], pointer))
            head = np.concatenate([[True], pointer[by][1:] != pointer[by][:-1]])
            first = by[np.flatnonzero(head)][np.cumsum(head) - 1]
            low_id, low_start = ids[entry[first]], (start[entry] + inner)[first]
            later = (ids[entry[by]] > low_id) | ((ids[entry[by]] == low_id) & ((start[entry] + inner)[by] > low_start))
            flag[base[entry[by[later]]] + inner[by[later]]] = True
            i = j
        copies = np.flatnonzero(rep != np.arange(len(rep)))
        r = rep[copies]
        later = copies[(ids[copies] > ids[r]) | (start[copies] > start[r])]
        flag[spans_index(base[later], windows[later])] = True
        equal = copies[(ids[copies] == ids[r]) & (start[copies] == start[r])]
        flag[spans_index(base[equal], windows[equal])] = flag[spans_index(base[rep[equal]], windows[equal])]
        some = np.flatnonzero(np.add.reduceat(flag, base) > 0) if len(flag) else np.zeros(0, np.int64)
        rows = {"block": [], "flags": []}
        for b in np.unique(blocks[some]):
            s = some[blocks[some] == b]
            rows["block"].append(int(b))
            rows["flags"].append(pack(local[s], np.packbits(flag[spans_index(base[s], windows[s])])))
        return pa.table(rows, schema=pa.schema([("block", pa.int32()), ("flags", pa.binary())]))
    return refine


def _remove(length: int, gram: int):
    def remove(key, table, answers):
        r = _Regions(Block(table), length, gram)
        data, offsets = r.block.data, r.block.offsets
        flag = np.zeros(len(data) + 1, bool)
        for blob in answers["flags"].to_pylist():
            local, bits = unpack(blob, np.int32, np.uint8)
            at = spans_index(r.first[local], r.windows[local])
            flag[at] = np.unpackbits(bits, count=len(at)).astype(bool)
        rep = r.repeated_strings()
        copies = np.flatnonzero(rep != np.arange(len(rep)))
        o = rep[copies]
        later = copies[(r.ids[copies] > r.ids[o]) | (r.start[copies] > r.start[o])]
        flag[spans_index(r.first[later], r.windows[later])] = True
        equal = copies[(r.ids[copies] == r.ids[o]) & (r.start[copies] == r.start[o])]
        flag[spans_index(r.first[equal], r.windows[equal])] = flag[spans_index(r.first[rep[equal]], r.windows[equal])]
        gone = covered(np.flatnonzero(flag[:-1]), length, len(data))
        rise = gone.copy()
        rise[1:] &= ~gone[:-1]
        inner = offsets[:-1][offsets[:-1] < len(data)]
        rise[inner] = gone[inner]
        upto = lambda x: np.diff(np.concatenate([[0], np.cumsum(x)])[offsets])
        removed, spans = upto(gone), upto(rise)
        kept = data[~gone].tobytes()
        ends = np.concatenate([[0], np.cumsum(np.diff(offsets) - removed)]).tolist()
        digest = [hashlib.sha256(kept[a:b]).hexdigest() for a, b in zip(ends[:-1], ends[1:])]
        return pa.table({"doc_id": r.block.doc_id, "n_bytes": pa.array(np.diff(offsets), pa.int64()), "n_removed": pa.array(removed, pa.int64()),
                         "n_spans": pa.array(spans, pa.int64()), "kept_sha256": pa.array(digest, pa.string())})
    return remove


def remove_repeated_bytes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = 100, gram: int = GRAM,
                          block_bytes: int = BLOCK_BYTES, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Per row: its UTF-8 bytes, how many of them lie in a string of ``length`` bytes that also starts earlier (in a row with
    a smaller id, or earlier in a row with this id), in how many maximal runs, and the SHA-256 of the rest.

    Strings are judged on the input, may overlap and lie in one document. Null and empty texts and texts shorter than
    ``length`` lose nothing; a null id counts as larger than all others; repeated rows each give a row and are equally
    early, so they never remove each other. Other columns of ``docs`` are ignored. An empty table gives an empty result.
    """
    total = text_bytes(docs, text)
    blocks = dealt(docs, doc_id, text, total, block_bytes)
    gram = min(gram, length)
    few = max(1, math.ceil(0.4 * total / bucket_bytes))
    buckets = max(1, math.ceil(2 * total / bucket_bytes))
    anchors = blocks.groupBy("block").applyInArrow(_anchors(length, gram, few), "bucket int, block int, anchors binary")
    known = anchors.groupBy("bucket").applyInArrow(_known, "block int, anchors binary")
    regions = blocks.groupBy("block").cogroup(known.groupBy("block")).applyInArrow(_send(length, gram, buckets), "bucket int, block int, regions binary")
    answers = regions.groupBy("bucket").applyInArrow(_refine(length), "block int, flags binary")
    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_remove(length, gram), _OUT)
