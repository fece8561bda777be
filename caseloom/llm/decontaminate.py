"""Benchmark passages in documents by a prefix-filtered set join.

An item is cut into windows of ``window`` words (a shorter item is one window). A window is a set of word shingles, and a
document that contains the window contains all of them, so one shingle per window is prefix enough: the one that is rarest
in the corpus. Neighbouring windows of an item mostly share their rarest shingle and join as one row. A pass over the
documents counts the benchmark's shingles, a second one finds the prefix shingles; both look them up in a bitmap of fixed
size first. Candidates must have room for the window around the shingle (length and position) and are then compared word
by word.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseloom.llm.arrays import RangeHash, Words, byte_class, flat_text, mix, pieces
from caseloom.session import cut_lineage

WORD = byte_class([(0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF)])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SHINGLE = 3
BITMAP_BITS = 24  # 2 MB, whatever the benchmark's size


def _words(column) -> tuple[np.ndarray, Words]:
    data, offsets = flat_text(column)
    data = LOWER[data]
    return data, Words(data, offsets, WORD)


def _word_hash(data: np.ndarray, words: Words) -> np.ndarray:
    return RangeHash(data).of(words.start, words.end)


def _shingles(h: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` words, as signed 64-bit numbers; runs over document ends are included."""
    out = np.full(max(0, len(h) - size + 1), size, np.uint64)
    for i in range(size):
        out += h[i:i + len(out)] * np.uint64(2 * i * 0x9E3779B97F4A7C15 + 1 & (1 << 64) - 1)
    return mix(out).view(np.int64)


def _inside(words: Words, size: int) -> np.ndarray:
    """Which runs of ``size`` words lie in one document."""
    doc = words.document()
    n = max(0, len(doc) - size + 1)
    return doc[:n] == doc[size - 1:size - 1 + n]


def _items(window: int, shingle: int):
    def items(batches):
        for batch in batches:
            texts = batch.column("text")
            data, words = _words(texts)
            h = _word_hash(data, words)
            raw = data.tobytes()
            all_words = [raw[a:b].decode() for a, b in zip(words.start.tolist(), words.end.tolist())]
            rows = {"item_id": [], "words": [], "shingles": [], "size": []}
            for i, item in enumerate(batch.column("item_id").to_pylist()):
                a, b = int(words.first[i]), int(words.first[i + 1])
                if a < b:
                    size = min(shingle, b - a)
                    rows["item_id"].append(item)
                    rows["words"].append(all_words[a:b])
                    rows["shingles"].append(_shingles(h[a:b], size).tolist())
                    rows["size"].append(size)
            yield pa.RecordBatch.from_pydict(rows, schema=pa.schema([("item_id", pa.string()), ("words", pa.list_(pa.string())),
                                                                     ("shingles", pa.list_(pa.int64())), ("size", pa.int32())]))
    return items


def _prefixes(window: int):
    """Rows of an item with the corpus counts of its shingles -> one row per run of windows with one rarest shingle."""
    def prefixes(batches):
        for batch in batches:
            rows = {"hash": [], "item_id": [], "left": [], "right": [], "least": [], "width": []}
            for item, words, shingles, size, counts in zip(*(batch.column(c).to_pylist() for c in ("item_id", "words", "shingles", "size", "counts"))):
                width = min(window, len(words))
                span = width - size + 1
                chosen = []
                for s in range(len(words) - width + 1):
                    best = min(range(s, s + span), key=lambda p: (counts[p], shingles[p], p))
                    chosen.append(best if counts[best] else -1)  # a shingle that no document has: no document has the window
                s = 0
                while s < len(chosen):
                    e = s
                    while e + 1 < len(chosen) and chosen[e + 1] == chosen[s]:
                        e += 1
                    p = chosen[s]
                    if p >= 0:
                        rows["hash"].append(shingles[p])
                        rows["item_id"].append(item)
                        rows["left"].append(words[s:p])
                        rows["right"].append(words[p:e + width])
                        rows["least"].append(p - e)
                        rows["width"].append(width)
                    s = e + 1
            yield pa.RecordBatch.from_pydict(rows, schema=pa.schema([
                ("hash", pa.int64()), ("item_id", pa.string()), ("left", pa.list_(pa.string())), ("right", pa.list_(pa.string())),
                ("least", pa.int32()), ("width", pa.int32())]))
    return prefixes


class Bitmap:
    """Marks of hashes in 2**24 bits: a cheap lossless filter, since an unmarked hash is none of the set."""

    def __init__(self, hashes: DataFrame, column: str):
        place = F.shiftrightunsigned(F.col(column), 64 - BITMAP_BITS) + 1  # the functions count values from 1 on
        rows = hashes.groupBy(F.bitmap_bucket_number(place).alias("b")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")).collect()
        bits = np.zeros((1 << BITMAP_BITS) // 8, np.uint8)
        for r in rows:
            at = (r["b"] - 1) * 4096
            part = np.frombuffer(bytes(r["bits"]), np.uint8)
            bits[at:at + len(part)] |= part
        self.bits = hashes.sparkSession.sparkContext.broadcast(bits.tobytes())

    def reader(self):
        shared = self.bits

        def marked(hashes: np.ndarray) -> np.ndarray:
            table = np.frombuffer(shared.value, np.uint8)
            place = hashes.view(np.uint64) >> np.uint64(64 - BITMAP_BITS)
            return (table[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 > 0
        return marked


def _count(sizes: list[int], marked):
    def count(batches):
        for batch in batches:
            for piece in pieces(batch, "text"):
                data, words = _words(piece["text"])
                h = _word_hash(data, words)
                found = []
                for size in sizes:
                    s = _shingles(h, size)
                    hit = np.flatnonzero(marked(s))
                    found.append(s[hit[_inside(words, size)[hit]]])
                values, times = np.unique(np.concatenate(found), return_counts=True)
                yield pa.RecordBatch.from_pydict({"hash": values, "n": times}, schema=pa.schema([("hash", pa.int64()), ("n", pa.int64())]))
    return count


_HITS = pa.schema([("doc_id", pa.int64()), ("text_key", pa.int64()), ("n_words", pa.int64()), ("position", pa.int64()), ("hash", pa.int64()),
                   ("before", pa.list_(pa.string())), ("after", pa.list_(pa.string()))])


def _hits(sizes: list[int], window: int, marked):
    """A row per document (position -1) and one per prefix shingle in it, with the words around."""
    def hits(batches):
        for batch in batches:
            for piece in pieces(batch, "text"):
                data, words = _words(piece["text"])
                h = RangeHash(data)
                raw = data.tobytes()
                ids = piece["doc_id"].combine_chunks()
                key = piece["text_key"].combine_chunks().to_numpy(zero_copy_only=False)
                wh = h.of(words.start, words.end)
                rows_doc, rows_at, rows_hash = [], [], []
                document = words.document()
                for size in sizes:
                    s = _shingles(wh, size)
                    at = np.flatnonzero(marked(s))
                    at = at[_inside(words, size)[at]]
                    rows_at.append(at)
                    rows_doc.append(document[at])
                    rows_hash.append(s[at])
                at, doc, value = (np.concatenate(x) for x in (rows_at, rows_doc, rows_hash))
                n = len(ids)
                before, after = [[]] * n, [[]] * n
                cache = {}

                def word(i):
                    if i not in cache:
                        cache[i] = raw[words.start[i]:words.end[i]].decode()
                    return cache[i]
                for d, i in zip(doc.tolist(), at.tolist()):
                    before.append([word(j) for j in range(max(int(words.first[d]), i - window + 1), i)])
                    after.append([word(j) for j in range(i, min(int(words.first[d + 1]), i + window))])
                every = np.concatenate([np.arange(n), doc])
                yield pa.RecordBatch.from_arrays([
                    ids.take(pa.array(every)), pa.array(key[every]), pa.array(words.count[every], pa.int64()),
                    pa.array(np.concatenate([np.full(n, -1), at - words.first[doc]]), pa.int64()), pa.array(np.concatenate([key, value])),
                    pa.array(before, pa.list_(pa.string())), pa.array(after, pa.list_(pa.string()))], schema=_HITS)
    return hits


def _common(a: list[str], b: list[str]) -> int:
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


def _verify(batches):
    """Compares words to the left and right of a shingle; the windows inside the common stretch occur."""
    schema = pa.schema([("doc_id", pa.int64()), ("text_key", pa.int64()), ("n_words", pa.int64()), ("is_doc", pa.bool_()),
                        ("begin", pa.int64()), ("end", pa.int64()), ("item_id", pa.string()), ("found", pa.bool_())])
    for batch in batches:
        columns = {c: batch.column(c).to_pylist() for c in ("doc_id", "text_key", "n_words", "position", "before", "after", "left", "right", "least", "width", "item_id")}
        out = {name: [] for name in schema.names}
        for doc_id, key, n_words, position, before, after, left, right, least, width, item in zip(*columns.values()):
            begin = end = None
            if position >= 0:
                if left is None:
                    continue
                most = _common(left[::-1], before[::-1])  # windows may start so many words before the shingle ...
                need = width - _common(right, after)  # ... and must start at least so many before it
                low = max(least, need)
                if low > most:
                    continue
                begin, end = position - most, position - low + width
            row = (doc_id, key, n_words, position < 0, begin, end, item if position >= 0 else None, position >= 0)
            for name, value in zip(schema.names, row):
                out[name].append(value)
        yield pa.RecordBatch.from_pydict(out, schema=schema)


def contamination(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text",
                  window: int = 10, shingle: int = SHINGLE) -> DataFrame:
    """Per row of ``docs``: doc_id, text_key, n_words, n_hit (words inside an occurrence of an item's window), items (sorted
    ids, as strings, of the items with occurrences), n_items, contaminated.

    Words are runs of digits, letters a-z and anything beyond ASCII, after lower-casing A-Z. Null has no words and is never
    hit; an item without words has no window; an item without an id marks words but is not counted; repeated items count
    once, repeated rows of ``docs`` each give a row. Other columns are ignored; empty tables are allowed on both sides.
    """
    docs = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.xxhash64(F.col(text)).alias("text_key"), F.col(text).alias("text"))
    cut = items.select(F.col(item_id).cast("string").alias("item_id"), F.col(item_text).alias("text")).mapInArrow(
        _items(window, shingle), "item_id string, words array<string>, shingles array<bigint>, size int").distinct()
    cut = cut_lineage(cut.withColumn("key", F.xxhash64("item_id", "words")))
    sizes = [r["size"] for r in cut.select("size").distinct().collect()] or [shingle]  # at most ``shingle`` values
    each = cut.select("key", "item_id", "words", F.posexplode("shingles").alias("place", "hash"))
    counted = docs.select("text").mapInArrow(_count(sizes, Bitmap(each, "hash").reader()), "hash bigint, n bigint")
    counts = counted.groupBy("hash").agg(F.sum("n").alias("n"))
    known = each.select("key", "item_id", "words", "place", "hash").join(counts, "hash", "left")
    listed = known.groupBy("key", "item_id", "words").agg(F.sort_array(F.collect_list(F.struct("place", F.coalesce("n", F.lit(0)).alias("n")))).alias("c"))
    listed = listed.join(cut.select(F.col("key").alias("k"), F.col("item_id").alias("i"), F.col("words").alias("w"), "shingles", "size"),
                         (F.col("key") == F.col("k")) & F.col("item_id").eqNullSafe(F.col("i")) & (F.col("words") == F.col("w")))
    prefixes = cut_lineage(listed.select("item_id", "words", "shingles", "size", F.col("c.n").alias("counts")).mapInArrow(
        _prefixes(window), "hash bigint, item_id string, left array<string>, right array<string>, least int, width int"))
    hits = docs.mapInArrow(_hits(sizes, window, Bitmap(prefixes, "hash").reader()), "doc_id bigint, text_key bigint, n_words bigint, position bigint, "
                           "hash bigint, before array<string>, after array<string>")
    joined = hits.join(prefixes.withColumnRenamed("hash", "prefix"), (F.col("hash") == F.col("prefix")) & (F.col("position") >= 0) & (
        F.size("before") >= F.col("least")) & (F.size("before") + F.size("after") >= F.col("width")), "left")
    checked = joined.mapInArrow(_verify, "doc_id bigint, text_key bigint, n_words bigint, is_doc boolean, begin bigint, end bigint, item_id string, found boolean")
    spans = F.array_sort(F.collect_set(F.when(F.col("found"), F.struct("begin", "end"))))
    grouped = checked.groupBy("doc_id", "text_key", "n_words").agg(F.count_if("is_doc").alias("rows"), F.array_sort(F.collect_set("item_id")).alias("items"), spans.alias("spans"))
    start = F.struct(F.lit(0).cast("bigint").alias("end"), F.lit(0).cast("bigint").alias("n"))
    hit = F.aggregate("spans", start, lambda a, s: F.struct(F.greatest(a["end"], s["end"]).alias("end"),
                                                            (a["n"] + F.greatest(F.lit(0), s["end"] - F.greatest(a["end"], s["begin"]))).alias("n")))["n"]
    return grouped.select("doc_id", "text_key", "n_words", hit.alias("n_hit"), "items", F.size("items").cast("bigint").alias("n_items"),
                          (F.size("spans") > 0).alias("contaminated"), F.explode(F.array_repeat(F.lit(0), F.col("rows").cast("int"))).alias("copy")).drop("copy")


def uncontaminated(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs``, with all their columns, that no window of an item occurs in."""
    found = contamination(docs, items, doc_id, text, **options).where("contaminated")
    key = lambda own: [F.coalesce(own, F.lit(0)).alias("id_or_0"), own.isNull().alias("no_id")]
    hit = found.select(*key(F.col("doc_id")), "text_key")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *key(F.col(doc_id).cast("bigint")), F.xxhash64(F.col(text)).alias("text_key"))
    return rows.join(hit, ["id_or_0", "no_id", "text_key"], "left_anti").select("row.*")
