"""Near duplicates by prefixes of MinHash labels, verified exactly.

Rows with the same words are one class; from here on classes are compared. There are ``trees`` labels of up to ``LONGEST``
values, each value with a hash function of its own. The matched prefix is shortened until a pair at the threshold agrees in
some label's prefix with probability ``recall``. Every pair at the threshold must be found, so that depth is the same for
all classes, and only the classes below one node of that depth meet: they are a bucket, its key a hash of label and prefix.
So the tries of an LSH forest are never built, nor the label values behind that depth.
Within a bucket a class is compared with leaders only: the signatures' estimate links it to every leader it may share a
near duplicate with, and makes it a leader unless it is close to one. By the triangle inequality of the Jaccard distance
two near duplicates of a bucket end up in one component of these links; only a spanning forest of them is written. The components
are then compared exactly, all members with all members, as products of incidence matrices, in pairs of blocks of bounded
size. So a link is lost only if all tries miss it.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from caseloom.llm.arrays import RangeHash, Words, byte_class, flat_text, mix, one_array, pieces
from caseloom.llm.components import components
from caseloom.session import cut_lineage

WORD = byte_class([(0x20, 0x20), (0x09, 0x0D)], inside=False)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
VALUES = 128
LONGEST = 16
BUCKET_ROWS = 5_000
BLOCK_ROWS = 512
#: estimates of 128 values: so close (a distance of 0.33 at most) that a member needs no turn as leader
_CLOSE = 0.8
_SEED = np.random.default_rng(20240610)
_FACTORS = _SEED.integers(1, 2**63, VALUES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def prefix_length(threshold: float, trees: int, recall: float, longest: int = LONGEST) -> int:
    """Shortens the matched prefix from the whole label until a pair at the threshold is found with probability ``recall``."""
    for length in range(longest, 0, -1):
        if 1 - (1 - threshold ** length) ** trees >= recall:
            return length
    return 1


def link_limit(threshold: float) -> float:
    """The estimate below which no near duplicate of a member close to a leader can be: a distance of 0.33 to the leader and one
    of the threshold add up, and an estimate is off by 0.2 at most (4 standard errors of ``VALUES`` values). 0: all are linked."""
    return max(0.0, threshold - 0.33 - 0.2)


def hash_factors(n: int) -> np.ndarray:
    """Odd factors of the first n hash functions; the first ``VALUES`` make the signature that estimates use."""
    return np.concatenate([_FACTORS, np.random.default_rng(7).integers(1, 2**63, max(0, n - VALUES), dtype=np.uint64) * np.uint64(2) + np.uint64(1)])[:n]


def word_shingles(column, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, first): 64-bit hashes of the runs of ``size`` lower-cased words of each text; a text of fewer words is one run."""
    data, offsets = flat_text(column)
    data = LOWER[data]
    words = Words(data, offsets, WORD)
    h = RangeHash(data).of(words.start, words.end)
    n = len(h)
    rolled = np.zeros(n, np.uint64)
    factor = [np.uint64(2 * i * 0x9E3779B97F4A7C15 + 1 & (1 << 64) - 1) for i in range(size)]
    for i in range(min(size, n)):
        rolled[:n - i] += h[i:] * factor[i]
    rolled = mix(rolled)
    count = np.where(words.count >= size, words.count - size + 1, np.minimum(words.count, 1))
    short = np.flatnonzero((words.count > 0) & (words.count < size))
    for d in short:  # their run must not reach into the next text
        a, b = words.first[d], words.first[d + 1]
        total = np.zeros(1, np.uint64)
        for i in range(b - a):
            total += h[a + i] * factor[i]
        rolled[a] = mix(total + np.uint64(b - a))[0]
    position = np.arange(n) - np.repeat(words.first[:-1], words.count)
    kept = position < np.repeat(count, words.count)
    return rolled[kept], np.concatenate([[0], np.cumsum(count)])


def signatures(hashes: np.ndarray, first: np.ndarray, n: int = VALUES) -> np.ndarray:
    """(documents, n) minima; all ones for a document without shingles."""
    some = np.flatnonzero(np.diff(first) > 0)
    out = np.full((len(first) - 1, n), 0xFFFFFFFF, np.uint32)
    if len(some):
        at = first[some]
        for k, f in enumerate(hash_factors(n)):
            out[some, k] = np.minimum.reduceat((hashes * f >> np.uint64(32)).astype(np.uint32), at)
    return out


_FEATURES = "doc_id bigint, text_key bigint, class_key bigint, n_shingles bigint, signature binary, nodes array<bigint>"


def prefix_nodes(sig: np.ndarray, trees: int, length: int) -> np.ndarray:
    """(documents, trees): the node of each label's prefix. No value is used twice, so the labels agree independently."""
    node = np.repeat(np.arange(trees, dtype=np.uint64)[None, :] * _FACTORS[1], len(sig), 0)
    for i in range(length):
        node = mix(node ^ sig[:, i * trees:(i + 1) * trees].astype(np.uint64) * _FACTORS[2 + i])
    return node


def _features(size: int, trees: int, length: int):
    n_values = max(VALUES, trees * length)

    def features(batches):
        schema = pa.schema([("doc_id", pa.int64()), ("text_key", pa.int64()), ("class_key", pa.int64()), ("n_shingles", pa.int64()),
                            ("signature", pa.binary()), ("nodes", pa.list_(pa.int64()))])
        for batch in batches:
            for piece in pieces(batch, "text", 1 << 20):
                hashes, first = word_shingles(piece["text"], size)
                sig = signatures(hashes, first, n_values)
                total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(hashes))])
                count = np.diff(first)
                key = mix(total[first[1:]] - total[first[:-1]] + count.astype(np.uint64) * _FACTORS[0]).view(np.int64)
                node = prefix_nodes(sig, trees, length)
                flat = pa.array(node.view(np.int64).ravel())
                ends = np.where(count > 0, trees, 0)  # a text without words is in no trie
                flat = flat.filter(pa.array(np.repeat(count > 0, trees)))
                small = sig[:, :VALUES].astype(np.uint8)
                yield pa.RecordBatch.from_arrays([
                    one_array(piece["doc_id"]), one_array(piece["text_key"]), pa.array(key), pa.array(count, pa.int64()),
                    pa.array([s.tobytes() for s in small], pa.binary()),
                    pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(ends)]), pa.int32()), flat)], schema=schema)
    return features


class _Bucket:
    """Leaders of one bucket, their signatures and which of them are joined already."""

    def __init__(self, key: int, signature: np.ndarray):
        self.keys, self.root, self.signatures = [key], [0], signature[None, :].copy()

    def add(self, key: int, signature: np.ndarray, root: int | None) -> None:
        n = len(self.keys)
        if n == len(self.signatures):
            self.signatures = np.concatenate([self.signatures, np.empty_like(self.signatures)])
        self.signatures[n] = signature
        self.keys.append(key)
        self.root.append(n if root is None else root)

    def find(self, i: int) -> int:
        while self.root[i] != i:
            i = self.root[i]
        return i


def _lead(threshold: float):
    link = link_limit(threshold)

    def lead(batches):
        """Rows (bucket, salt, class_key, signature) sorted by bucket and salt -> a spanning forest of the links to leaders, and
        the leaders (linked to themselves)."""
        schema = pa.schema([("bucket", pa.int64()), ("class_key", pa.int64()), ("leader", pa.int64())])
        current, held = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            bucket, salt, key = (batch.column(i).to_numpy() for i in range(3))
            sig = np.frombuffer(b"".join(batch.column(3).to_pylist()), np.uint8).reshape(-1, VALUES)
            head = np.concatenate([[True], (bucket[1:] != bucket[:-1]) | (salt[1:] != salt[:-1])])
            head[0] = current != (bucket[0], salt[0])
            run = np.cumsum(head) - 1  # -1: the bucket of the batch before
            begin = np.flatnonzero(head)
            # most members are close to the first leader of their bucket
            first = np.concatenate([[0], begin])[run + 1]
            first_key, first_sig = key[first], sig[first]
            if not head[0]:
                first_key[run < 0], first_sig[run < 0] = held.keys[0], held.signatures[0]
            estimate = (sig == first_sig).mean(axis=1)
            linked = np.flatnonzero((estimate >= link) & ~head)
            out = [(bucket[begin], key[begin], key[begin]), (bucket[linked], key[linked], first_key[linked])]
            more, at = [], -2
            for i in np.flatnonzero((estimate < _CLOSE) & ~head):
                if run[i] != at:
                    at = run[i]
                    held = _Bucket(key[begin[at]], sig[begin[at]]) if at >= 0 else held
                n = len(held.keys)
                every = (held.signatures[:n] == sig[i]).mean(axis=1)
                joined = list(dict.fromkeys(held.find(j) for j in np.flatnonzero(every >= link)))
                if joined and estimate[i] < link:
                    more.append((bucket[i], key[i], held.keys[joined[0]]))
                for j in joined[1:]:
                    more.append((bucket[i], held.keys[j], held.keys[joined[0]]))
                    held.root[j] = joined[0]
                if every.max() < _CLOSE:
                    held.add(key[i], sig[i], joined[0] if joined else None)
                    more.append((bucket[i], key[i], key[i]))
            if len(begin) and at != run[-1]:
                held = _Bucket(key[begin[-1]], sig[begin[-1]])
            current = (bucket[-1], salt[-1])
            columns = [np.concatenate([*(o[c] for o in out), np.array([m[c] for m in more], np.int64)]) for c in range(3)]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=schema)
    return lead


def _leaders(rows: DataFrame, threshold: float) -> DataFrame:
    """``rows``: bucket, salt, class_key, signature."""
    width = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.select("bucket", "salt", "class_key", "signature").repartition(width, "bucket", "salt").sortWithinPartitions("bucket", "salt", "class_key")
    return dealt.mapInArrow(_lead(threshold), "bucket bigint, class_key bigint, leader bigint")


def _compare(size: int, threshold: float):
    def compare(key, table):
        # a row of the table may have repeated rows beside it
        table = table.take(pa.array(np.unique(table["class_key"].to_numpy(), return_index=True)[1]))
        hashes, first = word_shingles(table["text"], size)
        component, keys, block, copies = (table[c].to_numpy() for c in ("component", "class_key", "block", "copies"))
        sets = [np.unique(hashes[a:b]) for a, b in zip(first[:-1], first[1:])]
        rows = {"class_key": [], "links": [], "near": [], "root": []}
        order = np.argsort(component, kind="stable")
        cuts = np.concatenate([np.flatnonzero(np.diff(component[order], prepend=component[order[0]] - 1)), [len(order)]])
        name = key[0].as_py().split("|")
        two_blocks = len(name) == 3 and name[1] != name[2]
        for i, j in zip(cuts[:-1], cuts[1:]):
            m = order[i:j]
            inner = intersections([sets[x] for x in m])
            n = np.array([len(sets[x]) for x in m], float)
            union = n[:, None] + n[None, :] - inner
            near = inner >= threshold * union - 1e-6
            np.fill_diagonal(near, False)
            if two_blocks:
                near &= block[m][:, None] != block[m][None, :]
            root = roots(near, keys[m])
            rows["class_key"].append(keys[m])
            rows["links"].append(near.sum(axis=1))
            rows["near"].append(near @ copies[m])
            rows["root"].append(root)
        return pa.table({c: np.concatenate(v).astype(np.int64) if v else np.zeros(0, np.int64) for c, v in rows.items()})
    return compare


def intersections(sets: list[np.ndarray], width: int = 4096) -> np.ndarray:
    """Sizes of all pairwise intersections, as products of 0/1 incidence matrices of ``width`` elements at a time."""
    m = len(sets)
    values, place = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(m), [len(s) for s in sets])
    order = np.argsort(place, kind="stable")
    place, owner = place[order], owner[order]
    out = np.zeros((m, m), np.float64)
    for low in range(0, len(values), width):
        a, b = np.searchsorted(place, [low, low + width])
        incidence = np.zeros((m, min(width, len(values) - low)), np.float32)
        incidence[owner[a:b], place[a:b] - low] = 1
        out += incidence @ incidence.T
    return out


def roots(near: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Smallest key of each node's component."""
    label = keys.copy()
    big = np.iinfo(np.int64).max
    while True:
        new = np.minimum(label, np.where(near, label[None, :], big).min(axis=1)) if len(keys) else label
        if (new == label).all():
            return label
        label = new


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = 5, threshold: float = 0.8, trees: int = 48,
                    recall: float = 0.9999) -> DataFrame:
    """Per row: doc_id, text_key, class_id (smallest id with the same shingles), class_size, n_links (other classes with a
    Jaccard similarity of ``threshold`` or more), n_near (other rows: copies and rows of linked classes), group_id (smallest
    id of the rows joined by links, directly or not) and group_key (one value per group).

    Shingles are runs of ``size`` words between white space, after lower-casing A-Z; a text of fewer words is one shingle.
    Null and texts without words form one class that links to nothing. Ids are null only where no row has one. Repeated
    rows each give a row. Other columns are ignored. No rows, no result rows.
    """
    length = prefix_length(threshold, trees, recall)
    base = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.xxhash64(F.col(text)).alias("text_key"), F.col(text).alias("text"))
    rows = cut_lineage(base.mapInArrow(_features(size, trees, length), _FEATURES))
    classes = rows.groupBy("class_key").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")).alias("first"), F.count(F.lit(1)).alias("copies"),
                                            F.first("signature").alias("signature"), F.first("nodes").alias("nodes"))
    classes = cut_lineage(classes)
    leaves = classes.select("class_key", F.explode("nodes").alias("bucket"))
    shared = leaves.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    members = leaves.join(shared, "bucket").join(classes.select("class_key", "signature"), "class_key")
    salts = F.ceil(F.col("n") / BUCKET_ROWS).cast("bigint")
    members = members.withColumn("salt", F.when(salts > 1, F.pmod(F.xxhash64("class_key"), salts) + 1).otherwise(F.lit(0)).cast("bigint"))
    found = cut_lineage(_leaders(members, threshold))
    # a large bucket was cut by salts: whatever its parts have, its leaders are joined to one of them
    many = shared.where(F.col("n") > BUCKET_ROWS).select("bucket")
    leaders = found.where("class_key = leader").join(many, "bucket")
    least = leaders.groupBy("bucket").agg(F.min("leader").alias("least"))
    links = found.where("class_key <> leader").select("class_key", "leader").unionAll(leaders.join(least, "bucket").select("class_key", F.col("least").alias("leader")))
    near = cut_lineage(components(links, "class_key", "leader"))
    # exact comparison inside each component, block pair by block pair
    sizes = near.groupBy("root").agg(F.count(F.lit(1)).alias("n"))
    held = near.join(sizes, "root").join(classes.select(F.col("class_key").alias("node"), "first", "copies"), "node")
    blocks = F.ceil(F.col("n") / BLOCK_ROWS).cast("int")
    held = held.withColumns({"blocks": blocks, "block": F.pmod(F.xxhash64("node"), blocks).cast("int")})
    held = held.select(F.col("node").alias("class_key"), F.col("root").alias("component"), "blocks", "block", "copies",
                       *_row_key(F.col("first.doc_id")), F.col("first.text_key").alias("text_key"))
    texts = held.join(base.select(*_row_key(F.col("doc_id")), "text_key", "text"), ["id_or_0", "no_id", "text_key"])
    pair = texts.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cell = F.when(F.col("blocks") == 1, F.concat(F.lit("s"), F.pmod(F.xxhash64("component"), F.lit(_cells(near))))).otherwise(
        F.concat_ws("|", "component", F.least("block", "other"), F.greatest("block", "other")))
    verified = pair.select(cell.alias("cell"), "class_key", "component", "block", "copies", "text").groupBy("cell").applyInArrow(
        _compare(size, threshold), "class_key bigint, links bigint, near bigint, root bigint")
    verified = cut_lineage(verified)
    degree = verified.groupBy("class_key").agg(F.sum("links").alias("links"), F.sum("near").alias("near"))
    group = components(verified, "class_key", "root")
    of_class = classes.select("class_key", "copies", F.col("first.doc_id").alias("class_id")).join(degree, "class_key", "left").join(
        group.withColumnRenamed("node", "class_key"), "class_key", "left").withColumn("group_key", F.coalesce("root", "class_key"))
    least = of_class.where("root IS NOT NULL").groupBy("group_key").agg(F.min("class_id").alias("group_id"))
    of_class = of_class.join(least, "group_key", "left")
    out = rows.select("doc_id", "text_key", "class_key").join(of_class, "class_key")
    links, near = F.coalesce("links", F.lit(0)), F.coalesce("near", F.lit(0))
    return out.select("doc_id", "text_key", "class_id", F.col("copies").alias("class_size"), links.alias("n_links"),
                      (near + F.col("copies") - 1).alias("n_near"), F.coalesce("group_id", "class_id").alias("group_id"), "group_key")


def _row_key(own: Column) -> list[Column]:
    return [F.coalesce(own, F.lit(0)).alias("id_or_0"), own.isNull().alias("no_id")]


def _cells(near: DataFrame) -> int:
    """Tasks for the small components: about 200 classes each."""
    return max(1, math.ceil(near.count() / 200))


def one_per_group(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The row with the smallest id of each group of near duplicates, with all its columns."""
    marks = near_duplicates(docs, doc_id, text, **options)
    stays = marks.groupBy("group_key").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")).alias("first"))
    stays = stays.select(*_row_key(F.col("first.doc_id")), F.col("first.text_key").alias("text_key"))
    key = ["id_or_0", "no_id", "text_key"]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *_row_key(F.col(doc_id).cast("bigint")), F.xxhash64(F.col(text)).alias("text_key"))
    turn = F.row_number().over(W.partitionBy(*key).orderBy(F.xxhash64("row")))
    return rows.join(stays, key, "left_semi").withColumn("turn", turn).where("turn = 1").select("row.*")
