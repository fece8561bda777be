"""Exact duplicates by counting quotient filters.

Each partition builds a counting quotient filter of its text fingerprints: a fingerprint is split into a quotient (its
run) and a remainder, runs hold sorted remainders with counts. Nothing is hashed away, so filters merge losslessly by
merging sorted remainders; a quotient range per task. Only fingerprints with a merged count above one can belong to
duplicates, and only their rows are routed, by a bit map of these fingerprints, to the comparison of bytes; no other text is
shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from caseloom.llm.arrays import pack, unpack
from caseloom.session import cut_lineage, shared_dir

FINGERPRINTS_PER_RANGE = 500_000
FINGERPRINTS_PER_FILTER = 2_000_000
#: the map of repeated fingerprints has 2 ** MOST_BITS bits at most: a million words of 64
MOST_BITS = 26
_LOW = np.uint64(0xFFFFFFFF)
_KINDS = (np.uint32, np.uint32, np.uint32, np.uint64)


class QuotientFilter:
    """Occupied quotients with their run lengths, and per slot a remainder (sorted in its run) with its count."""

    def __init__(self, quotient: np.ndarray, run: np.ndarray, remainder: np.ndarray, count: np.ndarray):
        self.quotient, self.run, self.remainder, self.count = quotient, run, remainder, count

    @classmethod
    def of(cls, fingerprints: np.ndarray, counts: np.ndarray | None = None) -> QuotientFilter:
        order = np.argsort(fingerprints, kind="stable")
        ranked = fingerprints[order]
        head = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]])) if len(ranked) else np.zeros(0, np.int64)
        if counts is None:
            count = np.diff(head, append=len(ranked)).astype(np.uint64)
        else:
            count = np.add.reduceat(counts[order], head) if len(head) else np.zeros(0, np.uint64)
        kept = ranked[head]
        quotient, run = np.unique((kept >> np.uint64(32)).astype(np.uint32), return_counts=True)
        return cls(quotient, run.astype(np.uint32), (kept & _LOW).astype(np.uint32), count)

    def fingerprints(self) -> np.ndarray:
        return np.repeat(self.quotient.astype(np.uint64) << np.uint64(32), self.run) | self.remainder

    @classmethod
    def merged(cls, filters: list[QuotientFilter]) -> QuotientFilter:
        return cls.of(np.concatenate([f.fingerprints() for f in filters]), np.concatenate([f.count for f in filters]))

    def ranges(self, parts: int) -> Iterator[tuple[int, QuotientFilter]]:
        """Cuts the filter at quotient bounds into the ranges it touches."""
        part = self.quotient.astype(np.int64) * parts >> 32
        cuts = np.concatenate([np.flatnonzero(np.diff(part, prepend=-1)), [len(part)]])
        slot = np.concatenate([[0], np.cumsum(self.run)]).astype(np.int64)
        for i, j in zip(cuts[:-1], cuts[1:]):
            yield int(part[i]), QuotientFilter(self.quotient[i:j], self.run[i:j], self.remainder[slot[i]:slot[j]], self.count[slot[i]:slot[j]])

    def pack(self) -> bytes:
        return pack(self.quotient, self.run, self.remainder, self.count)

    @classmethod
    def unpack(cls, blob: bytes) -> QuotientFilter:
        return cls(*unpack(blob, *_KINDS))


def _build(parts: int):
    def build(batches):
        held, size = [], 0

        def flush():
            rows = list(QuotientFilter.of(np.concatenate(held)).ranges(parts)) if held else []
            return pa.RecordBatch.from_pydict({"part": [p for p, _ in rows], "filter": [f.pack() for _, f in rows]},
                                              schema=pa.schema([("part", pa.int32()), ("filter", pa.binary())]))
        for batch in batches:
            held.append(batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64))
            size += len(held[-1])
            if size >= FINGERPRINTS_PER_FILTER:
                yield flush()
                held, size = [], 0
        yield flush()
    return build


def _merge(key, table):
    whole = QuotientFilter.merged([QuotientFilter.unpack(b) for b in table["filter"].to_pylist()])
    return pa.table({"fingerprint": pa.array(whole.fingerprints()[whole.count > 1].view(np.int64))})


def normalised(text: Column) -> Column:
    """Lower-cases A-Z and nothing else; null is empty."""
    return F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def repeated_fingerprints(fingerprints: DataFrame) -> DataFrame:
    """Fingerprints (one bigint column without nulls) that stand in more than one row."""
    parts = max(1, math.ceil(fingerprints.count() / FINGERPRINTS_PER_RANGE))
    filters = fingerprints.mapInArrow(_build(parts), "part int, filter binary")
    return filters.groupBy("part").applyInArrow(_merge, "fingerprint bigint")


def marked(rows: DataFrame, repeated: DataFrame) -> DataFrame:
    """Adds ``marked`` to rows with a ``fingerprint``: true for every repeated fingerprint, and for few others.

    The repeated fingerprints set bits of a map of about 16 bits each, ``MOST_BITS`` at most; its words, a bounded number, are
    broadcast. Beyond that bound the map lets more rows through, which the comparison of texts sorts out.
    """
    bits = 1 << min(MOST_BITS, max(10, (16 * repeated.count()).bit_length()))
    place = F.pmod("fingerprint", F.lit(bits))
    words = repeated.select(F.shiftright(place, 6).alias("word"), F.expr("shiftleft(1L, cast(pmod(fingerprint, 64) as int))").alias("bit"))
    words = words.groupBy("word").agg(F.bit_or("bit").alias("set"))
    found = rows.join(F.broadcast(words), F.shiftright(place, 6) == F.col("word"), "left")
    hit = F.expr("shiftright(set, cast(pmod(fingerprint, 64) as int)) & 1") == 1
    return found.withColumn("marked", F.coalesce(hit, F.lit(False))).drop("word", "set")


def _repeated(docs: DataFrame, text: str) -> DataFrame:
    """The repeated fingerprints of the texts, written: they are read several times."""
    return cut_lineage(repeated_fingerprints(docs.select(F.xxhash64(normalised(F.col(text))).alias("fingerprint"))))


def duplicate_groups(docs: DataFrame, repeated: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per text that stands in several rows: text_sha256, keep_id (largest id, null if none has one), group_size.

    Only rows that the filters mark are shuffled; copies are added up before, so a task sends each text once.
    """
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), normalised(F.col(text)).alias("text"))
    routed = marked(rows.withColumn("fingerprint", F.xxhash64("text")), repeated).where("marked")
    groups = routed.groupBy("text").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    return groups.where("group_size > 1").select(F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"), "keep_id", "group_size")


def exact_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, keep_id, group_size, kept, text_sha256; texts are equal when identical after lower-casing A-Z.

    Of equal texts the row with the largest id stays; a null id is smaller than all others. Rows that repeat the id that
    stays are told apart by their order, so exactly one of them is kept. Null and empty texts are one group. Other
    columns are ignored. No rows, no result rows.
    """
    turn = F.row_number().over(W.partitionBy("doc_id", "text_sha256").orderBy(F.lit(0)))
    low = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), normalised(F.col(text)).alias("text"))
    path = shared_dir(docs.sparkSession, "text-digests")
    low.select("doc_id", F.xxhash64("text").alias("fingerprint"), F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256")).write.parquet(path)
    slim = docs.sparkSession.read.parquet(path)
    repeated = cut_lineage(repeated_fingerprints(slim.select("fingerprint")))
    joined = slim.drop("fingerprint").withColumn("turn", turn).join(duplicate_groups(docs, repeated, doc_id, text), "text_sha256", "left")
    keep = F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return joined.select(
        "doc_id", keep.alias("keep_id"), F.coalesce("group_size", F.lit(1)).cast("bigint").alias("group_size"),
        (F.col("doc_id").eqNullSafe(keep) & (F.col("turn") == 1)).alias("kept"), "text_sha256")


def without_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``exact_duplicates`` keeps, with all their columns (one of several rows that repeat an id).

    Null and empty texts are one group, and a null id is smaller than all others. Rows that the filters do not mark stay where
    they are; of the others a task sends each text once, with its largest id. An empty table stays empty.
    """
    names = docs.columns
    inner = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.col(f"`{doc_id}`").cast("bigint").alias("id"), normalised(F.col(text)).alias("low"))
    rows = marked(inner.withColumn("fingerprint", F.xxhash64("low")), _repeated(docs, text))
    first = F.row_number().over(W.partitionBy("low").orderBy(F.desc_nulls_last("id"), F.xxhash64("row")))
    routed = rows.where("marked").withColumn("turn", first).where("turn = 1")
    return rows.where("NOT marked").select("row.*").unionAll(routed.select("row.*"))
