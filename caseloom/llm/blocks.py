"""Documents dealt into blocks of bounded size, and bytes removed from them, for the two passage deduplicators."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseloom.llm.arrays import RangeHash, flat_text, id_array, one_array

BLOCK_BYTES = 4 << 20


def text_bytes(docs: DataFrame, text: str) -> int:
    """Bytes of all texts."""
    return int(docs.agg(F.sum(F.octet_length(F.col(text)).cast("bigint"))).first()[0] or 0)


def dealt(docs: DataFrame, doc_id: str, text: str, total: int, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(block, doc_id, text): a block is set by a hash of the row, so every pass and every retry sees the same blocks."""
    blocks = max(1, math.ceil(total / block_bytes))
    return docs.select(F.pmod(F.xxhash64(F.col(doc_id), F.col(text)), F.lit(blocks)).cast("int").alias("block"),
                       F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))


class Block:
    """One block in canonical row order: by doc_id (missing last), then by text."""

    def __init__(self, table: pa.Table):
        ids = id_array(table["doc_id"])
        data, offsets = flat_text(table["text"])
        text_hash = RangeHash(data).of(offsets[:-1], offsets[1:])
        order = np.lexsort((text_hash, ids))
        self.doc_id = pc.take(one_array(table["doc_id"]), pa.array(order))
        self.ids = ids[order]
        self.data, self.offsets = flat_text(pc.take(one_array(pc.fill_null(table["text"], "")).cast(pa.large_string()), pa.array(order)))


def representatives(key: np.ndarray, order_by: tuple[np.ndarray, ...], same) -> np.ndarray:
    """For each string the first equal one (by ``order_by``, most significant last). ``same(a, b)`` compares the strings
    themselves, so that strings that only share a hash stay apart."""
    n = len(key)
    if not n:
        return np.zeros(0, np.int64)
    order = np.lexsort((*order_by, key))
    head = np.concatenate([[True], key[order][1:] != key[order][:-1]])
    rep = np.empty(n, np.int64)
    rep[order] = order[np.flatnonzero(head)][np.cumsum(head) - 1]
    other = np.flatnonzero(rep != np.arange(n))
    apart = other[~same(other, rep[other])]
    rep[apart] = apart
    return rep
