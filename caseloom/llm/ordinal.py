"""Quality grades by ordinal cumulative-link regression on hashed text.

P(grade <= k) = sigmoid(threshold_k - w x): one weight vector over hashed words, word ends and shapes is shared by all
grades, thresholds are ordered. It is fitted on a bounded sample of graded rows and scores every row: expected grade and
tail probability P(grade >= wanted), which selects.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from caseloom.llm.arrays import RangeHash, Words, byte_class, flat_text, pieces

WORD = byte_class([(0x20, 0x20), (0x09, 0x0D)], inside=False)
WEIGHT_BITS = 16
SAMPLE_ROWS = 6_000
STEPS = 120
#: letters and digits by class, so that a word's shape shows; other signs as they are
SHAPE = np.arange(256, dtype=np.uint8)
SHAPE[65:91], SHAPE[97:123], SHAPE[48:58], SHAPE[128:] = 65, 97, 48, 97
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def hashed(column) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, feature, value): shares of the words of a text that have a feature; the features of a word are itself in
    lower case, its last three signs by class, its first sign by class, and whether it repeats the word before."""
    data, offsets = flat_text(column)
    words = Words(data, offsets, WORD)
    n = len(words.start)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    doc = words.document()
    plain, shape = RangeHash(LOWER[data]), RangeHash(SHAPE[data])
    own = plain.of(words.start, words.end)
    again = np.zeros(n, np.uint64)
    again[1:] = (own[1:] == own[:-1]) & (doc[1:] == doc[:-1])
    kinds = [own, shape.of(np.maximum(words.start, words.end - 3), words.end) + np.uint64(1), shape.of(words.start, words.start + 1) + np.uint64(2),
             again * np.uint64(0x9E3779B97F4A7C15) + np.uint64(3)]
    size = 1 << WEIGHT_BITS
    cell = np.concatenate([doc * size + (k >> np.uint64(64 - WEIGHT_BITS)).astype(np.int64) for k in kinds])
    cell, times = np.unique(cell, return_counts=True)
    return cell // size, cell % size, times / words.count[cell // size]


@dataclass
class Ordinal:
    """Fitted weights and ordered thresholds."""

    weights: np.ndarray
    thresholds: np.ndarray

    def tails(self, column) -> np.ndarray:
        """P(grade >= k) for k = 1 .. grades - 1, a row per text."""
        doc, feature, value = hashed(column)
        score = np.bincount(doc, self.weights[feature] * value, minlength=len(column))
        return sigmoid(score[:, None] - self.thresholds[None, :])


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit(doc: np.ndarray, feature: np.ndarray, value: np.ndarray, grade: np.ndarray, grades: int, penalty: float = 1e-4, steps: int = STEPS, rate: float = 0.5) -> Ordinal:
    """Maximum likelihood by adaptive gradient steps. Thresholds stay ordered: each is the one before plus a positive gap."""
    n = max(1, len(grade))
    w = np.zeros(1 << WEIGHT_BITS)
    share = np.cumsum(np.bincount(grade, minlength=grades))[:-1] + 0.5
    first = np.log(share / (n + 1 - share))
    raw = np.concatenate([first[:1], np.log(np.maximum(np.diff(first), 0.05))])
    at = lambda r: r[0] + np.concatenate([[0.0], np.cumsum(np.exp(r[1:]))])
    if not len(grade) or grades < 2 or len(np.unique(grade)) < 2:
        return Ordinal(w, np.full(max(1, grades - 1), -40.0))  # nothing to learn from: every text has the highest grade
    moment_w, moment_r = np.full_like(w, 1e-6), np.full_like(raw, 1e-2)
    for _ in range(steps):
        edge = np.concatenate([[-np.inf], at(raw), [np.inf]])
        score = np.bincount(doc, w[feature] * value, minlength=n)
        low, high = edge[grade] - score, edge[grade + 1] - score
        f_low, f_high = sigmoid(low), sigmoid(high)
        p = np.maximum(f_high - f_low, 1e-9)
        slope = f_high + f_low - 1  # of the log likelihood by the score
        g_w = np.bincount(feature, slope[doc] * value, minlength=len(w)) / n - penalty * w
        g_edge = np.zeros(grades + 1)
        np.add.at(g_edge, grade + 1, f_high * (1 - f_high) / p)
        np.add.at(g_edge, grade, -f_low * (1 - f_low) / p)
        g_t = g_edge[1:-1] / n
        g_r = np.array([g_t.sum(), *(g_t[k:].sum() * np.exp(raw[k]) for k in range(1, len(raw)))])
        moment_w += g_w ** 2
        moment_r += g_r ** 2
        w += rate * 4 * g_w / np.sqrt(moment_w)
        raw += rate * g_r / np.sqrt(moment_r)
    return Ordinal(w, at(raw))


def sampled(labels: DataFrame, rows: int, *order) -> DataFrame:
    """At most ``rows`` rows, chosen by a hash of the id."""
    return labels.orderBy(*order, F.xxhash64("label_id"), "label_id").limit(rows)


def sample_texts(docs: DataFrame, chosen: DataFrame, doc_id: str, text: str) -> DataFrame:
    """The sampled labels (label_id is unique) with one text each: of several rows with an id that of the least hash, so there are
    never more texts than labels. A task sends one row of an id at most."""
    rows = docs.select(F.col(doc_id).cast("bigint").alias("label_id"), F.col(text).alias("text")).join(F.broadcast(chosen), "label_id")
    first = F.row_number().over(W.partitionBy("label_id").orderBy(F.xxhash64("text"), "text"))
    return rows.withColumn("turn", first).where("turn = 1").drop("turn")


def train(docs: DataFrame, graded: DataFrame, grades: int, doc_id: str = "doc_id", text: str = "text", sample_rows: int = SAMPLE_ROWS) -> Ordinal:
    """``graded`` has label_id and grade (0 .. grades - 1); rows without either are left out, and an id with several grades has the
    least. At most ``sample_rows`` of them, chosen by a hash of the id, meet one text each, however often an id stands in ``docs``;
    only hashed features come to the driver, at most 2**16 a text."""
    known = graded.where("label_id IS NOT NULL AND grade IS NOT NULL").groupBy("label_id").agg(F.min("grade").alias("grade"))
    rows = sample_texts(docs, sampled(known, sample_rows), doc_id, text).select("grade", "text")

    def featurise(batches):
        for batch in batches:
            for piece in pieces(batch, "text"):
                doc, feature, value = hashed(piece["text"])
                ends = np.searchsorted(doc, np.arange(piece.num_rows + 1))
                yield pa.RecordBatch.from_arrays([
                    pa.array(piece["grade"].to_pylist(), pa.int32()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(feature, pa.int32())),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(value, pa.float32()))], names=["grade", "feature", "value"])
    got = rows.selectExpr("cast(grade AS int) AS grade", "text").mapInArrow(featurise, "grade int, feature array<int>, value array<float>").toArrow()
    order = np.lexsort(([hash(tuple(f.as_py()[:8])) for f in got["feature"]], [len(f) for f in got["feature"]], got["grade"].to_numpy())) if got.num_rows else np.zeros(0, np.int64)
    got = got.take(pa.array(order, pa.int64()))  # the order of tasks must not show in rounding
    size = np.array([len(x) for x in got["feature"]], np.int64)
    flat = lambda c: np.concatenate([np.zeros(0), *[x.values.to_numpy() for x in got[c]]])
    return fit(np.repeat(np.arange(len(size)), size), flat("feature").astype(np.int64), flat("value").astype(float), got["grade"].to_numpy().astype(np.int64), grades)


def graded(docs: DataFrame, model: Ordinal, doc_id: str = "doc_id", text: str = "text", wanted: int = 1, least: float = 0.5) -> DataFrame:
    """Per row: doc_id, expected_grade, tail (P(grade >= wanted)), p_top (probability of the highest grade), selected.

    Null and empty texts have no words and score 0. Repeated rows each give a row; other columns are ignored; no rows, no
    result rows. A model from no labels, or from one grade only, selects everything.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model.weights.astype(np.float32), model.thresholds))  # 2**16 weights

    def score(batches):
        held = Ordinal(*shared.value)
        for batch in batches:
            for piece in pieces(batch, "text"):
                tails = held.tails(piece["text"])
                ids = piece["doc_id"].combine_chunks()
                yield pa.RecordBatch.from_arrays([ids, pa.array(tails.sum(axis=1)), pa.array(tails[:, wanted - 1]), pa.array(tails[:, -1]),
                                                  pa.array(tails[:, wanted - 1] >= least)], names=["doc_id", "expected_grade", "tail", "p_top", "selected"])
    return docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        score, "doc_id bigint, expected_grade double, tail double, p_top double, selected boolean")


def selected(docs: DataFrame, model: Ordinal, text: str = "text", wanted: int = 1, least: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose tail probability is at least ``least``, with all their columns and without a shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast((model.weights.astype(np.float32), model.thresholds))
    place = docs.columns.index(text)

    def keep(batches):
        held = Ordinal(*shared.value)
        for batch in batches:
            table = pa.Table.from_batches([batch]).rename_columns([str(i) for i in range(batch.num_columns)])
            for piece in pieces(table, str(place)):
                good = held.tails(piece[str(place)])[:, wanted - 1] >= least
                yield from piece.filter(pa.array(good)).rename_columns(batch.schema.names).to_batches()
    return docs.mapInArrow(keep, docs.schema)


def quality_grades(labels: DataFrame) -> DataFrame:
    """The grades of the labels table: 0 low quality, 1 good but toxic, 2 good and clean."""
    grade = F.when(F.col("quality") == 0, 0).when((F.col("quality") == 1) & (F.col("toxic") == 1), 1).when((F.col("quality") == 1) & (F.col("toxic") == 0), 2)
    return labels.select(F.col("doc_id").cast("bigint").alias("label_id"), grade.alias("grade"))
