"""Toxicity categories by a classifier chain.

Categories are predicted one after the other; each model is linear in cues (words and word beginnings of the text) and in
the probabilities of the categories before it. For training those probabilities are predicted out of fold, so a later
model sees errors like those it will meet. Cues are chosen by their log-odds in a bounded sample of labelled rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseloom.llm.arrays import RangeHash, Words, byte_class, flat_text, pieces
from caseloom.llm.ordinal import LOWER, sample_texts, sampled, sigmoid

WORD = byte_class([(0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)])
CUES = 2_000
LEAST_ROWS = 5
LEAST_ODDS = 2.0
FOLDS = 5
POSITIVE_ROWS, OTHER_ROWS = 4_000, 8_000
CATEGORIES = ("toxic", "insistent", "dense")


def cue_hashes(column) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, hash, words per document): every word in lower case, and its first four and five bytes."""
    data, offsets = flat_text(column)
    data = LOWER[data]
    words = Words(data, offsets, WORD)
    h = RangeHash(data)
    doc = words.document()
    parts = [h.of(words.start, words.end)]
    for size in (4, 5):
        parts.append(h.of(words.start, np.minimum(words.end, words.start + size)) + np.uint64(size))
    return np.tile(doc, 3), np.concatenate(parts), words.count


@dataclass
class Chain:
    """Sorted cue hashes, and per category the weights of cues, of the earlier probabilities and of the constant."""

    cues: np.ndarray
    weights: np.ndarray  # (categories, cues)
    earlier: np.ndarray  # (categories, categories)
    constant: np.ndarray

    def find(self, column) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(document, cue, occurrences, words per document) of the cues in each text."""
        doc, h, count = cue_hashes(column)
        if not len(self.cues):
            return doc[:0], doc[:0], doc[:0], count
        marks = np.zeros(1 << 20, bool)
        marks[(self.cues >> np.uint64(44)).astype(np.int64)] = True
        some = np.flatnonzero(marks[(h >> np.uint64(44)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.cues, h[some]), len(self.cues) - 1)
        hit = self.cues[at] == h[some]
        cell, times = np.unique(doc[some[hit]] * len(self.cues) + at[hit], return_counts=True)
        return cell // len(self.cues), cell % len(self.cues), times, count

    def probabilities(self, column) -> np.ndarray:
        doc, cue, _, count = self.find(column)
        out = np.zeros((len(count), len(self.constant)))
        for c in range(len(self.constant)):
            score = self.constant[c] + np.bincount(doc, self.weights[c][cue], minlength=len(count)) + out @ self.earlier[c]
            out[:, c] = sigmoid(score)
        return out


def fit_linear(doc, cue, dense: np.ndarray, y: np.ndarray, cues: int, steps: int = 150, penalty: float = 1e-3) -> tuple[np.ndarray, np.ndarray, float]:
    """Logistic regression on sparse 0/1 cues and a few dense columns; returns weights of both and the constant."""
    n = max(1, len(y))
    w, v, b = np.zeros(cues), np.zeros(dense.shape[1]), float(np.log((y.sum() + 0.5) / (n - y.sum() + 0.5)))
    mw, mv, mb = np.full(cues, 1e-6), np.full(len(v), 1e-4), 1e-4
    for _ in range(steps):
        score = b + np.bincount(doc, w[cue], minlength=len(y)) + dense @ v
        error = y - sigmoid(score)
        gw = np.bincount(cue, error[doc], minlength=cues) / n - penalty * w
        gv = dense.T @ error / n - penalty * v
        gb = error.sum() / n
        mw += gw ** 2
        mv += gv ** 2
        mb += gb ** 2
        w += 0.5 * gw / np.sqrt(mw)
        v += 0.5 * gv / np.sqrt(mv)
        b += 0.5 * gb / np.sqrt(mb)
    return w, v, b


def fit_chain(cues: np.ndarray, doc: np.ndarray, cue: np.ndarray, labels: np.ndarray, fold: np.ndarray) -> Chain:
    """``labels``: (rows, categories) of 0 and 1. The earlier categories' columns hold out-of-fold probabilities."""
    n, k = labels.shape
    weights, earlier, constant = np.zeros((k, len(cues))), np.zeros((k, k)), np.zeros(k)
    seen = np.zeros((n, k))
    for c in range(k):
        dense = seen[:, :c]
        weights[c], earlier[c, :c], constant[c] = fit_linear(doc, cue, dense, labels[:, c], len(cues))
        for f in range(FOLDS):
            inside = fold != f
            new = np.cumsum(inside) - 1
            part = inside[doc]
            w, v, b = fit_linear(new[doc[part]], cue[part], dense[inside], labels[inside, c], len(cues))
            score = b + np.bincount(doc, w[cue], minlength=n) + dense @ v
            seen[~inside, c] = sigmoid(score[~inside])
    return Chain(cues, weights, earlier, constant)


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", doc_id: str = "doc_id", text: str = "text", cues: int = CUES,
          positive_rows: int = POSITIVE_ROWS, other_rows: int = OTHER_ROWS) -> Chain:
    """Fits the chain on at most ``positive_rows`` toxic and ``other_rows`` other labelled ids, chosen by a hash of the id, with one
    text each, however often an id stands in ``docs``. An id with several labels is toxic if one of them says so.

    The label says whether a text is toxic. The further categories grade toxic texts by their cues: ``insistent`` has three
    occurrences or more of words with a cue, ``dense`` one in a hundred words or more. Rows without a label or id are left
    out. Without rows of both kinds every probability is 0.
    """
    known = labels.select(F.col(doc_id).cast("bigint").alias("label_id"), F.col(label).cast("int").alias("toxic")).where("label_id IS NOT NULL AND toxic IN (0, 1)")
    known = known.groupBy("label_id").agg(F.max("toxic").alias("toxic"))
    chosen = sampled(known.where("toxic = 1"), positive_rows).unionAll(sampled(known.where("toxic = 0"), other_rows))
    rows = sample_texts(docs, chosen, doc_id, text).select(
        "toxic", F.pmod(F.xxhash64("label_id"), F.lit(FOLDS)).cast("int").alias("fold"), "text")

    def tally(batches):
        for batch in batches:
            for piece in pieces(batch, "text"):
                toxic = piece["toxic"].to_numpy()
                doc, h, _ = cue_hashes(piece["text"])
                pair = np.unique(np.stack([doc.astype(np.uint64), h]), axis=1) if len(doc) else np.zeros((2, 0), np.uint64)
                yes = toxic[pair[0].astype(np.int64)] == 1
                values, inverse = np.unique(pair[1], return_inverse=True)
                yield pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(np.bincount(inverse, yes, len(values)).astype(np.int64)),
                                                  pa.array(np.bincount(inverse, ~yes, len(values)).astype(np.int64))], names=["hash", "yes", "no"])
    kinds = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    yes, no = kinds.get(1, 0), kinds.get(0, 0)
    if not yes or not no:
        k = len(CATEGORIES)
        return Chain(np.zeros(0, np.uint64), np.zeros((k, 0)), np.zeros((k, k)), np.full(k, -40.0))
    counts = rows.mapInArrow(tally, "hash bigint, yes bigint, no bigint").groupBy("hash").agg(F.sum("yes").alias("yes"), F.sum("no").alias("no"))
    odds = F.log((F.col("yes") + 0.5) / (yes + 1)) - F.log((F.col("no") + 0.5) / (no + 1))
    best = counts.where(F.col("yes") + F.col("no") >= LEAST_ROWS).withColumn("odds", odds).where(F.abs("odds") >= LEAST_ODDS)
    strength = F.abs("odds") * F.sqrt(F.col("yes") + F.col("no"))
    picked = best.orderBy(strength.desc(), "hash").limit(cues).select("hash", "odds").collect()
    picked = sorted((r["hash"] & (1 << 64) - 1, r["odds"]) for r in picked)
    table = np.array([p[0] for p in picked], np.uint64)
    toxic_cue = np.array([p[1] > 0 for p in picked], bool)
    empty = Chain(table, np.zeros((0, len(table))), np.zeros((0, 0)), np.zeros(0))

    def featurise(batches):
        for batch in batches:
            for piece in pieces(batch, "text"):
                doc, cue, times, count = empty.find(piece["text"])
                ends = pa.array(np.searchsorted(doc, np.arange(piece.num_rows + 1)), pa.int32())
                yield pa.RecordBatch.from_arrays([
                    *(pa.array(piece[c].to_pylist(), pa.int32()) for c in ("toxic", "fold")), pa.array(count, pa.int64()),
                    pa.ListArray.from_arrays(ends, pa.array(cue, pa.int32())), pa.ListArray.from_arrays(ends, pa.array(times, pa.int32()))],
                    names=["toxic", "fold", "words", "cue", "times"])
    got = rows.mapInArrow(featurise, "toxic int, fold int, words bigint, cue array<int>, times array<int>").orderBy("fold", "toxic", "words", "cue").toArrow()
    size = np.array([len(x) for x in got["cue"]], np.int64)
    flat = lambda c: np.concatenate([np.zeros(0, np.int32), *[x.values.to_numpy() for x in got[c]]]).astype(np.int64)
    doc, cue, times = np.repeat(np.arange(len(size)), size), flat("cue"), flat("times")
    toxic = got["toxic"].to_numpy().astype(float)
    hits = np.bincount(doc, times * toxic_cue[cue], minlength=len(size)) / 3  # a word and its two beginnings
    words = np.maximum(1, got["words"].to_numpy())
    labelled = np.stack([toxic, toxic * (hits >= 3), toxic * (hits >= words / 100)], axis=1)
    return fit_chain(table, doc, cue, labelled, got["fold"].to_numpy())


def scored(docs: DataFrame, chain: Chain, doc_id: str = "doc_id", text: str = "text", least: float = 0.5) -> DataFrame:
    """Per row: doc_id, a probability per category, and toxic (the first one is at least ``least``).

    The whole text counts. Null and empty texts have no cues and get the constant's probability. Repeated rows each give a
    row; other columns are ignored; no rows, no result rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(chain)  # at most ``cues`` cues

    def score(batches):
        for batch in batches:
            for piece in pieces(batch, "text"):
                p = shared.value.probabilities(piece["text"])
                yield pa.RecordBatch.from_arrays([piece["doc_id"].combine_chunks(), *(pa.array(p[:, c].copy()) for c in range(p.shape[1])), pa.array(p[:, 0] >= least)],
                                                 names=["doc_id", *(f"p_{c}" for c in CATEGORIES), "toxic"])
    return docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        score, "doc_id bigint, " + ", ".join(f"p_{c} double" for c in CATEGORIES) + ", toxic boolean")
