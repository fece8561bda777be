"""The two classifiers: held-out accuracy, gradients, odd rows."""

from __future__ import annotations

import numpy as np
import pytest
from llm_cases import ODD
from pyspark.sql import functions as F

from caseloom.llm import ordinal, queries, toxicity

SF = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def tables(spark):
    return queries.table(spark, SF, "documents"), queries.table(spark, SF, "labels")


def test_quality_on_held_out_rows(tables):
    docs, labels = tables
    grades = ordinal.quality_grades(labels)
    model = ordinal.train(docs, grades.where("label_id % 3 > 0"), 3)
    assert (np.diff(model.thresholds) > 0).all()
    got = ordinal.graded(docs, model).join(grades.where("label_id % 3 = 0"), F.col("doc_id") == F.col("label_id"))
    by = {r.grade: r for r in got.groupBy("grade").agg(F.avg(F.col("selected").cast("int")).alias("kept"), F.avg("expected_grade").alias("e")).collect()}
    assert by[0].kept < 0.03 and by[1].kept > 0.97 and by[2].kept > 0.99 and by[0].e < by[1].e


def test_toxicity_on_held_out_rows(tables):
    docs, labels = tables
    chain = toxicity.train(docs, labels.where("doc_id % 3 > 0"))
    got = toxicity.scored(docs, chain).join(labels.where("doc_id % 3 = 0").select("doc_id", F.col("toxic").alias("y")), "doc_id")
    by = {r.y: r.found for r in got.groupBy("y").agg(F.avg(F.col("toxic").cast("int")).alias("found")).collect()}
    assert by[1] > 0.7 and by[0] < 0.005  # at this size a quarter of the toxic texts has no cue that other toxic texts share


def test_later_links_use_earlier_probabilities():
    r = np.random.default_rng(1)
    n = 600
    x = r.random(n) < 0.5
    second = x & (r.random(n) < 0.9)
    chain = toxicity.fit_chain(np.array([1], np.uint64), np.flatnonzero(x), np.zeros(x.sum(), int), np.stack([x, second], axis=1).astype(float), np.arange(n) % toxicity.FOLDS)
    assert chain.earlier[1, 0] > 0.5 and chain.earlier[0].sum() == 0


def test_ordinal_fit_recovers_an_order():
    r = np.random.default_rng(2)
    n = 3000
    value = r.normal(size=n)
    grade = np.digitize(2 * value + r.logistic(size=n), [-1, 2])
    model = ordinal.fit(np.arange(n), np.zeros(n, int), value, grade, 3, penalty=0, steps=2000, rate=0.2)
    assert abs(model.weights[0] - 2) < 0.3 and np.abs(model.thresholds - [-1, 2]).max() < 0.3


def test_odd_rows(spark, documents):
    rows = list(enumerate(ODD)) + [(None, "some text"), (3, "idiot"), (3, "idiot")]
    docs = documents(rows)
    labels = spark.createDataFrame([(0, 1, 1), (1, 0, 0), (2, 1, 0), (None, 1, 1), (5, None, None)], "doc_id bigint, quality int, toxic int")
    for label in (labels, labels.where("doc_id < 0")):
        model = ordinal.train(docs, ordinal.quality_grades(label), 3)
        got = ordinal.graded(docs, model)
        assert sorted(str(r.doc_id) for r in got.collect()) == sorted(str(i) for i, _ in rows)
        assert ordinal.graded(docs.where("doc_id < 0"), model).collect() == []
        kept = ordinal.selected(docs, model)
        assert kept.columns == docs.columns and kept.count() == got.where("selected").count()
        chain = toxicity.train(docs, label)
        marks = toxicity.scored(docs, chain)
        assert sorted(str(r.doc_id) for r in marks.collect()) == sorted(str(i) for i, _ in rows)
        assert toxicity.scored(docs.where("doc_id < 0"), chain).collect() == []
    assert got.where("selected").count() == len(rows)  # no labels: all stay
    assert marks.where("toxic").count() == 0


def test_a_sample_has_one_text_for_each_id(spark, documents):
    rows = [(7, f"idiot text {i}") for i in range(500)] + [(i, f"plain words {i}") for i in range(20, 40)] + [(None, "a"), (None, "a")]
    docs = documents(rows)
    chosen = spark.createDataFrame([(7, 1), (20, 0), (99, 0)], "label_id bigint, grade int")
    got = ordinal.sample_texts(docs, chosen, "doc_id", "text").collect()
    assert sorted(r.label_id for r in got) == [7, 20] and {r.text for r in got} <= {t for _, t in rows}
    assert ordinal.sample_texts(documents(rows[::-1], 1), chosen, "doc_id", "text").orderBy("label_id").first().text == min(got, key=lambda r: r.label_id).text


def test_repeated_labels_count_once(spark, documents):
    rows = [(i, ("bad idiot " if i % 2 else "fine sunny ") * 5 + f"w{i}") for i in range(60)]
    docs = documents(rows + [(1, "some other text")] * 300)
    once = [(i, 1 - i % 2, i % 2) for i in range(60)]
    labels = lambda x: spark.createDataFrame(x, "doc_id bigint, quality int, toxic int")
    one, many = (ordinal.train(docs, ordinal.quality_grades(labels(x)), 3) for x in (once, once + [(3, 0, 1)] * 50))
    assert np.allclose(one.weights, many.weights) and np.allclose(one.thresholds, many.thresholds)
    one, many = (toxicity.train(docs, labels(x)) for x in (once, once + [(3, 0, 1)] * 50 + [(2, 1, 0)] * 9))
    assert np.array_equal(one.cues, many.cues) and np.allclose(one.weights, many.weights)


def test_chain_equals_a_plain_out_of_fold_loop():
    """Each link is fitted on all rows with the earlier links' out-of-fold probabilities, fold by fold, one row at a time."""
    r = np.random.default_rng(3)
    n, cues = 200, 4
    doc, cue = np.nonzero(r.random((n, cues)) < 0.4)
    labels = np.zeros((n, 3))
    has = np.zeros((n, cues))
    has[doc, cue] = 1
    labels[:, 0] = has[:, 0] + r.random(n) > 1.2
    labels[:, 1] = labels[:, 0] * (has[:, 1] > 0)
    labels[:, 2] = labels[:, 0] * (r.random(n) < 0.5)
    folds = r.integers(0, toxicity.FOLDS, n)
    chain = toxicity.fit_chain(np.arange(cues, dtype=np.uint64), doc, cue, labels, folds)
    sigmoid = lambda x: 1 / (1 + np.exp(-x))

    def fitted(rows, c, dense):
        at = {d: i for i, d in enumerate(rows)}
        keep = [(at[d], f) for d, f in zip(doc, cue) if d in at]
        return toxicity.fit_linear(np.array([k[0] for k in keep]), np.array([k[1] for k in keep]), dense[rows], labels[rows, c], cues)
    seen = np.zeros((n, 3))
    for c in range(3):
        dense = seen[:, :c]
        w, v, b = fitted(np.arange(n), c, dense)
        assert np.allclose(chain.weights[c], w) and np.allclose(chain.earlier[c, :c], v) and np.isclose(chain.constant[c], b)
        for f in range(toxicity.FOLDS):
            inside = np.flatnonzero(folds != f)
            w, v, b = fitted(inside, c, dense)
            for i in np.flatnonzero(folds == f):
                seen[i, c] = sigmoid(b + sum(w[k] for d, k in zip(doc, cue) if d == i) + dense[i] @ v)
