"""Each stage of the pipeline judged on its own input."""

from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

pipeline = pytest.importorskip("corpus_pipeline")
from caseloom.llm import queries  # noqa: E402

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    home = tmp_path_factory.mktemp("stages")
    docs = queries.table(spark, SF, "documents").withColumn("row", F.lit("own")).withColumn("text_sha256", F.lit("own"))
    out = [docs]
    for name, stage in pipeline.STAGES:
        stage(spark, out[-1], SF).write.parquet(str(home / name))
        out.append(spark.read.parquet(str(home / name)))
    return out


def test_columns_stay(steps):
    assert all(s.columns == steps[0].columns for s in steps[:5])


def test_quality(spark, steps):
    labels = queries.table(spark, SF, "labels")
    kept = steps[1].select("doc_id").join(labels, "doc_id")
    good = labels.where("quality = 1").count()
    assert kept.where("quality = 1").count() > 0.99 * good and kept.where("quality = 0").count() < 0.05 * labels.where("quality = 0").count()


def test_exact(steps):
    az = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    want = {}
    for r in steps[1].collect():
        key = r.text.translate(az)
        want[key] = max(want.get(key, -1), r.doc_id)
    assert sorted(r.doc_id for r in steps[2].collect()) == sorted(want.values())


def test_near(steps):
    from test_forest import brute
    rows = [(r.doc_id, r.text) for r in steps[2].collect()]
    want = {w[5] for w in brute(rows)}
    assert sorted(str(r.doc_id) for r in steps[3].collect()) == sorted(want)


def test_benchmark(spark, steps):
    from test_decontaminate import words
    windows = set()
    for r in queries.table(spark, SF, "benchmark").collect():
        w = words(r.text)
        k = min(10, len(w))
        windows.update(tuple(w[i:i + k]) for i in range(len(w) - k + 1) if k)
    sizes = {len(w) for w in windows}
    want = []
    for r in steps[3].collect():
        w = words(r.text)
        if not any(tuple(w[i:i + k]) in windows for k in sizes for i in range(len(w) - k + 1)):
            want.append(r.doc_id)
    assert sorted(r.doc_id for r in steps[4].collect()) == sorted(want)


def test_tokens(steps):
    tokenizers = pytest.importorskip("tokenizers")
    library = tokenizers.Tokenizer.from_file(queries.tokenizer_path())
    texts = {r.doc_id: r.text for r in steps[4].collect()}
    rows = steps[5].collect()
    assert {r.doc_id for r in rows} == set(texts) and len(rows) == len(texts)
    for r in rows:
        assert r.ids == library.encode(texts[r.doc_id], add_special_tokens=False).ids and r.n_tokens == len(r.ids)
        assert r.decoded_sha256 == hashlib.sha256(library.decode(r.ids, skip_special_tokens=False).encode()).hexdigest()


def test_run_is_registered(spark, sf):
    import __spark_entry__ as entry
    assert entry.queries()["pipeline"] is pipeline.run
    assert pipeline.run(spark, sf).count() > 0
