"""From raw documents to token ids, in five stages of one operator each. Every stage is written and read again.

1. ``quality``: texts that are probably of the lowest grade go (ordinal regression on the labels beside the documents).
2. ``exact``: of equal texts one stays.  3. ``near``: of each group of near duplicates one stays.
4. ``benchmark``: texts in which a benchmark passage occurs go.  5. ``tokens``: texts become token ids.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from caseloom.llm import bpe, decontaminate, forest, ordinal, quotient
from caseloom.llm.queries import table, tokenizer_path
from caseloom.session import shared_dir

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose grade is probably 1 or more. The model is fitted on labelled rows of ``docs``."""
    grades = ordinal.quality_grades(table(spark, sf_dir, "labels"))
    return ordinal.selected(docs, ordinal.train(docs, grades, 3))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each text."""
    return quotient.without_duplicates(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates."""
    return forest.one_per_group(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without benchmark passages."""
    return decontaminate.uncontaminated(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids, n_tokens and the digest of the decoded text."""
    return bpe.tokenised(docs, tokenizer_path())


STAGES: list[tuple[str, Stage]] = [("quality", quality), ("exact", exact), ("near", near), ("benchmark", benchmark), ("tokens", tokens)]

#: SQL has no expression for the model, the forest and the tokenizer: the tests compare with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other; each is written to the shared folder, so that a lost executor repeats one stage at most."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = shared_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
