"""Batch scoring with saved models and a registry of model versions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom.operators.features import feature_contract
from caseloom.operators.reshape import literal_rows, union_all

REGISTRY = "name string, seq bigint, version string, path string, action string"


def score(df: DataFrame, model: PipelineModel, features: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Prediction, probability and risk level per row. Features are put in the saved order first; a model brings its
    own scaling as a pipeline stage, so no model is scaled that was not trained on scaled data."""
    scored = model.transform(feature_contract(df, features, keep))
    return scored.select(*keep, F.col("prediction").cast("int").alias("prediction"), vector_to_array("probability")[1].alias("probability"),
                         F.when(F.col("prediction") == 1, "High").otherwise("Low").alias("risk_level"))


def registered(registry: DataFrame, name: str, version: str, path: str, action: str = "register") -> DataFrame:
    """The registry with one more entry for the model, which makes it the active one."""
    seq = registry.where(F.col("name") == name).agg(F.coalesce(F.max("seq"), F.lit(0)) + 1).first()[0]
    return registry.unionByName(literal_rows(registry.sparkSession, [(name, seq, version, path, action)], REGISTRY))


def active_versions(registry: DataFrame) -> DataFrame:
    """The entry with the highest sequence number per model."""
    latest = registry.groupBy("name").agg(F.max_by(F.struct("version", "path", "seq"), "seq").alias("_l"))
    return latest.select("name", "_l.version", "_l.path", "_l.seq")


def rolled_back(registry: DataFrame, name: str, version: str) -> DataFrame:
    """The registry with an older version active again. History is kept; an unknown version is an error."""
    found = registry.where((F.col("name") == name) & (F.col("version") == version)).orderBy(F.desc("seq")).first()
    if found is None:
        raise ValueError(f"{name} has no version {version}")
    return registered(registry, name, version, found["path"], "rollback")


def roll_back_many(registry: DataFrame, names: DataFrame) -> DataFrame:
    """Rolls every listed model back to the version before its latest entry, in one job.

    Models with a single entry stay as they are.
    """
    latest = registry.groupBy(F.col("name").alias("_n")).agg(F.max("seq").alias("_top"))
    older = registry.join(latest, (F.col("name") == F.col("_n")) & (F.col("seq") < F.col("_top"))).join(names, "name", "left_semi")
    before = older.groupBy("name").agg(F.max_by(F.struct("version", "path"), "seq").alias("_p"), F.max("_top").alias("_top"))
    entries = before.select("name", (F.col("_top") + 1).alias("seq"), "_p.version", "_p.path", F.lit("rollback").alias("action"))
    return union_all([registry, entries])


class ModelStore:
    """Loaded models by path, so that a job reads each version once. ``reload`` forgets a path."""

    def __init__(self) -> None:
        self._models: dict[str, PipelineModel] = {}

    def get(self, path: str) -> PipelineModel:
        if path not in self._models:
            self._models[path] = PipelineModel.load(path)
        return self._models[path]

    def reload(self, path: str) -> None:
        self._models.pop(path, None)


def empty_registry(spark: SparkSession) -> DataFrame:
    return literal_rows(spark, [], REGISTRY)
