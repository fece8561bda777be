"""Extraction and scoring on a stream. Both are row-local, so the batch plans run unchanged and need no state."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from caseloom.operators.serve import score
from caseloom.sources.files import RECORD_CORE


def stream_records(spark: SparkSession, path: str, core: str = RECORD_CORE, files_per_batch: int = 100) -> DataFrame:
    """New record files as a stream of (source, text)."""
    pieces = (spark.readStream.option("lineSep", core).option("maxFilesPerTrigger", files_per_batch).text(path)
              .select(F.col("_metadata.file_path").alias("source"), "value"))
    body = F.regexp_replace(F.regexp_replace("value", r"^\s*#\d+\s*---", ""), r"---\s*$", "")
    return pieces.select("source", F.regexp_replace(body, r"^\s+|\s+$", "").alias("text")).where("text <> ''")


def stream_extract(records: DataFrame, plan: Callable[..., DataFrame], out: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Runs an extraction plan over streamed records into parquet; the checkpoint folder makes restarts exact."""
    rows = plan(records, keep=["source"])
    return rows.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def stream_score(rows: DataFrame, model: PipelineModel, features: Sequence[str], keep: Sequence[str], out: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Scores streamed rows into parquet."""
    scored = score(rows, model, features, keep)
    return scored.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
