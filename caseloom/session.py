"""Session settings and the one folder that every executor can reach."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(app: str = "caseloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session for local runs; on a cluster the submitter's settings win over these."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        **conf,
    }
    for name, value in settings.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh path under the cluster's shared checkpoint folder.

    The folder is read from ``spark.checkpoint.dir`` (or the context's checkpoint directory). Only a local
    master without such a setting gets a temporary folder of its own.
    """
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not base:
        if context.master != "local" and not context.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="caseloom-")
        context.setCheckpointDir(base)
    return os.path.join(base, f"{name}-{uuid.uuid4().hex}")


#: rows of a partition of a table that many small jobs read: at least, if there are fewer than the cores could share, and at most
LEAST_ROWS, MOST_ROWS = 1 << 13, 1 << 17


def partitions_for(spark: SparkSession, rows: int, most: int = MOST_ROWS, beside: int = 1) -> int:
    """Few partitions for few rows, one a core for more, then as many as keep them bounded. ``beside`` jobs at once share the cores."""
    cores = max(1, spark.sparkContext.defaultParallelism // beside)
    return max(1, min(cores, -(-rows // LEAST_ROWS)), -(-rows // most))


def compact(df):
    """Writes the rows once, in no more partitions than they or the cores need: many small jobs will read them."""
    df = cut_lineage(df)
    return df.coalesce(partitions_for(df.sparkSession, df.count()))


def cut_lineage(df):
    """Checkpoint ``df`` to the shared folder, so that lost executors do not replay a long history."""
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(shared_dir(df.sparkSession, "checkpoint"))
    return df.checkpoint()


def written(df, name: str):
    """Writes ``df`` to the shared folder by columns, which takes a fraction of a checkpoint's room, and reads it again."""
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
