"""File sources and sinks: raw CSV, record files, typed tables, the star, metric files."""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseloom.operators.clean import NA_TOKENS, cast_columns, null_tokens
from caseloom.operators.star import Star

# Fixed value: the literal core of the line that ends a record; the reader cuts at it.
RECORD_CORE = "END OF RECORD"


def read_raw_csv(spark: SparkSession, path: str, columns: Sequence[str], types: dict[str, str] | None = None,
                 tokens: Sequence[str] = tuple(NA_TOKENS)) -> DataFrame:
    """Reads every column as text with a fixed schema (no inference pass), turns missing-value tokens into NULL and
    casts. Text that does not parse becomes NULL."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    raw = spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path)
    return cast_columns(null_tokens(raw, tokens), types or {})


def read_records(spark: SparkSession, path: str, core: str = RECORD_CORE) -> DataFrame:
    """(source, record_no, text, whole): the records of text files that end each record with ``--- END OF RECORD #n ---``.

    The files are cut at the literal core while they are read, so a file of any size is split over many tasks. Markers
    count up from 1 in each file; the marker in front of a piece belongs to the record before it, so the piece's own
    number is the next one. ``whole`` is false for a piece at whose start the core occurred outside a full marker;
    callers can look at those.
    """
    pieces = spark.read.option("lineSep", core).option("recursiveFileLookup", True).text(path).select(
        F.col("_metadata.file_path").alias("source"), F.col("value"))
    head = r"^\s*#(\d+)\s*---"
    number = F.regexp_extract("value", head, 1).try_cast("bigint")
    body = F.regexp_replace(F.regexp_replace("value", head, ""), r"---\s*$", "")
    return (pieces.select("source", (F.coalesce(number, F.lit(0)) + 1).alias("record_no"), F.regexp_replace(body, r"^\s+|\s+$", "").alias("text"),
                          (number.isNotNull() | ~F.col("value").rlike(r"^\s*#")).alias("whole"))
            .where("text <> ''"))


def spread(df: DataFrame) -> DataFrame:
    """Deals out the rows of a table that was read in fewer pieces than there are cores, before costly work per row.

    A table of many files or blocks is left as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def write_records(df: DataFrame, text: str, order: str, path: str, by: str) -> None:
    """Writes records with their end markers, one file per value of ``by``, numbered from 1 in the given order."""
    numbered = df.withColumn("_n", F.row_number().over(W.partitionBy(by).orderBy(order)))
    body = F.concat(F.col(text), F.lit("\n\n--- END OF RECORD #"), F.format_string("%05d", "_n"), F.lit(" ---\n"))
    numbered.select(body.alias("value"), by, "_n").sortWithinPartitions(by, "_n").drop("_n").write.mode("overwrite").partitionBy(by).text(path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_table(df: DataFrame, path: str, form: str = "parquet") -> None:
    """Writes a cleaned table, replacing an earlier one."""
    writer = df.write.mode("overwrite")
    writer.option("header", True).csv(path) if form == "csv" else writer.format(form).save(path)


def load_star(star: Star, path: str, keep: int = 2) -> None:
    """Loads all tables or none: they are written to a folder of their own, then one small manifest names it.

    A reader follows the manifest of the highest number, so a load that fails in between leaves the earlier star as it was, and two
    loads at a time cannot both take a number. Running it again gives the same tables. The last ``keep`` stars stay on disk, for
    readers that are still on their way.
    """
    spark = star.dim.sparkSession
    number = max([m["number"] for m in _manifests(spark, path)], default=0) + 1
    folder = f"versions/{number:010d}-{uuid.uuid4().hex}"
    tables = {"dim_patient": star.dim, **star.facts}
    for name, df in tables.items():
        write_table(df, f"{path}/{folder}/{name}")
    file = _path(spark, f"{path}/manifests/{number:010d}.json")
    out = _filesystem(spark, path).create(file, False)  # fails if another load was first
    out.write(bytearray(json.dumps({"number": number, "folder": folder, "tables": list(tables)}).encode()))
    out.close()
    for old in sorted(_manifests(spark, path), key=lambda m: m["number"])[:-keep]:
        _filesystem(spark, path).delete(_path(spark, f"{path}/manifests/{old['number']:010d}.json"), False)
        _filesystem(spark, path).delete(_path(spark, f"{path}/{old['folder']}"), True)


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _filesystem(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def _manifests(spark: SparkSession, path: str) -> list[dict]:
    """The manifests of finished loads, a few small files; one that is not written to its end does not count."""
    if not _filesystem(spark, path).exists(_path(spark, f"{path}/manifests")):
        return []
    out = []
    for row in spark.read.text(f"{path}/manifests", wholetext=True).collect():
        try:
            out.append(json.loads(row[0]))
        except ValueError:
            continue
    return out


def load_star_bucketed(star: Star, database: str, buckets: int) -> None:
    """Saves catalog tables bucketed and sorted by the key, so that joins of facts and dimension need no shuffle."""
    for name, df in {"dim_patient": star.dim, **star.facts}.items():
        df.write.mode("overwrite").bucketBy(buckets, star.key).sortBy(star.key).format("parquet").saveAsTable(f"{database}.{name}")


def read_star(spark: SparkSession, path: str, facts: Sequence[str], key: str = "patient_id") -> Star:
    """The star of the last finished load."""
    manifests = _manifests(spark, path)
    if not manifests:
        raise FileNotFoundError(f"no star was loaded to {path}")
    base = f"{path}/{max(manifests, key=lambda m: m['number'])['folder']}"
    return Star(read_table(spark, f"{base}/dim_patient"), {f: read_table(spark, f"{base}/{f}") for f in facts}, key)


def write_metrics_csv(results: DataFrame, path: str) -> None:
    """A results table (one row per model) as a single CSV file."""
    results.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def write_split(df: DataFrame, path: str, split: str = "split") -> None:
    """Training and test rows in one folder each; a reader of one part does not touch the other."""
    df.write.mode("overwrite").partitionBy(split).parquet(path)


def read_split(spark: SparkSession, path: str, part: str, split: str = "split") -> DataFrame:
    return spark.read.parquet(path).where(F.col(split) == part).drop(split)
