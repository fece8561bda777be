"""Table profiles: shape, missing values, types, category previews and per-class descriptions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseloom.functions.scalar import percent
from caseloom.operators.ranks import weighted_quantiles
from caseloom.operators.reshape import long_counts, union_all

QUARTILES = {"q25": 0.25, "q50": 0.5, "q75": 0.75}


def _null_counts(df: DataFrame):
    return [F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns]


def shape(df: DataFrame) -> DataFrame:
    """Rows, columns and the column names."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        "n_rows", F.lit(len(df.columns)).alias("n_cols"), F.lit(",".join(df.columns)).alias("columns"))


def missing_counts(df: DataFrame) -> DataFrame:
    """Missing values per column beside the number of rows, all columns in one pass."""
    wide = df.agg(*_null_counts(df), F.count(F.lit(1)).alias("_rows"))
    return wide.unpivot(["_rows"], df.columns, "column_name", "missing")


def missing_profile(df: DataFrame) -> DataFrame:
    """Missing values per column, all columns in one pass; most missing first."""
    return (missing_counts(df)
            .select("column_name", "missing", percent(F.col("missing"), F.col("_rows"), 4).alias("pct_of_rows"))
            .orderBy(F.desc("missing"), "column_name"))


def missing_totals(df: DataFrame, dataset: str) -> DataFrame:
    """One row: rows, columns, cells, missing cells, their share, and how many columns have any."""
    n_cols = len(df.columns)
    wide = df.agg(*_null_counts(df), F.count(F.lit(1)).alias("_rows"))
    missing = sum((F.col(f"`{c}`") for c in df.columns), F.lit(0))
    bad = sum((F.when(F.col(f"`{c}`") > 0, 1).otherwise(0) for c in df.columns), F.lit(0))
    return wide.select(
        F.lit(dataset).alias("dataset"), F.col("_rows").alias("n_rows"), F.lit(n_cols).alias("n_cols"),
        missing.cast("bigint").alias("missing_cells"),
        percent(missing, F.col("_rows") * n_cols, 4).alias("missing_pct"),
        bad.cast("int").alias("columns_with_missing"))


def type_overview(df: DataFrame) -> DataFrame:
    """Columns and non-missing values per data type."""
    by_type: dict[str, list[str]] = {}
    for f in df.schema.fields:
        by_type.setdefault(f.dataType.simpleString(), []).append(f.name)
    wide = df.agg(*[F.struct(F.lit(len(names)).alias("n_columns"), sum((F.count(F.col(f"`{c}`")) for c in names), F.lit(0)).alias("n_values")).alias(t)
                    for t, names in by_type.items()])
    return wide.unpivot([], [F.col(f"`{t}`") for t in by_type], "data_type", "_s").select("data_type", "_s.n_columns", "_s.n_values").orderBy("data_type")


def category_preview(df: DataFrame, columns: Sequence[str] | None = None, size: int = 6) -> DataFrame:
    """Distinct values per string column and the first few of them in sorted order.

    Values are counted before anything is ranked and only ``size`` rows per column reach the preview, so a
    column with billions of distinct values is fine.
    """
    columns = list(columns or [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)])
    values = long_counts(df, columns, name="column_name", dtype=None)
    first = (values.withColumn("_r", F.row_number().over(W.partitionBy("column_name").orderBy("value")))
             .where(F.col("_r") <= size).groupBy("column_name")
             .agg(F.array_join(F.array_sort(F.collect_list("value")), ", ").alias("sample")))
    distinct = values.groupBy("column_name").agg(F.count(F.lit(1)).alias("n_distinct"))
    return distinct.join(first, "column_name").select(
        "column_name", "n_distinct",
        F.concat("sample", F.when(F.col("n_distinct") > size, " ...").otherwise("")).alias("sample"))


def dataset_summary(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows, columns and missing cells, one row per table."""
    return union_all([missing_totals(df, name) for name, df in tables.items()])


def change_report(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows, columns and missing cells before and after a cleaning step, with the deltas."""
    def long(df: DataFrame, name: str) -> DataFrame:
        one = missing_totals(df, name).select(
            F.col("n_rows").alias("rows"), F.col("n_cols").cast("bigint").alias("columns"),
            F.col("missing_cells").alias("missing_cells"))
        return one.unpivot([], ["rows", "columns", "missing_cells"], "metric", name)
    return long(before, "before").join(long(after, "after"), "metric").select(
        "metric", "before", "after", (F.col("after") - F.col("before")).alias("delta"))


def cleaning_summary(tables: dict[str, DataFrame], label: str) -> DataFrame:
    """Rows, columns, missing cells and the share of positive labels per cleaned table, one scan each."""
    out = []
    for name, df in tables.items():
        wide = df.agg(*_null_counts(df), F.count(F.lit(1)).alias("_rows"), F.count_if(F.col(label) == 1).alias("_pos"))
        missing = sum((F.col(f"`{c}`") for c in df.columns), F.lit(0))
        out.append(wide.select(
            F.lit(name).alias("dataset"), F.col("_rows").alias("n_rows"), F.lit(len(df.columns)).alias("n_cols"),
            missing.cast("bigint").alias("missing_cells"), percent(F.col("_pos"), F.col("_rows"), 2).alias("target_pct")))
    return union_all(out)


def describe_by(df: DataFrame, group: str, measures: Sequence[str], digits: int | None = None) -> DataFrame:
    """count, mean, std, min, quartiles and max of each measure per class, all from one scan.

    The deviations are taken from the group's mean, which the running totals carry along.
    """
    counts = long_counts(df, measures, [group]).withColumn("s", F.col("value") * F.col("n"))
    mean = F.col("total_s") / F.col("total_n")
    gap = F.col("value") - mean
    extra = [F.max("total_n").alias("count"), F.max(mean).alias("mean"), F.sum(F.col("n") * gap * gap).alias("squares"),
             F.min("value").alias("min"), F.max("value").alias("max")]
    out = weighted_quantiles(counts, "value", "n", QUARTILES, [group, "feature"], extra=extra, carry=["s"])
    std = F.sqrt(F.try_divide(F.col("squares"), (F.col("count") - 1).cast("double")))
    shown = out.select(group, "feature", F.col("count").alias("n"), "mean", std.alias("std"), "min", *QUARTILES, "max")
    return shown if digits is None else shown.withColumns({c: F.round(c, digits) for c in ("mean", "std", "min", *QUARTILES, "max")})
