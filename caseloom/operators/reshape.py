"""Wide-to-long helpers used by profiles, statistics and feature scores."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def to_long(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = (), name: str = "feature",
            value: str = "value", dtype: str | None = "double") -> DataFrame:
    """One row per (input row, column). Values are cast to a common type."""
    picked = [F.col(c).cast(dtype).alias(c) if dtype else F.col(c) for c in columns]
    return df.select(*[F.col(k) for k in keep], *picked).unpivot(list(keep), list(columns), name, value)


def long_counts(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = (), name: str = "feature",
                value: str = "value", dtype: str | None = "double") -> DataFrame:
    """Rows per (keep..., column, non-null value): the pre-aggregated form that rank statistics start from."""
    long = to_long(df, columns, keep, name, value, dtype)
    return long.where(F.col(value).isNotNull()).groupBy(*keep, name, value).agg(F.count(F.lit(1)).alias("n"))


def union_all(frames: Sequence[DataFrame], allow_missing: bool = False) -> DataFrame:
    """Union by column name."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), frames)


def one_row_long(df: DataFrame, names: Sequence[str], name: str = "name", value: str = "value") -> DataFrame:
    """Turns a one-row aggregate into (name, value) rows."""
    return df.select(*names).unpivot([], list(names), name, value)


def literal_rows(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A few driver-side rows as a plan of literals, whose size the optimizer knows."""
    columns = [c.strip().rsplit(" ", 1) for c in schema.split(",")]
    structs = [F.struct(*[F.lit(v).cast(t).alias(n) for v, (n, t) in zip(row, columns)]) for row in rows]
    if not structs:
        return spark.range(0).select(*[F.lit(None).cast(t).alias(n) for n, t in columns])
    return spark.range(0, 1, 1, 1).select(F.inline(F.array(*structs)))
