"""Data-quality gates: binary, null, domain, key and constraint checks, each table scanned once."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseloom.operators.reshape import literal_rows, one_row_long, union_all


class DataQualityError(ValueError):
    """A table does not meet a required condition."""


@dataclass(frozen=True)
class Constraint:
    """A named CHECK: a row violates it when the condition is false (NULL passes, as in SQL)."""

    name: str
    condition: Column

    @staticmethod
    def not_null(column: str) -> Constraint:
        return Constraint(f"{column} not null", F.col(column).isNotNull())

    @staticmethod
    def one_of(column: str, allowed: Sequence) -> Constraint:
        return Constraint(f"{column} in domain", F.col(column).isin(list(allowed)))

    @staticmethod
    def between(column: str, low, high) -> Constraint:
        return Constraint(f"{column} between {low} and {high}", F.col(column).between(low, high))


def columns_with_missing(df: DataFrame) -> list[str]:
    row = df.agg(*[F.max(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns]).first()
    return [c for c in df.columns if row[c]]


def assert_no_missing(df: DataFrame, name: str) -> None:
    bad = columns_with_missing(df)
    if bad:
        raise DataQualityError(f"{name}: missing values remain in {bad}")


def binary_violations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows outside {0, 1} per column; NULL is not a violation."""
    wide = df.agg(*[F.count_if(~F.col(f"`{c}`").isin(0, 1)).alias(c) for c in columns])
    return one_row_long(wide, columns, "column_name", "violations")


def assert_binary(df: DataFrame, columns: Sequence[str], name: str) -> None:
    bad = [r["column_name"] for r in binary_violations(df, columns).where("violations > 0").collect()]
    if bad:
        raise DataQualityError(f"{name}: columns must hold 0 or 1 only: {bad}")


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    return union_all([df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
                      for name, df in tables.items()])


def orphan_counts(facts: dict[str, DataFrame], dim: DataFrame, key: str) -> DataFrame:
    """Fact rows whose key has no dimension row. All facts go through one anti join."""
    tagged = union_all([df.select(key, F.lit(name).alias("fact_table")) for name, df in facts.items()])
    lost = tagged.join(dim.select(key), key, "left_anti").groupBy("fact_table").agg(F.count(F.lit(1)).alias("n"))
    names = literal_rows(dim.sparkSession, [(n,) for n in facts], "fact_table string")
    return names.join(lost, "fact_table", "left").select(
        "fact_table", F.coalesce("n", F.lit(0)).cast("bigint").alias("orphaned_rows"))


def null_audit(tables: dict[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """NULL count per listed column, one aggregate per table."""
    parts = []
    for name, (df, columns) in tables.items():
        labels = {c: f"{name}.{c}" for c in columns}
        wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(label) for c, label in labels.items()])
        quoted = [F.col(f"`{v}`") for v in labels.values()]
        parts.append(wide.select(*quoted).unpivot([], quoted, "column_checked", "null_count"))
    return union_all(parts).orderBy(F.desc("null_count"), "column_checked")


def domain_violations(tables: dict[str, tuple[DataFrame, dict[str, Sequence]]]) -> DataFrame:
    """Rows outside the allowed values per column, one aggregate per table; NULL is not a violation."""
    parts = []
    for name, (df, domains) in tables.items():
        labels = {c: f"{name}.{c}" for c in domains}
        wide = df.agg(*[F.count_if(~F.col(c).isin(list(domains[c]))).alias(label) for c, label in labels.items()])
        quoted = [F.col(f"`{v}`") for v in labels.values()]
        parts.append(wide.select(*quoted).unpivot([], quoted, "check_target", "violations"))
    return union_all(parts)


def tag_violations(df: DataFrame, constraints: Sequence[Constraint], out: str = "violated") -> DataFrame:
    """Adds the names of the constraints each row breaks."""
    names = F.array(*[F.when(~F.coalesce(c.condition, F.lit(True)), c.name) for c in constraints])
    return df.withColumn(out, F.filter(names, lambda n: n.isNotNull()))


def constraint_report(df: DataFrame, constraints: Sequence[Constraint]) -> DataFrame:
    """Violations per constraint, zero included."""
    labels = [f"k{i}" for i in range(len(constraints))]
    wide = df.agg(*[F.count_if(~F.coalesce(c.condition, F.lit(True))).alias(k) for k, c in zip(labels, constraints)])
    name = F.element_at(F.create_map(*[F.lit(v) for k, c in zip(labels, constraints) for v in (k, c.name)]), F.col("k"))
    return one_row_long(wide, labels, "k", "violations").select(name.alias("constraint_name"), "violations")


def split_by_constraints(df: DataFrame, constraints: Sequence[Constraint]) -> tuple[DataFrame, DataFrame]:
    """(rows that meet every constraint, the others with the names of what they break)."""
    tagged = tag_violations(df, constraints)
    return tagged.where(F.size("violated") == 0).drop("violated"), tagged.where(F.size("violated") > 0)


def write_checked(df: DataFrame, constraints: Sequence[Constraint], path: str) -> None:
    """Writes parquet only when no row breaks a constraint."""
    broken = constraint_report(df, constraints).where("violations > 0").collect()
    if broken:
        raise DataQualityError(f"{path}: {[(r['constraint_name'], r['violations']) for r in broken]}")
    df.write.mode("overwrite").parquet(path)


def load_validation(dim: DataFrame, facts: dict[str, DataFrame], key: str, expected_rows: dict[str, DataFrame],
                    null_checks: dict[str, Sequence[str]], dim_name: str = "dim_patient") -> DataFrame:
    """Expected against actual: rows per table (sources on the expected side), orphans and NULLs must be 0."""
    tables = {dim_name: dim, **facts}
    sources = row_counts(expected_rows).withColumnRenamed("row_count", "expected")
    rows = (row_counts(tables).join(sources, "table_name", "left")
            .select(F.concat("table_name", F.lit(" row count")).alias("check_name"), "expected",
                    F.col("row_count").alias("actual")))
    orphans = orphan_counts(facts, dim, key).select(
        F.concat("fact_table", F.lit(" FK orphans")).alias("check_name"), F.lit(0).cast("bigint").alias("expected"),
        F.col("orphaned_rows").alias("actual"))
    nulls = null_audit({t: (tables[t], cols) for t, cols in null_checks.items()}).select(
        F.concat(F.lit("NULL values in "), "column_checked").alias("check_name"),
        F.lit(0).cast("bigint").alias("expected"), F.col("null_count").alias("actual"))
    return union_all([rows, orphans, nulls]).withColumn("passed", F.col("expected").eqNullSafe(F.col("actual")))


def cascade_delete(dim: DataFrame, facts: dict[str, DataFrame], deleted: DataFrame, key: str):
    """(dim, facts) without the deleted keys; facts of a deleted key go with it."""
    gone = deleted.select(key).distinct()
    return dim.join(gone, key, "left_anti"), {n: f.join(gone, key, "left_anti") for n, f in facts.items()}
