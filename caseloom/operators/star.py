"""Star schema: keyed loading of a patient dimension with one fact table per cohort, and its views."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseloom.functions.scalar import decode
from caseloom.operators.ranks import number_rows
from caseloom.operators.reshape import union_all
from caseloom.session import cut_lineage


@dataclass
class Cohort:
    """How one cleaned table enters the star: its order column, its dimension columns and its fact columns."""

    source: str
    frame: DataFrame
    order: str
    dim: dict[str, Column]
    fact: dict[str, Column]


@dataclass
class Star:
    """A dimension with its facts."""

    dim: DataFrame
    facts: dict[str, DataFrame]
    key: str = "patient_id"
    source: str = "source_dataset"
    label: str = "label"
    fact_sources: dict[str, str] = field(default_factory=dict)

    def source_of(self, fact: str) -> str:
        return self.fact_sources.get(fact, fact.removeprefix("fact_"))

    def labels(self) -> DataFrame:
        """Every fact row as (key, source, label): one thin table instead of one join per fact."""
        return union_all([f.select(self.key, F.lit(self.source_of(n)).alias(self.source), self.label)
                          for n, f in self.facts.items()])


def assign_keys(cohorts: Sequence[Cohort], key: str = "patient_id", cells: int | None = None) -> DataFrame:
    """(source, order value, key): ids count up from 1 through the cohorts in the given order, without gaps.

    An order value that occurs twice in a cohort is an error: its rows could not be told apart. The keys are written
    once, so that dimension and facts see the same ones.
    """
    slim = union_all([c.frame.select(F.lit(c.source).alias("_source"), F.col(c.order).cast("bigint").alias("_order"))
                      for c in cohorts])
    once = slim.groupBy("_source", "_order").agg(F.count(F.lit(1)).alias("_n"))
    repeated = F.raise_error(F.concat(F.lit("order value occurs more than once in "), F.col("_source"), F.lit(": "), F.col("_order")))
    unique = once.select("_source", F.when(F.col("_n") == 1, F.col("_order")).otherwise(repeated.cast("bigint")).alias("_order"))
    return cut_lineage(number_rows(unique, "_order", key, "_source", [c.source for c in cohorts], cells))


def build_star(cohorts: Sequence[Cohort], key: str = "patient_id", source: str = "source_dataset",
               cells: int | None = None) -> Star:
    """Keys every cohort once, writes the keyed rows and splits each into its dimension row and its fact row."""
    keys = assign_keys(cohorts, key, cells)
    dims, facts = [], {}
    for c in cohorts:
        own = keys.where(F.col("_source") == c.source).select(F.col("_order").alias("_k"), key)
        keyed = cut_lineage(c.frame.join(own, c.frame[c.order].cast("bigint") == own["_k"]).select(
            key, *[e.alias(f"_dim_{n}") for n, e in c.dim.items()], *[e.alias(f"_fact_{n}") for n, e in c.fact.items()]))
        dims.append(keyed.select(key, *[F.col(f"_dim_{n}").alias(n) for n in c.dim], F.lit(c.source).alias(source)))
        facts[f"fact_{c.source}"] = keyed.select(key, *[F.col(f"_fact_{n}").alias(n) for n in c.fact])
    return Star(union_all(dims), facts, key, source)


def full_view(fact: DataFrame, dim: DataFrame, key: str, decoded: dict[str, tuple[dict, str]],
              renamed: dict[str, str] | None = None) -> DataFrame:
    """Fact joined to dimension, dimension columns first, codes replaced by their names."""
    joined = fact.join(dim, key)
    columns = [*dim.columns, *[c for c in fact.columns if c != key]]
    out = []
    for c in columns:
        value = decode(F.col(c), *decoded[c]) if c in decoded else F.col(c)
        out.append(value.alias((renamed or {}).get(c, c)))
    return joined.select(*out)


def create_views(views: dict[str, DataFrame]) -> None:
    """Registers each frame under its name for SQL users."""
    for name, df in views.items():
        df.createOrReplaceTempView(name)
