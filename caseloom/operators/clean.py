"""Cleaning steps: trimming, value maps, brackets, grouped-median imputation, alignment of tables."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseloom.functions.scalar import right_closed_bin, total
from caseloom.operators.ranks import settle, small_side, weighted_quantiles
from caseloom.operators.reshape import union_all
from caseloom.session import cut_lineage

# Tokens read as missing, the age brackets of the imputation and the slang of forum posts.
NA_TOKENS = ["?", "", " ", "N/A", "n/a", "NA", "na", "null", "NULL", "None"]
BRACKET_EDGES = [0.0, 18.0, 40.0, 60.0, 80.0, math.inf]
BRACKET_LABELS = ["0-18", "19-40", "41-60", "61-80", "81+"]
SLANG = {"bc": "because", "w/": "with", " u ": " you "}


def trim_strings(df: DataFrame) -> DataFrame:
    """Strips leading and trailing whitespace in every string column."""
    return df.select(*[F.regexp_replace(F.col(f"`{f.name}`"), r"^\s+|\s+$", "").alias(f.name)
                       if isinstance(f.dataType, T.StringType) else F.col(f"`{f.name}`") for f in df.schema.fields])


def null_tokens(df: DataFrame, tokens: Sequence[str] = tuple(NA_TOKENS)) -> DataFrame:
    """Turns missing-value tokens in string columns into NULL."""
    trimmed = sorted({t.strip() for t in tokens})
    return df.select(*[F.when(~F.trim(F.col(f"`{f.name}`")).isin(trimmed), F.col(f"`{f.name}`")).alias(f.name)
                       if isinstance(f.dataType, T.StringType) else F.col(f"`{f.name}`") for f in df.schema.fields])


def cast_columns(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Casts the named columns; text that does not parse becomes NULL instead of failing the job."""
    return df.withColumns({c: F.col(f"`{c}`").try_cast(t) for c, t in types.items()})


def rename_columns(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(names)


def map_value(value: Column, mapping: dict[str, int | str], ignore_case: bool = True) -> Column:
    """Maps values; a value without a mapping is kept if the target type can hold it and is NULL otherwise."""
    subject = F.lower(value.cast("string")) if ignore_case else value.cast("string")
    branch = None
    for source, target in mapping.items():
        hit = subject == (source.lower() if ignore_case else source)
        branch = F.when(hit, F.lit(target)) if branch is None else branch.when(hit, F.lit(target))
    kept = value.cast("string") if isinstance(next(iter(mapping.values())), str) else value.cast("string").try_cast("int")
    return branch.otherwise(kept)


def map_columns(df: DataFrame, columns: Sequence[str], mapping: dict, ignore_case: bool = True) -> DataFrame:
    return df.withColumns({c: map_value(F.col(f"`{c}`"), mapping, ignore_case) for c in columns})


def drop_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.drop(*columns)


def drop_sentinels(df: DataFrame, column: str, sentinels: Sequence, ignore_case: bool = True) -> DataFrame:
    """Removes the rows that carry a sentinel; NULL rows stay."""
    value = F.col(column)
    if ignore_case and isinstance(df.schema[column].dataType, T.StringType):
        value, sentinels = F.lower(value), [s.lower() for s in sentinels]
    return df.where(~F.coalesce(value.isin(list(sentinels)), F.lit(False)))


def add_score(df: DataFrame, items: Sequence[str], out: str) -> DataFrame:
    """Row-wise sum of items."""
    return df.withColumn(out, total([F.col(i) for i in items]))


def age_bracket(age: str | Column) -> Column:
    """The five right-closed brackets used for imputation; 0 and negative ages have none."""
    return right_closed_bin(F.col(age) if isinstance(age, str) else age, BRACKET_EDGES, BRACKET_LABELS)


FEW_GROUPS = 10_000


@dataclass
class MedianImputer:
    """Fills missing values with the median of the row's group, else with the overall median.

    ``fit`` makes one pass that counts values per group and writes one row per group; ``transform`` joins it, by
    broadcast where it was counted to have at most ``FEW_GROUPS`` rows. The overall median is taken after the groups
    are filled.
    """

    value: str
    group: str
    table: DataFrame | None = None
    fallback: float | None = None

    def fit(self, df: DataFrame) -> MedianImputer:
        counts = settle(
            df.groupBy(F.col(self.group).alias("_g"), F.col(self.value).cast("double").alias("_v")).agg(F.count(F.lit(1)).alias("_rows"))
            .withColumn("_n", F.when(F.col("_v").isNotNull(), F.col("_rows")).otherwise(0)), "_v", ["_g"])
        absent = F.sum(F.col("_rows") - F.col("_n")).alias("missing")
        found = weighted_quantiles(counts, "_v", "_n", {"median": 0.5}, ["_g"], extra=[absent], settled=True)
        self.table = cut_lineage(found.withColumn("median", F.when(F.col("_g").isNotNull(), F.col("median"))))
        if self.table.where("missing > 0 AND median IS NULL").limit(1).count():
            present = counts.where("_v IS NOT NULL").select("_v", "_n")
            filled = self.table.where("missing > 0 AND median IS NOT NULL").select("median", "missing")
            row = weighted_quantiles(present.union(filled).groupBy("_v").agg(F.sum("_n").alias("_n")), "_v", "_n", {"median": 0.5}).first()
            self.fallback = row["median"] if row else None
        return self

    @property
    def medians(self) -> dict:
        """The medians on the driver, to look at where groups are few."""
        return {r["_g"]: r["median"] for r in self.table.where("median IS NOT NULL").collect()}

    def transform(self, df: DataFrame, out: str | None = None) -> DataFrame:
        name = out or self.value
        known = small_side(self.table.where("median IS NOT NULL").select("_g", F.col("median").alias("_median")), FEW_GROUPS)
        filled = F.coalesce(F.col(self.value).cast("double"), "_median", F.lit(self.fallback).cast("double"))
        return df.join(known, F.col(self.group) == F.col("_g"), "left").withColumn(name, filled).drop("_g", "_median")

    def bracket_table(self, df: DataFrame) -> DataFrame:
        """Group, median and how many values were missing."""
        return self.table.select(F.col("_g").alias(self.group), "median", "missing")


def align_union(main: DataFrame, other: DataFrame, derive: dict[str, Column]) -> DataFrame:
    """Derives the columns of ``main`` from ``other``, keeps only those, casts to main's types and appends."""
    mapped = other.select(*[derive.get(f.name, F.col(f"`{f.name}`")).cast(f.dataType).alias(f.name)
                            for f in main.schema.fields])
    return main.unionByName(mapped)


def months_to_years(months: Column) -> Column:
    """Months to whole years, rounding halves to even."""
    return F.bround(months.cast("double") / 12.0, 0).cast("smallint")


def expand_slang(text: Column, slang: dict[str, str] | None = None) -> Column:
    """Literal replacements, in order."""
    for short, full in (slang or SLANG).items():
        text = F.replace(text, F.lit(short), F.lit(full))
    return text


def concat_tables(frames: Sequence[DataFrame]) -> DataFrame:
    return union_all(frames)
