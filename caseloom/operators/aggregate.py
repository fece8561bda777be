"""Aggregates behind the exploratory tables and charts: distributions, crosstabs, histograms, densities."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from caseloom.functions.scalar import percent, ratio, seeded_hash
from caseloom.operators.ranks import hash_parts, settle, weighted_quantiles
from caseloom.operators.reshape import long_counts, to_long, union_all


def _count() -> Column:
    return F.count(F.lit(1))


def class_distribution(df: DataFrame, label: str = "label") -> DataFrame:
    """Rows and share per class; the share is a window over the aggregate of a few rows."""
    n = df.groupBy(label).agg(_count().alias("n"))
    whole = n.agg(F.sum("n")).scalar()
    return n.select(label, "n", percent(F.col("n"), whole, 2).alias("pct"))


def imbalance_table(tables: dict[str, DataFrame], label: str = "label", severe: float = 10.0) -> DataFrame:
    """Positives, negatives, positive share, ratio text and strategy, one row per dataset."""
    rows = []
    for name, df in tables.items():
        n = df.agg(_count().alias("total"), F.count_if(F.col(label) == 1).alias("positive"),
                   F.count_if(F.col(label) == 0).alias("negative"))
        odds = ratio(F.col("negative"), F.col("positive"))
        rows.append(n.select(
            F.lit(name).alias("dataset"), "total", "positive", "negative",
            percent(F.col("positive"), F.col("total"), 2).alias("positive_pct"),
            F.concat(F.lit("1 : "), F.format_number(odds, 1)).alias("imbalance_ratio"),
            F.when(odds <= severe, "class_weight=balanced").otherwise("SMOTE + scale_pos_weight (SEVERE)").alias("strategy")))
    return union_all(rows)


def crosstab(df: DataFrame, feature: str, label: str = "label", classes: Sequence = (0, 1)) -> DataFrame:
    """Counts of each class per feature value, and the row percentages. The classes are named, so no extra job."""
    n = df.groupBy(feature).agg(*[F.count_if(F.col(label) == c).alias(f"n_{c}") for c in classes])
    size = sum((F.col(f"n_{c}") for c in classes), F.lit(0))
    return n.select(feature, *[f"n_{c}" for c in classes], *[percent(F.col(f"n_{c}"), size, 2).alias(f"pct_{c}") for c in classes])


def crosstabs(df: DataFrame, features: Sequence[str], label: str = "label", classes: Sequence = (0, 1)) -> DataFrame:
    """The crosstab of many features in one pass, in long form."""
    long = to_long(df, features, [label], dtype="string")
    return crosstab(long.withColumn("_fv", F.struct("feature", "value")), "_fv", label, classes).select(
        "_fv.feature", "_fv.value", *[f"n_{c}" for c in classes], *[f"pct_{c}" for c in classes])


def two_key_shares(df: DataFrame, rows: str, columns: str, values: Sequence) -> DataFrame:
    """Sizes by two keys, spread over the column key (missing pairs are 0) and normalised per row."""
    sizes = df.groupBy(rows).pivot(columns, list(values)).agg(_count())
    filled = [F.coalesce(F.col(f"`{v}`"), F.lit(0)) for v in values]
    size = sum(filled, F.lit(0))
    return sizes.select(rows, *[f.alias(f"n_{v}") for f, v in zip(filled, values)],
                        *[percent(f, size, 2).alias(f"pct_{v}") for f, v in zip(filled, values)])


def rate_by(df: DataFrame, category: str, label: str = "label") -> DataFrame:
    """Sum, count and rate of the label per category."""
    return df.groupBy(category).agg(F.sum(label).cast("bigint").alias("positives"), F.count(label).alias("n"),
                                    percent(F.sum(label), F.count(label), 4).alias("rate"))


def class_means(df: DataFrame, features: Sequence[str], label: str = "label") -> DataFrame:
    """Mean of each feature per class, in long form."""
    return to_long(df, features, [label]).groupBy("feature", label).agg(F.avg("value").alias("mean"))


def sample_per_class(df: DataFrame, key: str | Sequence[str], label: str, size: int, seed: int = 42,
                     classes: Sequence | None = None) -> DataFrame:
    """The first ``size`` rows of each class in seeded hash order; classes not listed are kept whole.

    The hash at rank ``size`` is found first; only the rows up to it, ``size`` and ties of their hash, are ranked.
    """
    keys = [key] if isinstance(key, str) else list(key)
    ordered = df.withColumn("_h", seeded_hash(keys, seed))
    limited = ordered if classes is None else ordered.where(F.col(label).isin(list(classes)))
    within = hash_parts(limited, keys, label, [F.lit(size - 1)], seed).transform(limited, "_part", closed=True).where("_part = 0").drop("_part")
    picked = (within.withColumn("_r", F.row_number().over(W.partitionBy(label).orderBy("_h", *keys)))
              .where(F.col("_r") <= size).drop("_r"))
    if classes is not None:
        picked = picked.unionByName(ordered.where(~F.col(label).isin(list(classes))))
    return picked.drop("_h")


def histogram(df: DataFrame, value: str, by: str, low: float, high: float, bins: int) -> DataFrame:
    """Equal-width counts and density per class; values outside the range count in the first and last bin."""
    width = (high - low) / bins
    bin_ = F.greatest(F.lit(0), F.least(F.floor((F.col(value) - low) / width), F.lit(bins - 1))).cast("int")
    n = df.where(F.col(value).isNotNull()).groupBy(by, bin_.alias("bin")).agg(_count().alias("n"))
    share = F.col("n") / (F.sum("n").over(W.partitionBy(by)) * width)
    return n.select(by, "bin", (F.lit(low) + F.col("bin") * width).alias("bin_start"), "n", F.round(share, 8).alias("density"))


def box_stats(df: DataFrame, measures: Sequence[str], by: str, reach: float = 1.5) -> DataFrame:
    """Quartiles, whisker ends (the extreme values within ``reach`` IQR of the box) and the number of outliers."""
    counts = settle(long_counts(df, measures, [by]), "value", [by, "feature"])
    quarts = weighted_quantiles(counts, "value", "n", {"q1": 0.25, "median": 0.5, "q3": 0.75}, [by, "feature"], settled=True)
    box = quarts.select(F.col(by).alias("_g"), F.col("feature").alias("_f"), "q1", "median", "q3")
    span = F.lit(reach) * (F.col("q3") - F.col("q1"))
    near = F.col("value").between(F.col("q1") - span, F.col("q3") + span)
    return (counts.join(box, counts[by].eqNullSafe(box["_g"]) & counts["feature"].eqNullSafe(box["_f"]))
            .groupBy(by, "feature", "q1", "median", "q3")
            .agg(F.min(F.when(near, F.col("value"))).alias("whisker_low"), F.max(F.when(near, F.col("value"))).alias("whisker_high"),
                 F.sum(F.when(~near, F.col("n")).otherwise(0)).alias("outliers")))


def density(df: DataFrame, value: str, by: str, low: float, high: float, points: int = 50, bins: int = 512) -> DataFrame:
    """Gaussian kernel density per class on a grid, bandwidth by Scott's rule.

    The values are first counted into ``bins`` fine bins, so the kernel sum is over bins and not over rows; values outside
    the range count in the first and last one.
    """
    width = (high - low) / bins
    moments = df.where(F.col(value).isNotNull()).groupBy(by).agg(
        F.count(value).alias("_size"), (F.stddev_samp(value) * F.pow(F.count(value).cast("double"), F.lit(-0.2))).alias("_h"))
    bin_ = F.greatest(F.lit(0), F.least(F.floor((F.col(value) - low) / width), F.lit(bins - 1)))
    centre = F.lit(low) + (bin_ + 0.5) * width
    fine = df.where(F.col(value).isNotNull()).groupBy(F.col(by).alias("_by"), centre.alias("_c")).agg(_count().alias("_n"))
    step = (high - low) / (points - 1)
    grid = F.explode(F.transform(F.sequence(F.lit(0), F.lit(points - 1)), lambda i: F.lit(low) + i * F.lit(step)))
    z = (F.col("x") - F.col("_c")) / F.col("_h")
    return (fine.join(moments, fine["_by"].eqNullSafe(moments[by])).withColumn("x", grid)
            .groupBy(by, "x", "_size", "_h").agg(F.sum(F.col("_n") * F.exp(-0.5 * z * z)).alias("_k"))
            .select(by, "x", (F.col("_k") / (F.col("_size") * F.col("_h") * math.sqrt(2 * math.pi))).alias("density")))


def violin(df: DataFrame, value: str, by: str, low: float, high: float, points: int = 50) -> DataFrame:
    """Density per class with the class median and extremes on every grid point."""
    counts = df.where(F.col(value).isNotNull()).groupBy(by, F.col(value).cast("double").alias("_v")).agg(_count().alias("_n"))
    marks = weighted_quantiles(counts, "_v", "_n", {"median": 0.5}, [by], extra=[F.min("_v").alias("minimum"), F.max("_v").alias("maximum")])
    marks = marks.withColumnRenamed(by, "_g")
    shape = density(df, value, by, low, high, points)
    return shape.join(marks, shape[by].eqNullSafe(marks["_g"])).select(by, "x", "density", "minimum", "median", "maximum")


def metric_pivot(results: DataFrame, metric: str, datasets: Sequence[str], only: str | None = None,
                 model: str = "model", dataset: str = "dataset") -> DataFrame:
    """A model by dataset table of one metric, optionally for one dataset only."""
    kept = results.where(F.col(dataset) == only) if only else results
    names = [only] if only else list(datasets)
    return kept.groupBy(model).pivot(dataset, names).agg(F.first(metric, ignorenulls=True))


def modelling_inputs(df: DataFrame, dataset: str, split: str, label: str, features: int) -> DataFrame:
    """Train and test rows, positives, and the size of the training set once the minority is raised to the majority."""
    train = F.col(split) == "train"
    n = df.groupBy(dataset).agg(
        F.count_if(train).alias("train_rows"), F.count_if(F.col(split) == "test").alias("test_rows"),
        F.count_if(train & (F.col(label) == 1)).alias("train_positives"),
        F.count_if(train & (F.col(label) == 0)).alias("train_negatives"))
    return n.select(dataset, "train_rows", "test_rows", F.lit(features).alias("n_features"), "train_positives",
                    (2 * F.greatest("train_positives", "train_negatives")).alias("smote_rows"))
