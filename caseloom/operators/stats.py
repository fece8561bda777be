"""Contingency and rank tests, correlation. Many features are tested in one pass, in long form."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseloom.functions.scalar import chi2_upper, kolmogorov_upper, normal_two_sided, ratio
from caseloom.operators.ranks import prefix_sums
from caseloom.operators.reshape import to_long, union_all

ALPHA = 0.05
P_FLOOR = 1e-300
#: fixed values: up to these sizes the usual statistics libraries take exact probabilities
EXACT_ROWS, EXACT_WALK = 8, 10_000


def chi2_independence(df: DataFrame, features: Sequence[str], label: str = "label", alpha: float = ALPHA,
                      dtype: str = "string") -> DataFrame:
    """Chi-square test of independence of each feature and the 0/1 label, with Yates' correction for two values.

    One scan for all features and no join: with row sums r_v and class sizes N_c the statistic is
    N * sum_c (sum_v o_vc^2 / r_v) / N_c - N, and in a 2 x 2 table all |o - e| are equal, so the corrected value
    follows from one cell.
    """
    long = to_long(df, features, [label], dtype=dtype)
    table = (long.where(F.col("value").isNotNull() & F.col(label).isNotNull()).groupBy("feature", "value")
             .agg(F.count_if(F.col(label) == 0).alias("n0"), F.count_if(F.col(label) == 1).alias("n1"))
             .withColumn("r", (F.col("n0") + F.col("n1")).cast("double")))
    out = table.groupBy("feature").agg(
        F.sum(F.col("n0").cast("double") * F.col("n0") / F.col("r")).alias("a0"), F.sum(F.col("n1").cast("double") * F.col("n1") / F.col("r")).alias("a1"),
        F.sum("n0").alias("c0"), F.sum("n1").alias("c1"), F.count(F.lit(1)).alias("k"), F.max(F.struct("r", "n0")).alias("one"))
    n = (F.col("c0") + F.col("c1")).cast("double")
    plain = F.greatest(n * (F.try_divide("a0", "c0") + F.try_divide("a1", "c1")) - n, F.lit(0.0))
    gap = F.abs(F.col("one.n0") - F.col("one.r") * F.col("c0") / n)
    # the correction never overshoots the gap
    shrink = F.coalesce(F.try_divide(gap - F.least(F.lit(0.5), gap), gap), F.lit(0.0))
    dof = (F.col("k") - 1).cast("int")
    chi2 = F.when(dof == 1, plain * shrink * shrink).otherwise(plain)
    return out.select("feature", chi2.alias("chi2"), dof.alias("dof")).withColumn(
        "p_value", chi2_upper(F.col("chi2"), F.col("dof"))).withColumn("significant", F.col("p_value") < alpha)


def class_value_counts(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """(feature, value, n0, n1): the pre-aggregated input of every rank statistic."""
    long = to_long(df, features, [label]).where(F.col("value").isNotNull())
    return long.groupBy("feature", "value").agg(
        F.count_if(F.col(label) == 0).alias("n0"), F.count_if(F.col(label) == 1).alias("n1"))


def rank_sum_tail(u: float, m: int, n: int) -> float:
    """Two-sided probability of a Mann-Whitney U at least as far from its middle, by the number of arrangements without ties.

    The numbers by U are the coefficients of the product over i of (1 - q^(n + i)) / (1 - q^i), one factor for each row of the
    smaller sample; each step divides by the number of arrangements so far, so they stay probabilities.
    """
    m, n = min(m, n), max(m, n)
    share = np.zeros(m * n + 1)
    share[0] = 1.0
    for i in range(1, m + 1):
        share[n + i:] -= share[:-(n + i)].copy() if n + i < len(share) else 0.0
        for start in range(i):
            share[start::i] = np.cumsum(share[start::i])
        share *= i / (n + i)
    least = math.floor(min(u, m * n - u) + 1e-9)
    return float(min(1.0, 2.0 * share[:least + 1].sum()))


def two_sample_tail(ks: float, m: int, n: int) -> float:
    """Probability that two samples of one continuous distribution lie at least ``ks`` apart.

    All orders of the rows are equally likely, so a walk over the lattice takes the next row from a sample in proportion to what
    is left of it; what reaches the distance is taken out and added up. A step for each row, over the rows of one sample.
    """
    far = round(ks * m * n)
    if far <= 0:
        return 1.0
    i = np.arange(m + 1)
    inside, outside = np.zeros(m + 1), 0.0
    inside[0] = 1.0
    for t in range(m + n):  # rows taken so far: i of the first sample, t - i of the second
        left = np.clip(m - i, 0, None) / (m + n - t)
        ahead = np.where(t - i < n, inside * (1 - left), 0.0)
        ahead[1:] += (inside * left)[:-1]
        hit = np.abs(i * n - (t + 1 - i) * m) >= far
        outside += float(ahead[hit].sum())
        inside = np.where(hit, 0.0, ahead)
    return min(1.0, outside)


def mann_whitney(df: DataFrame, features: Sequence[str], label: str = "label", alpha: float = ALPHA,
                 cells: int | None = None, exact: bool = False) -> DataFrame:
    """Two-sided Mann-Whitney U of class 0 against class 1, with means and rank-biserial effect size.

    Normal approximation with tie and continuity correction. With ``exact``, features without ties in which one class has 8 rows
    or fewer get the exact probability (``rank_sum_tail``).
    """
    counts = class_value_counts(df, features, label)
    placed = prefix_sums(counts, "value", ["n0", "n1"], ["feature"], cells)
    tied = (F.col("n0") + F.col("n1")).cast("double")
    out = placed.groupBy("feature").agg(
        F.sum(F.col("n0") * (F.col("below_n1") + F.col("n1") / 2.0)).alias("u"),
        F.sum(tied * tied * tied - tied).alias("ties"),
        F.sum(F.col("value") * F.col("n0")).alias("s0"), F.sum(F.col("value") * F.col("n1")).alias("s1"),
        F.max("total_n0").cast("double").alias("m"), F.max("total_n1").cast("double").alias("k"))
    n = F.col("m") + F.col("k")
    variance = F.col("m") * F.col("k") / 12.0 * (n + 1 - F.try_divide(F.col("ties"), n * (n - 1)))
    z = F.try_divide(F.greatest(F.abs(F.col("u") - F.col("m") * F.col("k") / 2.0) - 0.5, F.lit(0.0)), F.sqrt(variance))
    p = normal_two_sided(z)
    if exact:  # one row a feature
        tail = F.udf(lambda u, m, k: None if u is None else rank_sum_tail(u, int(m), int(k)), "double")
        few = (F.col("ties") == 0) & (F.least("m", "k") <= EXACT_ROWS) & (F.least("m", "k") > 0)
        p = F.when(few, tail(F.when(few, F.col("u")), "m", "k")).otherwise(p)
    return out.select(
        "feature", ratio(F.col("s0"), F.col("m")).alias("mean_0"), ratio(F.col("s1"), F.col("k")).alias("mean_1"), "u",
        z.alias("z"), p.alias("p_value"),
        (F.lit(1.0) - ratio(2.0 * F.col("u"), F.col("m") * F.col("k"))).alias("effect_r"),
    ).withColumn("significant", F.col("p_value") < alpha)


def kolmogorov_smirnov(df: DataFrame, features: Sequence[str], group: str, first, second, alpha: float = ALPHA,
                       cells: int | None = None, exact: bool = False) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov test between two groups (for example train and test), asymptotic p. With ``exact``, features
    with at most 10,000 rows a group get the exact probability (``two_sample_tail``)."""
    side = F.when(F.col(group) == first, 0).when(F.col(group) == second, 1)
    pair = df.select(*features, side.alias("_side")).where(F.col("_side").isNotNull())
    placed = prefix_sums(class_value_counts(pair, features, "_side"), "value", ["n0", "n1"], ["feature"], cells)
    gap = F.abs((F.col("below_n0") + F.col("n0")) / F.col("total_n0") - (F.col("below_n1") + F.col("n1")) / F.col("total_n1"))
    out = placed.groupBy("feature").agg(F.max(gap).alias("ks"), F.max("total_n0").alias("m"), F.max("total_n1").alias("k"))
    effective = F.sqrt(F.col("m") * F.col("k") / (F.col("m") + F.col("k")))
    p = kolmogorov_upper(effective * F.col("ks"))
    if exact:  # one row a feature
        tail = F.udf(lambda ks, m, k: None if ks is None or m is None else two_sample_tail(ks, int(m), int(k)), "double")
        few = F.greatest("m", "k") <= EXACT_WALK
        p = F.when(few, tail("ks", F.when(few, F.col("m")), "k")).otherwise(p)
    return out.select("feature", "ks", p.alias("p_value")).withColumn(
        "status", F.when(F.col("p_value") > alpha, "OK").otherwise("WARNING"))


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Lower triangle of the Pearson matrix as (a, b, r). All pairs are aggregated in one scan."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[:i]]
    wide = df.agg(*[F.corr(F.col(f"`{a}`").cast("double"), F.col(f"`{b}`").cast("double")).alias(f"{i}")
                    for i, (a, b) in enumerate(pairs)])
    names = F.create_map(*[x for i, (a, b) in enumerate(pairs)
                           for x in (F.lit(str(i)), F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")))])
    ids = [F.col(f"`{i}`") for i in range(len(pairs))]
    return wide.unpivot([], ids, "i", "r").select(F.element_at(names, F.col("i")).alias("p"), "r").select("p.a", "p.b", "r")


def target_correlation(df: DataFrame, features: Sequence[str], label: str = "label") -> DataFrame:
    """Absolute correlation of each feature with the label, strongest first."""
    wide = df.agg(*[F.corr(F.col(f"`{c}`").cast("double"), F.col(label).cast("double")).alias(c) for c in features])
    long = wide.unpivot([], [F.col(f"`{c}`") for c in features], "feature", "r")
    return long.select("feature", F.abs("r").alias("abs_r")).orderBy(F.desc("abs_r"), "feature")


def significance_table(tests: dict[str, DataFrame], alpha: float = ALPHA) -> DataFrame:
    """-log10 of the p values of many tests, strongest first. Each frame has ``feature`` and ``p_value``."""
    stacked = union_all([t.select(F.concat(F.lit(f"{name} — "), "feature").alias("test"), "p_value") for name, t in tests.items()])
    return stacked.select(
        "test", "p_value", (-F.log10(F.greatest("p_value", F.lit(P_FLOOR)))).alias("neg_log10_p"),
        (F.col("p_value") < alpha).alias("significant")).orderBy(F.desc("neg_log10_p"), "test")


def split_ratio_check(df: DataFrame, split: str, label: str = "label", tolerance: float = 1.0) -> DataFrame:
    """Negatives per positive in train and test, and whether they agree."""
    def odds(part: str) -> Column:
        here = F.col(split) == part
        return ratio(F.count_if(here & (F.col(label) == 0)), F.count_if(here & (F.col(label) == 1)))
    out = df.agg(odds("train").alias("train_ratio"), odds("test").alias("test_ratio"))
    return out.withColumn("maintained", F.abs(F.col("train_ratio") - F.col("test_ratio")) < tolerance)


def moments(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Mean and population standard deviation per column."""
    long = to_long(df, columns)
    return long.groupBy("feature").agg(F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"))


