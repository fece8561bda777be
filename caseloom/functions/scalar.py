"""Column helpers shared by the operators. All of them stay inside Catalyst; none calls Python per row."""

from __future__ import annotations

import math
from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_BITS = 60
UNIT_BITS = 52


def ratio(numerator: Column, denominator: Column, digits: int | None = None) -> Column:
    """numerator / denominator as a double, NULL where the denominator is zero."""
    out = F.try_divide(numerator.cast("double"), denominator.cast("double"))
    return out if digits is None else F.round(out, digits)


def percent(part: Column, whole: Column, digits: int | None = None) -> Column:
    """100 * part / whole as a double, NULL where the whole is zero."""
    out = F.try_divide(F.lit(100.0) * part, whole.cast("double"))
    return out if digits is None else F.round(out, digits)


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """numerator / denominator with zero division giving 0, the usual convention for model metrics."""
    return F.coalesce(ratio(numerator, denominator), F.lit(0.0))


def total(columns: list[Column]) -> Column:
    """Row-wise sum."""
    return reduce(add, columns)


def seeded_hash(key: str | Column | list, seed: int = 42) -> Column:
    """A repeatable pseudo-random long in [0, 2^60) that depends only on the key and the seed.

    md5 rather than an engine-specific hash: the same rows are chosen on every run, every partitioning and in
    every SQL engine.
    """
    keys = key if isinstance(key, (list, tuple)) else [key]
    parts = [(F.col(k) if isinstance(k, str) else k).cast("string") for k in keys]
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts, F.lit(str(seed)))), 1, 15), 16, 10).cast("bigint")


def seeded_uniform(key: str | Column | list, seed: int = 42) -> Column:
    """A repeatable double in [0, 1) with 52 random bits."""
    return F.shiftright(seeded_hash(key, seed), HASH_BITS - UNIT_BITS) / F.lit(float(1 << UNIT_BITS))


def right_closed_bin(value: Column, edges: list[float], labels: list[str]) -> Column:
    """Label of the interval (edge[i], edge[i+1]] that holds the value; NULL outside all of them."""
    branch = None
    for low, high, label in zip(edges, edges[1:], labels):
        inside = value > F.lit(low)
        if not math.isinf(high):
            inside = inside & (value <= F.lit(high))
        branch = F.when(inside, label) if branch is None else branch.when(inside, label)
    return branch


def left_closed_bin(value: Column, edges: list[float], labels: list[str]) -> Column:
    """Label by upper edges: value < edges[0] gets labels[0], ..., everything else the last label."""
    branch = F.when(value < F.lit(edges[0]), labels[0])
    for edge, label in zip(edges[1:], labels[1:]):
        branch = branch.when(value < F.lit(edge), label)
    return branch.otherwise(labels[-1])


def decode(value: Column, names: dict, default: str | None = None) -> Column:
    """Code to label, with a default for every other value and for NULL."""
    branch = None
    for code, name in names.items():
        hit = value == F.lit(code)
        branch = F.when(hit, name) if branch is None else branch.when(hit, name)
    return branch.otherwise(F.lit(default))


# Coefficients of the rational Chebyshev fit to erfc (Numerical Recipes, section 6.2).
_ERFC = [-1.26551223, 1.00002368, 0.37409196, 0.09678418, -0.18628806,
         0.27886807, -1.13520398, 1.48851587, -0.82215223, 0.17087277]


def erfc(x: Column) -> Column:
    """Complementary error function for x >= 0; the relative error stays below 1.2e-7."""
    t = F.lit(1.0) / (F.lit(1.0) + F.lit(0.5) * x)
    poly = F.lit(_ERFC[-1])
    for coefficient in reversed(_ERFC[:-1]):
        poly = F.lit(coefficient) + t * poly
    return t * F.exp(-x * x + poly)


def normal_two_sided(z: Column) -> Column:
    """P(|Z| >= |z|) for a standard normal Z."""
    return F.least(F.lit(1.0), erfc(F.abs(z) / F.lit(math.sqrt(2.0))))


def chi2_upper(x: Column, dof: Column) -> Column:
    """P(X >= x) for chi-squared X: the finite sums for odd and even degrees of freedom."""
    x = x.cast("double")
    density = F.exp(-x / 2.0)
    half = F.floor(dof / 2).cast("int")
    start = F.struct(F.lit(1.0).alias("term"), F.lit(0.0).alias("sum"))

    def step(first: Column):
        def run(acc: Column, r: Column) -> Column:
            term = acc["term"] * first(r)
            return F.struct(term.alias("term"), (acc["sum"] + term).alias("sum"))
        return run

    def series(count: Column, factor) -> Column:
        return F.when(count > 0, F.aggregate(F.sequence(F.lit(1), F.greatest(count, F.lit(1))), start,
                                             step(factor), lambda acc: acc["sum"])).otherwise(0.0)

    odd_sum = series(half, lambda r: F.when(r == 1, F.sqrt(x)).otherwise(x / (2 * r - 1)))
    even_sum = series(half - 1, lambda r: x / (2 * r))
    odd = erfc(F.sqrt(x / 2.0)) + F.lit(2.0 / math.sqrt(2.0 * math.pi)) * density * odd_sum
    even = density * (F.lit(1.0) + even_sum)
    return F.least(F.lit(1.0), F.when(dof % 2 == 1, odd).otherwise(even))


def kolmogorov_upper(lam: Column, terms: int = 100) -> Column:
    """Upper tail of the Kolmogorov distribution, 2 * sum (-1)^(k-1) exp(-2 k^2 lambda^2)."""
    summed = F.aggregate(
        F.sequence(F.lit(1), F.lit(terms)), F.lit(0.0),
        lambda acc, k: acc + F.when(k % 2 == 1, 1.0).otherwise(-1.0) * F.exp(-2.0 * k * k * lam * lam))
    return F.when(lam < 0.2, 1.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), 2.0 * summed)))
