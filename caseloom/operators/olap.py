"""OLAP reports over a star: summaries, roll-up, slice, dice, prevalence, risk tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from caseloom.functions.scalar import decode, left_closed_bin, percent, ratio, total
from caseloom.operators.ranks import quantiles
from caseloom.operators.reshape import union_all
from caseloom.operators.star import Star

# Bracket edges and names of the reports, and the severity and strategy texts.
AGE_EDGES = [18.0, 40.0, 60.0, 80.0]
AGE_NAMES = ["0–17   (Paediatric)", "18–39  (Young Adult)", "40–59  (Middle-Aged)",
             "60–79  (Older Adult)", "80+    (Elderly)"]
COARSE_EDGES = [40.0, 60.0, 80.0]
COARSE_NAMES = ["Under 40", "40–59", "60–79", "80+"]
MILD = "MILD    — use class_weight=balanced"
MODERATE = "MODERATE — apply SMOTE"
SEVERE = "SEVERE  — SMOTE + scale_pos_weight required"


def _count() -> Column:
    return F.count(F.lit(1))


def _sum(c: str | Column) -> Column:
    return F.sum(c).cast("bigint")


# --- summaries over the whole star ---------------------------------------------------------------------------

def cohort_summary(star: Star, age: str = "age", flag: str = "gender") -> DataFrame:
    """Total, positives, positive %, average age and share of the flag per cohort.

    The facts are stacked into one thin (key, source, label) table first, so the dimension is joined once however
    many facts there are. Dimension rows without a fact still count.
    """
    labels = star.labels()
    joined = star.dim.select(star.key, star.source, age, flag).join(labels, [star.key, star.source], "left")
    return joined.groupBy(F.col(star.source).alias("disease")).agg(
        _count().alias("total_patients"),
        _sum(star.label).alias("positive_cases"),
        percent(F.sum(star.label), _count(), 2).alias("positive_pct"),
        F.round(F.avg(age), 1).alias("avg_age"),
        percent(F.sum(flag), _count(), 1).alias("pct_male"))


def cohort_summary_by_joins(star: Star, age: str = "age", flag: str = "gender") -> DataFrame:
    """The same summary written as one left join per fact, each restricted to its own cohort."""
    joined, label = star.dim, None
    for name, fact in star.facts.items():
        source = star.source_of(name)
        own = fact.select(F.col(star.key).alias(f"_k_{name}"), F.col(star.label).alias(f"_l_{name}"))
        joined = joined.join(own, (F.col(star.key) == F.col(f"_k_{name}")) & (F.col(star.source) == source), "left")
        hit = F.col(star.source) == source
        label = F.when(hit, F.col(f"_l_{name}")) if label is None else label.when(hit, F.col(f"_l_{name}"))
    return joined.groupBy(F.col(star.source).alias("disease")).agg(
        _count().alias("total_patients"), _sum(label).alias("positive_cases"),
        percent(F.sum(label), _count(), 2).alias("positive_pct"), F.round(F.avg(age), 1).alias("avg_age"),
        percent(F.sum(flag), _count(), 1).alias("pct_male"))


def cohort_profile(dim: DataFrame, group: str = "source_dataset", age: str = "age", flag: str = "gender",
                   cells: int | None = None) -> DataFrame:
    """Size, age range, mean, lower median and flag shares per cohort."""
    base = dim.groupBy(F.col(group).alias("disease_cohort")).agg(
        _count().alias("total_patients"), F.round(F.min(age), 1).alias("min_age"), F.round(F.max(age), 1).alias("max_age"),
        F.round(F.avg(age), 2).alias("avg_age"), percent(F.sum(flag), _count(), 1).alias("pct_male"),
        percent(F.sum(1 - F.col(flag)), _count(), 1).alias("pct_female"))
    median = lower_median(dim, age, group, cells).select(F.col(group).alias("_g"), F.round("median", 1).alias("approx_median_age"))
    return base.join(median, base["disease_cohort"].eqNullSafe(median["_g"]), "left").select(
        "disease_cohort", "total_patients", "min_age", "max_age", "avg_age", "approx_median_age", "pct_male", "pct_female")


def lower_median(df: DataFrame, value: str, group: str, cells: int | None = None) -> DataFrame:
    """The value at offset (n - 1) / 2 of the sorted group."""
    return quantiles(df, value, {"median": 0.5}, [group], "lower", cells)


def rollup_share(dim: DataFrame, group: str = "source_dataset", age: str = "age") -> DataFrame:
    """Rows per cohort and age bracket with the share inside the cohort. The window runs over the aggregate."""
    bracket = left_closed_bin(F.col(age), AGE_EDGES, AGE_NAMES)
    n = dim.groupBy(F.col(group).alias("disease"), bracket.alias("age_bracket")).agg(_count().alias("patient_count"))
    share = percent(F.col("patient_count"), F.sum("patient_count").over(W.partitionBy("disease")), 1)
    return n.select("disease", "age_bracket", "patient_count", share.alias("pct_within_disease"))


def flag_balance(dim: DataFrame, group: str = "source_dataset", flag: str = "gender") -> DataFrame:
    """Counts and shares of a flag per cohort, balanced when the share is within 10 points of one half."""
    n = dim.groupBy(F.col(group).alias("disease")).agg(
        _sum(flag).alias("male_count"), _sum(1 - F.col(flag)).alias("female_count"), _count().alias("total"))
    share = percent(F.col("male_count"), F.col("total"))
    return n.select("*", F.round(share, 2).alias("pct_male"),
                    percent(F.col("female_count"), F.col("total"), 2).alias("pct_female"),
                    F.when(F.abs(F.lit(50.0) - share) < 10, "Balanced").otherwise("Imbalanced").alias("gender_balance"))


def prevalence_dashboard(summary: DataFrame) -> DataFrame:
    """Totals, positives, negatives, rate and imbalance ratio from a cohort summary."""
    negatives = F.col("total_patients") - F.col("positive_cases")
    return summary.select(
        "disease", "total_patients", "positive_cases", negatives.alias("negative_cases"),
        F.col("positive_pct").alias("positive_rate_pct"),
        ratio(negatives, F.col("positive_cases"), 2).alias("imbalance_ratio"), "avg_age", "pct_male",
    ).orderBy(F.desc("positive_rate_pct"), "disease")


def imbalance_classes(summary: DataFrame, classify_rounded: bool = False) -> DataFrame:
    """Negative-to-positive ratio and the resampling strategy it calls for; no positives counts as severe.

    ``classify_rounded`` compares the ratio after rounding to one decimal.
    """
    negatives = F.col("total_patients") - F.col("positive_cases")
    exact = ratio(negatives, F.col("positive_cases"))
    rounded = F.round(exact, 1)
    judged = rounded if classify_rounded else exact
    return summary.select(
        "disease", "positive_cases", negatives.alias("negative_cases"), rounded.alias("neg_to_pos_ratio"),
        F.when(judged < 3, MILD).when(judged.between(3, 10), MODERATE).otherwise(SEVERE).alias("recommended_strategy"),
    ).orderBy(F.desc("neg_to_pos_ratio"), "disease")


def outcome_demographics(star: Star, names: dict[str, tuple[str, str]], age: str = "age",
                         flag: str = "gender") -> DataFrame:
    """Size, average age and flag share per cohort and outcome. ``names``: source to (positive, negative) text."""
    joined = star.labels().join(star.dim.select(star.key, age, flag), star.key)
    n = joined.groupBy(star.source, star.label).agg(
        _count().alias("n"), F.round(F.avg(age), 1).alias("avg_age"), percent(F.sum(flag), _count(), 1).alias("pct_male"))
    text = None
    for source, (positive, negative) in names.items():
        name = F.when(F.col(star.label) == 1, positive).otherwise(negative)
        hit = F.col(star.source) == source
        text = F.when(hit, name) if text is None else text.when(hit, name)
    return n.select(F.col(star.source).alias("disease"), text.alias("diagnosis"), "n", "avg_age", "pct_male")


def unified_summary(star: Star, titles: dict[str, tuple[str, str]], age: str = "age", flag: str = "gender") -> DataFrame:
    """One row per cohort with its title and its main risk indicator. ``titles``: source to (title, indicator)."""
    joined = star.labels().join(star.dim.select(star.key, age, flag), star.key)
    n = joined.groupBy(star.source).agg(
        _count().alias("total"), _sum(star.label).alias("positives"), F.round(F.avg(age), 1).alias("avg_age"),
        percent(F.sum(flag), _count(), 1).alias("pct_male"), percent(F.sum(star.label), _count(), 2).alias("prevalence_pct"))
    source = F.col(star.source)
    return n.select(
        decode(source, {s: t for s, (t, _) in titles.items()}).alias("disease"), "total", "positives", "avg_age",
        "pct_male", "prevalence_pct",
        decode(source, {s: i for s, (_, i) in titles.items()}).alias("primary_risk_indicator"))


# --- one cohort ----------------------------------------------------------------------------------------------

def score_stats(fact: DataFrame, score: str, threshold: float, names: tuple[str, str], label: str = "label") -> DataFrame:
    """Range, mean and share at or above the threshold of a score, per outcome."""
    above = F.count_if(F.col(score) >= threshold)
    return fact.groupBy(label).agg(
        _count().alias("n"), F.min(score).alias("min_score"), F.max(score).alias("max_score"),
        F.round(F.avg(score), 2).alias("avg_score"), above.alias("above_threshold"),
        percent(above, _count(), 1).alias("pct_above_threshold"),
    ).select(F.when(F.col(label) == 1, names[0]).otherwise(names[1]).alias("diagnosis"), "n", "min_score", "max_score",
             "avg_score", "above_threshold", "pct_above_threshold")


def _class_rates(fact: DataFrame, flags: Sequence[str], label: str, name: str) -> DataFrame:
    """(flag, rate in positives, rate in negatives) as unrounded percentages: one scan, then one row is unpivoted."""
    def rate(c: str, outcome: int) -> Column:
        return F.avg(F.when(F.col(label) == outcome, F.col(f"`{c}`") * 100.0))
    wide = fact.agg(*[F.struct(rate(c, 1).alias("pos"), rate(c, 0).alias("neg")).alias(c) for c in flags])
    long = wide.unpivot([], [F.col(f"`{c}`") for c in flags], name, "_r")
    return long.select(name, F.col("_r.pos").alias("_pos"), F.col("_r.neg").alias("_neg"))


def response_rates(fact: DataFrame, items: Sequence[str], label: str = "label") -> DataFrame:
    """Share of 1 per item and outcome with the gap in points, widest gap first."""
    rates = _class_rates(fact, items, label, "item")
    return rates.select(
        F.upper("item").alias("item"), F.round("_pos", 1).alias("pct_pos"), F.round("_neg", 1).alias("pct_neg"),
        F.round(F.col("_pos") - F.col("_neg"), 1).alias("gap_pp")).orderBy(F.desc("gap_pp"), "item")


def prevalence_gap(fact: DataFrame, flags: Sequence[str], label: str = "label", high: float = 30.0, moderate: float = 15.0,
                   names: tuple[str, str] = ("pct_in_positive", "pct_in_negative")) -> DataFrame:
    """Prevalence per flag and outcome, the gap, and how well the flag separates the outcomes."""
    rates = _class_rates(fact, flags, label, "symptom")
    gap = F.col("_pos") - F.col("_neg")
    power = (F.when(gap > high, "HIGH discriminative power").when(gap > moderate, "MODERATE discriminative power")
             .otherwise("LOW discriminative power"))
    return rates.select(
        "symptom", F.round("_pos", 1).alias(names[0]), F.round("_neg", 1).alias(names[1]),
        F.round(gap, 1).alias("gap_percentage_points"), power.alias("discriminative_power"),
    ).orderBy(F.desc("gap_percentage_points"), "symptom")


def class_gap_top(fact: DataFrame, flags: Sequence[str], k: int, label: str = "label") -> DataFrame:
    """The k flags whose rate differs most between the outcomes."""
    return (_class_rates(fact, flags, label, "feature")
            .select("feature", F.round(F.col("_pos") - F.col("_neg"), 4).alias("gap"))
            .orderBy(F.desc("gap"), "feature").limit(k))


def risk_profile(fact: DataFrame, dim: DataFrame, key: str, means: dict[str, tuple[str, int]], rates: dict[str, str],
                 names: tuple[str, str], label: str = "label") -> DataFrame:
    """Means and flag rates per outcome. ``means``: output to (column, digits); ``rates``: output to flag."""
    joined = fact.join(dim, key)
    n = joined.groupBy(label).agg(
        _count().alias("n"), *[F.round(F.avg(c), d).alias(o) for o, (c, d) in means.items()],
        *[percent(F.sum(c), _count(), 1).alias(o) for o, c in rates.items()])
    return n.select(F.when(F.col(label) == 1, names[0]).otherwise(names[1]).alias("outcome"), "n", *means, *rates)


def incidence_vs_average(fact: DataFrame, category: str, label: str = "label") -> DataFrame:
    """Cases and rate per category, compared with the overall rate; both rates are rounded before the comparison.

    The overall rate is a scalar subquery over the same aggregate, so the fact is scanned once.
    """
    n = fact.groupBy(category).agg(_count().alias("total_patients"), _sum(label).alias("cases"))
    rate = percent(F.col("cases"), F.col("total_patients"), 2)
    overall = n.agg(percent(F.sum("cases"), F.sum("total_patients"), 2)).scalar()
    return n.select(
        category, "total_patients", "cases", (F.col("total_patients") - F.col("cases")).alias("non_cases"),
        rate.alias("rate_pct"),
        F.when(rate > overall, "ABOVE average risk").otherwise("Below average risk").alias("vs_average"))


def comorbidity_matrix(fact: DataFrame, first: tuple[str, str], second: tuple[str, str], label: str = "label") -> DataFrame:
    """Cases and rate for the four combinations of two flags and their share of all cases.

    ``first`` and ``second`` are (column, title).
    """
    n = fact.groupBy(first[0], second[0]).agg(_count().alias("total_patients"), _sum(label).alias("cases"))
    cases = n.agg(F.sum("cases")).scalar()

    def status(column: str, title: str) -> Column:
        return F.concat(F.lit(f"{title}: "), F.when(F.col(column) == 1, "Yes").otherwise("No")).alias(f"{column}_status")
    return n.select(
        status(*first), status(*second), "total_patients", "cases",
        percent(F.col("cases"), F.col("total_patients"), 2).alias("rate_pct"),
        percent(F.col("cases"), cases, 1).alias("pct_of_all_cases")).orderBy(F.desc("rate_pct"))


# --- roll-up, slice, dice ------------------------------------------------------------------------------------

def bracket_category_rates(fact: DataFrame, dim: DataFrame, key: str, category: str, age: str = "age",
                           label: str = "label", top: int | None = None, totals: bool = False) -> DataFrame:
    """Cases and rate per coarse age bracket and category.

    ``totals`` adds the bracket totals and the grand total (category or bracket NULL, ``level`` tells them apart);
    ``top`` keeps the highest rates, ties broken by bracket and category.
    """
    joined = fact.select(key, category, label).join(dim.select(key, age), key)
    rows = joined.select(left_closed_bin(F.col(age), COARSE_EDGES, COARSE_NAMES).alias("age_bracket"), category, label)
    grouped = rows.rollup("age_bracket", category) if totals else rows.groupBy("age_bracket", category)
    level = [F.grouping_id().cast("int").alias("level")] if totals else []
    n = grouped.agg(_count().alias("patients"), _sum(label).alias("cases"), *level)
    out = n.select("age_bracket", category, "patients", "cases", percent(F.col("cases"), F.col("patients"), 2).alias("rate_pct"),
                   *(["level"] if totals else []))
    out = out.orderBy(F.desc("rate_pct"), "age_bracket", category)
    return out.limit(top) if top else out


def case_registry(fact: DataFrame, dim: DataFrame, key: str, shown: dict[str, Column], risk: Sequence[Column],
                  age: str = "age", label: str = "label", top: int = 20) -> DataFrame:
    """Positive cases ordered by an additive risk score, then age, then key: sort and limit are one operator."""
    cases = fact.where(F.col(label) == 1).join(dim, key)
    score = total([F.when(r, 1).otherwise(0) for r in risk])
    return (cases.withColumn("risk_factor_score", score)
            .orderBy(F.desc("risk_factor_score"), F.desc(age), key).limit(top)
            .select(key, *[e.alias(n) for n, e in shown.items()], "risk_factor_score"))


@dataclass(frozen=True)
class Subgroup:
    """A dice: the fact, the predicate over fact and dimension columns, and the reported aggregates."""

    title: str
    fact: DataFrame
    where: Column
    report: dict[str, Column] = field(default_factory=dict)


def dice(subgroups: Sequence[Subgroup], dim: DataFrame, key: str, age: str = "age") -> DataFrame:
    """Size and reported aggregates per subgroup; a column that a subgroup does not report is NULL."""
    rows = [s.fact.join(dim, key).where(s.where).agg(
        _count().alias("patients"), F.round(F.avg(age), 1).alias("avg_age"), *[e.alias(n) for n, e in s.report.items()],
    ).select(F.lit(s.title).alias("subgroup"), "*") for s in subgroups]
    return union_all(rows, allow_missing=True)
