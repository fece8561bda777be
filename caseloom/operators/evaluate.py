"""Evaluation of a predictions table: confusion counts, metrics, ROC and PR curves, thresholds, comparisons.

A predictions table has one row per scored row: ``label`` 0/1, ``probability``, ``prediction`` 0/1, and any grouping
columns such as ``model``, ``dataset`` and ``fold``. Everything is computed per group in one aggregate.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseloom.functions.scalar import ratio, safe_ratio
from caseloom.operators.ranks import CELL, prefix_sums, settle
from caseloom.operators.reshape import union_all

# The threshold grid 0.05 .. 0.95, the precision floor of the clinical threshold, the overfit gap.
SWEEP = [round(0.05 + 0.01 * i, 2) for i in range(91)]
CLINICAL_PRECISION = 0.20
CLINICAL_DEFAULT = 0.5
OVERFIT_GAP = 0.05


def confusion(predictions: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """tn, fp, fn, tp per group."""
    truth, guess = F.col("label"), F.col("prediction")

    def cell(t: int, g: int) -> Column:
        return F.count_if((truth == t) & (guess == g))
    return predictions.groupBy(*group).agg(
        cell(0, 0).alias("tn"), cell(0, 1).alias("fp"), cell(1, 0).alias("fn"), cell(1, 1).alias("tp"))


def _f1(precision: Column, recall: Column) -> Column:
    return safe_ratio(2.0 * precision * recall, precision + recall)


def metric_columns() -> dict[str, Column]:
    """Closed forms over tn, fp, fn, tp. A zero denominator gives 0."""
    tn, fp, fn, tp = (F.col(c).cast("double") for c in ("tn", "fp", "fn", "tp"))
    n = tn + fp + fn + tp
    precision, recall = safe_ratio(tp, tp + fp), safe_ratio(tp, tp + fn)
    precision0, recall0 = safe_ratio(tn, tn + fn), safe_ratio(tn, tn + fp)
    pos, neg = safe_ratio(tp + fn, n), safe_ratio(tn + fp, n)
    mcc = safe_ratio(tp * tn - fp * fn, F.sqrt(tp + fp) * F.sqrt(tp + fn) * F.sqrt(tn + fp) * F.sqrt(tn + fn))
    return {
        "accuracy": safe_ratio(tp + tn, n), "precision": precision, "recall": recall, "f1": _f1(precision, recall),
        "specificity": recall0, "mcc": mcc,
        "weighted_precision": pos * precision + neg * precision0,
        "weighted_recall": pos * recall + neg * recall0,
        "weighted_f1": pos * _f1(precision, recall) + neg * _f1(precision0, recall0),
    }


def _metrics_of(counts: DataFrame, group: Sequence[str], digits: int | None) -> DataFrame:
    columns = metric_columns()
    if digits is not None:
        columns = {k: F.round(v, digits) for k, v in columns.items()}
    return counts.select(*group, "tn", "fp", "fn", "tp", *[v.alias(k) for k, v in columns.items()])


def metrics(predictions: DataFrame, group: Sequence[str] = (), digits: int | None = None) -> DataFrame:
    """Binary and class-weighted metrics per group."""
    return _metrics_of(confusion(predictions, group), group, digits)


def class_report(predictions: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """precision, recall, f1 and support for class 0, class 1, the macro and the weighted average."""
    tn, fp, fn, tp = (F.col(c).cast("double") for c in ("tn", "fp", "fn", "tp"))
    p0, r0, s0 = safe_ratio(tn, tn + fn), safe_ratio(tn, tn + fp), tn + fp
    p1, r1, s1 = safe_ratio(tp, tp + fp), safe_ratio(tp, tp + fn), tp + fn
    f0, f1 = _f1(p0, r0), _f1(p1, r1)
    n = s0 + s1

    def entry(name: str, p: Column, r: Column, f: Column, s: Column) -> Column:
        return F.struct(F.lit(name).alias("class"), p.alias("precision"), r.alias("recall"), f.alias("f1"),
                        s.cast("bigint").alias("support"))

    def weighted(a: Column, b: Column) -> Column:
        return safe_ratio(a * s0 + b * s1, n)
    rows = F.array(entry("0", p0, r0, f0, s0), entry("1", p1, r1, f1, s1),
                   entry("macro avg", (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, n),
                   entry("weighted avg", weighted(p0, p1), weighted(r0, r1), weighted(f0, f1), n))
    return confusion(predictions, group).select(*group, F.inline(rows))


def _score_counts(predictions: DataFrame, group: Sequence[str], cells: int | None) -> DataFrame:
    counts = predictions.where(F.col("probability").isNotNull()).groupBy(*group, "probability").agg(
        F.count_if(F.col("label") == 0).alias("n0"), F.count_if(F.col("label") == 1).alias("n1"))
    return _above(counts, group, cells)


def _above(counts: DataFrame, group: Sequence[str], cells: int | None = None, settled: bool = False) -> DataFrame:
    placed = prefix_sums(counts, "probability", ["n0", "n1"], group, cells, settled)
    return placed.withColumns({"tp": F.col("total_n1") - F.col("below_n1"), "fp": F.col("total_n0") - F.col("below_n0")})


def roc_points(predictions: DataFrame, group: Sequence[str] = (), cells: int | None = None) -> DataFrame:
    """(threshold, fpr, tpr) at every distinct score, from one distributed prefix sum."""
    return _score_counts(predictions, group, cells).select(
        *group, F.col("probability").alias("threshold"), ratio(F.col("fp"), F.col("total_n0")).alias("fpr"),
        ratio(F.col("tp"), F.col("total_n1")).alias("tpr"))


def pr_points(predictions: DataFrame, group: Sequence[str] = (), cells: int | None = None) -> DataFrame:
    """(threshold, precision, recall) at every distinct score."""
    return _score_counts(predictions, group, cells).select(
        *group, F.col("probability").alias("threshold"), ratio(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
        ratio(F.col("tp"), F.col("total_n1")).alias("recall"))


def ranking_scores(predictions: DataFrame, group: Sequence[str] = (), cells: int | None = None) -> DataFrame:
    """ROC AUC (ties count half) and average precision, sum of (R_i - R_i-1) * P_i, per group."""
    return _areas(_score_counts(predictions, group, cells), group)


def _areas(at: DataFrame, group: Sequence[str]) -> DataFrame:
    wins = F.sum(F.col("n1") * (F.col("below_n0") + F.col("n0") / 2.0))
    steps = F.sum(F.col("n1") * F.col("tp") / (F.col("tp") + F.col("fp")))
    return at.groupBy(*group).agg(wins.alias("w"), steps.alias("s"), F.max("total_n0").alias("m"), F.max("total_n1").alias("k")).select(
        *group, ratio(F.col("w"), F.col("m").cast("double") * F.col("k")).alias("roc_auc"), ratio(F.col("s"), F.col("k")).alias("pr_auc"))


def full_evaluation(predictions: DataFrame, group: Sequence[str], digits: int = 4) -> DataFrame:
    """Metrics and ranking scores per group. Groups without probabilities get 0 for both areas.

    The predictions are read once: both sides come from the counts per group and probability, which are written.
    """
    cells = ("tn", "fp", "fn", "tp")
    counted = confusion(predictions, [*group, "probability"])
    written = settle(counted, "probability", group)
    left = _metrics_of(written.groupBy(*group).agg(*[F.sum(c).alias(c) for c in cells]), group, digits)
    classes = written.where(F.col("probability").isNotNull()).select(
        *group, "probability", CELL, (F.col("tn") + F.col("fp")).alias("n0"), (F.col("fn") + F.col("tp")).alias("n1"))
    right = _areas(_above(classes, group, settled=True), group).select(
        *[F.col(g).alias(f"_{g}") for g in group], F.round("roc_auc", digits).alias("roc_auc"), F.round("pr_auc", digits).alias("pr_auc"))
    on = [left[g].eqNullSafe(right[f"_{g}"]) for g in group]
    joined = left.join(right, on, "left")
    return joined.withColumns({c: F.coalesce(c, F.lit(0.0)) for c in ("roc_auc", "pr_auc")}).drop(*[f"_{g}" for g in group])


def fold_scores(predictions: DataFrame, group: Sequence[str], fold: str = "fold", metric: str = "f1") -> DataFrame:
    """Mean and population standard deviation of a metric over the folds."""
    per_fold = metrics(predictions, [*group, fold])
    return per_fold.groupBy(*group).agg(F.avg(metric).alias("cv_mean"), F.stddev_pop(metric).alias("cv_std"),
                                        F.count(F.lit(1)).alias("n_folds"))


def thresholds_reached(probability: Column, thresholds: Sequence[float]) -> Column:
    """How many ascending thresholds are <= the probability.

    On an even grid the position is computed and then corrected against the exact neighbours; any other list is
    searched.
    """
    cuts = F.array(*[F.lit(float(t)) for t in thresholds])
    n = len(thresholds)
    step = (thresholds[-1] - thresholds[0]) / (n - 1) if n > 1 else 0.0
    if not step or max(abs(t - (thresholds[0] + i * step)) for i, t in enumerate(thresholds)) > step / 4:
        return F.size(F.filter(cuts, lambda t: t <= probability))
    guess = F.floor((probability - thresholds[0]) / step)
    at = F.least(F.greatest(guess, F.lit(0)), F.lit(n - 1)).cast("int")
    up = F.when(probability >= F.get(cuts, at + 1), 1).otherwise(0)
    down = F.when(probability < F.get(cuts, at), 1).otherwise(0)
    return at + 1 + up - down


def threshold_sweep(predictions: DataFrame, group: Sequence[str] = (), thresholds: Sequence[float] = tuple(SWEEP),
                    digits: int = 4) -> DataFrame:
    """Precision, recall, F1 and specificity at every threshold.

    Rows are counted by the number of thresholds they reach, one pass; the sums over "at least this many" are then
    taken over a table of at most ``len(thresholds) + 1`` rows per group.
    """
    cuts = F.array(*[F.lit(float(t)) for t in thresholds])
    reached = thresholds_reached(F.col("probability"), thresholds)
    bins = predictions.where(F.col("probability").isNotNull()).groupBy(*group, reached.alias("_r")).agg(
        F.count_if(F.col("label") == 1).alias("_p"), F.count_if(F.col("label") == 0).alias("_q"))
    by_group = bins.groupBy(*group).agg(F.collect_list(F.struct("_r", "_p", "_q")).alias("_b"),
                                        F.sum("_p").alias("_np"), F.sum("_q").alias("_nq"))

    def reaching(field: str, i: Column) -> Column:
        return F.aggregate(F.filter(F.col("_b"), lambda b: b["_r"] > i), F.lit(0).cast("bigint"), lambda acc, b: acc + b[field])
    rows = F.transform(F.sequence(F.lit(0), F.lit(len(thresholds) - 1)), lambda i: F.struct(
        F.get(cuts, i).alias("threshold"), reaching("_p", i).alias("tp"), reaching("_q", i).alias("fp")))
    long = by_group.select(*group, "_np", "_nq", F.inline(rows))
    precision = safe_ratio(F.col("tp"), F.col("tp") + F.col("fp"))
    recall = safe_ratio(F.col("tp"), F.col("_np"))
    return long.select(
        *group, "threshold", F.round(precision, digits).alias("precision"), F.round(recall, digits).alias("recall"),
        F.round(_f1(precision, recall), digits).alias("f1"),
        F.round(safe_ratio(F.col("_nq") - F.col("fp"), F.col("_nq")), digits).alias("specificity"))


def best_thresholds(sweep: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """The first threshold with the best F1, and the clinical one: the first best recall with enough precision."""
    first_f1 = F.max_by("threshold", F.struct("f1", -F.col("threshold")))
    allowed = F.col("precision") >= CLINICAL_PRECISION
    order = F.when(allowed, F.struct(F.col("recall").alias("r"), (-F.col("threshold")).alias("t")))
    found = sweep.groupBy(*group).agg(
        first_f1.alias("f1_threshold"), F.max("f1").alias("best_f1"),
        F.max_by(F.struct("threshold", "recall", "precision"), order).alias("_c"), F.max(allowed).alias("_any"))
    def clinical(field: str, default: float) -> Column:
        return F.when(F.col("_any"), F.col(f"_c.{field}")).otherwise(default)
    return found.select(*group, "f1_threshold", "best_f1", clinical("threshold", CLINICAL_DEFAULT).alias("clinical_threshold"),
                        clinical("recall", 0.0).alias("clinical_recall"), clinical("precision", 0.0).alias("clinical_precision"))


def best_models(results: DataFrame, metric: dict[str, str], default: str = "f1", dataset: str = "dataset",
                model: str = "model", shown: Sequence[str] = ("f1", "recall", "roc_auc", "pr_auc", "mcc")) -> DataFrame:
    """The best model per dataset by that dataset's own metric; equal scores go to the first name."""
    score = F.col(default)
    for name, column in metric.items():
        score = F.when(F.col(dataset) == name, F.col(column)).otherwise(score)
    # the smallest (negated score, name) wins
    order = F.struct((-score).alias("s"), F.col(model).alias("m"))
    best = results.groupBy(dataset).agg(F.min_by(F.struct(model, *shown), order).alias("_b"))
    return best.select(dataset, F.col(f"_b.{model}").alias("best_model"), *[F.col(f"_b.{c}") for c in shown])


def overfit_check(results: DataFrame, cv: str = "cv_f1", test: str = "f1") -> DataFrame:
    """Cross-validation score minus test score, flagged when the gap is too wide."""
    gap = F.col(cv) - F.col(test)
    return results.withColumns({"gap": F.round(gap, 4), "overfit": gap > OVERFIT_GAP})


def baselines(df: DataFrame, group: Sequence[str] = (), label: str = "label") -> DataFrame:
    """No-skill precision (mean label) and the accuracy of always answering negative."""
    mean = F.avg(F.col(label).cast("double"))
    return df.groupBy(*group).agg(mean.alias("no_skill"), (1.0 - mean).alias("naive_accuracy"))


def run_log(results: DataFrame, run_id: str, params: dict[str, str], measures: Sequence[str], dataset: str = "dataset",
            model: str = "model") -> DataFrame:
    """Parameters and metrics of a run in long form (run_id, dataset, model, kind, name, value)."""
    logged = results.unpivot([dataset, model], [F.col(m).cast("double").alias(m) for m in measures], "name", "value").select(
        dataset, model, F.lit("metric").alias("kind"), "name", F.col("value").cast("string").alias("value"))
    if params:
        pairs = F.explode(F.array(*[F.struct(F.lit(k).alias("name"), F.lit(str(v)).alias("value")) for k, v in params.items()]))
        logged = union_all([logged, results.select(dataset, model, pairs.alias("_p")).select(
            dataset, model, F.lit("param").alias("kind"), "_p.name", "_p.value")])
    return logged.select(F.lit(run_id).alias("run_id"), "*")


def append_run(log: DataFrame, path: str) -> None:
    log.write.mode("append").parquet(path)
