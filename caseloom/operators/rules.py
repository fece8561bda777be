"""A rule engine over DataFrames: which rules fire per row, whether they agree with a model, and a text report."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseloom.operators.reshape import literal_rows


@dataclass(frozen=True)
class Rule:
    """IF predicate THEN conclusion. ``positive`` says whether the conclusion speaks for the disease."""

    rule_id: str
    condition: str
    conclusion: str
    confidence: float
    evidence: str
    predicate: Column
    positive: bool

    def struct(self) -> Column:
        return F.struct(F.lit(self.rule_id).alias("rule_id"), F.lit(self.condition).alias("condition"), F.lit(self.conclusion).alias("conclusion"),
                        F.lit(self.confidence).alias("confidence"), F.lit(self.evidence).alias("evidence"), F.lit(self.positive).alias("positive"))


def rule_table(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    rows = [(r.rule_id, r.condition, r.conclusion, r.confidence, r.evidence, r.positive) for r in rules]
    return literal_rows(df.sparkSession, rows, "rule_id string, condition string, conclusion string, confidence double, evidence string, positive boolean")


def evaluate_rules(df: DataFrame, rules: Sequence[Rule], out: str = "fired") -> DataFrame:
    """Adds the fired rules, in order; a predicate over a NULL does not fire."""
    fired = F.array(*[F.when(r.predicate, r.struct()) for r in rules])
    return df.withColumn(out, F.filter(fired, lambda r: r.isNotNull()))


def fired_rules(df: DataFrame, rules: Sequence[Rule], keep: Sequence[str]) -> DataFrame:
    """One row per (row, fired rule)."""
    return evaluate_rules(df, rules).select(*keep, F.explode("fired").alias("_r")).select(*keep, "_r.*")


def with_agreement(df: DataFrame, rules: Sequence[Rule], prediction: str = "prediction") -> DataFrame:
    """Adds the number of fired rules, whether one speaks for the disease, and whether model and rules agree.

    Without a fired rule there is nothing to disagree with.
    """
    judged = evaluate_rules(df, rules).withColumn("rule_positive", F.exists("fired", lambda r: r["positive"]))
    return judged.withColumns({
        "n_fired": F.size("fired"),
        "agrees": F.when(F.size("fired") == 0, True).otherwise((F.col(prediction) == 1) == F.col("rule_positive"))})


def explanation(df: DataFrame, title: str, prediction: str = "prediction", probability: str = "probability") -> Column:
    """A text report per row, over the columns of ``with_agreement``."""
    # fixed values: the layout and wording of the report
    bar = "=" * 60

    def entry(r: Column) -> Column:
        return F.concat(F.lit("    ["), r["rule_id"], F.lit("] IF "), r["condition"], F.lit("\n           THEN "), r["conclusion"],
                        F.lit("\n           Confidence: "), F.format_string("%.0f%%", r["confidence"] * 100), F.lit("\n           Evidence: "), r["evidence"], F.lit("\n"))
    listed = F.array_join(F.transform("fired", entry), "\n")
    risk = F.when(F.col(prediction) == 1, "HIGH RISK").otherwise("LOW RISK")
    verdict = F.when(F.col("agrees"), "  AGREEMENT: ML model and clinical rules AGREE.\n  -> High confidence in the prediction.").otherwise(
        "  DISAGREEMENT: ML model and clinical rules DISAGREE.\n  -> Manual clinical review recommended.\n"
        "  -> The rule-based system provides interpretable\n     guardrails against pure statistical predictions.")
    rules_text = F.when(F.col("n_fired") == 0, "  No clinical rules triggered.\n\n\n").otherwise(
        F.concat(F.format_string("  CLINICAL RULES TRIGGERED (%d):\n", "n_fired"), listed, F.lit("\n"), verdict, F.lit("\n\n")))
    return F.concat(F.lit(f"{bar}\n  CLINICAL DECISION SUPPORT — {title.upper()}\n{bar}\n\n  ML Model Prediction: "), risk,
                    F.lit("\n  ML Confidence: "), F.format_string("%.1f%%", F.col(probability) * 100), F.lit("\n\n"), rules_text, F.lit(bar))
