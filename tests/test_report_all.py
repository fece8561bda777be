"""Reports of the whole table, against plain Python."""

from __future__ import annotations

from collections import Counter

from caseloom.configs import rules as rule_sets
from caseloom.plans import fixtures as fx
from caseloom.plans import registry

FIRES = {"STR-001": lambda r: r.age >= 65 and r.hypertension == 1, "STR-002": lambda r: r.avg_glucose_level >= 200 and r.age >= 55,
         "STR-003": lambda r: r.heart_disease == 1 and r.hypertension == 1,
         "STR-004": lambda r: r.bmi is not None and r.bmi >= 30 and r.avg_glucose_level >= 150 and r.age >= 50}


def report(r, prediction, probability):
    fired = [x for x in rule_sets.stroke() if FIRES[x.rule_id](r)]
    bar = "=" * 60
    lines = [bar, "  CLINICAL DECISION SUPPORT — STROKE", bar, "", f"  ML Model Prediction: {'HIGH' if prediction else 'LOW'} RISK", f"  ML Confidence: {probability * 100:.1f}%", ""]
    if not fired:
        return "\n".join([*lines, "  No clinical rules triggered.", "", "", bar]), 0, True
    lines.append(f"  CLINICAL RULES TRIGGERED ({len(fired)}):")
    for x in fired:
        lines += [f"    [{x.rule_id}] IF {x.condition}", f"           THEN {x.conclusion}", f"           Confidence: {x.confidence * 100:.0f}%", f"           Evidence: {x.evidence}", ""]
    agrees = bool(prediction) == any(x.positive for x in fired)
    if agrees:
        lines += ["  AGREEMENT: ML model and clinical rules AGREE.", "  -> High confidence in the prediction."]
    else:
        lines += ["  DISAGREEMENT: ML model and clinical rules DISAGREE.", "  -> Manual clinical review recommended.",
                  "  -> The rule-based system provides interpretable", "     guardrails against pure statistical predictions."]
    return "\n".join([*lines, "", bar]), len(fired), agrees


def test_every_patient_has_a_report(spark, sf):
    patients = fx.fact(spark, sf, "stroke").join(fx.dim_patient(spark, sf), "patient_id").collect()
    got = {r.patient_id: r for r in registry.QUERIES["xa6c_report_all"](spark, sf).collect()}
    assert set(got) == {p.patient_id for p in patients} and len(got) == len(patients)
    for p in patients:
        probability = 0.05 + p.age / 200 + 0.3 * p.ever_married
        g = got[p.patient_id]
        assert abs(g.probability - probability) < 1e-9 and g.prediction == (probability > 0.5)
        assert (g.report, g.n_fired, g.agrees) == report(p, g.prediction, g.probability)
    seen = Counter((r.n_fired > 0, r.agrees) for r in got.values())
    assert len(seen) == 3 and len({r.prediction for r in got.values()}) == 2
