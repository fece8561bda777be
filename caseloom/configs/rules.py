"""Clinical rules of the three cohorts, over the gold column names."""

from __future__ import annotations

from pyspark.sql import functions as F

from caseloom.operators.rules import Rule

# Thresholds, wording, confidence and evidence of the clinical rules.

C = F.col
SYMPTOMS = ["polyuria", "polydipsia", "sudden_weight_loss", "weakness", "polyphagia", "genital_thrush", "visual_blurring",
            "itching", "irritability", "delayed_healing", "partial_paresis", "muscle_stiffness", "alopecia", "obesity"]


def autism() -> list[Rule]:
    return [
        Rule("AUT-001", "AQ_Score >= 6", "ASD POSITIVE — Refer for comprehensive diagnostic evaluation", 0.95,
             "AQ-10 clinical referral threshold (Allison et al., 2012)", C("aq_score") >= 6, True),
        Rule("AUT-002", "AQ_Score < 6", "ASD NEGATIVE — No immediate ASD-specific referral needed", 0.90,
             "AQ-10 clinical referral threshold (Allison et al., 2012)", C("aq_score") < 6, False),
        Rule("AUT-003", "Family_ASD == 1 AND AQ_Score >= 4", "ELEVATED RISK — Family history + borderline AQ score; consider monitoring", 0.80,
             "Genetic predisposition in ASD (Sandin et al., 2014)", (C("family_asd") == 1) & (C("aq_score") >= 4), False),
        Rule("AUT-004", "Jaundice == 1 AND AQ_Score >= 5", "MONITOR — Neonatal jaundice is a known ASD risk factor", 0.70,
             "Maimburg & Vaeth, 2006 — Neonatal jaundice and ASD risk", (C("jaundice") == 1) & (C("aq_score") >= 5), False),
    ]


def diabetes() -> list[Rule]:
    count = sum((C(s) for s in SYMPTOMS), F.lit(0))
    return [
        Rule("DIA-001", "Polyuria == 1 AND Polydipsia == 1", "HIGH RISK — Classic diabetes triad symptoms present", 0.92,
             "WHO Diabetes Diagnostic Criteria (2006)", (C("polyuria") == 1) & (C("polydipsia") == 1), True),
        Rule("DIA-002", "Polyuria == 1 AND sudden_weight_loss == 1 AND Polyphagia == 1",
             "VERY HIGH RISK — Multiple cardinal symptoms; urgent HbA1c test recommended", 0.95, "ADA Standards of Medical Care in Diabetes (2023)",
             (C("polyuria") == 1) & (C("sudden_weight_loss") == 1) & (C("polyphagia") == 1), True),
        Rule("DIA-003", "Age >= 45 AND Obesity == 1", "MODERATE RISK — Age + obesity are primary Type 2 risk factors", 0.75,
             "ADA Risk Assessment Guidelines (2023)", (C("age") >= 45) & (C("obesity") == 1), False),
        Rule("DIA-004", "Total symptoms >= 5", "HIGH RISK — Multiple symptoms indicate metabolic dysfunction", 0.85,
             "Islam et al. (2020) — Symptom count threshold", count >= 5, True),
    ]


def stroke() -> list[Rule]:
    return [
        Rule("STR-001", "age >= 65 AND hypertension == 1", "HIGH RISK — Age + hypertension are the strongest stroke predictors", 0.88,
             "Framingham Stroke Risk Profile (Wolf et al., 1991)", (C("age") >= 65) & (C("hypertension") == 1), True),
        Rule("STR-002", "avg_glucose_level >= 200 AND age >= 55", "HIGH RISK — Hyperglycemia + advanced age significantly increase stroke risk", 0.82,
             "Emerging Risk Factors Collaboration (2010)", (C("avg_glucose_level") >= 200) & (C("age") >= 55), True),
        Rule("STR-003", "heart_disease == 1 AND hypertension == 1",
             "VERY HIGH RISK — Dual cardiovascular comorbidities; aggressive preventive therapy recommended", 0.90,
             "AHA/ASA Guidelines for Stroke Prevention (2021)", (C("heart_disease") == 1) & (C("hypertension") == 1), True),
        Rule("STR-004", "bmi >= 30 AND avg_glucose_level >= 150 AND age >= 50",
             "ELEVATED RISK — Metabolic syndrome profile; lifestyle intervention indicated", 0.75, "MetS and stroke meta-analysis (Li et al., 2016)",
             (C("bmi") >= 30) & (C("avg_glucose_level") >= 150) & (C("age") >= 50), False),
    ]
