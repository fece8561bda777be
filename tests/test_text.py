from __future__ import annotations

import pytest

from caseloom.configs import notes
from caseloom.operators import text
from caseloom.plans import intake


def one(spark, plan, note, **kw):
    return plan(spark.createDataFrame([(note,)], "text string"), **kw).first().asDict()


def items(row):
    return [i for i in range(1, 11) if row[f"a{i}"] == 1]


@pytest.mark.parametrize("block,expected", [
    ("Endorsed items: A4, A10.\n  Not endorsed: A1, A2.", [4, 10]),  # a10 does not imply a1
    ("  No items endorsed.\n  Not endorsed: A1, A2.", []),
    ("AQ-10: A1(+) A2(-) A10(+) = 2/10", [1, 10]),
    ("    A1 (+)\n    A2 (-)\n    A3: YES — x\n    A4: NO — y\n    Item A5: \"z\" — endorsed (YES)\n    Item A6: \"z\" — not endorsed (NO)", [1, 3, 5]),
    ("  A1 = 1\n  A2 = 0\n  A9 = 1", [1, 9]),
    ("Patient endorsed the following: A1 (notices small sounds);\n A4 (switching). All other items denied.", [1, 4]),  # over a line end
    ("The patient did not endorse any of the AQ-10 items.", []),
])
def test_questionnaire_layouts(spark, block, expected):
    row = one(spark, intake.autism_notes, f"34-year-old male\n{block}")
    assert items(row) == expected and row["aq_score"] == len(expected) and row["age"] == 34


@pytest.mark.parametrize("phrase,flag", [
    ("No history of neonatal jaundice.", 0), ("History of neonatal jaundice.", 1), ("jaundice(-)", 0), ("Neonatal jaundice: Yes", 1),
    ("has a history of neonatal jaundice", 1), ("nothing to note", 0)])
def test_negative_phrase_beats_positive(spark, phrase, flag):
    assert one(spark, intake.autism_notes, f"5yo F. {phrase}")["jaundice"] == flag


def test_family_history_bullet(spark):
    assert one(spark, intake.autism_notes, "- Patient: male, age 7\n- Family history of ASD: Yes")["family_asd"] == 1


def test_toddler_post(spark):
    post = ("Hi, I'm really worried about my 24 month old son. He had jaundice as a baby. No family history of ASD at all.\n"
            "Never looks me in the eyes zones out and stares at nothing still no words yet no waving at all talking to u bc.\n"
            "I (family member, Asian) am freaking out.")
    row = one(spark, intake.toddler_posts, post)
    assert (row["age_months"], row["sex"], row["jaundice"], row["family_asd"]) == (24, "m", "yes", "no")
    assert items(row) == [2, 8, 9, 10] and row["score"] == 4 and row["label"] == "Yes"
    assert (row["completed_by"], row["ethnicity"]) == ("family member", "asian")


def test_toddler_defaults(spark):
    row = one(spark, intake.toddler_posts, "my 13 month old")
    assert (row["sex"], row["completed_by"], row["ethnicity"], row["label"]) == ("m", "family member", "White European", "No")


def flags(row):
    return {s for s in notes.SYMPTOM_WORDS if row[s] == 1}


def test_diabetes_sections(spark):
    note = "58 yo M\nReports the following symptoms:\n - polyuria\n - hair loss\nDenies:\n - itching\n - obesity\nCLINICAL ASSESSMENT:\nLow risk for diabetes"
    row = one(spark, intake.diabetes_records, note)
    assert flags(row) == {"polyuria", "alopecia"} and (row["age"], row["sex"], row["label"]) == (58, 1, 0)


def test_diabetes_findings_header_is_no_verdict(spark):
    note = "female, 40 years old\nPositive findings:\n • excessive thirst\nAll other screened symptoms denied.\nASSESSMENT:\nDiabetes Risk: NEGATIVE."
    row = one(spark, intake.diabetes_records, note)
    assert flags(row) == {"polydipsia"} and row["label"] == 0 and row["sex"] == 0


def test_diabetes_marks_and_mentions(spark):
    assert flags(one(spark, intake.diabetes_records, "Pt: 40yo F\nROS: polyuria(+), itching(-), obese(+)\nHigh risk")) == {"polyuria", "obesity"}
    assert flags(one(spark, intake.diabetes_records, "45 yo F with blurred vision. Positive screen")) == {"visual_blurring"}


def test_device_records(spark):
    json = '{"log_id": "SEQ-1", "patient": {"age": 40, "gender": "M"}, "telemetry": {"symptoms_flagged": ["POLYURIA", "SUDDEN_WEIGHT_LOSS"], "risk_classification": "HIGH"}}'
    row = one(spark, intake.diabetes_records, json)
    assert (row["age"], row["sex"], row["label"], flags(row)) == (40, 1, 1, {"polyuria", "sudden_weight_loss"})
    log = "[2024-01-01T00:00:00Z] SYS_LOG | DEV=X | PT_AGE=51 | GENDER=F | SYMPT_FLAG=NONE | RISK_CLASS=LOW"
    row = one(spark, intake.diabetes_records, log)
    assert (row["age"], row["sex"], row["label"], flags(row)) == (51, 0, 0, set())


def test_stroke_traps(spark):
    note = ("Patient is a 67.5-year-old female.\n Not married. Works in Self-employed.\n Lives in an rural area.\nPMH: HTN, heart dz.\n"
            "Labs/Vitals: glucose 228.69 mg/dL, BMI N/A kg/m², smoking: Unknown\nImpression: Acute stroke. Code stroke activated.")
    row = one(spark, intake.stroke_notes, note, impute=False)
    assert row == {"gender": 0, "age": 67.5, "ever_married": 0, "work_type": "Self-employed", "residence_type": 0, "hypertension": 1,
                   "heart_disease": 1, "avg_glucose_level": 228.69, "bmi": None, "smoking_status": "Unknown", "label": 1}


def test_stroke_more_wordings(spark):
    note = "Pt: 45yo M, married: Y\nWork: Govt_job | Residence: urban\nPMH: HTN(-) Heart dz(+)\nGlucose (avg): 90.1 mg/dL\nBody mass index: 27.3 kg/m²\nTobacco use: smokes.\nDx: No stroke."
    row = one(spark, intake.stroke_notes, note, impute=False)
    assert (row["gender"], row["hypertension"], row["heart_disease"], row["bmi"], row["label"], row["work_type"]) == (1, 0, 1, 27.3, 0, "Govt_job")
    assert intake.stroke_notes(spark.createDataFrame([("no data here",)], "text string"), impute=False).count() == 0  # unreadable gender


def test_split_drops_blank_records(spark):
    blob = "one\n--- END OF RECORD #00001 ---\n two \n---END OF RECORD #2---\n \n--- END OF RECORD #3 ---\n"
    rows = text.split_records(spark.createDataFrame([(blob,)], "b string"), "b", notes.RECORD_END).collect()
    assert [r["text"] for r in rows] == ["one", "two"]


def test_phrase_lookup_equals_contains(spark):
    phrases = ["ab", "abc", "bc", "c d", "x(y", "é"]
    samples = ["abc", "xab", "bc d", "x(y é", "", "abd"]
    df = spark.createDataFrame([(s,) for s in samples], "t string")
    found = df.select("t", text.mentioned(df["t"], phrases).alias("f"))
    out = found.select("t", *[text.among("f", [p], phrases).alias(f"p{i}") for i, p in enumerate(phrases)]).collect()
    for r in out:
        assert [r[f"p{i}"] for i in range(len(phrases))] == [p in r["t"] for p in phrases]
