"""Star schema, validation, profile and OLAP queries with their oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from caseloom.operators import olap, profile, validate
from caseloom.operators.reshape import literal_rows
from caseloom.operators.star import full_view
from caseloom.plans import fixtures as fx
from caseloom.plans.catalog import Catalog
from caseloom.plans.fixtures import AQ_ITEMS, FACTS, SMOKING, SYMPTOMS, WORK_TYPES, with_ctes

catalog = Catalog()
query = catalog.query

YES_NO = ({1: "Yes"}, "No")
SEX = ({1: "Male"}, "Female")
URBAN = ({1: "Urban"}, "Rural")
LABELS = " UNION ALL ".join(f"SELECT patient_id, '{s}' AS source_dataset, label FROM fact_{s}" for s in ("autism", "diabetes", "stroke"))


def _pct(part: str, whole: str, digits: int) -> str:
    return f"ROUND(100.0*({part})/({whole}), {digits})"


# --- views and cohort summaries ---

@query("ol0a_autism_view", with_ctes("fact_autism") + f"""
SELECT d.patient_id, age, CASE gender WHEN 1 THEN 'Male' ELSE 'Female' END AS gender, source_dataset, {', '.join(AQ_ITEMS)},
 aq_score, CASE jaundice WHEN 1 THEN 'Yes' ELSE 'No' END AS jaundice, CASE family_asd WHEN 1 THEN 'Yes' ELSE 'No' END AS family_asd,
 label AS asd_diagnosis FROM fact_autism f JOIN dim_patient d ON d.patient_id=f.patient_id""")
def ol0a(spark, sf):
    return full_view(fx.fact(spark, sf, "autism"), fx.dim_patient(spark, sf), "patient_id",
                     {"gender": SEX, "jaundice": YES_NO, "family_asd": YES_NO}, {"label": "asd_diagnosis"})


@query("ol0b_diabetes_view", with_ctes("fact_diabetes") + f"""
SELECT d.patient_id, age, CASE gender WHEN 1 THEN 'Male' ELSE 'Female' END AS gender, source_dataset, {', '.join(SYMPTOMS)},
 label AS diabetes_diagnosis FROM fact_diabetes f JOIN dim_patient d ON d.patient_id=f.patient_id""")
def ol0b(spark, sf):
    return full_view(fx.fact(spark, sf, "diabetes"), fx.dim_patient(spark, sf), "patient_id", {"gender": SEX},
                     {"label": "diabetes_diagnosis"})


@query("ol0c_stroke_view", with_ctes("fact_stroke") + """
SELECT d.patient_id, age, CASE gender WHEN 1 THEN 'Male' ELSE 'Female' END AS gender, source_dataset, hypertension, heart_disease,
 CASE ever_married WHEN 1 THEN 'Yes' ELSE 'No' END AS ever_married, work_type,
 CASE residence_type WHEN 1 THEN 'Urban' ELSE 'Rural' END AS residence_type, ROUND(avg_glucose_level, 8) AS avg_glucose_level,
 ROUND(bmi, 8) AS bmi, smoking_status, label AS stroke_diagnosis
FROM fact_stroke f JOIN dim_patient d ON d.patient_id=f.patient_id""")
def ol0c(spark, sf):
    view = full_view(fx.fact(spark, sf, "stroke"), fx.dim_patient(spark, sf), "patient_id",
                     {"gender": SEX, "ever_married": YES_NO, "residence_type": URBAN}, {"label": "stroke_diagnosis"})
    return view.withColumns({c: F.round(c, 8) for c in ("avg_glucose_level", "bmi")})


SUMMARY = f"""SELECT d.source_dataset AS disease, COUNT(*) AS total_patients, CAST(SUM(l.label) AS BIGINT) AS positive_cases,
 {_pct('SUM(l.label)', 'COUNT(*)', 2)} AS positive_pct, ROUND(AVG(age), 1) AS avg_age, {_pct('SUM(gender)', 'COUNT(*)', 1)} AS pct_male
FROM dim_patient d LEFT JOIN ({LABELS}) l ON l.patient_id=d.patient_id AND l.source_dataset=d.source_dataset GROUP BY d.source_dataset"""
SUMMARY_BY_JOINS = f"""SELECT d.source_dataset AS disease, COUNT(*) AS total_patients,
 CAST(SUM(CASE d.source_dataset WHEN 'autism' THEN fa.label WHEN 'diabetes' THEN fd.label WHEN 'stroke' THEN fs.label END) AS BIGINT) AS positive_cases,
 {_pct("SUM(CASE d.source_dataset WHEN 'autism' THEN fa.label WHEN 'diabetes' THEN fd.label WHEN 'stroke' THEN fs.label END)", 'COUNT(*)', 2)} AS positive_pct,
 ROUND(AVG(age), 1) AS avg_age, {_pct('SUM(gender)', 'COUNT(*)', 1)} AS pct_male
FROM dim_patient d LEFT JOIN fact_autism fa ON d.patient_id=fa.patient_id AND d.source_dataset='autism'
 LEFT JOIN fact_diabetes fd ON d.patient_id=fd.patient_id AND d.source_dataset='diabetes'
 LEFT JOIN fact_stroke fs ON d.patient_id=fs.patient_id AND d.source_dataset='stroke' GROUP BY d.source_dataset"""


@query("ol0d_summary", with_ctes(*FACTS) + SUMMARY_BY_JOINS)
def ol0d(spark, sf):
    return olap.cohort_summary(fx.star(spark, sf))


@query("jn3_three_left_joins", with_ctes(*FACTS) + SUMMARY_BY_JOINS)
def jn3(spark, sf):
    return olap.cohort_summary_by_joins(fx.star(spark, sf))


@query("ol5_profile", with_ctes("dim_patient") + f"""
SELECT source_dataset AS disease_cohort, COUNT(*) AS total_patients, ROUND(MIN(age),1) AS min_age, ROUND(MAX(age),1) AS max_age,
 ROUND(AVG(age),2) AS avg_age, ROUND(quantile_disc(age, 0.5),1) AS approx_median_age, {_pct('SUM(gender)', 'COUNT(*)', 1)} AS pct_male,
 {_pct('SUM(1-gender)', 'COUNT(*)', 1)} AS pct_female FROM dim_patient GROUP BY source_dataset""")
def ol5(spark, sf):
    return olap.cohort_profile(fx.dim_patient(spark, sf))


@query("jn5_lower_median", with_ctes("obs") + """
SELECT label, m2 AS median FROM (SELECT label, m2, ROW_NUMBER() OVER (PARTITION BY label ORDER BY m2) - 1 AS r,
 COUNT(*) OVER (PARTITION BY label) AS n FROM obs) WHERE r = (n - 1) // 2""")
def jn5(spark, sf):
    return olap.lower_median(fx.obs(spark, sf), "m2", "label")


_BRACKET = """CASE WHEN age < 18 THEN '0–17   (Paediatric)' WHEN age < 40 THEN '18–39  (Young Adult)'
 WHEN age < 60 THEN '40–59  (Middle-Aged)' WHEN age < 80 THEN '60–79  (Older Adult)' ELSE '80+    (Elderly)' END"""


@query("ol6_rollup_share", with_ctes("dim_patient") + f"""
SELECT source_dataset AS disease, {_BRACKET} AS age_bracket, COUNT(*) AS patient_count,
 ROUND(100.0*COUNT(*)/SUM(COUNT(*)) OVER (PARTITION BY source_dataset), 1) AS pct_within_disease
FROM dim_patient GROUP BY 1, 2""")
def ol6(spark, sf):
    return olap.rollup_share(fx.dim_patient(spark, sf))


@query("ol7_balance", with_ctes("dim_patient") + f"""
SELECT source_dataset AS disease, CAST(SUM(gender) AS BIGINT) AS male_count, CAST(SUM(1-gender) AS BIGINT) AS female_count,
 COUNT(*) AS total, {_pct('SUM(gender)', 'COUNT(*)', 2)} AS pct_male, {_pct('SUM(1-gender)', 'COUNT(*)', 2)} AS pct_female,
 CASE WHEN ABS(50.0-100.0*SUM(gender)/COUNT(*)) < 10 THEN 'Balanced' ELSE 'Imbalanced' END AS gender_balance
FROM dim_patient GROUP BY source_dataset""")
def ol7(spark, sf):
    return olap.flag_balance(fx.dim_patient(spark, sf))


_RATIO = "CAST(total_patients-positive_cases AS DOUBLE)/NULLIF(positive_cases,0)"


@query("ol8_prevalence", with_ctes(*FACTS, summary=SUMMARY) + f"""
SELECT disease, total_patients, positive_cases, total_patients-positive_cases AS negative_cases, positive_pct AS positive_rate_pct,
 ROUND({_RATIO}, 2) AS imbalance_ratio, avg_age, pct_male FROM summary""")
def ol8(spark, sf):
    return olap.prevalence_dashboard(olap.cohort_summary(fx.star(spark, sf)))


@query("ol9_imbalance", with_ctes(*FACTS, summary=SUMMARY) + f"""
SELECT disease, positive_cases, total_patients-positive_cases AS negative_cases, ROUND({_RATIO}, 1) AS neg_to_pos_ratio,
 CASE WHEN {_RATIO} < 3 THEN '{olap.MILD}' WHEN {_RATIO} BETWEEN 3 AND 10 THEN '{olap.MODERATE}' ELSE '{olap.SEVERE}' END
 AS recommended_strategy FROM summary""")
def ol9(spark, sf):
    return olap.imbalance_classes(olap.cohort_summary(fx.star(spark, sf)))


@query("ol9b_imbalance_rounded", with_ctes("obs_cat", summary="""SELECT cat AS disease, COUNT(*) AS total_patients,
 CAST(SUM(label) AS BIGINT) AS positive_cases FROM obs_cat GROUP BY cat""") + f"""
SELECT disease, positive_cases, total_patients-positive_cases AS negative_cases, ROUND({_RATIO}, 1) AS neg_to_pos_ratio,
 CASE WHEN ROUND({_RATIO},1) < 3 THEN '{olap.MILD}' WHEN ROUND({_RATIO},1) BETWEEN 3 AND 10 THEN '{olap.MODERATE}' ELSE '{olap.SEVERE}' END
 AS recommended_strategy FROM summary""")
def ol9b(spark, sf):
    summary = fx.obs(spark, sf, True).groupBy(F.col("cat").alias("disease")).agg(
        F.count(F.lit(1)).alias("total_patients"), F.sum("label").alias("positive_cases"))
    return olap.imbalance_classes(summary, classify_rounded=True)


@query("ol10_pos_neg", with_ctes(*FACTS, labels=LABELS) + f"""
SELECT l.source_dataset AS disease, CASE WHEN l.source_dataset='stroke' THEN CASE l.label WHEN 1 THEN 'Stroke' ELSE 'No Stroke' END
 ELSE CASE l.label WHEN 1 THEN 'Positive' ELSE 'Negative' END END AS diagnosis, COUNT(*) AS n, ROUND(AVG(age),1) AS avg_age,
 {_pct('SUM(gender)', 'COUNT(*)', 1)} AS pct_male FROM labels l JOIN dim_patient d ON d.patient_id=l.patient_id GROUP BY l.source_dataset, l.label""")
def ol10(spark, sf):
    plain = ("Positive", "Negative")
    return olap.outcome_demographics(fx.star(spark, sf), {"autism": plain, "diabetes": plain, "stroke": ("Stroke", "No Stroke")})


@query("ol11_score_stats", with_ctes("fact_autism") + f"""
SELECT CASE label WHEN 1 THEN 'ASD Positive' ELSE 'ASD Negative' END AS diagnosis, COUNT(*) AS n, MIN(aq_score) AS min_score,
 MAX(aq_score) AS max_score, ROUND(AVG(aq_score),2) AS avg_score, CAST(SUM(CASE WHEN aq_score>=6 THEN 1 ELSE 0 END) AS BIGINT) AS above_threshold,
 {_pct('SUM(CASE WHEN aq_score>=6 THEN 1 ELSE 0 END)', 'COUNT(*)', 1)} AS pct_above_threshold FROM fact_autism GROUP BY label""")
def ol11(spark, sf):
    return olap.score_stats(fx.fact(spark, sf, "autism"), "aq_score", 6, ("ASD Positive", "ASD Negative"))


def _rate(c: str, label: int) -> str:
    return f"AVG(CASE WHEN label={label} THEN {c}*100.0 END)"


@query("ol12_item_rates", with_ctes("fact_autism") + " UNION ALL ".join(
    f"SELECT '{c.upper()}' AS item, ROUND({_rate(c, 1)},1) AS pct_pos, ROUND({_rate(c, 0)},1) AS pct_neg, "
    f"ROUND({_rate(c, 1)}-{_rate(c, 0)},1) AS gap_pp FROM fact_autism" for c in AQ_ITEMS))
def ol12(spark, sf):
    return olap.response_rates(fx.fact(spark, sf, "autism"), AQ_ITEMS)


@query("ol13_prevalence_gap", with_ctes("fact_diabetes") + " UNION ALL ".join(
    f"SELECT '{c}' AS symptom, ROUND({_rate(c, 1)},1) AS pct_in_diabetic_patients, ROUND({_rate(c, 0)},1) AS pct_in_healthy_patients, "
    f"ROUND({_rate(c, 1)}-{_rate(c, 0)},1) AS gap_percentage_points, CASE WHEN {_rate(c, 1)}-{_rate(c, 0)} > 30 THEN 'HIGH discriminative power' "
    f"WHEN {_rate(c, 1)}-{_rate(c, 0)} > 15 THEN 'MODERATE discriminative power' ELSE 'LOW discriminative power' END AS discriminative_power "
    f"FROM fact_diabetes" for c in SYMPTOMS))
def ol13(spark, sf):
    return olap.prevalence_gap(fx.fact(spark, sf, "diabetes"), SYMPTOMS, names=("pct_in_diabetic_patients", "pct_in_healthy_patients"))


@query("ol14_risk_profile", with_ctes("fact_stroke") + f"""
SELECT CASE label WHEN 1 THEN 'Stroke' ELSE 'No Stroke' END AS outcome, COUNT(*) AS n, ROUND(AVG(age),1) AS avg_age,
 ROUND(AVG(avg_glucose_level),2) AS avg_glucose_mg_dl, ROUND(AVG(bmi),2) AS avg_bmi, {_pct('SUM(hypertension)', 'COUNT(*)', 1)} AS pct_hypertension,
 {_pct('SUM(heart_disease)', 'COUNT(*)', 1)} AS pct_heart_disease, {_pct('SUM(ever_married)', 'COUNT(*)', 1)} AS pct_ever_married,
 {_pct('SUM(residence_type)', 'COUNT(*)', 1)} AS pct_urban FROM fact_stroke f JOIN dim_patient d ON d.patient_id=f.patient_id GROUP BY label""")
def ol14(spark, sf):
    return olap.risk_profile(
        fx.fact(spark, sf, "stroke"), fx.dim_patient(spark, sf), "patient_id",
        {"avg_age": ("age", 1), "avg_glucose_mg_dl": ("avg_glucose_level", 2), "avg_bmi": ("bmi", 2)},
        {"pct_hypertension": "hypertension", "pct_heart_disease": "heart_disease", "pct_ever_married": "ever_married",
         "pct_urban": "residence_type"}, ("Stroke", "No Stroke"))


@query("ol15_incidence_vs_avg", with_ctes("fact_stroke") + f"""
SELECT smoking_status, COUNT(*) AS total_patients, CAST(SUM(label) AS BIGINT) AS cases, CAST(COUNT(*)-SUM(label) AS BIGINT) AS non_cases,
 {_pct('SUM(label)', 'COUNT(*)', 2)} AS rate_pct, CASE WHEN {_pct('SUM(label)', 'COUNT(*)', 2)} > (SELECT {_pct('SUM(label)', 'COUNT(*)', 2)} FROM fact_stroke)
 THEN 'ABOVE average risk' ELSE 'Below average risk' END AS vs_average FROM fact_stroke GROUP BY smoking_status""")
def ol15(spark, sf):
    return olap.incidence_vs_average(fx.fact(spark, sf, "stroke"), "smoking_status")


@query("ol16_comorbidity", with_ctes("fact_stroke") + f"""
SELECT 'Hypertension: ' || CASE hypertension WHEN 1 THEN 'Yes' ELSE 'No' END AS hypertension_status,
 'Heart Disease: ' || CASE heart_disease WHEN 1 THEN 'Yes' ELSE 'No' END AS heart_disease_status, COUNT(*) AS total_patients,
 CAST(SUM(label) AS BIGINT) AS cases, {_pct('SUM(label)', 'COUNT(*)', 2)} AS rate_pct,
 {_pct('SUM(label)', '(SELECT SUM(label) FROM fact_stroke)', 1)} AS pct_of_all_cases FROM fact_stroke GROUP BY hypertension, heart_disease""")
def ol16(spark, sf):
    return olap.comorbidity_matrix(fx.fact(spark, sf, "stroke"), ("hypertension", "Hypertension"), ("heart_disease", "Heart Disease"))


TITLES = {"autism": ("Autism Screening", "AQ_Score >= 6"), "diabetes": ("Diabetes Risk", "Polyuria + Polydipsia"),
          "stroke": ("Stroke Prediction", "Age + Glucose + Hypertension")}


@query("ol17_unified", with_ctes(*FACTS) + " UNION ALL ".join(
    f"SELECT '{title}' AS disease, COUNT(*) AS total, CAST(SUM(label) AS BIGINT) AS positives, ROUND(AVG(age),1) AS avg_age, "
    f"{_pct('SUM(gender)', 'COUNT(*)', 1)} AS pct_male, {_pct('SUM(label)', 'COUNT(*)', 2)} AS prevalence_pct, '{ind}' AS primary_risk_indicator "
    f"FROM fact_{s} f JOIN dim_patient d ON d.patient_id=f.patient_id" for s, (title, ind) in TITLES.items()))
def ol17(spark, sf):
    return olap.unified_summary(fx.star(spark, sf), TITLES)


_COARSE = "CASE WHEN age < 40 THEN 'Under 40' WHEN age < 60 THEN '40–59' WHEN age < 80 THEN '60–79' ELSE '80+' END"


@query("ol18_rollup_topk", with_ctes("fact_stroke") + f"""
SELECT {_COARSE} AS age_bracket, work_type, COUNT(*) AS patients, CAST(SUM(label) AS BIGINT) AS cases, {_pct('SUM(label)', 'COUNT(*)', 2)} AS rate_pct
FROM fact_stroke f JOIN dim_patient d ON d.patient_id=f.patient_id GROUP BY 1, 2 ORDER BY rate_pct DESC, age_bracket, work_type LIMIT 15""")
def ol18(spark, sf):
    return olap.bracket_category_rates(fx.fact(spark, sf, "stroke"), fx.dim_patient(spark, sf), "patient_id", "work_type", top=15)


@query("ol18b_rollup_totals", with_ctes("fact_stroke", joined=f"SELECT {_COARSE} AS age_bracket, work_type, label FROM fact_stroke f "
       "JOIN dim_patient d ON d.patient_id=f.patient_id") + f"""
SELECT age_bracket, work_type, COUNT(*) AS patients, CAST(SUM(label) AS BIGINT) AS cases, {_pct('SUM(label)', 'COUNT(*)', 2)} AS rate_pct,
 CAST(GROUPING_ID(age_bracket, work_type) AS INT) AS level FROM joined GROUP BY ROLLUP(age_bracket, work_type)""")
def ol18b(spark, sf):
    return olap.bracket_category_rates(fx.fact(spark, sf, "stroke"), fx.dim_patient(spark, sf), "patient_id", "work_type", totals=True)


@query("ol19_slice_registry", with_ctes("fact_stroke") + """
SELECT d.patient_id, ROUND(age,0) AS age, CASE gender WHEN 1 THEN 'Male' ELSE 'Female' END AS gender, hypertension, heart_disease,
 CASE ever_married WHEN 1 THEN 'Yes' ELSE 'No' END AS ever_married, work_type, CASE residence_type WHEN 1 THEN 'Urban' ELSE 'Rural' END AS residence,
 ROUND(avg_glucose_level,1) AS glucose_mg_dl, ROUND(bmi,1) AS bmi, smoking_status,
 hypertension + heart_disease + CASE WHEN age>=65 THEN 1 ELSE 0 END + CASE WHEN avg_glucose_level>140 THEN 1 ELSE 0 END
 + CASE WHEN bmi>30 THEN 1 ELSE 0 END AS risk_factor_score
FROM fact_stroke f JOIN dim_patient d ON d.patient_id=f.patient_id WHERE label=1 ORDER BY risk_factor_score DESC, d.age DESC, d.patient_id LIMIT 20""")
def ol19(spark, sf):
    shown = {"age": F.round("age", 0), "gender": F.when(F.col("gender") == 1, "Male").otherwise("Female"),
             "hypertension": F.col("hypertension"), "heart_disease": F.col("heart_disease"),
             "ever_married": F.when(F.col("ever_married") == 1, "Yes").otherwise("No"), "work_type": F.col("work_type"),
             "residence": F.when(F.col("residence_type") == 1, "Urban").otherwise("Rural"),
             "glucose_mg_dl": F.round("avg_glucose_level", 1), "bmi": F.round("bmi", 1), "smoking_status": F.col("smoking_status")}
    risk = [F.col("hypertension") == 1, F.col("heart_disease") == 1, F.col("age") >= 65, F.col("avg_glucose_level") > 140, F.col("bmi") > 30]
    return olap.case_registry(fx.fact(spark, sf, "stroke"), fx.dim_patient(spark, sf), "patient_id", shown, risk)


_DICE = ["Autism — Older Male ASD Positive", "Diabetes — Dual-Symptom Positive (Polyuria+Polydipsia)",
         "Stroke — Dual Comorbidity (Hypertension+Heart Disease)"]


@query("ol20_dice", with_ctes(*FACTS) + f"""
SELECT '{_DICE[0]}' AS subgroup, COUNT(*) AS patients, ROUND(AVG(age),1) AS avg_age, ROUND(AVG(aq_score),2) AS avg_aq_score,
 {_pct('SUM(family_asd)', 'COUNT(*)', 1)} AS pct_risk FROM fact_autism f JOIN dim_patient d ON d.patient_id=f.patient_id WHERE label=1 AND gender=1 AND age>=12
UNION ALL SELECT '{_DICE[1]}', COUNT(*), ROUND(AVG(age),1), NULL, {_pct('SUM(obesity)', 'COUNT(*)', 1)}
 FROM fact_diabetes f JOIN dim_patient d ON d.patient_id=f.patient_id WHERE label=1 AND polyuria=1 AND polydipsia=1
UNION ALL SELECT '{_DICE[2]}', COUNT(*), ROUND(AVG(age),1), NULL, {_pct("SUM(CASE WHEN smoking_status='smokes' THEN 1 ELSE 0 END)", 'COUNT(*)', 1)}
 FROM fact_stroke f JOIN dim_patient d ON d.patient_id=f.patient_id WHERE label=1 AND hypertension=1 AND heart_disease=1""")
def ol20(spark, sf):
    star = fx.star(spark, sf)
    n = F.count(F.lit(1))
    positive = F.col("label") == 1

    def share(part):
        return F.round(F.try_divide(F.lit(100.0) * part, n.cast("double")), 1)
    return olap.dice([
        olap.Subgroup(_DICE[0], star.facts["fact_autism"], positive & (F.col("gender") == 1) & (F.col("age") >= 12),
                      {"avg_aq_score": F.round(F.avg("aq_score"), 2), "pct_risk": share(F.sum("family_asd"))}),
        olap.Subgroup(_DICE[1], star.facts["fact_diabetes"], positive & (F.col("polyuria") == 1) & (F.col("polydipsia") == 1),
                      {"pct_risk": share(F.sum("obesity"))}),
        olap.Subgroup(_DICE[2], star.facts["fact_stroke"], positive & (F.col("hypertension") == 1) & (F.col("heart_disease") == 1),
                      {"pct_risk": share(F.count_if(F.col("smoking_status") == "smokes"))})], star.dim, "patient_id")


# --- joins and sorts on their own ---

@query("jn1_inner_join", with_ctes("fact_stroke") + "SELECT d.patient_id, age, gender, label FROM fact_stroke f JOIN dim_patient d ON d.patient_id=f.patient_id")
def jn1(spark, sf):
    return fx.fact(spark, sf, "stroke").join(fx.dim_patient(spark, sf), "patient_id").select("patient_id", "age", "gender", "label")


@query("jn2_anti_join", """SELECT c_custkey, c_name FROM customer LEFT JOIN (SELECT DISTINCT o_custkey FROM orders WHERE o_totalprice > 400000) o
 ON o_custkey = c_custkey WHERE o_custkey IS NULL""")
def jn2(spark, sf):
    dear = fx.table(spark, sf, "orders").where("o_totalprice > 400000")
    return fx.table(spark, sf, "customer").join(dear, F.col("o_custkey") == F.col("c_custkey"), "left_anti").select("c_custkey", "c_name")


@query("jn4_scalar_subquery", """SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > (SELECT AVG(o_totalprice)*1.8 FROM orders)""")
def jn4(spark, sf):
    orders = fx.table(spark, sf, "orders")
    return orders.where(F.col("o_totalprice") > orders.agg(F.avg("o_totalprice") * 1.8).scalar()).select("o_orderkey", "o_totalprice")


@query("srt2_top_k", "SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber LIMIT 25")
def srt2(spark, sf):
    return (fx.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
            .orderBy(F.desc("l_extendedprice"), "l_orderkey", "l_linenumber").limit(25))


# --- validation ---

def _holey(spark, sf):
    """The star with every tenth patient missing from the dimension, so that orphans exist."""
    star = fx.star(spark, sf)
    return star.dim.where("patient_id % 10 <> 0"), star.facts


@query("val3_counts", with_ctes(*FACTS) + "SELECT 'dim_patient' AS table_name, COUNT(*) AS row_count FROM dim_patient UNION ALL "
       + " UNION ALL ".join(f"SELECT '{f}', COUNT(*) FROM {f}" for f in FACTS))
def val3(spark, sf):
    star = fx.star(spark, sf)
    return validate.row_counts({"dim_patient": star.dim, **star.facts})


@query("val4_orphans", with_ctes(*FACTS, d="SELECT * FROM dim_patient WHERE patient_id % 10 <> 0") + " UNION ALL ".join(
    f"SELECT '{f}' AS fact_table, COUNT(*) AS orphaned_rows FROM {f} f LEFT JOIN d ON d.patient_id=f.patient_id WHERE d.patient_id IS NULL" for f in FACTS))
def val4(spark, sf):
    dim, facts = _holey(spark, sf)
    return validate.orphan_counts(facts, dim, "patient_id")


_AUDIT = {"dim_patient": ["age", "gender", "source_dataset"], "fact_autism": ["aq_score", "label"], "fact_diabetes": ["label"],
          "fact_stroke": ["bmi", "avg_glucose_level", "label"]}


@query("val5_nulls", with_ctes(*FACTS) + " UNION ALL ".join(
    f"SELECT '{t}.{c}' AS column_checked, COUNT(*) - COUNT({c}) AS null_count FROM {t}" for t, cs in _AUDIT.items() for c in cs))
def val5(spark, sf):
    star = fx.star(spark, sf)
    tables = {"dim_patient": star.dim, **star.facts}
    return validate.null_audit({t: (tables[t], cs) for t, cs in _AUDIT.items()})


_DOMAINS = {"fact_autism": {"jaundice": [0, 1], "family_asd": [0, 1]},
            "fact_stroke": {"hypertension": [0, 1], "heart_disease": [0, 1], "residence_type": [0, 1], "work_type": WORK_TYPES,
                            "smoking_status": SMOKING}}


@query("val6_domain", with_ctes(*FACTS) + " UNION ALL ".join(
    f"SELECT '{t}.{c}' AS check_target, CAST(COUNT(*) FILTER (WHERE {c} NOT IN ({', '.join(map(repr, ok))})) AS BIGINT) AS violations FROM {t}"
    for t, cs in _DOMAINS.items() for c, ok in cs.items()))
def val6(spark, sf):
    star = fx.star(spark, sf)
    return validate.domain_violations({t: (star.facts[t], d) for t, d in _DOMAINS.items()})


def _stroke_constraints():
    c = validate.Constraint
    return [c.not_null("bmi"), c.one_of("work_type", WORK_TYPES), c.one_of("smoking_status", SMOKING),
            c.between("avg_glucose_level", 50, 250), c.one_of("label", [0, 1])]


@query("val7_constraints", with_ctes("fact_stroke") + f"""
SELECT 'bmi not null' AS constraint_name, COUNT(*) FILTER (WHERE bmi IS NULL) AS violations FROM fact_stroke
UNION ALL SELECT 'work_type in domain', COUNT(*) FILTER (WHERE work_type NOT IN ({', '.join(map(repr, WORK_TYPES))})) FROM fact_stroke
UNION ALL SELECT 'smoking_status in domain', COUNT(*) FILTER (WHERE smoking_status NOT IN ({', '.join(map(repr, SMOKING))})) FROM fact_stroke
UNION ALL SELECT 'avg_glucose_level between 50 and 250', COUNT(*) FILTER (WHERE avg_glucose_level NOT BETWEEN 50 AND 250) FROM fact_stroke
UNION ALL SELECT 'label in domain', COUNT(*) FILTER (WHERE label NOT IN (0, 1)) FROM fact_stroke""")
def val7(spark, sf):
    return validate.constraint_report(fx.fact(spark, sf, "stroke"), _stroke_constraints())


@query("val7b_good_rows", with_ctes("fact_stroke") + f"""
SELECT patient_id, work_type, smoking_status FROM fact_stroke WHERE bmi IS NOT NULL AND work_type IN ({', '.join(map(repr, WORK_TYPES))})
 AND smoking_status IN ({', '.join(map(repr, SMOKING))}) AND avg_glucose_level BETWEEN 50 AND 250""")
def val7b(spark, sf):
    good, _ = validate.split_by_constraints(fx.fact(spark, sf, "stroke"), _stroke_constraints())
    return good.select("patient_id", "work_type", "smoking_status")


@query("val8_load_validation", with_ctes(*FACTS, d="SELECT * FROM dim_patient WHERE patient_id % 10 <> 0") + f"""
SELECT check_name, CAST(expected AS BIGINT) AS expected, CAST(actual AS BIGINT) AS actual, expected = actual AS passed FROM (
SELECT 'dim_patient row count' AS check_name, (SELECT COUNT(*) FROM dim_patient) AS expected, (SELECT COUNT(*) FROM d) AS actual
{' '.join(f"UNION ALL SELECT '{f} row count', (SELECT COUNT(*) FROM {f}), (SELECT COUNT(*) FROM {f})" for f in FACTS)}
{' '.join(f"UNION ALL SELECT '{f} FK orphans', 0, (SELECT COUNT(*) FROM {f} WHERE patient_id NOT IN (SELECT patient_id FROM d))" for f in FACTS)}
UNION ALL SELECT 'NULL values in fact_stroke.bmi', 0, (SELECT COUNT(*) FROM fact_stroke WHERE bmi IS NULL)
UNION ALL SELECT 'NULL values in fact_autism.label', 0, (SELECT COUNT(*) FROM fact_autism WHERE label IS NULL))""")
def val8(spark, sf):
    dim, facts = _holey(spark, sf)
    expected = {"dim_patient": fx.dim_patient(spark, sf), **facts}
    return validate.load_validation(dim, facts, "patient_id", expected, {"fact_stroke": ["bmi"], "fact_autism": ["label"]})


@query("val9_cascade", with_ctes(*FACTS) + "SELECT 'dim_patient' AS table_name, COUNT(*) AS row_count FROM dim_patient WHERE age >= 18 UNION ALL "
       + " UNION ALL ".join(f"SELECT '{f}', COUNT(*) FROM {f} WHERE patient_id IN (SELECT patient_id FROM dim_patient WHERE age >= 18)" for f in FACTS))
def val9(spark, sf):
    star = fx.star(spark, sf)
    dim, facts = validate.cascade_delete(star.dim, star.facts, star.dim.where("age < 18"), "patient_id")
    return validate.row_counts({"dim_patient": dim, **facts})


@query("val2_binary", with_ctes("obs") + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, COUNT(*) FILTER (WHERE {c} NOT IN (0, 1)) AS violations FROM obs" for c in ("label", "f1", "f2", "f3", "f4", "m1")))
def val2(spark, sf):
    return validate.binary_violations(fx.obs(spark, sf), ["label", "f1", "f2", "f3", "f4", "m1"])


@query("val1_missing_columns", with_ctes("fact_stroke") + """SELECT column_name FROM (SELECT 'bmi' AS column_name, COUNT(*) FILTER (WHERE bmi IS NULL) AS n
 FROM fact_stroke UNION ALL SELECT 'label', COUNT(*) FILTER (WHERE label IS NULL) FROM fact_stroke) WHERE n > 0""")
def val1(spark, sf):
    fact = fx.fact(spark, sf, "stroke")
    return literal_rows(spark, [(c,) for c in validate.columns_with_missing(fact)], "column_name string")


# --- profiles ---

_STROKE_COLUMNS = ["patient_id", "hypertension", "heart_disease", "ever_married", "work_type", "residence_type", "avg_glucose_level", "bmi",
                   "smoking_status", "label"]


@query("prf1_shape", "SELECT COUNT(*) AS n_rows, 11 AS n_cols, 'l_orderkey,l_partkey,l_suppkey,l_linenumber,l_quantity,l_extendedprice,"
       "l_discount,l_tax,l_returnflag,l_linestatus,l_shipdate' AS columns FROM lineitem")
def prf1(spark, sf):
    return profile.shape(fx.table(spark, sf, "lineitem"))


@query("prf2_missing", with_ctes("fact_stroke") + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, COUNT(*) - COUNT({c}) AS missing, ROUND(100.0*(COUNT(*)-COUNT({c}))/COUNT(*), 4) AS pct_of_rows FROM fact_stroke"
    for c in _STROKE_COLUMNS))
def prf2(spark, sf):
    return profile.missing_profile(fx.fact(spark, sf, "stroke"))


@query("prf3_types", """SELECT * FROM (SELECT 'bigint' AS data_type, 3 AS n_columns, COUNT(l_orderkey) + COUNT(l_partkey) + COUNT(l_suppkey) AS n_values FROM lineitem
 UNION ALL SELECT 'double', 4, COUNT(l_quantity) + COUNT(l_extendedprice) + COUNT(l_discount) + COUNT(l_tax) FROM lineitem UNION ALL SELECT 'int', 1, COUNT(l_linenumber) FROM lineitem
 UNION ALL SELECT 'string', 2, COUNT(l_returnflag) + COUNT(l_linestatus) FROM lineitem UNION ALL SELECT 'timestamp_ntz', 1, COUNT(l_shipdate) FROM lineitem)""")
def prf3(spark, sf):
    return profile.type_overview(fx.table(spark, sf, "lineitem"))


def _preview(columns: list[str], source: str) -> str:
    one = """SELECT '{c}' AS column_name, COUNT(*) AS n_distinct, STRING_AGG(v, ', ' ORDER BY v) FILTER (WHERE r <= 6)
 || CASE WHEN COUNT(*) > 6 THEN ' ...' ELSE '' END AS sample FROM (SELECT v, ROW_NUMBER() OVER (ORDER BY v) AS r FROM (SELECT DISTINCT {c} AS v
 FROM {s} WHERE {c} IS NOT NULL))"""
    return " UNION ALL ".join(one.format(c=c, s=source) for c in columns)


@query("prf4_categories", _preview(["p_name", "p_brand", "p_type"], "part"))
def prf4(spark, sf):
    return profile.category_preview(fx.table(spark, sf, "part"))


def _totals(name: str, columns: list[str]) -> str:
    missing = " + ".join(f"(COUNT(*) - COUNT({c}))" for c in columns)
    bad = " + ".join(f"CASE WHEN COUNT(*) > COUNT({c}) THEN 1 ELSE 0 END" for c in columns)
    return (f"SELECT '{name}' AS dataset, COUNT(*) AS n_rows, {len(columns)} AS n_cols, CAST({missing} AS BIGINT) AS missing_cells, "
            f"ROUND(100.0*({missing})/(COUNT(*)*{len(columns)}), 4) AS missing_pct, {bad} AS columns_with_missing FROM {name}")


_AUTISM_COLUMNS = ["patient_id", *AQ_ITEMS, "aq_score", "jaundice", "family_asd", "label"]


@query("prf5_dataset_summary", with_ctes(*FACTS) + _totals("fact_autism", _AUTISM_COLUMNS) + " UNION ALL "
       + _totals("fact_diabetes", ["patient_id", *SYMPTOMS, "label"]) + " UNION ALL " + _totals("fact_stroke", _STROKE_COLUMNS))
def prf5(spark, sf):
    return profile.dataset_summary(fx.star(spark, sf).facts)


@query("prf6_change_report", with_ctes("fact_stroke") + """
SELECT metric, CAST(before AS BIGINT) AS before, CAST(after AS BIGINT) AS after, CAST(after - before AS BIGINT) AS delta FROM (
SELECT 'rows' AS metric, (SELECT COUNT(*) FROM fact_stroke) AS before, (SELECT COUNT(bmi) FROM fact_stroke) AS after
UNION ALL SELECT 'columns', 10, 9 UNION ALL SELECT 'missing_cells', (SELECT COUNT(*) - COUNT(bmi) FROM fact_stroke), 0)""")
def prf6(spark, sf):
    fact = fx.fact(spark, sf, "stroke")
    return profile.change_report(fact, fact.where("bmi IS NOT NULL").drop("patient_id"))


def _cleaning(name: str, columns: list[str]) -> str:
    missing = " + ".join(f"(COUNT(*) - COUNT({c}))" for c in columns)
    return (f"SELECT '{name}' AS dataset, COUNT(*) AS n_rows, {len(columns)} AS n_cols, CAST({missing} AS BIGINT) AS missing_cells, "
            f"ROUND(100.0*COUNT(*) FILTER (WHERE label=1)/COUNT(*), 2) AS target_pct FROM {name}")


@query("prf7_cleaning_summary", with_ctes(*FACTS) + _cleaning("fact_autism", _AUTISM_COLUMNS) + " UNION ALL "
       + _cleaning("fact_diabetes", ["patient_id", *SYMPTOMS, "label"]) + " UNION ALL " + _cleaning("fact_stroke", _STROKE_COLUMNS))
def prf7(spark, sf):
    return profile.cleaning_summary(fx.star(spark, sf).facts, "label")


@query("prf8_describe", with_ctes("obs") + " UNION ALL ".join(
    f"SELECT label, '{c}' AS feature, COUNT({c}) AS n, ROUND(AVG({c}),4) AS mean, ROUND(STDDEV_SAMP({c}),4) AS std, ROUND(MIN({c}),4) AS min, "
    f"ROUND(quantile_cont({c}, 0.25),4) AS q25, ROUND(quantile_cont({c}, 0.5),4) AS q50, ROUND(quantile_cont({c}, 0.75),4) AS q75, "
    f"ROUND(MAX({c}),4) AS max FROM obs GROUP BY label" for c in ("m1", "m2")))
def prf8(spark, sf):
    return profile.describe_by(fx.obs(spark, sf), "label", ["m1", "m2"], digits=4)
