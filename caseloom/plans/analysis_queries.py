"""Cleaning, exploratory aggregates, statistics and evaluation queries with their oracles."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from caseloom.functions.scalar import _ERFC
from caseloom.operators import aggregate, clean, evaluate, olap, stats
from caseloom.operators.star import Cohort, assign_keys, build_star
from caseloom.plans import fixtures as fx
from caseloom.plans.catalog import Catalog
from caseloom.plans.fixtures import FACTS, OBS_FLAGS, OBS_MEASURES, SYMPTOMS, with_ctes

catalog = Catalog()
query = catalog.query


def sql_hash(key: str, seed: int = 42) -> str:
    """The seeded hash of a key expression, in DuckDB."""
    return f"CAST('0x' || SUBSTR(md5({key} || '|{seed}'), 1, 15) AS BIGINT)"


LINE_KEY = "concat_ws('|', l_orderkey, l_linenumber, l_partkey, cents)"


# --- cleaning ---

@query("cln1_trim", "SELECT c_custkey, c_name, c_mktsegment FROM customer")
def cln1(spark, sf):
    raw = fx.table(spark, sf, "customer").select("c_custkey", F.concat(F.lit("  "), "c_name", F.lit("\t ")).alias("c_name"), F.concat("c_mktsegment", F.lit(" \n")).alias("c_mktsegment"))
    return clean.trim_strings(raw)


@query("cln2_rename_drop", "SELECT o_orderkey AS order_id, o_totalprice AS \"Class\" FROM orders")
def cln2(spark, sf):
    raw = fx.table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    return clean.drop_columns(clean.rename_columns(raw, {"o_orderkey": "order_id", "o_totalprice": "Class"}), ["o_orderstatus"])


@query("cln3_map", """SELECT l_orderkey, l_linenumber, CAST(CASE l_returnflag WHEN 'R' THEN 1 WHEN 'N' THEN 0 END AS INT) AS flag,
 CASE l_linestatus WHEN 'O' THEN 'open' ELSE l_linestatus END AS status FROM lineitem""")
def cln3(spark, sf):
    raw = fx.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.lower("l_returnflag").alias("flag"), F.col("l_linestatus").alias("status"))
    return clean.map_columns(clean.map_columns(raw, ["flag"], {"R": 1, "N": 0}), ["status"], {"o": "open"})


@query("cln5_sentinels", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus NOT IN ('P') OR o_orderstatus IS NULL")
def cln5(spark, sf):
    return clean.drop_sentinels(fx.table(spark, sf, "orders").select("o_orderkey", "o_orderstatus"), "o_orderstatus", ["p"])


@query("cln6_score_cast", with_ctes("obs") + "SELECT l_orderkey, l_linenumber, CAST(f1+f2+f3+f4 AS TINYINT) AS score FROM obs")
def cln6(spark, sf):
    scored = clean.add_score(fx.obs(spark, sf), OBS_FLAGS, "score")
    return clean.cast_columns(scored, {"score": "tinyint"}).select("l_orderkey", "l_linenumber", "score")


_AGE_BIN = ("CASE WHEN age > 0 AND age <= 18 THEN '0-18' WHEN age > 18 AND age <= 40 THEN '19-40' WHEN age > 40 AND age <= 60 THEN '41-60' "
            "WHEN age > 60 AND age <= 80 THEN '61-80' WHEN age > 80 THEN '81+' END")


@query("cln8_bins", with_ctes("dim_patient") + f"SELECT patient_id, {_AGE_BIN} AS bracket FROM dim_patient")
def cln8(spark, sf):
    return fx.dim_patient(spark, sf).select("patient_id", clean.age_bracket("age").alias("bracket"))


def _stroke_ages(spark, sf):
    return fx.fact(spark, sf, "stroke").join(fx.dim_patient(spark, sf), "patient_id").select(
        "patient_id", "bmi", clean.age_bracket("age").alias("bracket"))


_AGED = f"SELECT f.patient_id, bmi, {_AGE_BIN} AS bracket FROM fact_stroke f JOIN dim_patient d ON d.patient_id=f.patient_id"
_MEDS = "SELECT bracket, median(bmi) AS m FROM aged WHERE bracket IS NOT NULL GROUP BY bracket"
_FILLED = "SELECT patient_id, a.bracket, COALESCE(bmi, m) AS bmi FROM aged a LEFT JOIN meds ON meds.bracket = a.bracket"


@query("cln9_median_impute", with_ctes("fact_stroke", aged=_AGED, meds=_MEDS, filled=_FILLED) + """
SELECT patient_id, bracket, ROUND(COALESCE(bmi, (SELECT median(bmi) FROM filled)), 8) AS bmi FROM filled""")
def cln9(spark, sf):
    aged = _stroke_ages(spark, sf)
    return clean.MedianImputer("bmi", "bracket").fit(aged).transform(aged).select("patient_id", "bracket", F.round("bmi", 8).alias("bmi"))


@query("cln9b_bracket_table", with_ctes("fact_stroke", aged=_AGED) + """
SELECT bracket, ROUND(median(bmi), 8) AS median, COUNT(*) - COUNT(bmi) AS missing FROM aged WHERE bracket IS NOT NULL GROUP BY bracket""")
def cln9b(spark, sf):
    aged = _stroke_ages(spark, sf)
    return clean.MedianImputer("bmi", "bracket").fit(aged).bracket_table(aged).where("bracket IS NOT NULL").withColumn("median", F.round("median", 8))


@query("cln10_align_union", with_ctes("dim_patient") + """
SELECT patient_id, CAST(age AS SMALLINT) AS age, CAST(gender AS TINYINT) AS gender FROM dim_patient
UNION ALL SELECT o_orderkey, CAST(round_even((o_orderkey % 240) / 12.0, 0) AS SMALLINT), CAST(CASE o_orderstatus WHEN 'F' THEN 1 ELSE 0 END AS TINYINT) FROM orders""")
def cln10(spark, sf):
    main = fx.dim_patient(spark, sf).select("patient_id", F.col("age").cast("smallint").alias("age"), F.col("gender").cast("tinyint").alias("gender"))
    other = fx.table(spark, sf, "orders")
    sex = F.when(F.col("o_orderstatus") == "F", "yes").otherwise("no")
    return clean.align_union(main, other, {
        "patient_id": F.col("o_orderkey"), "age": clean.months_to_years(F.col("o_orderkey") % 240),
        "gender": clean.map_value(sex, {"yes": 1, "no": 0})})


@query("cln11_slang", """SELECT doc_id, md5(REPLACE(REPLACE(REPLACE(LOWER(text), 'bc', 'because'), 'w/', 'with'), ' u ', ' you ')) AS fingerprint
 FROM documents""")
def cln11(spark, sf):
    docs = fx.table(spark, sf, "documents")
    return docs.select("doc_id", F.md5(clean.expand_slang(F.lower("text"))).alias("fingerprint"))


def _cohorts(spark, sf):
    customers = fx.table(spark, sf, "customer")
    suppliers = fx.table(spark, sf, "supplier")
    parts = fx.table(spark, sf, "part")
    return [Cohort("supplier", suppliers, "s_suppkey", {"age": F.col("s_acctbal"), "gender": F.col("s_nationkey") % 2}, {"label": F.when(F.col("s_acctbal") > 0, 1).otherwise(0)}),
            Cohort("customer", customers, "c_custkey", {"age": F.col("c_acctbal"), "gender": F.col("c_nationkey") % 2}, {"label": F.when(F.col("c_acctbal") > 0, 1).otherwise(0)}),
            Cohort("part", parts, "p_partkey", {"age": F.col("p_retailprice"), "gender": F.col("p_size") % 2}, {"label": F.when(F.col("p_size") > 25, 1).otherwise(0)})]


_KEYED = """SELECT ROW_NUMBER() OVER (ORDER BY block, natural_key) AS patient_id, source, natural_key, age, gender, label FROM (
 SELECT 1 AS block, 'supplier' AS source, s_suppkey AS natural_key, s_acctbal AS age, s_nationkey % 2 AS gender, CASE WHEN s_acctbal>0 THEN 1 ELSE 0 END AS label FROM supplier
 UNION ALL SELECT 2, 'customer', c_custkey, c_acctbal, c_nationkey % 2, CASE WHEN c_acctbal>0 THEN 1 ELSE 0 END FROM customer
 UNION ALL SELECT 3, 'part', p_partkey, p_retailprice, p_size % 2, CASE WHEN p_size>25 THEN 1 ELSE 0 END FROM part)"""


@query("cln13_surrogate", f"WITH keyed AS ({_KEYED}) SELECT source, natural_key, patient_id FROM keyed")
def cln13(spark, sf):
    return assign_keys(_cohorts(spark, sf)).select(F.col("_source").alias("source"), F.col("_order").alias("natural_key"), "patient_id")


@query("cln13b_surrogate_cells", f"WITH keyed AS ({_KEYED}) SELECT source, natural_key, patient_id FROM keyed")
def cln13b(spark, sf):
    """The path for tables too large for one cell, on the same data."""
    return assign_keys(_cohorts(spark, sf), cells=16).select(F.col("_source").alias("source"), F.col("_order").alias("natural_key"), "patient_id")


@query("cln14_split_star", f"WITH keyed AS ({_KEYED}) SELECT source AS source_dataset, patient_id, age, CAST(gender AS INT) AS gender, label FROM keyed")
def cln14(spark, sf):
    built = build_star(_cohorts(spark, sf))
    return built.dim.join(built.labels(), ["patient_id", "source_dataset"]).select("source_dataset", "patient_id", "age", "gender", "label")


# --- exploratory aggregates ---

@query("ag1_class_distribution", with_ctes("obs") + "SELECT label, COUNT(*) AS n, ROUND(100.0*COUNT(*)/(SELECT COUNT(*) FROM obs), 2) AS pct FROM obs GROUP BY label")
def ag1(spark, sf):
    return aggregate.class_distribution(fx.obs(spark, sf))


@query("ag2_imbalance_table", with_ctes(*FACTS) + " UNION ALL ".join(
    f"""SELECT '{f}' AS dataset, COUNT(*) AS total, COUNT(*) FILTER (WHERE label=1) AS positive, COUNT(*) FILTER (WHERE label=0) AS negative,
 ROUND(100.0*COUNT(*) FILTER (WHERE label=1)/COUNT(*), 2) AS positive_pct, '1 : ' || format('{{:.1f}}', ROUND(CAST(COUNT(*) FILTER (WHERE label=0) AS DOUBLE)/COUNT(*) FILTER (WHERE label=1), 1)) AS imbalance_ratio,
 CASE WHEN CAST(COUNT(*) FILTER (WHERE label=0) AS DOUBLE)/COUNT(*) FILTER (WHERE label=1) <= 10 THEN 'class_weight=balanced' ELSE 'SMOTE + scale_pos_weight (SEVERE)' END AS strategy FROM {f}""" for f in FACTS))
def ag2(spark, sf):
    return aggregate.imbalance_table(fx.star(spark, sf).facts)


@query("ag3_crosstab_pct", with_ctes("obs") + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS value, COUNT(*) FILTER (WHERE label=0) AS n_0, COUNT(*) FILTER (WHERE label=1) AS n_1, "
    f"ROUND(100.0*COUNT(*) FILTER (WHERE label=0)/COUNT(*),2) AS pct_0, ROUND(100.0*COUNT(*) FILTER (WHERE label=1)/COUNT(*),2) AS pct_1 FROM obs GROUP BY {c}" for c in OBS_FLAGS))
def ag3(spark, sf):
    return aggregate.crosstabs(fx.obs(spark, sf), OBS_FLAGS)


@query("ag4_two_key_shares", with_ctes("obs_cat") + """SELECT cat, COUNT(*) FILTER (WHERE f1=0) AS n_0, COUNT(*) FILTER (WHERE f1=1) AS n_1,
 ROUND(100.0*COUNT(*) FILTER (WHERE f1=0)/COUNT(*),2) AS pct_0, ROUND(100.0*COUNT(*) FILTER (WHERE f1=1)/COUNT(*),2) AS pct_1 FROM obs_cat GROUP BY cat""")
def ag4(spark, sf):
    return aggregate.two_key_shares(fx.obs(spark, sf, True), "cat", "f1", [0, 1])


@query("ag5_rate", with_ctes("obs_cat") + "SELECT cat, CAST(SUM(label) AS BIGINT) AS positives, COUNT(label) AS n, ROUND(100.0*SUM(label)/COUNT(label), 4) AS rate FROM obs_cat GROUP BY cat")
def ag5(spark, sf):
    return aggregate.rate_by(fx.obs(spark, sf, True), "cat")


@query("ag6_top_gaps", with_ctes("fact_diabetes") + "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, ROUND(AVG(CASE WHEN label=1 THEN {c}*100.0 END)-AVG(CASE WHEN label=0 THEN {c}*100.0 END),4) AS gap FROM fact_diabetes" for c in SYMPTOMS)
       + ") ORDER BY gap DESC, feature LIMIT 5")
def ag6(spark, sf):
    return olap.class_gap_top(fx.fact(spark, sf, "diabetes"), SYMPTOMS, 5)


@query("ag6b_class_means", with_ctes("obs") + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, label, ROUND(AVG({c}), 6) AS mean FROM obs GROUP BY label" for c in [*OBS_FLAGS, *OBS_MEASURES]))
def ag6b(spark, sf):
    return aggregate.class_means(fx.obs(spark, sf), [*OBS_FLAGS, *OBS_MEASURES]).withColumn("mean", F.round("mean", 6))


@query("ag7_class_sample", with_ctes("obs") + f"""SELECT l_orderkey, l_linenumber, label FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY label
 ORDER BY {sql_hash(LINE_KEY)}) AS r FROM obs) WHERE label = 1 OR r <= 600""")
def ag7(spark, sf):
    return aggregate.sample_per_class(fx.obs(spark, sf), fx.OBS_KEY, "label", 600, classes=[0]).select("l_orderkey", "l_linenumber", "label")


@query("ag8_histogram", with_ctes("obs", b="""SELECT label, LEAST(CAST(FLOOR((m2 - 0.0) / (110000.0/35)) AS INT), 34) AS bin, COUNT(*) AS n
 FROM obs WHERE m2 BETWEEN 0 AND 110000 GROUP BY 1, 2""") + """
SELECT label, bin, ROUND(bin * (110000.0/35), 6) AS bin_start, n, ROUND(n / (SUM(n) OVER (PARTITION BY label) * (CAST(110000 AS DOUBLE)/35)), 8) AS density FROM b""")
def ag8(spark, sf):
    return aggregate.histogram(fx.obs(spark, sf), "m2", "label", 0.0, 110000.0, 35).withColumn("bin_start", F.round("bin_start", 6))


@query("ag9_box", with_ctes("obs", long="SELECT label, 'm1' AS feature, m1 AS value FROM obs UNION ALL SELECT label, 'm2', m2 FROM obs",
                            q="""SELECT label, feature, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median, quantile_cont(value, 0.75) AS q3
 FROM long GROUP BY label, feature""") + """
SELECT l.label, l.feature, ROUND(q1, 6) AS q1, ROUND(median, 6) AS median, ROUND(q3, 6) AS q3,
 MIN(CASE WHEN value BETWEEN q1 - 1.5*(q3-q1) AND q3 + 1.5*(q3-q1) THEN value END) AS whisker_low,
 MAX(CASE WHEN value BETWEEN q1 - 1.5*(q3-q1) AND q3 + 1.5*(q3-q1) THEN value END) AS whisker_high,
 COUNT(*) FILTER (WHERE value NOT BETWEEN q1 - 1.5*(q3-q1) AND q3 + 1.5*(q3-q1)) AS outliers
FROM long l JOIN q ON q.label=l.label AND q.feature=l.feature GROUP BY l.label, l.feature, q1, median, q3""")
def ag9(spark, sf):
    box = aggregate.box_stats(fx.obs(spark, sf), OBS_MEASURES, "label")
    return box.withColumns({c: F.round(c, 6) for c in ("q1", "median", "q3")})


_KDE = """SELECT label AS l, 0.0 + (FLOOR((m1 - 0.0)/(CAST(60 AS DOUBLE)/512)) + 0.5)*(CAST(60 AS DOUBLE)/512) AS c, COUNT(*) AS n FROM obs GROUP BY 1, 2"""
_KDE_M = "SELECT label, COUNT(m1) AS size, STDDEV_SAMP(m1) * POW(COUNT(m1), -0.2) AS h FROM obs GROUP BY label"
_KDE_OUT = f"""SELECT m.label, ROUND(g.i * (CAST(60 AS DOUBLE)/49), 6) AS x,
 ROUND(SUM(n * EXP(-0.5 * POW((g.i * (CAST(60 AS DOUBLE)/49) - c)/h, 2))) / (size * h * {math.sqrt(2 * math.pi)!r}::DOUBLE), 8) AS density
FROM fine JOIN m ON m.label = l, (SELECT CAST(range AS INT) AS i FROM range(50)) g GROUP BY m.label, g.i, size, h"""


@query("ag10_density", with_ctes("obs", fine=_KDE, m=_KDE_M) + _KDE_OUT)
def ag10(spark, sf):
    kde = aggregate.density(fx.obs(spark, sf), "m1", "label", 0.0, 60.0)
    return kde.select("label", F.round("x", 6).alias("x"), F.round("density", 8).alias("density"))


@query("ag11_violin", with_ctes("obs", fine=_KDE, m=_KDE_M, kde=_KDE_OUT, e="SELECT label, MIN(m1) AS minimum, median(m1) AS median, MAX(m1) AS maximum FROM obs GROUP BY label")
       + "SELECT kde.label, x, density, minimum, median, maximum FROM kde JOIN e ON e.label=kde.label")
def ag11(spark, sf):
    v = aggregate.violin(fx.obs(spark, sf), "m1", "label", 0.0, 60.0)
    return v.withColumns({"x": F.round("x", 6), "density": F.round("density", 8)})


# --- statistics ---

def _erfc_sql(z: str) -> str:
    poly = repr(_ERFC[-1])
    for c in reversed(_ERFC[:-1]):
        poly = f"({c!r} + (1.0/(1.0+0.5*{z}))*{poly})"
    return f"((1.0/(1.0+0.5*{z}))*EXP(-{z}*{z}+{poly}))"


_TESTED = [*OBS_FLAGS]


def _chi2_sql(features: list[str], source: str, label: str = "label") -> str:
    cells = " UNION ALL ".join(f"SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS value, {label} AS class, COUNT(*) AS o FROM {source} GROUP BY 2, 3" for c in features)
    return f"""cells AS ({cells}), r AS (SELECT feature, value, SUM(o) AS r FROM cells GROUP BY 1, 2), k AS (SELECT feature, class, SUM(o) AS k FROM cells GROUP BY 1, 2),
 t AS (SELECT feature, SUM(k) AS n, COUNT(*) AS nk FROM k GROUP BY 1), nr AS (SELECT feature, COUNT(*) AS nr FROM r GROUP BY 1),
 e AS (SELECT r.feature, CAST(r AS DOUBLE)*k/n AS e, COALESCE(o, 0) AS o, (nr-1)*(nk-1) AS dof FROM r JOIN k ON k.feature=r.feature JOIN t ON t.feature=r.feature
  JOIN nr ON nr.feature=r.feature LEFT JOIN cells c ON c.feature=r.feature AND c.value=r.value AND c.class=k.class),
 chi AS (SELECT feature, SUM(POW(CASE WHEN dof=1 THEN ABS(o-e)-LEAST(0.5, ABS(o-e)) ELSE ABS(o-e) END, 2)/e) AS chi2, CAST(MAX(dof) AS INT) AS dof FROM e GROUP BY 1)"""


@query("st1_chi2", with_ctes("obs").rstrip() + ", " + _chi2_sql(_TESTED, "obs") + f"""
SELECT feature, ROUND(chi2, 6) AS chi2, dof, ROUND({_erfc_sql('SQRT(chi2/2)')}, 6) AS p_value, chi2 > 3.841458820694124 AS significant FROM chi""")
def st1(spark, sf):
    return stats.chi2_independence(fx.obs(spark, sf), _TESTED).withColumns({"chi2": F.round("chi2", 6), "p_value": F.round("p_value", 6)})


@query("st1b_chi2_many_values", with_ctes("obs_cat").rstrip() + ", " + _chi2_sql(["cat"], "obs_cat") + "SELECT feature, ROUND(chi2, 6) AS chi2, dof FROM chi")
def st1b(spark, sf):
    return stats.chi2_independence(fx.obs(spark, sf, True), ["cat"]).select("feature", F.round("chi2", 6).alias("chi2"), "dof")


def _mw_sql(c: str) -> str:
    return f"""SELECT '{c}' AS feature, SUM(n0*(COALESCE(below, 0)+n1/2.0)) AS u, SUM(POW(n0+n1, 3)-(n0+n1)) AS ties, SUM(n0) AS m, SUM(n1) AS k, SUM(v*n0) AS s0, SUM(v*n1) AS s1 FROM (
 SELECT v, CAST(n0 AS DOUBLE) AS n0, CAST(n1 AS DOUBLE) AS n1, SUM(CAST(n1 AS DOUBLE)) OVER (ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS below FROM (
 SELECT {c} AS v, COUNT(*) FILTER (WHERE label=0) AS n0, COUNT(*) FILTER (WHERE label=1) AS n1 FROM obs GROUP BY 1))"""


_MW = " UNION ALL ".join(_mw_sql(c) for c in OBS_MEASURES)
_MW_Z = "GREATEST(ABS(u-m*k/2)-0.5, 0)/SQRT(m*k/12*(m+k+1-ties/((m+k)*(m+k-1))))"


@query("st2_mannwhitney", with_ctes("obs", mw=_MW, z=f"SELECT *, {_MW_Z} AS z FROM mw") + f"""
SELECT feature, ROUND(s0/m, 6) AS mean_0, ROUND(s1/k, 6) AS mean_1, u, ROUND(z, 6) AS z, ROUND({_erfc_sql('(z/SQRT(2.0::DOUBLE))')}, 6) AS p_value,
 ROUND(1-2*u/(m*k), 8) AS effect_r, z > 1.959963985 AS significant FROM z""")
def st2(spark, sf):
    out = stats.mann_whitney(fx.obs(spark, sf), OBS_MEASURES)
    return out.withColumns({"mean_0": F.round("mean_0", 6), "mean_1": F.round("mean_1", 6), "z": F.round("z", 6), "p_value": F.round("p_value", 6), "effect_r": F.round("effect_r", 8)})


@query("st2b_mannwhitney_cells", with_ctes("obs", mw=_MW) + "SELECT feature, u, ROUND(1-2*u/(m*k), 8) AS effect_r FROM mw")
def st2b(spark, sf):
    """The path for tables too large for one cell, on the same data."""
    return stats.mann_whitney(fx.obs(spark, sf), OBS_MEASURES, cells=16).select("feature", "u", F.round("effect_r", 8).alias("effect_r"))


_CORR = [*OBS_FLAGS, *OBS_MEASURES, "label"]


@query("st3_corr", with_ctes("obs") + " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, ROUND(CORR({a}, {b}), 6) AS r FROM obs" for i, a in enumerate(_CORR) for b in _CORR[:i]))
def st3(spark, sf):
    return stats.correlation_matrix(fx.obs(spark, sf), _CORR).withColumn("r", F.round("r", 6))


@query("st3b_target_corr", with_ctes("obs") + " UNION ALL ".join(f"SELECT '{a}' AS feature, ROUND(ABS(CORR({a}, label)), 6) AS abs_r FROM obs" for a in _CORR[:-1]))
def st3b(spark, sf):
    return stats.target_correlation(fx.obs(spark, sf), _CORR[:-1]).withColumn("abs_r", F.round("abs_r", 6))


def _ks_sql(c: str) -> str:
    return f"""SELECT '{c}' AS feature, MAX(ABS(c0/SUM0 - c1/SUM1)) AS ks, MAX(SUM0) AS m, MAX(SUM1) AS k FROM (SELECT SUM(n0) OVER (ORDER BY v) AS c0, SUM(n1) OVER (ORDER BY v) AS c1,
 SUM(n0) OVER () AS SUM0, SUM(n1) OVER () AS SUM1 FROM (SELECT {c} AS v, CAST(COUNT(*) FILTER (WHERE l_orderkey % 5 <> 0) AS DOUBLE) AS n0,
 CAST(COUNT(*) FILTER (WHERE l_orderkey % 5 = 0) AS DOUBLE) AS n1 FROM obs GROUP BY 1))"""


@query("st4_ks", with_ctes("obs", ks=" UNION ALL ".join(_ks_sql(c) for c in OBS_MEASURES)) + """
SELECT feature, ROUND(ks, 8) AS ks, ROUND(CASE WHEN lam < 0.2 THEN 1.0 ELSE GREATEST(0.0, LEAST(1.0, p)) END, 6) AS p_value,
 CASE WHEN CASE WHEN lam < 0.2 THEN 1.0 ELSE GREATEST(0.0, LEAST(1.0, p)) END > 0.05 THEN 'OK' ELSE 'WARNING' END AS status FROM (
 SELECT feature, ks, lam, 2*SUM(CASE WHEN i % 2 = 1 THEN 1.0::DOUBLE ELSE -1.0::DOUBLE END * EXP(-2.0*i*i*lam*lam)) AS p
 FROM (SELECT feature, ks, SQRT(m*k/(m+k))*ks AS lam FROM ks), (SELECT CAST(range AS DOUBLE) AS i FROM range(1, 101)) GROUP BY feature, ks, lam)""")
def st4(spark, sf):
    split = fx.obs(spark, sf).withColumn("split", F.when(F.col("l_orderkey") % 5 == 0, "test").otherwise("train"))
    return stats.kolmogorov_smirnov(split, OBS_MEASURES, "split", "train", "test").withColumns({"ks": F.round("ks", 8), "p_value": F.round("p_value", 6)})


@query("st5_significance", with_ctes("obs", mw=_MW, z=f"SELECT *, {_MW_Z} AS z FROM mw").rstrip() + ", " + _chi2_sql(_TESTED, "obs") + f""",
 p AS (SELECT 'chi2 — ' || feature AS test, {_erfc_sql('SQRT(chi2/2)')} AS p FROM chi UNION ALL SELECT 'rank — ' || feature, {_erfc_sql('(z/SQRT(2.0::DOUBLE))')} FROM z)
SELECT test, ROUND(LEAST(p, 1.0), 6) AS p_value, ROUND(-LOG10(GREATEST(LEAST(p, 1.0), 1e-300)), 4) AS neg_log10_p, p < 0.05 AS significant FROM p""")
def st5(spark, sf):
    data = fx.obs(spark, sf)
    table = stats.significance_table({"chi2": stats.chi2_independence(data, _TESTED), "rank": stats.mann_whitney(data, OBS_MEASURES)})
    return table.withColumns({"p_value": F.round("p_value", 6), "neg_log10_p": F.round("neg_log10_p", 4) + 0.0})


@query("st6_split_ratio", with_ctes("obs") + """SELECT ROUND(tr, 6) AS train_ratio, ROUND(te, 6) AS test_ratio, ABS(tr-te) < 1 AS maintained FROM (
 SELECT COUNT(*) FILTER (WHERE label=0 AND l_orderkey%5<>0)/CAST(COUNT(*) FILTER (WHERE label=1 AND l_orderkey%5<>0) AS DOUBLE) AS tr,
 COUNT(*) FILTER (WHERE label=0 AND l_orderkey%5=0)/CAST(COUNT(*) FILTER (WHERE label=1 AND l_orderkey%5=0) AS DOUBLE) AS te FROM obs)""")
def st6(spark, sf):
    split = fx.obs(spark, sf).withColumn("split", F.when(F.col("l_orderkey") % 5 == 0, "test").otherwise("train"))
    return stats.split_ratio_check(split, "split").withColumns({"train_ratio": F.round("train_ratio", 6), "test_ratio": F.round("test_ratio", 6)})


# --- evaluation ---

_CM = """SELECT {g}, COUNT(*) FILTER (WHERE label=0 AND prediction=0) AS tn, COUNT(*) FILTER (WHERE label=0 AND prediction=1) AS fp,
 COUNT(*) FILTER (WHERE label=1 AND prediction=0) AS fn, COUNT(*) FILTER (WHERE label=1 AND prediction=1) AS tp FROM pred GROUP BY {g}"""


def _z(num: str, den: str) -> str:
    return f"COALESCE(CAST({num} AS DOUBLE)/NULLIF({den}, 0), 0.0)"


P1, R1, P0, R0 = _z("tp", "tp+fp"), _z("tp", "tp+fn"), _z("tn", "tn+fn"), _z("tn", "tn+fp")
F1, F0 = _z(f"2*{P1}*{R1}", f"({P1}+{R1})"), _z(f"2*{P0}*{R0}", f"({P0}+{R0})")
S1, S0 = _z("tp+fn", "tn+fp+fn+tp"), _z("tn+fp", "tn+fp+fn+tp")
MCC = _z("(CAST(tp AS DOUBLE)*tn-CAST(fp AS DOUBLE)*fn)", "(SQRT(tp+fp)*SQRT(tp+fn)*SQRT(tn+fp)*SQRT(tn+fn))")
METRICS = {"accuracy": _z("tp+tn", "tn+fp+fn+tp"), "precision": P1, "recall": R1, "f1": F1, "specificity": R0, "mcc": MCC,
           "weighted_precision": f"{S1}*{P1}+{S0}*{P0}", "weighted_recall": f"{S1}*{R1}+{S0}*{R0}", "weighted_f1": f"{S1}*{F1}+{S0}*{F0}"}


@query("ev1_confusion", with_ctes("pred") + _CM.format(g="model, dataset"))
def ev1(spark, sf):
    return evaluate.confusion(fx.predictions(spark, sf), ["model", "dataset"])


@query("ev2_metrics", with_ctes("pred", cm=_CM.format(g="model, dataset")) + "SELECT model, dataset, tn, fp, fn, tp, "
       + ", ".join(f"ROUND({e}, 6) AS {n}" for n, e in METRICS.items()) + " FROM cm")
def ev2(spark, sf):
    return evaluate.metrics(fx.predictions(spark, sf), ["model", "dataset"], digits=6)


_CURVE = """SELECT model, probability, n0, n1, SUM(n0) OVER (PARTITION BY model ORDER BY probability DESC) AS fp, SUM(n1) OVER (PARTITION BY model ORDER BY probability DESC) AS tp,
 SUM(n0) OVER (PARTITION BY model) AS t0, SUM(n1) OVER (PARTITION BY model) AS t1 FROM (SELECT model, probability,
 CAST(COUNT(*) FILTER (WHERE label=0) AS DOUBLE) AS n0, CAST(COUNT(*) FILTER (WHERE label=1) AS DOUBLE) AS n1 FROM pred GROUP BY 1, 2)"""


@query("ev3_roc_points", with_ctes("pred", c=_CURVE) + "SELECT model, ROUND(probability, 8) AS threshold, ROUND(fp/t0, 8) AS fpr, ROUND(tp/t1, 8) AS tpr FROM c")
def ev3(spark, sf):
    p = evaluate.roc_points(fx.predictions(spark, sf), ["model"])
    return p.withColumns({c: F.round(c, 8) for c in ("threshold", "fpr", "tpr")})


@query("ev3b_auc", with_ctes("pred", c=_CURVE) + "SELECT model, ROUND(SUM(n1*((t0-fp)+n0/2))/(MAX(t0)*MAX(t1)), 8) AS roc_auc FROM c GROUP BY model")
def ev3b(spark, sf):
    return evaluate.ranking_scores(fx.predictions(spark, sf), ["model"]).select("model", F.round("roc_auc", 8).alias("roc_auc"))


@query("ev4_pr_points", with_ctes("pred", c=_CURVE) + "SELECT model, ROUND(probability, 8) AS threshold, ROUND(tp/(tp+fp), 8) AS precision, ROUND(tp/t1, 8) AS recall FROM c")
def ev4(spark, sf):
    p = evaluate.pr_points(fx.predictions(spark, sf), ["model"])
    return p.withColumns({c: F.round(c, 8) for c in ("threshold", "precision", "recall")})


@query("ev4b_average_precision", with_ctes("pred", c=_CURVE) + "SELECT model, ROUND(SUM(n1*tp/(tp+fp))/MAX(t1), 8) AS pr_auc FROM c GROUP BY model")
def ev4b(spark, sf):
    return evaluate.ranking_scores(fx.predictions(spark, sf), ["model"], cells=16).select("model", F.round("pr_auc", 8).alias("pr_auc"))


@query("ev5_cv_scores", with_ctes("pred", cm=_CM.format(g="model, fold")) + f"""
SELECT model, ROUND(AVG({F1}), 6) AS cv_mean, ROUND(STDDEV_POP({F1}), 6) AS cv_std, COUNT(*) AS n_folds FROM cm GROUP BY model""")
def ev5(spark, sf):
    return evaluate.fold_scores(fx.predictions(spark, sf), ["model"]).withColumns({"cv_mean": F.round("cv_mean", 6), "cv_std": F.round("cv_std", 6)})


_SWEEP = f"""SELECT threshold, ROUND({P1}, 4) AS precision, ROUND({R1}, 4) AS recall, ROUND({F1}, 4) AS f1, ROUND({R0}, 4) AS specificity, dataset FROM (
 SELECT dataset, threshold, COUNT(*) FILTER (WHERE label=0 AND probability < threshold) AS tn, COUNT(*) FILTER (WHERE label=0 AND probability >= threshold) AS fp,
 COUNT(*) FILTER (WHERE label=1 AND probability < threshold) AS fn, COUNT(*) FILTER (WHERE label=1 AND probability >= threshold) AS tp
 FROM pred, (SELECT UNNEST([{', '.join(repr(t) + '::DOUBLE' for t in evaluate.SWEEP)}]) AS threshold) GROUP BY dataset, threshold)"""


@query("ev6_sweep", with_ctes("pred") + _SWEEP)
def ev6(spark, sf):
    return evaluate.threshold_sweep(fx.predictions(spark, sf), ["dataset"])


@query("ev7_thresholds", with_ctes("pred", s=_SWEEP) + """
SELECT dataset, arg_min(threshold, (-f1, threshold)) AS f1_threshold, MAX(f1) AS best_f1,
 COALESCE(arg_min(threshold, (-recall, threshold)) FILTER (WHERE precision >= 0.2), 0.5) AS clinical_threshold,
 COALESCE(arg_min(recall, (-recall, threshold)) FILTER (WHERE precision >= 0.2), 0.0) AS clinical_recall,
 COALESCE(arg_min(precision, (-recall, threshold)) FILTER (WHERE precision >= 0.2), 0.0) AS clinical_precision FROM s GROUP BY dataset""")
def ev7(spark, sf):
    return evaluate.best_thresholds(evaluate.threshold_sweep(fx.predictions(spark, sf), ["dataset"]), ["dataset"])


_REPORT = [("0", P0, R0, F0, "tn+fp"), ("1", P1, R1, F1, "tp+fn"),
           ("macro avg", f"({P0}+{P1})/2", f"({R0}+{R1})/2", f"({F0}+{F1})/2", "tn+fp+fn+tp"),
           ("weighted avg", f"{S1}*{P1}+{S0}*{P0}", f"{S1}*{R1}+{S0}*{R0}", f"{S1}*{F1}+{S0}*{F0}", "tn+fp+fn+tp")]


@query("ev8_class_report", with_ctes("pred", cm=_CM.format(g="model")) + " UNION ALL ".join(
    f"SELECT model, '{n}' AS class, ROUND({p}, 6) AS precision, ROUND({r}, 6) AS recall, ROUND({f}, 6) AS f1, {s} AS support FROM cm" for n, p, r, f, s in _REPORT))
def ev8(spark, sf):
    return evaluate.class_report(fx.predictions(spark, sf), ["model"]).withColumns({c: F.round(c, 6) for c in ("precision", "recall", "f1")})


_CURVE2 = _CURVE.replace("model, probability", "model, dataset, probability").replace("PARTITION BY model", "PARTITION BY model, dataset").replace("GROUP BY 1, 2", "GROUP BY 1, 2, 3")
_FULL = f"""SELECT cm.model, cm.dataset, {', '.join(f'ROUND({e}, 4) AS {n}' for n, e in METRICS.items())}, roc_auc, pr_auc FROM cm JOIN
 (SELECT model, dataset, ROUND(SUM(n1*((t0-fp)+n0/2))/(MAX(t0)*MAX(t1)), 4) AS roc_auc, ROUND(SUM(n1*tp/(tp+fp))/MAX(t1), 4) AS pr_auc FROM c GROUP BY 1, 2) a
 ON a.model=cm.model AND a.dataset=cm.dataset"""


@query("ev9_best", with_ctes("pred", cm=_CM.format(g="model, dataset"), c=_CURVE2, full_=_FULL) + """
SELECT dataset, model AS best_model, f1, recall, roc_auc, pr_auc, mcc FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY dataset
 ORDER BY CASE WHEN dataset='stroke' THEN pr_auc ELSE f1 END DESC, model) AS r FROM full_) WHERE r = 1""")
def ev9(spark, sf):
    full = evaluate.full_evaluation(fx.predictions(spark, sf), ["model", "dataset"])
    return evaluate.best_models(full, {"stroke": "pr_auc"})


@query("ev10_overfit", with_ctes("pred", cm=_CM.format(g="model, fold"), cv=f"SELECT model, AVG({F1}) AS cv_f1 FROM cm GROUP BY model",
                                  cmt=_CM.format(g="model")) + f"""
SELECT cv.model, ROUND(cv_f1, 6) AS cv_f1, ROUND({F1} - 0.06, 6) AS f1, ROUND(cv_f1 - ({F1} - 0.06), 4) AS gap, cv_f1 - ({F1} - 0.06) > 0.05 AS overfit FROM cv JOIN cmt ON cmt.model=cv.model""")
def ev10(spark, sf):
    pred = fx.predictions(spark, sf)
    cv = evaluate.fold_scores(pred, ["model"]).select("model", F.col("cv_mean").alias("cv_f1"))
    test = evaluate.metrics(pred, ["model"]).select("model", (F.col("f1") - 0.06).alias("f1"))
    out = evaluate.overfit_check(cv.join(test, "model"))
    return out.withColumns({"cv_f1": F.round("cv_f1", 6), "f1": F.round("f1", 6)})


@query("ev11_baselines", with_ctes("pred") + "SELECT dataset, ROUND(AVG(label), 8) AS no_skill, ROUND(1-AVG(label), 8) AS naive_accuracy FROM pred GROUP BY dataset")
def ev11(spark, sf):
    return evaluate.baselines(fx.predictions(spark, sf), ["dataset"]).withColumns({c: F.round(c, 8) for c in ("no_skill", "naive_accuracy")})


@query("ev12_run_log", with_ctes("pred", cm=_CM.format(g="model, dataset")) + f"""
SELECT 'run-1' AS run_id, dataset, model, 'metric' AS kind, name, CAST(ROUND(value, 2) AS VARCHAR) AS value FROM (
 SELECT dataset, model, 'accuracy' AS name, {METRICS['accuracy']} AS value FROM cm UNION ALL SELECT dataset, model, 'f1', {F1} FROM cm)
UNION ALL SELECT 'run-1', dataset, model, 'param', 'seed', '42' FROM cm""")
def ev12(spark, sf):
    results = evaluate.metrics(fx.predictions(spark, sf), ["dataset", "model"], digits=2)
    return evaluate.run_log(results, "run-1", {"seed": "42"}, ["accuracy", "f1"])


@query("ag12_metric_pivot", with_ctes("pred", cm=_CM.format(g="model, dataset"), f=f"SELECT model, dataset, ROUND({F1}, 4) AS f1 FROM cm") + """
SELECT model, MAX(f1) FILTER (WHERE dataset='autism') AS autism, MAX(f1) FILTER (WHERE dataset='diabetes') AS diabetes, MAX(f1) FILTER (WHERE dataset='stroke') AS stroke FROM f GROUP BY model""")
def ag12(spark, sf):
    results = evaluate.metrics(fx.predictions(spark, sf), ["model", "dataset"], digits=4)
    return aggregate.metric_pivot(results, "f1", ["autism", "diabetes", "stroke"])


@query("ag13_modelling_inputs", with_ctes("pred") + """SELECT dataset, COUNT(*) FILTER (WHERE fold<>0) AS train_rows, COUNT(*) FILTER (WHERE fold=0) AS test_rows, 15 AS n_features,
 COUNT(*) FILTER (WHERE fold<>0 AND label=1) AS train_positives, 2*GREATEST(COUNT(*) FILTER (WHERE fold<>0 AND label=1), COUNT(*) FILTER (WHERE fold<>0 AND label=0)) AS smote_rows FROM pred GROUP BY dataset""")
def ag13(spark, sf):
    split = fx.predictions(spark, sf).withColumn("split", F.when(F.col("fold") == 0, "test").otherwise("train"))
    return aggregate.modelling_inputs(split, "dataset", "split", "label", 15)
