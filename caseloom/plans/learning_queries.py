"""Feature, selection, model, explanation, rule, serving and file queries with their oracles."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from caseloom.configs import rules as rule_sets
from caseloom.operators import clean, evaluate, explain, features, models, rules, select, serve
from caseloom.operators.features import OneHot, Scaler
from caseloom.operators.reshape import literal_rows, to_long, union_all
from caseloom.operators.select import GeneticSearch
from caseloom.operators.star import create_views
from caseloom.plans import fixtures as fx
from caseloom.plans import intake, rendered
from caseloom.plans.analysis_queries import LINE_KEY, METRICS, _CM, sql_hash
from caseloom.plans.catalog import Catalog
from caseloom.plans.fixtures import AQ_ITEMS, OBS_FLAGS, OBS_MEASURES, SYMPTOMS, with_ctes
from caseloom.session import compact, cut_lineage, shared_dir
from caseloom.sources import files

catalog = Catalog()
query = catalog.query

KEYS = fx.OBS_KEY
STROKE_FEATURES = ["age", "gender", "hypertension", "heart_disease", "ever_married", "residence_type", "avg_glucose_level"]


# --- feature preparation ---

_DUMMIES = [("o_orderpriority", v) for v in ("2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")] + [("o_orderstatus", v) for v in ("O", "P")]


@query("fe1_onehot", "SELECT o_orderkey, o_totalprice, " + ", ".join(
    f"CASE WHEN {c}='{v}' THEN 1 ELSE 0 END AS \"{c}_{v}\"" for c, v in _DUMMIES) + " FROM orders")
def fe1(spark, sf):
    rows = fx.table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority", "o_orderstatus")
    return OneHot(["o_orderpriority", "o_orderstatus"]).fit(rows).transform(rows)


_RANKED = f"SELECT *, ROW_NUMBER() OVER (PARTITION BY label ORDER BY {sql_hash(LINE_KEY)}) - 1 AS r, COUNT(*) OVER (PARTITION BY label) AS n FROM obs"


@query("fe2_split", with_ctes("obs", r=_RANKED) + "SELECT l_orderkey, l_linenumber, l_partkey, cents, label, CASE WHEN r < ROUND(n*0.2) THEN 'test' ELSE 'train' END AS split FROM r")
def fe2(spark, sf):
    return features.stratified_split(fx.obs(spark, sf), KEYS).select(*KEYS, "label", "split")


_TRAIN = f"train AS (SELECT * FROM (SELECT *, CASE WHEN r < ROUND(n*0.2) THEN 'test' ELSE 'train' END AS split FROM ({_RANKED})) WHERE split='train')"


@query("fe3_scale", with_ctes("obs").rstrip() + f", {_TRAIN}, p AS (SELECT AVG(m1) AS a1, STDDEV_POP(m1) AS s1, AVG(m2) AS a2, STDDEV_POP(m2) AS s2 FROM train) "
       "SELECT l_orderkey, l_linenumber, l_partkey, cents, ROUND((m1-a1)/s1, 6) AS m1, ROUND((m2-a2)/s2, 6) AS m2 FROM obs, p")
def fe3(spark, sf):
    split = features.stratified_split(fx.obs(spark, sf), KEYS)
    scaled = Scaler(OBS_MEASURES).fit(split.where("split = 'train'")).transform(split)
    return scaled.select(*KEYS, F.round("m1", 6).alias("m1"), F.round("m2", 6).alias("m2"))


@query("fe4_weights", with_ctes("obs") + """SELECT class, n, ROUND((n0+n1)/(2.0*n), 8) AS weight, ROUND(n0/CAST(n1 AS DOUBLE), 8) AS scale_pos_weight FROM (
 SELECT label AS class, COUNT(*) AS n FROM obs GROUP BY label), (SELECT COUNT(*) FILTER (WHERE label=0) AS n0, COUNT(*) FILTER (WHERE label=1) AS n1 FROM obs)""")
def fe4(spark, sf):
    return features.class_weights(fx.obs(spark, sf)).withColumns({c: F.round(c, 8) for c in ("weight", "scale_pos_weight")})


@query("fe5_folds", with_ctes("obs", r=_RANKED) + "SELECT l_orderkey, l_linenumber, l_partkey, cents, label, CAST(FLOOR(r*5/n) AS INT) AS fold FROM r")
def fe5(spark, sf):
    return features.stratified_folds(fx.obs(spark, sf), KEYS).select(*KEYS, "label", "fold")


def _stroke_rows(spark, sf):
    return fx.fact(spark, sf, "stroke").join(fx.dim_patient(spark, sf), "patient_id")


_SMOTE_X = ["age", "hypertension", "avg_glucose_level"]
_UNIT = "(CAST('0x' || SUBSTR(md5(id || '|' || copy || '|{seed}'), 1, 13) AS BIGINT) / 4503599627370496.0::DOUBLE)"
_SMOTE_SQL = with_ctes(
    "fact_stroke", s="SELECT f.patient_id, label, age, CAST(hypertension AS DOUBLE) AS hypertension, avg_glucose_level FROM fact_stroke f JOIN dim_patient d ON d.patient_id=f.patient_id",
    c="SELECT COUNT(*) FILTER (WHERE label=1) AS n1, COUNT(*) FILTER (WHERE label=0) - COUNT(*) FILTER (WHERE label=1) AS need FROM s",
    m=f"SELECT *, ROW_NUMBER() OVER (ORDER BY {sql_hash('patient_id')}) - 1 AS r FROM s WHERE label=1",
    p="""SELECT age, hypertension, avg_glucose_level, MIN(patient_id) AS id, COUNT(*) AS m, SUM(need // n1 + CASE WHEN r < need % n1 THEN 1 ELSE 0 END) AS copies
 FROM m, c GROUP BY 1, 2, 3""",
    d="""SELECT a.id, b.age, b.hypertension, b.avg_glucose_level, b.m, ROW_NUMBER() OVER (PARTITION BY a.id ORDER BY
 SQRT((a.age-b.age)*(a.age-b.age) + (a.hypertension-b.hypertension)*(a.hypertension-b.hypertension) + (a.avg_glucose_level-b.avg_glucose_level)*(a.avg_glucose_level-b.avg_glucose_level)), b.id) AS rk
 FROM p a JOIN p b ON a.id <> b.id""",
    pool="""SELECT id, age, hypertension, avg_glucose_level, ROW_NUMBER() OVER (PARTITION BY id ORDER BY rk, t) - 1 AS slot FROM (
 SELECT id, age, hypertension, avg_glucose_level, 0 AS rk, UNNEST(range(0, m - 1)) AS t FROM p UNION ALL SELECT id, age, hypertension, avg_glucose_level, rk, UNNEST(range(0, m)) FROM d WHERE rk <= 5)
 QUALIFY slot < 5""",
    sz="SELECT id, COUNT(*) AS k FROM pool GROUP BY id",
    e="SELECT p.*, k, UNNEST(range(1, CAST(copies AS BIGINT) + 1)) AS copy FROM p JOIN sz ON sz.id = p.id") + f"""
SELECT patient_id AS base, CAST(0 AS BIGINT) AS copy, label, age, hypertension, ROUND(avg_glucose_level, 6) AS avg_glucose_level FROM s
UNION ALL SELECT e.id, e.copy, 1, ROUND(e.age + u*(q.age-e.age), 6), ROUND(e.hypertension + u*(q.hypertension-e.hypertension), 6),
 ROUND(e.avg_glucose_level + u*(q.avg_glucose_level-e.avg_glucose_level), 6) FROM (SELECT *, {_UNIT.format(seed=43)} AS u, CAST(FLOOR({_UNIT.format(seed=44)}*k) AS BIGINT) AS slot FROM e) e
 JOIN pool q ON q.id = e.id AND q.slot = e.slot"""


@query("fe6_smote", _SMOTE_SQL)
def fe6(spark, sf):
    out = features.smote(_stroke_rows(spark, sf), "patient_id", _SMOTE_X)
    return out.withColumns({c: F.round(c, 6) for c in _SMOTE_X})


@query("fe6b_smote_cells", _SMOTE_SQL)
def fe6b(spark, sf):
    """The neighbour search over many cells, on the same data."""
    out = features.smote(_stroke_rows(spark, sf), "patient_id", _SMOTE_X, cells=8)
    return out.withColumns({c: F.round(c, 6) for c in _SMOTE_X})


# sizes in closed form: a fold holds the ranks from ceil(n*f/5) on; what is left of the minority is raised to the majority
_SMOTE_FOLDS_SQL = with_ctes(
    "fact_stroke", c="SELECT label, COUNT(*) AS n FROM fact_stroke f JOIN dim_patient d ON d.patient_id=f.patient_id GROUP BY label",
    h="SELECT label, n, CAST(f AS INT) AS cv_fold, CAST(CEIL(n*(f+1)/5.0) - CEIL(n*f/5.0) AS BIGINT) AS held FROM c, (SELECT UNNEST(range(0, 5)) AS f)",
    t="SELECT *, n - held AS own, MAX(n - held) OVER (PARTITION BY cv_fold) AS most FROM h") + """
SELECT cv_fold, 'train' AS part, label, most AS n, most - own AS synthetic FROM t
UNION ALL SELECT cv_fold, 'valid', label, held, CAST(0 AS BIGINT) FROM t WHERE held > 0"""


@query("fe7_smote_folds", _SMOTE_FOLDS_SQL)
def fe7(spark, sf):
    folded = features.stratified_folds(_stroke_rows(spark, sf), "patient_id", k=5)
    made = features.smote_folds(folded, "patient_id", _SMOTE_X, folds=range(5))
    return made.groupBy("cv_fold", "part", "label").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("copy") > 0).alias("synthetic"))


@query("fe8_contract", with_ctes("fact_stroke") + "SELECT patient_id, CAST(heart_disease AS DOUBLE) AS heart_disease, 0.0::DOUBLE AS cholesterol, ROUND(COALESCE(bmi, 0), 8) AS bmi FROM fact_stroke")
def fe8(spark, sf):
    return features.feature_contract(fx.fact(spark, sf, "stroke"), ["heart_disease", "cholesterol", "bmi"], ["patient_id"]).withColumn("bmi", F.round("bmi", 8))


# --- feature selection ---

def _mi_sql(c: str, bin_: str) -> str:
    return f"""SELECT '{c}' AS feature, SUM(CASE WHEN n > 0 THEN n/t * LN(n*t/(nb*nc)) ELSE 0 END) AS score FROM (
 SELECT CAST(n AS DOUBLE) AS n, CAST(SUM(n) OVER (PARTITION BY b) AS DOUBLE) AS nb, CAST(SUM(n) OVER (PARTITION BY label) AS DOUBLE) AS nc, CAST(SUM(n) OVER () AS DOUBLE) AS t FROM (
 SELECT {bin_} AS b, label, COUNT(*) AS n FROM {{src}} GROUP BY 1, 2))"""


_BINNED = """(SELECT label, FLOOR(below*20.0/t) AS b FROM (SELECT label, RANK() OVER (ORDER BY m2) - 1 AS below, COUNT(*) OVER () AS t FROM obs))"""
_MI = " UNION ALL ".join([_mi_sql(c, c).format(src="obs") for c in [*OBS_FLAGS, "m1"]] + [_mi_sql("m2", "b").format(src=_BINNED)])


@query("fs1_mutual_info", with_ctes("obs", mi=_MI) + "SELECT feature, ROUND(score, 8) AS score FROM mi")
def fs1(spark, sf):
    return select.mutual_information(fx.obs(spark, sf), [*OBS_FLAGS, *OBS_MEASURES], discrete=[*OBS_FLAGS, "m1"]).withColumn("score", F.round("score", 8))


def _neighbour_sql(c: str, k: int = 3) -> str:
    """Ross' estimate of one feature: the k-th neighbour within the class among the next values, and the rows nearer than it."""
    psi = {n: select.digamma(n).replace("D", "::DOUBLE") for n in ("k", "ny", "m", "total")}
    sides = [(f"{f.lower()}{j}", f"{f}(x, {j}) OVER w", f"{f}(c, {j}) OVER w") for f in ("LAG", "LEAD") for j in range(1, k + 1)]
    beside = ", ".join(f"{x} AS {n}, {m} AS c{n}" for n, x, m in sides)
    names = [n for n, _, _ in sides]
    inside = lambda d: "c - 1 + " + " + ".join(f"CASE WHEN ABS({n} - x) <= {d} THEN c{n} ELSE 0 END" for n in names)
    reach = ", ".join(f"CASE WHEN {inside(f'ABS({n} - x)')} >= want THEN ABS({n} - x) END" for n in names)
    side = lambda sign, names: "CASE WHEN d = 0 THEN x " + " ".join(f"WHEN ABS({n} - x) = d THEN {n}" for n in names) + f" ELSE x {sign} d END"
    return f"""SELECT '{c}' AS feature, GREATEST(0.0, FIRST({psi['total']}) + SUM(c * ({psi['k']} - {psi['ny']} - {psi['m']})) / FIRST(total)) AS score FROM (
 SELECT q.*, CASE WHEN d = 0 THEN c - 1 ELSE want END AS k, (SELECT COUNT(*) FROM obs) AS total, CASE WHEN d = 0 THEN COALESCE(e.n, 0) - 1 ELSE COALESCE(h.cum, 0) - COALESCE(l.cum, 0) END AS m FROM (
  SELECT *, {side('+', [f'lead{j}' for j in range(1, k + 1)])} AS hi, {side('-', [f'lag{j}' for j in range(1, k + 1)])} AS lo FROM (
   SELECT *, CASE WHEN c > want THEN 0 ELSE LEAST({reach}) END AS d FROM (
    SELECT *, LEAST({k}, SUM(c) OVER (PARTITION BY label) - 1) AS want, SUM(c) OVER (PARTITION BY label) AS ny, {beside}
    FROM (SELECT label, CAST({c} AS DOUBLE) AS x, COUNT(*) AS c FROM obs GROUP BY 1, 2) WINDOW w AS (PARTITION BY label ORDER BY x)))) q
 LEFT JOIN (SELECT CAST({c} AS DOUBLE) AS x, COUNT(*) AS n FROM obs GROUP BY 1) e ON e.x = q.x
 ASOF LEFT JOIN cum_{c} h ON q.hi > h.x ASOF LEFT JOIN cum_{c} l ON q.lo >= l.x)"""


_CUM = {f"cum_{c}": f"SELECT x, SUM(n) OVER (ORDER BY x) AS cum FROM (SELECT CAST({c} AS DOUBLE) AS x, COUNT(*) AS n FROM obs GROUP BY 1)" for c in [*OBS_FLAGS, *OBS_MEASURES]}


@query("fs1b_neighbour_information", with_ctes("obs", **_CUM) + "SELECT feature, ROUND(score, 7) AS score FROM (" + " UNION ALL ".join(_neighbour_sql(c) for c in [*OBS_FLAGS, *OBS_MEASURES]) + ")")
def fs1b(spark, sf):
    return select.neighbour_information(fx.obs(spark, sf), [*OBS_FLAGS, *OBS_MEASURES]).withColumn("score", F.round("score", 7))


def _chi_score(c: str) -> str:
    return f"""SELECT '{c}' AS feature, (o0-e0)*(o0-e0)/e0 + (o1-e1)*(o1-e1)/e1 AS score FROM (SELECT o0, o1, (o0+o1)*n0/(n0+n1) AS e0, (o0+o1)*n1/(n0+n1) AS e1 FROM (
 SELECT SUM(CASE WHEN label=0 THEN ({c}-lo)/(hi-lo) END) AS o0, SUM(CASE WHEN label=1 THEN ({c}-lo)/(hi-lo) END) AS o1, CAST(COUNT(*) FILTER (WHERE label=0) AS DOUBLE) AS n0,
 CAST(COUNT(*) FILTER (WHERE label=1) AS DOUBLE) AS n1 FROM obs, (SELECT CAST(MIN({c}) AS DOUBLE) AS lo, CAST(MAX({c}) AS DOUBLE) AS hi FROM obs)))"""


_CHI = " UNION ALL ".join(_chi_score(c) for c in [*OBS_FLAGS, *OBS_MEASURES])
_COR = " UNION ALL ".join(f"SELECT '{c}' AS feature, ABS(CORR({c}, label)) AS score FROM obs" for c in [*OBS_FLAGS, *OBS_MEASURES])


@query("fs2_chi2_score", with_ctes("obs", chi=_CHI) + "SELECT feature, ROUND(score, 6) AS score FROM chi")
def fs2(spark, sf):
    return select.chi2_score(fx.obs(spark, sf), [*OBS_FLAGS, *OBS_MEASURES]).withColumn("score", F.round("score", 6))


@query("fs3_correlation", with_ctes("obs", cor=_COR) + "SELECT feature, ROUND(score, 8) AS score FROM cor")
def fs3(spark, sf):
    scores = select.feature_scores(fx.obs(spark, sf), [*OBS_FLAGS, *OBS_MEASURES], discrete=[*OBS_FLAGS, "m1"])
    return scores.where("method = 'correlation'").select("feature", F.round("score", 8).alias("score"))


_POSITION = " ".join(f"WHEN '{c}' THEN {i}" for i, c in enumerate([*OBS_FLAGS, *OBS_MEASURES]))


@query("fs4_rank_agg", with_ctes("obs", mi=_MI, chi=_CHI, cor=_COR, s="SELECT 'm' AS method, * FROM mi UNION ALL SELECT 'c', * FROM chi UNION ALL SELECT 'r', * FROM cor",
                                 k=f"SELECT feature, ROW_NUMBER() OVER (PARTITION BY method ORDER BY score DESC, CASE feature {_POSITION} END) - 1 AS r FROM s") + f"""
SELECT feature, ROUND(AVG(r), 6) AS avg_rank FROM k GROUP BY feature ORDER BY avg_rank, CASE feature {_POSITION} END LIMIT 3""")
def fs4(spark, sf):
    names = [*OBS_FLAGS, *OBS_MEASURES]
    scores = select.feature_scores(fx.obs(spark, sf), names, discrete=[*OBS_FLAGS, "m1"])
    return select.aggregate_ranks(scores, select.default_top(len(names))).withColumn("avg_rank", F.round("avg_rank", 6))


def _folded(spark, sf, source: str, k: int):
    """The rows with folds, written once: what reads them has a short plan."""
    return compact(features.stratified_folds(fx.fact(spark, sf, source), "patient_id", k=k))


@query("fs5_genetic")
def fs5(spark, sf):
    data = _folded(spark, sf, "diabetes", 3).persist()
    search = GeneticSearch(SYMPTOMS)
    chosen, fitness = search.run(data)
    data.unpersist()
    return literal_rows(spark, [(f, i, fitness) for i, f in enumerate(chosen)], "feature string, position int, fitness double")


@query("fs5b_history")
def fs5b(spark, sf):
    data = _folded(spark, sf, "autism", 3).persist()
    search = GeneticSearch([*AQ_ITEMS, "jaundice", "family_asd"])
    search.run(data)
    data.unpersist()
    return search.history_table(data)


@query("fs6_compare")
def fs6(spark, sf):
    data = _folded(spark, sf, "diabetes", 5).persist()
    ranked = select.aggregate_ranks(select.feature_scores(data, SYMPTOMS, discrete=SYMPTOMS), select.default_top(len(SYMPTOMS)))
    chosen, _ = GeneticSearch(SYMPTOMS).run(data)
    subsets = {"Baseline (All)": SYMPTOMS, "Heuristic": [r["feature"] for r in ranked.collect()], "Genetic": list(chosen)}
    out = models.compare_subsets(data, subsets)
    data.unpersist()
    return out


# --- models ---

_CLASSIFIED = {"autism": ["age", "gender", *AQ_ITEMS, "jaundice", "family_asd"], "diabetes": ["age", "gender", *SYMPTOMS], "stroke": [*STROKE_FEATURES, "bmi"]}


def _classified(spark, sf, source: str):
    """(training rows with folds, test rows, names of all prepared features): one-hot columns and medians from training rows."""
    joined = cut_lineage(fx.fact(spark, sf, source).join(fx.dim_patient(spark, sf), "patient_id"))  # read by each step below
    rows = features.stratified_split(joined, "patient_id")
    names = _CLASSIFIED[source]
    if source == "stroke":
        train = rows.where("split = 'train'")
        rows = rows.withColumn("bracket", clean.age_bracket("age"))
        rows = clean.MedianImputer("bmi", "bracket").fit(rows.where("split = 'train'")).transform(rows)
        onehot = OneHot(["work_type", "smoking_status"]).fit(train)
        rows, names = onehot.transform(rows), [*names, *onehot.names]
    rows = cut_lineage(rows.select("patient_id", "label", "split", *[F.col(f"`{c}`").cast("double").alias(_plain(c)) for c in names]))
    train = features.stratified_folds(rows.where("split = 'train'"), "patient_id", k=5, seed=7)
    return train, rows.where("split = 'test'"), [_plain(c) for c in names]


def _plain(name: str) -> str:
    return "".join(c if c.isalnum() else "_" for c in name)


def _evaluated(spark, sf, names: list[str], source: str = "stroke", rounds: int = 100, trees: int = 100):
    """Recipes on one fact table: all prepared features, five folds, training rows raised inside the folds and before the last fit."""
    train, test, features_ = _classified(spark, sf, source)
    chosen = {n: r for n, r in models.recipes(rounds=rounds, trees=trees).items() if n in names}
    return models.train_and_evaluate(train, test, features_, chosen, folds=5, oversample="patient_id").results


@query("ml1_logistic")
def ml1(spark, sf):
    return _evaluated(spark, sf, ["Logistic Regression"])


@query("ml2_tree")
def ml2(spark, sf):
    return _evaluated(spark, sf, ["Decision Tree"])


@query("ml3_forest")
def ml3(spark, sf):
    return _evaluated(spark, sf, ["Random Forest"])


@query("ml4_boosting")
def ml4(spark, sf):
    return _evaluated(spark, sf, ["Boosted Trees"])


@query("ml5_boosting_wide")
def ml5(spark, sf):
    return _evaluated(spark, sf, ["Boosted Trees (leaf-wise)"])


def _members(spark, sf):
    train, test, names = _classified(spark, sf, "stroke")
    scaler = Scaler([n for n in names if n in ("age", "avg_glucose_level", "bmi")]).fit(train)
    train, test = scaler.transform(train), scaler.transform(test)
    prepared = compact(models.prepare(train, names, keep=["fold"]))
    return prepared, models.prepare(test, names, train=train)


@query("ml6_svm")
def ml6(spark, sf):
    prepared, held = _members(spark, sf)
    fitted = models.fit(models.base_recipes()["svm"], prepared)
    return evaluate.full_evaluation(models.predictions_of(fitted, held), ["model"])


@query("ml7_naive_bayes")
def ml7(spark, sf):
    prepared, held = _members(spark, sf)
    fitted = models.fit(models.base_recipes()["nb"], prepared)
    return evaluate.full_evaluation(models.predictions_of(fitted, held), ["model"])


@query("ml8_voting")
def ml8(spark, sf):
    prepared, held = _members(spark, sf)
    fitted = models.fit_members(prepared, models.base_recipes())
    both = union_all([models.predictions_of(models.Voting(fitted, soft), held) for soft in (True, False)])
    return evaluate.full_evaluation(both, ["model"])


@query("ml9_stacking")
def ml9(spark, sf):
    prepared, held = _members(spark, sf)
    stacked = models.fit_stacking(prepared, models.base_recipes(), folds=5)
    return evaluate.full_evaluation(models.predictions_of(stacked, held), ["model"])


def _all_models(spark, sf, sources=tuple(_CLASSIFIED), **sizes):
    """All recipes on each fact table; the tables run side by side."""
    names = list(models.recipes())
    out = models.parallel([lambda source=source: _evaluated(spark, sf, names, source, **sizes) for source in sources])
    return union_all([rows.select(F.lit(source).alias("dataset"), "*") for source, rows in zip(sources, out)])


@query("ml10_train_evaluate")
def ml10(spark, sf):
    return _all_models(spark, sf)


# --- explanations ---

def _forest(spark, sf, source: str, names: list[str]):
    data = models.prepare(fx.fact(spark, sf, source), names)
    return RandomForestClassifier(numTrees=100, maxDepth=4, labelCol="label", featuresCol=models.FEATURES, weightCol=models.WEIGHT, seed=42).fit(data)


@query("xa1_tree_importance")
def xa1(spark, sf):
    return explain.tree_importance(_forest(spark, sf, "diabetes", SYMPTOMS), SYMPTOMS, fx.fact(spark, sf, "diabetes"))


_FLAGS = ["f1", "f2", "f3"]
_VOTES = {**{f: f"{{}}.{f}" for f in OBS_FLAGS}, "m1": "CASE WHEN {}.m1 > 25 THEN 1 ELSE 0 END", "m2": "CASE WHEN {}.m2 > 38000 THEN 1 ELSE 0 END"}


def _permutation_sql(names, least: int) -> str:
    """Rows numbered by hash, ten keyed permutations of the numbers, and one vote after the other borrowed from the permuted row."""
    numbered = (f"SELECT label, {', '.join(names)}, ROW_NUMBER() OVER (ORDER BY {sql_hash(LINE_KEY)}) - 1 AS i, COUNT(*) OVER () AS n, "
                "CAST(FLOOR(SQRT(COUNT(*) OVER () - 1)) AS BIGINT) + 1 AS a FROM obs")
    first, more = (explain.permuted_position(x, "a", "((n + a - 1) // a)", "r", 42, "//") for x in ("i", "v"))
    moved = (f"SELECT *, list_reduce(list_concat([{first}], range(1, 34)), lambda v, s: CASE WHEN v < n THEN v ELSE {more} END) AS d "
             "FROM h, (SELECT UNNEST(range(1, 11)) AS r)")
    own = " + ".join(_VOTES[f].format("x") for f in names)
    cases = " UNION ALL ".join(
        f"SELECT '{f}' AS feature, x.r, x.label, CASE WHEN {' + '.join(_VOTES[g].format('y' if g == f else 'x') for g in names)} >= {least} THEN 1 ELSE 0 END AS p "
        "FROM v x JOIN h y ON y.i = x.d" for f in names)
    return with_ctes("obs", h=numbered, v=moved) + f"""
SELECT feature, ROUND(AVG(d), 8) AS importance_mean, ROUND(STDDEV_POP(d), 8) AS importance_std FROM (
 SELECT feature, (SELECT AVG(CASE WHEN (CASE WHEN {own} >= {least} THEN 1 ELSE 0 END) = label THEN 1.0::DOUBLE ELSE 0 END) FROM h x) - AVG(CASE WHEN p = label THEN 1.0::DOUBLE ELSE 0 END) AS d
 FROM ({cases}) GROUP BY feature, r) GROUP BY feature"""


def _permutation(spark, sf, names, least: int):
    def predict(df):
        return df.withColumn("prediction", F.when(_votes(names) >= least, 1).otherwise(0))
    out = explain.permutation_importance(fx.obs(spark, sf), KEYS, names, predict, repeats=10)
    return out.withColumns({c: F.round(c, 8) for c in ("importance_mean", "importance_std")})


@query("xa2_permutation", _permutation_sql(_FLAGS, 2))
def xa2(spark, sf):
    """Three of the flags, by a predictor that reads these; ``xa2b_permutation_all`` has all six features."""
    return _permutation(spark, sf, _FLAGS, 2)


@query("xa2b_permutation_all", _permutation_sql([*OBS_FLAGS, *OBS_MEASURES], 3))
def xa2b(spark, sf):
    """All six features of the observations, by a predictor that reads each of them."""
    return _permutation(spark, sf, [*OBS_FLAGS, *OBS_MEASURES], 3)


def _votes(names):
    """One vote for each flag that is set and each measure above its centre."""
    centres = {"m1": 25.0, "m2": 38000.0}
    return sum((F.when(F.col(c) > centres.get(c, 0.0), 1).otherwise(0) for c in names), F.lit(0))


@query("xa3_shap")
def xa3(spark, sf):
    fact = fx.fact(spark, sf, "diabetes")
    values = explain.shap_values(_forest(spark, sf, "diabetes", SYMPTOMS), fact, SYMPTOMS, ["patient_id"])
    return explain.mean_abs_shap(values, SYMPTOMS)


@query("xa4_local_surrogates")
def xa4(spark, sf):
    rows = _stroke_rows(spark, sf)
    names = ["age", "hypertension", "heart_disease", "avg_glucose_level"]
    scaler = Scaler(names).fit(rows)
    fitted = models.fit(models.base_recipes()["lr"], models.prepare(rows, names))

    def predict(df):
        return fitted.transform(models.assembler(names).transform(df)).drop(models.FEATURES)
    return explain.local_surrogates(rows, names, scaler.mean, scaler.std, predict, ["patient_id"], samples=5000)


# --- rules ---

_RULE_SQL = {
    "stroke": [("STR-001", "age >= 65 AND hypertension = 1", 0.88, True), ("STR-002", "avg_glucose_level >= 200 AND age >= 55", 0.82, True),
               ("STR-003", "heart_disease = 1 AND hypertension = 1", 0.9, True), ("STR-004", "bmi >= 30 AND avg_glucose_level >= 150 AND age >= 50", 0.75, False)],
    "diabetes": [("DIA-001", "polyuria = 1 AND polydipsia = 1", 0.92, True), ("DIA-002", "polyuria = 1 AND sudden_weight_loss = 1 AND polyphagia = 1", 0.95, True),
                 ("DIA-003", "age >= 45 AND obesity = 1", 0.75, False), ("DIA-004", f"{' + '.join(SYMPTOMS)} >= 5", 0.85, True)],
    "autism": [("AUT-001", "aq_score >= 6", 0.95, True), ("AUT-002", "aq_score < 6", 0.9, False), ("AUT-003", "family_asd = 1 AND aq_score >= 4", 0.8, False),
               ("AUT-004", "jaundice = 1 AND aq_score >= 5", 0.7, False)],
}


def _joined_fact(spark, sf, source):
    return fx.fact(spark, sf, source).join(fx.dim_patient(spark, sf), "patient_id")


@query("xa5_rules", with_ctes(*fx.FACTS) + " UNION ALL ".join(
    f"SELECT f.patient_id, '{rid}' AS rule_id, {conf}::DOUBLE AS confidence, {str(pos).upper()} AS positive FROM fact_{s} f JOIN dim_patient d ON d.patient_id=f.patient_id WHERE {cond}"
    for s, rs in _RULE_SQL.items() for rid, cond, conf, pos in rs))
def xa5(spark, sf):
    chosen = {"autism": rule_sets.autism(), "diabetes": rule_sets.diabetes(), "stroke": rule_sets.stroke()}
    return union_all([rules.fired_rules(_joined_fact(spark, sf, s), r, ["patient_id"]) for s, r in chosen.items()]).select(
        "patient_id", "rule_id", "confidence", "positive")


_FIRED = {s: " + ".join(f"CASE WHEN {c} THEN 1 ELSE 0 END" for _, c, _, _ in rs) for s, rs in _RULE_SQL.items()}
_POS = {s: " OR ".join(f"COALESCE({c}, FALSE)" for _, c, _, p in rs if p) for s, rs in _RULE_SQL.items()}


@query("xa6_agreement", with_ctes(*fx.FACTS) + " UNION ALL ".join(
    f"""SELECT '{s}' AS source, patient_id, n_fired, rule_positive, CASE WHEN n_fired = 0 THEN TRUE ELSE (label = 1) = rule_positive END AS agrees FROM (
 SELECT f.patient_id, label, CAST({_FIRED[s]} AS INT) AS n_fired, ({_POS[s]}) AS rule_positive FROM fact_{s} f JOIN dim_patient d ON d.patient_id=f.patient_id)""" for s in _RULE_SQL))
def xa6(spark, sf):
    chosen = {"autism": rule_sets.autism(), "diabetes": rule_sets.diabetes(), "stroke": rule_sets.stroke()}
    return union_all([rules.with_agreement(_joined_fact(spark, sf, s), r, "label").select(F.lit(s).alias("source"), "patient_id", "n_fired", "rule_positive", "agrees")
                      for s, r in chosen.items()])


@query("xa6b_report", with_ctes("fact_stroke") + f"""
SELECT patient_id, md5('{'=' * 60}' || chr(10) || '  CLINICAL DECISION SUPPORT — STROKE' || chr(10) || '{'=' * 60}' || chr(10) || chr(10) || '  ML Model Prediction: HIGH RISK' || chr(10)
 || '  ML Confidence: 75.0%' || chr(10) || chr(10) || '  No clinical rules triggered.' || chr(10) || chr(10) || chr(10) || '{'=' * 60}') AS report
FROM (SELECT f.patient_id, {_FIRED['stroke']} AS n FROM fact_stroke f JOIN dim_patient d ON d.patient_id=f.patient_id) WHERE n = 0""")
def xa6b(spark, sf):
    scored = _joined_fact(spark, sf, "stroke").withColumns({"prediction": F.lit(1), "probability": F.lit(0.75)})
    judged = rules.with_agreement(scored, rule_sets.stroke()).where("n_fired = 0")
    return judged.select("patient_id", F.md5(rules.explanation(judged, "stroke")).alias("report"))


@query("xa6c_report_all")
def xa6c(spark, sf):
    """Reports of all rows, with fired rules and both verdicts; the prediction is each row's own. ``xa6b_report`` and its SQL
    hold the rows without a fired rule only."""
    # stands for a model's score; not made of the rules, so that both verdicts occur
    risk = F.lit(0.05) + F.col("age") / 200.0 + F.lit(0.3) * F.col("ever_married")
    scored = _joined_fact(spark, sf, "stroke").withColumn("probability", risk).withColumn("prediction", F.when(F.col("probability") > 0.5, 1).otherwise(0))
    judged = rules.with_agreement(scored, rule_sets.stroke())
    return judged.select("patient_id", "prediction", "probability", "n_fired", "agrees", rules.explanation(judged, "stroke").alias("report"))


# --- serving and files ---

@query("sv1_score")
def sv1(spark, sf):
    rows = _stroke_rows(spark, sf)
    scaler = Scaler(["age", "avg_glucose_level"]).fit(rows)
    inputs = ["age__scaled", "avg_glucose_level__scaled", "hypertension", "heart_disease"]
    stages = [models.scaling_stage(scaler), models.assembler(inputs), LogisticRegression(labelCol="label", featuresCol=models.FEATURES, regParam=0.01)]
    path = shared_dir(spark, "model")
    models.save_model(Pipeline(stages=stages).fit(rows.select("label", "age", "avg_glucose_level", "hypertension", "heart_disease")), path)
    return serve.score(rows, models.load_model(path), ["age", "avg_glucose_level", "hypertension", "heart_disease"], ["patient_id"])


_REG = "SELECT CAST(o_custkey AS VARCHAR) AS name, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS seq, 'v' || o_orderkey AS version, 'models/' || o_orderkey AS path FROM orders"


@query("sv2_registry", f"WITH r AS ({_REG}) SELECT name, version, path, seq FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY name ORDER BY seq DESC) AS k FROM r) WHERE k = 1")
def sv2(spark, sf):
    return serve.active_versions(_registry(spark, sf))


@query("sv2b_rollback", f"""WITH r AS ({_REG}), t AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY name ORDER BY seq DESC) AS k, COUNT(*) OVER (PARTITION BY name) AS n FROM r)
SELECT name, version, path, CASE WHEN k = 2 THEN n + 1 ELSE seq END AS seq FROM t WHERE k = CASE WHEN n > 1 AND CAST(name AS BIGINT) % 2 = 0 THEN 2 ELSE 1 END""")
def sv2b(spark, sf):
    registry = _registry(spark, sf)
    even = registry.where(F.col("name").cast("bigint") % 2 == 0).select("name").distinct()
    return serve.active_versions(serve.roll_back_many(registry, even))


def _registry(spark, sf):
    orders = fx.table(spark, sf, "orders")
    seq = F.row_number().over(W.partitionBy("o_custkey").orderBy("o_orderkey")).cast("bigint")
    return orders.select(F.col("o_custkey").cast("string").alias("name"), seq.alias("seq"), F.concat(F.lit("v"), F.col("o_orderkey").cast("string")).alias("version"),
                         F.concat(F.lit("models/"), F.col("o_orderkey").cast("string")).alias("path"), F.lit("register").alias("action"))


@query("src1_csv_tokens", """SELECT c_custkey, CASE WHEN c_custkey % 10 IN (0, 1, 2) THEN NULL ELSE c_acctbal END AS balance,
 CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_mktsegment END AS segment FROM customer""")
def src1(spark, sf):
    k = F.col("c_custkey")
    messy = fx.table(spark, sf, "customer").select(
        "c_custkey", F.when(k % 10 == 0, "N/A").when(k % 10 == 1, " ? ").when(k % 10 == 2, "not a number").otherwise(F.col("c_acctbal").cast("string")).alias("balance"),
        F.when(k % 7 == 0, "None").otherwise(F.col("c_mktsegment")).alias("segment"))
    path = shared_dir(spark, "csv")
    files.write_table(messy, path, "csv")
    return files.read_raw_csv(spark, path, ["c_custkey", "balance", "segment"], {"c_custkey": "bigint", "balance": "double"})


@query("src2_record_files", f"""SELECT record_no, TRUE AS whole, age, CAST(label AS TINYINT) AS label FROM (
 SELECT *, ROW_NUMBER() OVER (PARTITION BY c_custkey % 8 ORDER BY c_custkey) AS record_no FROM ({rendered.attributes_sql(rendered.STROKE)}))""")
def src2(spark, sf):
    path = shared_dir(spark, "records")
    notes = rendered.stroke(spark, sf).withColumn("ward", F.pmod("c_custkey", F.lit(8)))
    files.write_records(notes, "text", "c_custkey", path, by="ward")
    return intake.stroke_notes(files.read_records(spark, path), keep=["record_no", "whole"], impute=False).select("record_no", "whole", "age", "label")


_LOADED = {"dim_patient": ["age", "gender"], "fact_autism": [*AQ_ITEMS, "jaundice", "family_asd", "label"], "fact_diabetes": [*SYMPTOMS, "label"],
           "fact_stroke": ["hypertension", "heart_disease", "avg_glucose_level", "bmi", "label"]}


@query("snk2_load_star", with_ctes(*fx.FACTS) + " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, patient_id, '{c}' AS column_name, ROUND(CAST({c} AS DOUBLE), 8) AS value FROM {t}" for t, cs in _LOADED.items() for c in cs))
def snk2(spark, sf):
    path = shared_dir(spark, "star")
    built = fx.star(spark, sf)
    files.load_star(built, path)
    files.load_star(built, path)
    back = files.read_star(spark, path, list(built.facts))
    tables = {"dim_patient": back.dim, **back.facts}
    return union_all([to_long(tables[t], cs, ["patient_id"], "column_name").select(
        F.lit(t).alias("table_name"), "patient_id", "column_name", F.round("value", 8).alias("value")) for t, cs in _LOADED.items()])


@query("snk3_metrics_csv", with_ctes("pred", cm=_CM.format(g="model")) + "SELECT model, tn, fp, fn, tp, " + ", ".join(f"ROUND({e}, 4) AS {n}" for n, e in METRICS.items()) + " FROM cm")
def snk3(spark, sf):
    path = shared_dir(spark, "metrics")
    files.write_metrics_csv(evaluate.metrics(fx.predictions(spark, sf), ["model"], 4), path)
    back = files.read_raw_csv(spark, path, ["model", "tn", "fp", "fn", "tp", *evaluate.metric_columns()],
                              {**{c: "bigint" for c in ("tn", "fp", "fn", "tp")}, **{c: "double" for c in evaluate.metric_columns()}})
    return back


@query("snk1_silver_table", "SELECT COUNT(*) AS n, ROUND(SUM(c_acctbal), 2) AS balance FROM customer")
def snk1(spark, sf):
    path = shared_dir(spark, "silver")
    files.write_table(fx.table(spark, sf, "customer"), path)
    return files.read_table(spark, path).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("c_acctbal"), 2).alias("balance"))


@query("snk4_split_tables", with_ctes("obs", r=_RANKED) + "SELECT split, label, COUNT(*) AS n FROM (SELECT label, CASE WHEN r < ROUND(n*0.2) THEN 'test' ELSE 'train' END AS split FROM r) GROUP BY split, label")
def snk4(spark, sf):
    path = shared_dir(spark, "split")
    files.write_split(features.stratified_split(fx.obs(spark, sf), KEYS), path)
    parts = [files.read_split(spark, path, p).select(F.lit(p).alias("split"), "label") for p in ("train", "test")]
    return union_all(parts).groupBy("split", "label").agg(F.count(F.lit(1)).alias("n"))


@query("src4_sql", """SELECT d.source_dataset AS cohort, COUNT(*) AS n, CAST(SUM(CAST(o_totalprice AS DECIMAL(18, 2))) AS DOUBLE) AS paid FROM (SELECT c_custkey, CASE WHEN c_mktsegment IN ('AUTOMOBILE','BUILDING') THEN 'autism'
 WHEN c_mktsegment='FURNITURE' THEN 'diabetes' ELSE 'stroke' END AS source_dataset FROM customer) d JOIN orders ON o_custkey = d.c_custkey GROUP BY 1""")
def src4(spark, sf):
    create_views({"v_patient": fx.dim_patient(spark, sf), "v_orders": fx.table(spark, sf, "orders")})
    return spark.sql("SELECT source_dataset AS cohort, COUNT(*) AS n, CAST(SUM(CAST(o_totalprice AS DECIMAL(18, 2))) AS DOUBLE) AS paid FROM v_patient JOIN v_orders ON o_custkey = patient_id GROUP BY source_dataset")


@query("set1_union_all", "SELECT 'customer' AS kind, c_custkey AS id, c_acctbal AS amount FROM customer UNION ALL SELECT 'order', o_orderkey, o_totalprice FROM orders")
def set1(spark, sf):
    customers = fx.table(spark, sf, "customer").select(F.lit("customer").alias("kind"), F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("amount"))
    orders = fx.table(spark, sf, "orders").select(F.lit("order").alias("kind"), F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("amount"))
    return union_all([customers, orders])


@query("prd1_predicates", """SELECT o_orderkey FROM orders WHERE o_totalprice BETWEEN 1000 AND 200000 AND o_orderstatus IN ('F', 'O') AND o_orderpriority NOT IN ('1-URGENT') AND o_custkey IS NOT NULL AND o_custkey >= 10""")
def prd1(spark, sf):
    orders = fx.table(spark, sf, "orders")
    return orders.where(F.col("o_totalprice").between(1000, 200000) & F.col("o_orderstatus").isin("F", "O") & ~F.col("o_orderpriority").isin("1-URGENT")
                        & F.col("o_custkey").isNotNull() & (F.col("o_custkey") >= 10)).select("o_orderkey")
