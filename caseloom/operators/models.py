"""Classifiers on Spark ML: single models, voting, stacking, cross-validated training and evaluation."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml import Estimator, Model, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier, LinearSVC, LogisticRegression, NaiveBayes, RandomForestClassifier)
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom.operators import boosting, evaluate
from caseloom.operators.boosting import Booster, Growth
from caseloom.operators.features import Scaler, class_weights, smote, smote_folds
from caseloom.operators.reshape import literal_rows, union_all
from caseloom.session import MOST_ROWS, compact, cut_lineage, partitions_for

KERNEL_FEATURES = 256
#: rows whose random features a Python worker holds at once when it scores
ROWS_AT_ONCE = 1024
#: fits over random features that run side by side: each keeps rows x KERNEL_FEATURES numbers in memory
FITS_AT_ONCE = 3
FEATURES = "features"
WEIGHT = "weight"


def assembler(features: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol=FEATURES, handleInvalid="keep")


def scaling_stage(scaler: Scaler, suffix: str = "__scaled") -> SQLTransformer:
    """The fitted scaler as a stage that is saved with the pipeline; scaled columns get a suffix."""
    parts = [f"(CAST(`{c}` AS DOUBLE) - {scaler.mean[c]!r}D) / {scaler.std[c]!r}D AS `{c}{suffix}`" for c in scaler.columns]
    return SQLTransformer(statement=f"SELECT *, {', '.join(parts)} FROM __THIS__")


@dataclass(frozen=True)
class Recipe:
    """A named classifier: how to build its estimator for a training set of n rows, and whether rows are weighted."""

    name: str
    build: Callable[[int], Estimator] | None = None
    weighted: bool = True
    #: number of random features of a Gaussian kernel under the classifier
    kernel: int | None = None
    #: boosted recipes: all training sets of all such recipes grow together
    growth: Growth | None = None


def logistic(c: float = 1.0, iterations: int = 200) -> Callable[[int], Estimator]:
    """Ridge-penalised logistic regression; C is the inverse penalty on the summed loss (balanced weights sum to n)."""
    return lambda n: LogisticRegression(regParam=1.0 / (c * max(n, 1)), elasticNetParam=0.0, standardization=False, maxIter=iterations)


def recipes(seed: int = 42, rounds: int = 100, trees: int = 100) -> dict[str, Recipe]:
    """The compared classifiers; the two boosted ones grow level by level and best leaf first."""
    entries = [
        Recipe("Logistic Regression", logistic(0.1)),
        Recipe("Decision Tree", lambda n: DecisionTreeClassifier(maxDepth=7, minInstancesPerNode=5, seed=seed)),
        # each row keeps its node in each tree, so that a level does not walk down all trees again
        Recipe("Random Forest", lambda n: RandomForestClassifier(numTrees=trees, maxDepth=8, minInstancesPerNode=2, featureSubsetStrategy="sqrt", seed=seed,
                                                                 cacheNodeIds=True)),
        *[Recipe(g.name, growth=g) for g in (boosting.level_wise(rounds=rounds, seed=seed), boosting.leaf_wise(rounds=rounds, seed=seed))],
    ]
    return {r.name: r for r in entries}


def base_recipes(seed: int = 42) -> dict[str, Recipe]:
    """The members of the ensembles: logistic regression, a support vector machine with a Gaussian kernel, Gaussian naive Bayes."""
    entries = [
        Recipe("lr", logistic(1.0)),
        Recipe("svm", lambda n: LinearSVC(regParam=1.0 / max(n, 1), maxIter=100, tol=1e-5, standardization=False), kernel=KERNEL_FEATURES),
        Recipe("nb", lambda n: NaiveBayes(modelType="gaussian"), weighted=False),
    ]
    return {r.name: r for r in entries}


@dataclass
class Fitted:
    """A fitted classifier: ``transform`` adds the probability of class 1 and the 0/1 prediction."""

    name: str
    model: Model
    calibration: Model | None = None

    def transform(self, df: DataFrame, probability: str = "probability", prediction: str = "prediction") -> DataFrame:
        kept = df.columns
        raw = {"rawPrediction": f"_raw_{self.name}", "prediction": f"_pred_{self.name}", "probability": f"_prob_{self.name}"}
        scored = self.model.transform(df, {self.model.getParam(f"{p}Col"): c for p, c in raw.items() if self.model.hasParam(f"{p}Col")})
        if self.calibration is not None:
            margin = scored.withColumn("_margin", vector_to_array(raw["rawPrediction"])[1])
            coefficient, intercept = float(self.calibration.coefficients[0]), float(self.calibration.intercept)
            p = 1.0 / (1.0 + F.exp(-(F.lit(coefficient) * F.col("_margin") + F.lit(intercept))))
            return margin.select(*kept, p.alias(probability), F.col(raw["prediction"]).cast("int").alias(prediction))
        return scored.select(*kept, vector_to_array(raw["probability"])[1].alias(probability), F.col(raw["prediction"]).cast("int").alias(prediction))


@dataclass
class GaussianFeatures:
    """Random Fourier features: their inner products approach exp(-gamma |x - y|^2), so a linear margin over them is one of that kernel."""

    weights: np.ndarray
    offsets: np.ndarray

    @classmethod
    def of(cls, prepared: DataFrame, size: int, seed: int = 42, gamma: float | None = None) -> GaussianFeatures:
        """``gamma`` is 1 / (number of features * variance of all entries), taken in one scan, unless given."""
        values = vector_to_array(FEATURES)
        row = prepared.agg(F.max(F.size(values)).alias("d"), F.avg(F.aggregate(values, F.lit(0.0), lambda t, v: t + v) / F.size(values)).alias("m"),
                           F.avg(F.aggregate(values, F.lit(0.0), lambda t, v: t + v * v) / F.size(values)).alias("q")).first()
        width = row["d"] or 1
        if gamma is None:
            variance = (row["q"] or 0.0) - (row["m"] or 0.0) ** 2
            gamma = 1.0 / (width * variance) if variance > 0 else 1.0
        draw = np.random.default_rng(seed)
        return cls(draw.normal(0.0, np.sqrt(2 * gamma), (width, size)), draw.uniform(0, 2 * np.pi, size))

    def map(self, x: np.ndarray) -> np.ndarray:
        out = x @ self.weights
        out += self.offsets
        np.cos(out, out=out)
        out *= np.sqrt(2.0 / len(self.offsets))
        return out

    def transform(self, df: DataFrame, out: str) -> DataFrame:
        @F.arrow_udf("array<double>")
        def mapped(values: pa.Array) -> pa.Array:
            found = self.map(_matrix(values))
            ends = np.arange(len(found) + 1, dtype=np.int32) * len(self.offsets)
            return pa.ListArray.from_arrays(pa.array(ends), pa.array(found.ravel()))
        return df.withColumn(out, array_to_vector(mapped(vector_to_array(FEATURES))))

    def margin(self, coefficients: np.ndarray, intercept: float) -> Column:
        """The linear margin over the random features of a row; they are made for few rows at a time and do not leave the worker."""
        @F.arrow_udf("double")
        def margin(values: pa.Array) -> pa.Array:
            x = _matrix(values)
            out = np.empty(len(x))
            for i in range(0, len(x), ROWS_AT_ONCE):
                out[i:i + ROWS_AT_ONCE] = self.map(x[i:i + ROWS_AT_ONCE]) @ coefficients
            return pa.array(out + intercept)
        return margin(vector_to_array(FEATURES))


def _matrix(values: pa.Array) -> np.ndarray:
    return values.flatten().to_numpy(zero_copy_only=False).reshape(len(values), -1) if len(values) else np.zeros((0, 0))


@dataclass
class KernelMargin:
    """A margin over random features, with probabilities from margins that rows were given by models which had not seen them."""

    name: str
    kernel: GaussianFeatures
    model: Model
    calibration: Model

    def transform(self, df: DataFrame, probability: str = "probability", prediction: str = "prediction") -> DataFrame:
        margin = self.kernel.margin(self.model.coefficients.toArray(), float(self.model.intercept))
        coefficient, intercept = float(self.calibration.coefficients[0]), float(self.calibration.intercept)
        p = 1.0 / (1.0 + F.exp(-(F.lit(coefficient) * F.col("_margin") + F.lit(intercept))))
        positive = (F.col("_margin") > 0) & ~F.isnan("_margin")
        return df.withColumn("_margin", margin).select(*df.columns, p.alias(probability), F.when(positive, 1).otherwise(0).alias(prediction))


def _platt(margins: DataFrame, label: str) -> Model:
    """The sigmoid over margins: targets pulled in by one row of each class, each row by its weight."""
    n = {r[0]: r[1] for r in margins.groupBy(F.col(label).cast("int")).count().collect()}
    high, low = (n.get(1, 0) + 1.0) / (n.get(1, 0) + 2.0), 1.0 / (n.get(0, 0) + 2.0)
    target = F.when(F.col(label) == 1, high).otherwise(low)
    both = F.explode(F.array(F.struct(F.lit(1.0).alias("y"), target.alias("share")), F.struct(F.lit(0.0).alias("y"), (1 - target).alias("share"))))
    rows = margins.select("_m", WEIGHT, both.alias("_t")).select("_m", F.col("_t.y").alias("_y"), (F.col("_t.share") * F.col(WEIGHT)).alias("_w"))
    vector = VectorAssembler(inputCols=["_m"], outputCol="_f").transform(rows)
    return LogisticRegression(featuresCol="_f", labelCol="_y", weightCol="_w", standardization=False, maxIter=200, tol=1e-9).fit(vector)


def fit_kernel(recipe: Recipe, prepared: DataFrame, label: str = "label", n: int | None = None, folds: int = 5, gamma: float | None = None) -> KernelMargin:
    """A margin over random features of a Gaussian kernel. Its probabilities come from out-of-fold margins: rows fall in folds by a
    hash of their features, so equal rows share one."""
    size = n if n is not None else prepared.count()
    kernel = GaussianFeatures.of(prepared, recipe.kernel, gamma=gamma)
    own = prepared.coalesce(partitions_for(prepared.sparkSession, size, beside=FITS_AT_ONCE))  # a fit has many small jobs
    own = own.withColumn("_fold", F.pmod(F.xxhash64(vector_to_array(FEATURES)), F.lit(folds)).cast("int"))
    mapped = kernel.transform(own, "_mapped").drop(FEATURES).withColumnRenamed("_mapped", FEATURES).persist()
    classes = {(r["_fold"], r[label]) for r in mapped.select("_fold", label).distinct().collect()}  # two rows a fold

    def margin(rows: DataFrame) -> Model:
        return recipe.build(size).setParams(featuresCol=FEATURES, labelCol=label, weightCol=WEIGHT).fit(rows)

    def held_out(f: int) -> DataFrame:
        rows = mapped.where(F.col("_fold") == f)
        if len({y for fold, y in classes if fold != f}) < 2:  # nothing to learn from the other folds
            return rows.select(label, WEIGHT, F.lit(0.0).alias("_m"))
        model = margin(mapped.where(F.col("_fold") != f))
        out = model.transform(rows, {model.getParam("rawPredictionCol"): "_raw", model.getParam("predictionCol"): "_pred"})
        return out.select(label, WEIGHT, vector_to_array("_raw")[1].alias("_m"))
    *parts, model = parallel([*[lambda f=f: held_out(f) for f in range(folds)], lambda: margin(mapped)], FITS_AT_ONCE)
    calibration = _platt(union_all(parts), label)
    mapped.unpersist()
    return KernelMargin(recipe.name, kernel, model, calibration)


def prepare(df: DataFrame, features: Sequence[str], label: str = "label", train: DataFrame | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """Feature vector, 0/1 label as double and the balanced class weight (from the training rows)."""
    w = {r["class"]: r["weight"] or 0.0 for r in class_weights(df if train is None else train, label).collect()}
    weight = F.when(F.col(label) == 1, F.lit(w[1])).otherwise(F.lit(w[0]))
    kept = [c for c in dict.fromkeys([*keep, label])]
    return assembler(features).transform(df.withColumn(WEIGHT, weight)).select(*kept, WEIGHT, FEATURES)


def fit(recipe: Recipe, prepared: DataFrame, label: str = "label", n: int | None = None) -> Fitted | Boosted | KernelMargin:
    """Fits one recipe. A model without probabilities gets a logistic calibration of its margin."""
    if recipe.kernel is not None:
        return fit_kernel(recipe, prepared, label, n)
    if recipe.growth is not None:
        return Boosted(recipe.name, fit_boosted([recipe], prepared, label=label)[recipe.name, 0])
    size = n if n is not None else prepared.count()
    estimator = recipe.build(size)
    estimator.setParams(featuresCol=FEATURES, labelCol=label)
    if recipe.weighted:
        estimator.setParams(weightCol=WEIGHT)
    model = estimator.fit(prepared)
    calibration = None
    if not model.hasParam("probabilityCol"):
        margins = model.transform(prepared, {model.getParam("rawPredictionCol"): "_raw", model.getParam("predictionCol"): "_pred"})
        vector = VectorAssembler(inputCols=["_m"], outputCol="_f").transform(margins.withColumn("_m", vector_to_array("_raw")[1]))
        calibration = LogisticRegression(featuresCol="_f", labelCol=label, standardization=False).fit(vector)
    return Fitted(recipe.name, model, calibration)


@dataclass
class Boosted:
    """A fitted booster over the feature vector."""

    name: str
    booster: Booster

    def transform(self, df: DataFrame, probability: str = "probability", prediction: str = "prediction") -> DataFrame:
        scored = boosting.scored(df, [self.booster], F.lit(0), vector_to_array(FEATURES), probability, prediction)
        return scored.select(*df.columns, probability, prediction)


def fit_boosted(chosen: Sequence[Recipe], prepared: DataFrame, key: Sequence[str] = (), label: str = "label", training: Column | None = None,
                trainings: int = 1) -> dict[tuple[str, int], Booster]:
    """Boosters by (recipe, training set), all grown in the same scans; bit t of ``training`` marks the rows of set t.
    Rows are drawn by a hash of ``key``, or else of their features."""
    values = vector_to_array(FEATURES)
    first = prepared.select(F.size(values)).first()
    names = [f"_x{i}" for i in range(first[0] if first else 0)]
    rows = prepared.withColumns({"_key": F.xxhash64(*(key or [values])), **{n: values[i] for i, n in enumerate(names)}})
    return boosting.boost(rows, names, [r.growth for r in chosen], "_key", label, training, trainings)


@dataclass
class Voting:
    """Soft voting averages the probabilities; hard voting takes the most frequent prediction and has none."""

    members: list[Fitted]
    soft: bool = True

    @property
    def name(self) -> str:
        return "Voting (Soft)" if self.soft else "Voting (Hard)"

    def transform(self, df: DataFrame) -> DataFrame:
        kept = df.columns
        for m in self.members:
            df = m.transform(df, f"_p_{m.name}", f"_y_{m.name}")
        n = len(self.members)
        if self.soft:
            p = sum((F.col(f"_p_{m.name}") for m in self.members), F.lit(0.0)) / n
            return df.select(*kept, p.alias("probability"), F.when(p > 0.5, 1).otherwise(0).alias("prediction"))
        votes = sum((F.col(f"_y_{m.name}") for m in self.members), F.lit(0))
        return df.select(*kept, F.lit(None).cast("double").alias("probability"), F.when(votes * 2 > n, 1).otherwise(0).alias("prediction"))


@dataclass
class Stacking:
    """A logistic model over the probabilities of the members."""

    members: list[Fitted]
    meta: Fitted
    name: str = "Stacking (LR Meta)"

    @staticmethod
    def inputs(df: DataFrame, members: Sequence[Fitted]) -> DataFrame:
        kept = df.columns
        for m in members:
            df = m.transform(df, f"_p_{m.name}", f"_y_{m.name}")
        return df.select(*kept, *[f"_p_{m.name}" for m in members])

    def transform(self, df: DataFrame) -> DataFrame:
        kept = df.columns
        stacked = self.inputs(df, self.members).withColumnRenamed(FEATURES, "_features")
        stacked = VectorAssembler(inputCols=[f"_p_{m.name}" for m in self.members], outputCol=FEATURES).transform(stacked)
        return self.meta.transform(stacked).withColumnRenamed(FEATURES, "_meta").withColumnRenamed("_features", FEATURES).select(
            *kept, "probability", "prediction")


def parallel(jobs: Sequence[Callable], width: int = 3) -> list:
    """Runs independent Spark jobs side by side; Spark's scheduler shares the executors among them."""
    with ThreadPoolExecutor(max_workers=width) as pool:
        return list(pool.map(lambda job: job(), jobs))


def fits_at_once(spark: SparkSession, rows: int, most: int = 6) -> int:
    """How many fits over ``rows`` rows each run side by side: as many as have three tasks a core, as these are uneven; so what they
    keep in memory follows the cores. Two at least, one beside the other's steps on the driver."""
    return max(2, min(most, 3 * spark.sparkContext.defaultParallelism // max(1, -(-rows // MOST_ROWS))))


def fit_members(prepared: DataFrame, members: dict[str, Recipe], label: str = "label") -> list[Fitted]:
    n = prepared.count()
    return parallel([lambda r=r: fit(r, prepared, label, n) for r in members.values()])


def fit_stacking(prepared: DataFrame, members: dict[str, Recipe], label: str = "label", fold: str = "fold", folds: int = 5) -> Stacking:
    """Members are refitted per fold to give every row an out-of-fold probability; the meta model learns from those."""
    def held_out(f: int) -> DataFrame:
        fitted = fit_members(prepared.where(F.col(fold) != f), members, label)
        return Stacking.inputs(prepared.where(F.col(fold) == f), fitted)
    stacked = union_all([held_out(f) for f in range(folds)])  # members run side by side; folds beside each other would need the memory of all
    meta_rows = VectorAssembler(inputCols=[f"_p_{r.name}" for r in members.values()], outputCol=FEATURES).transform(stacked.drop(FEATURES))
    meta = fit(Recipe("meta", logistic(1.0)), meta_rows, label)
    return Stacking(fit_members(prepared, members, label), meta)


def predictions_of(model, df: DataFrame, label: str = "label", keep: Sequence[str] = ()) -> DataFrame:
    """(model, kept columns, label, probability, prediction)."""
    return model.transform(df).select(F.lit(model.name).alias("model"), *keep, F.col(label).cast("int").alias("label"), "probability", "prediction")


def cross_predictions(prepared: DataFrame, recipe: Recipe, label: str = "label", fold: str = "fold", folds: int = 5,
                      training: DataFrame | None = None) -> DataFrame:
    """Every row scored by a model that did not see its fold. ``training`` replaces the training rows of each fold
    (for example by oversampled ones) and carries the fold they must not be used for in ``fold``."""
    sets = None if training is None else [training.where(F.col(fold) == f) for f in range(folds)]
    return union_all(parallel(_cross_jobs(prepared, recipe, label, fold, folds, sets)))


def _cross_jobs(prepared: DataFrame, recipe: Recipe, label: str, fold: str, folds: int, training: Sequence[DataFrame] | None) -> list[Callable[[], DataFrame]]:
    def one(f: int) -> DataFrame:
        rows = prepared.where(F.col(fold) != f) if training is None else training[f]
        fitted = fit(recipe, rows, label)
        return predictions_of(fitted, prepared.where(F.col(fold) == f), label, [fold])
    return [lambda f=f: one(f) for f in range(folds)]


def _grown(chosen: Sequence[Recipe], prepared: DataFrame, whole: DataFrame, training: DataFrame | None, label: str, fold: str,
           folds: int) -> tuple[dict[str, Boosted], list[DataFrame]]:
    """Boosters of all rows, and predictions of every row by a booster that did not see its fold: one run for all of them."""
    key = [] if training is None else ["base", "copy"]
    if training is None:
        rows, mask = prepared, F.lit((2 << folds) - 1).cast("bigint") - F.expr(f"shiftleft(1L, `{fold}`)")
    else:  # each fold has its own raised rows
        rows = training.select(label, FEATURES, *key, F.expr(f"shiftleft(1L, `{fold}`)").alias("_mask")).unionAll(
            whole.select(label, FEATURES, *key, F.lit(1 << folds).cast("bigint").alias("_mask")))
        mask = F.col("_mask")
    found = fit_boosted(chosen, rows, key, label, mask, folds + 1)
    cross = []
    for r in chosen:
        out = boosting.scored(prepared, [found[r.name, f] for f in range(folds)], F.col(fold), vector_to_array(FEATURES))
        cross.append(out.select(F.lit(r.name).alias("model"), fold, F.col(label).cast("int").alias("label"), "probability", "prediction"))
    return {r.name: Boosted(r.name, found[r.name, folds]) for r in chosen}, cross


@dataclass
class Report:
    """What training and evaluating a set of models produces."""

    results: DataFrame
    predictions: DataFrame
    models: dict[str, Fitted | Boosted] = field(default_factory=dict)


def _gathered(rows: DataFrame, n: int) -> DataFrame:
    """The rows of one training set, kept in partitions of their own: as many as one of the fits side by side can use."""
    spark = rows.sparkSession
    return rows.coalesce(partitions_for(spark, n, beside=fits_at_once(spark, n))).persist()


def train_and_evaluate(train: DataFrame, test: DataFrame, features: Sequence[str], chosen: dict[str, Recipe], label: str = "label",
                       fold: str = "fold", folds: int = 5, cv_metric: str = "f1", oversample: str | None = None) -> Report:
    """Cross-validates each recipe, fits it on all training rows and evaluates it on the test rows.

    ``oversample`` names the key of the rows: the training rows of each fold, and those of the last fit, are then raised to
    equal classes; rows that are scored never are.

    All predictions end in one table, so the metrics of all models come from one aggregate. The prepared training
    rows are read by many jobs and are kept in memory as long as these run.
    """
    spark = train.sparkSession
    prepared = prepare(train, features, label, keep=[fold]).persist()
    whole, training, sets = prepared, None, None
    if oversample is not None:
        both = parallel([lambda: cut_lineage(smote(train, oversample, features, label)),
                         lambda: cut_lineage(smote_folds(train, oversample, features, label, fold, range(folds)).where("part = 'train'").withColumnRenamed("cv_fold", fold))])
        whole = _gathered(prepare(both[0], features, label, keep=["base", "copy"]), both[0].count())
        raised = prepare(both[1], features, label, keep=[fold, "base", "copy"])
        sizes = {r[0]: r[1] for r in both[1].groupBy(fold).count().collect()}  # one row a fold
        sets = [_gathered(raised.where(F.col(fold) == f), sizes.get(f, 0)) for f in range(folds)]
        training = union_all(sets)
    try:
        held = prepare(test, features, label, train)
        n = whole.count()
        scoring = partitions_for(spark, n * len(chosen))  # a task of the scoring job gets all models: few tasks for few rows
        single = [r for r in chosen.values() if r.growth is None]
        grown = [r for r in chosen.values() if r.growth is not None]
        jobs = [lambda: _grown(grown, prepared, whole, training, label, fold, folds)] if grown else []
        jobs += [lambda r=r: fit(r, whole, label, n) for r in single]
        jobs += [job for r in single for job in _cross_jobs(prepared, r, label, fold, folds, sets)]
        done = parallel(jobs, fits_at_once(spark, n))
        first = len(jobs) - len(single) * folds
        fitted, parts = {r.name: m for r, m in zip(single, done[first - len(single):first])}, done[first:]
        if grown:
            boosted, cross = done[0]
            fitted.update(boosted)
            parts += cross
        fitted = {name: fitted[name] for name in chosen}
        cv = union_all(parts).coalesce(scoring)
        scores = evaluate.fold_scores(cv, ["model"], fold, cv_metric).select(
            F.col("model").alias("_m"), F.round("cv_mean", 4).alias("cv_f1"), F.round("cv_std", 4).alias("cv_f1_std"))
        predictions = union_all([predictions_of(m, held, label) for m in fitted.values()]).coalesce(scoring)
        table = evaluate.full_evaluation(predictions, ["model"])
        rows = table.join(scores, table["model"] == scores["_m"]).drop("_m").withColumn("n_features", F.lit(len(features)))
        results = spark.createDataFrame(rows.collect(), rows.schema)  # one row per model
    finally:
        for kept in (prepared, whole, *(sets or [])):
            kept.unpersist()
    return Report(results, predictions, fitted)


def compare_subsets(df: DataFrame, subsets: dict[str, Sequence[str]], label: str = "label", fold: str = "fold", folds: int = 5,
                    recipe: Recipe | None = None) -> DataFrame:
    """Cross-validated weighted F1 (mean and standard deviation) of a forest on each feature subset. The rows are written once in few
    partitions; the forests of all subsets and folds are grown side by side, and one aggregate scores them all."""
    forest = recipe or Recipe("forest", lambda n: RandomForestClassifier(numTrees=100, maxDepth=8, featureSubsetStrategy="sqrt", seed=42))
    used = list(dict.fromkeys(f for features in subsets.values() for f in features))
    rows = compact(df.select(fold, label, *used)).persist()

    def one(name: str, f: int) -> DataFrame:
        prepared = sets[name]
        fitted = fit(forest, prepared.where(F.col(fold) != f), label)
        return predictions_of(fitted, prepared.where(F.col(fold) == f), label, [fold]).withColumn("model", F.lit(name))
    try:
        sets = {name: prepare(rows, features, label, keep=[fold]) for name, features in subsets.items()}
        cv = union_all(parallel([lambda name=name, f=f: one(name, f) for name in subsets for f in range(folds)], 6))
        scores = {r["model"]: r for r in evaluate.fold_scores(cv, ["model"], fold, "weighted_f1").select(
            "model", F.round("cv_mean", 4).alias("m"), F.round("cv_std", 4).alias("s")).collect()}  # one row per subset
    finally:
        rows.unpersist()
    out = [(name, len(features), scores[name]["m"], scores[name]["s"]) for name, features in subsets.items() if name in scores]
    return literal_rows(df.sparkSession, out, "method string, n_features int, cv_f1_mean double, cv_f1_std double")


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
